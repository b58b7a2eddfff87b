"""Simple effect estimates over a panel (X5 group comparison lives in the
catalog; X7 difference-in-differences here).

All inputs are panel rows (keys x years), so the window over a key and the
one-row aggregate are small at any data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.session import materialize


def diff_in_diff(panel: DataFrame, *, key: str = "State", time: str = "Year",
                 outcome: str = "Avg_kWh", exposure: str = "DC_Opened",
                 min_exposure: int = 4, cut: int | None = None) -> DataFrame:
    """One row: mean outcome of treated / control keys before / after ``cut``
    and the difference-in-differences.

    A key is treated when its total exposure over the panel is at least
    ``min_exposure``.  Without ``cut`` the split year is the midpoint of the
    panel's years (rows with ``time > (min + max) / 2`` are "after").
    """
    total = F.sum(exposure).over(Window.partitionBy(key))
    df = panel.withColumn("_treated", total >= min_exposure)
    if cut is None:
        b = panel.agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
        mid = (b.select("lo").scalar() + b.select("hi").scalar()) / 2
        df = df.withColumn("_post", F.col(time) > mid)
    else:
        df = df.withColumn("_post", F.col(time) >= cut)

    def cell(t: bool, p: bool):
        return F.avg(F.when((F.col("_treated") == t) & (F.col("_post") == p), F.col(outcome)))

    out = df.agg(cell(True, False).alias("treated_before"), cell(True, True).alias("treated_after"),
                 cell(False, False).alias("control_before"), cell(False, True).alias("control_after"))
    return out.withColumn("did", (F.col("treated_after") - F.col("treated_before"))
                          - (F.col("control_after") - F.col("control_before")))


def _literals(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def two_way_effect(panel: DataFrame, *, key: str = "State", time: str = "Year", outcome: str = "Avg_kWh",
                   exposure: str = "DC_Opened", tolerance: float = 1e-12, max_rounds: int = 2000) -> DataFrame:
    """X7 as a regression: ``outcome`` on ``exposure`` with an effect for every
    key and every time.  One row: ``n, n_keys, n_times, effect, std_error``
    (clustered by key, no small-sample factor).

    Outcome and exposure are demeaned by key and time in turn until the time
    effects move by less than ``tolerance`` of their spread; one normal equation
    on the remainders gives the effect.  The panel is shuffled once, to one row a
    key holding its times; a round reads those rows and returns one row a time,
    so only the time effects (two numbers a time) reach the driver.

    Rows with a NULL in any of the four columns or a non-finite number are left
    out.  (key, time) must be unique.  Effect and error are NULL where the
    exposure does not vary beyond key and time, or no row is left; no
    convergence in ``max_rounds`` is an error.
    """
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = panel.select(F.col(key).alias("k"), F.col(time).alias("t"), F.col(outcome).cast("double").alias("y"),
                        F.col(exposure).cast("double").alias("x"))
    rows = rows.filter(F.col("k").isNotNull() & F.col("t").isNotNull() & finite("y") & finite("x"))
    # unique (key, time) first: a key then has at most one entry a time
    cells = rows.groupBy("k", "t").agg(F.count(F.lit(1)).alias("n"), F.max("y").alias("y"), F.max("x").alias("x"))
    keys = materialize(cells.groupBy("k").agg(F.max("n").alias("n"), F.collect_list(F.struct("t", "y", "x")).alias("r")),
                       "two_way_rows")
    if (keys.agg(F.max("n")).first()[0] or 1) > 1:
        raise ValueError(f"two_way_effect: several rows of one ({key}, {time})")
    flat = keys.select(F.explode("r").alias("r")).select("r.*")
    start = flat.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("y").alias("sy"),
                                  F.stddev_pop("x").alias("sx")).orderBy("t").collect()  # one row a time
    times = [r.t for r in start]
    spread = [max([1e-300, *[r[c] for r in start]]) for c in ("sy", "sx")]
    place = {t: i for i, t in enumerate(times)}
    gy, gx = [0.0] * len(times), [0.0] * len(times)
    order = F.array(*[F.lit(t) for t in times]) if times else F.array().cast("array<int>")

    def without_means(gy: list[float], gx: list[float]) -> DataFrame:
        """``k, r``: entries with their place, less the time effects, and the means of those."""
        less = keys.select("k", F.transform("r", lambda r: F.struct(
            r.t.alias("t"), r.y.alias("y0"), r.x.alias("x0"),
            (r.y - F.get(_literals(gy), F.array_position(order, r.t).cast("int") - 1)).alias("y"),
            (r.x - F.get(_literals(gx), F.array_position(order, r.t).cast("int") - 1)).alias("x"))).alias("r"))
        mean = lambda c: F.aggregate(F.col(f"r.{c}"), F.lit(0.0), lambda a, v: a + v) / F.size("r")
        return less.select("k", "r", mean("y").alias("ay"), mean("x").alias("ax"))

    for done in range(max_rounds + 1):
        if not times:
            break
        if done == max_rounds:
            raise RuntimeError(f"two_way_effect: not settled after {max_rounds} rounds")
        got = (without_means(gy, gx).select("ay", "ax", F.explode("r").alias("r")).groupBy("r.t")
               .agg(F.avg(F.col("r.y0") - F.col("ay")).alias("y"), F.avg(F.col("r.x0") - F.col("ax")).alias("x"))
               .collect())  # one row a time
        ny, nx = list(gy), list(gx)
        for r in got:
            ny[place[r.t]], nx[place[r.t]] = r.y, r.x
        # the level is the keys' part; only differences between times count
        ny, nx = [v - ny[0] for v in ny], [v - nx[0] for v in nx]
        moved = max(max(abs(a - b) for a, b in zip(new, old)) / s
                    for new, old, s in ((ny, gy, spread[0]), (nx, gx, spread[1])))
        gy, gx = ny, nx
        if moved <= tolerance:
            break

    left = without_means(gy, gx).select("k", "ay", "ax", F.explode("r").alias("r")).select(
        "k", (F.col("r.y") - F.col("ay")).alias("y"), (F.col("r.x") - F.col("ax")).alias("x"))
    per_key = materialize(left.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x") * F.col("y")).alias("xy"),
        F.sum(F.col("x") * F.col("x")).alias("xx")), "two_way_keys")
    # exposure explained by key and time leaves only rounding
    floor = 1e-18 * sum(r.n * spread[1] ** 2 for r in start)
    total = per_key.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_keys"),
                        F.sum("xy").alias("xy"), F.sum("xx").alias("xx"))
    effect = total.select(F.when(F.col("xx") > floor, F.col("xy") / F.col("xx"))).scalar()
    out = per_key.withColumn("_e", effect).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("n_keys"),
        F.lit(len(times)).cast("long").alias("n_times"), F.max("_e").alias("effect"),
        F.sum((F.col("xy") - F.col("_e") * F.col("xx")) ** 2).alias("_meat"), F.sum("xx").alias("_xx"))
    return out.withColumn("std_error", F.sqrt("_meat") / F.when(F.col("_xx") > floor, F.col("_xx"))).drop("_meat", "_xx")
