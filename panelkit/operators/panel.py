"""Panel operators: bounds, year spine, entity x year grid, opening counts,
running totals, average prices and the price join.

Scale notes
-----------
* Facility and sales rows are reduced by ``groupBy`` (partial + final hash
  aggregation, so a state holding a third of all rows is pre-aggregated map
  side) *before* any join or window.  Joins and windows therefore only see
  ``states x years`` rows.
* Year bounds are a one-row global aggregate used as a scalar subquery:
  no driver round trip, and the broadcast value has a fixed size of one row.
* The grid is built by exploding ``sequence(lo, hi)`` next to each distinct
  state: no cross join and no driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelkit.session import materialize_all


def year_bounds(df: DataFrame, *, time: str = "Year",
                lo: str = "min_year", hi: str = "max_year") -> DataFrame:
    """A1: one-row table of min and max of ``time`` (one job, not two)."""
    return df.agg(F.min(time).alias(lo), F.max(time).alias(hi))


def _bound(bounds: DataFrame, name: str) -> Column:
    return bounds.select(name).scalar()


def year_spine(bounds: DataFrame, *, lo: str = "min_year", hi: str = "max_year",
               out: str = "Year") -> DataFrame:
    """One row per year in [lo, hi] (end inclusive)."""
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias(out))


def distinct_keys(df: DataFrame, *, key: str = "State") -> DataFrame:
    """Distinct values of ``key`` (NULL kept as a value)."""
    return df.select(key).distinct()


def panel_grid(entities: DataFrame, bounds: DataFrame, *, key: str = "State",
               time: str = "Year", lo: str = "min_year", hi: str = "max_year") -> DataFrame:
    """Every distinct ``key`` paired with every year of ``bounds``."""
    years = F.sequence(_bound(bounds, lo), _bound(bounds, hi))
    return distinct_keys(entities, key=key).select(key, F.explode(years).alias(time))


def event_counts(facilities: DataFrame, *, key: str = "State",
                 event_time: str = "Opening_Year", out: str = "n",
                 sums: tuple[str, ...] = ()) -> DataFrame:
    """(key, event year, n): the one pass over raw event rows.

    Grid, yearly counts and pre-period counts are all derived from this small
    aggregate, so the raw rows are scanned and shuffled once (partial
    aggregation first, so a hot key is reduced map side).  NULL years form
    their own group, so their key still enters the grid.
    """
    return facilities.groupBy(key, event_time).agg(
        F.count(F.lit(1)).alias(out), *[F.sum(c).alias(c) for c in sums])


def _tally(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def openings_by_year(facilities: DataFrame, bounds: DataFrame, *, key: str = "State",
                     event_time: str = "Opening_Year", time: str = "Year",
                     lo: str = "min_year", out: str = "DC_Opened",
                     weight: str | None = None) -> DataFrame:
    """F4 + A3: count of events per (key, year) from the first bound on.

    Rows with a NULL event year fail the predicate and are never counted,
    although their key still enters the grid.  ``weight`` sums a count
    column instead (input already aggregated by :func:`event_counts`).
    """
    return (facilities.filter(F.col(event_time) >= _bound(bounds, lo))
            .groupBy(key, F.col(event_time).alias(time))
            .agg(_tally(weight).alias(out)))


def pre_period_count(facilities: DataFrame, bounds: DataFrame, *, key: str = "State",
                     event_time: str = "Opening_Year", lo: str = "min_year",
                     out: str = "Pre_DC", weight: str | None = None) -> DataFrame:
    """F3 + A2: count of events per key before the first bound."""
    return (facilities.filter(F.col(event_time) < _bound(bounds, lo))
            .groupBy(key).agg(_tally(weight).alias(out)))


def left_join_fill(left: DataFrame, right: DataFrame, on: list[str],
                   fill: dict) -> DataFrame:
    """J2/J3 + F10: left equi join, then fill the right side's NULLs."""
    return left.join(right, on=on, how="left").fillna(fill)


def fill_missing(df: DataFrame, fill: dict) -> DataFrame:
    """per-column NULL replacement."""
    return df.fillna(fill)


def _ordered(key: str, time: str):
    return Window.partitionBy(key).orderBy(time)


def running_total(df: DataFrame, *, key: str = "State", time: str = "Year",
                  value: str = "DC_Opened", base: str | None = None,
                  out: str = "Cumulative_DC") -> DataFrame:
    """W1 (+ P7): ``base + sum(value)`` from the first year to this one.

    Rows frame; equal to the default RANGE frame because (key, time) is unique
    in a panel.
    """
    w = _ordered(key, time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum(value).over(w)
    if base is not None:
        total = F.col(base) + total
    return df.withColumn(out, total)


def cumulative_openings(grid: DataFrame, by_year: DataFrame, pre: DataFrame, *,
                        key: str = "State", time: str = "Year",
                        opened: str = "DC_Opened", base: str = "Pre_DC",
                        out: str = "Cumulative_DC") -> DataFrame:
    """Grid + yearly counts + pre-period baseline -> running facility count."""
    df = left_join_fill(grid, by_year, [key, time], {opened: 0})
    df = left_join_fill(df, pre, [key], {base: 0})
    return running_total(df, key=key, time=time, value=opened, base=base, out=out).drop(base)


def group_mean(df: DataFrame, *, keys: list[str], value: str, out: str) -> DataFrame:
    """A4: unweighted mean per group (NULLs skipped)."""
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def avg_price(sales: DataFrame, *, key: str = "State", time: str = "Year",
              price: str = "Price_Per_kWh", out: str = "Avg_kWh",
              weighted_by: str | None = None, revenue: str | None = None) -> DataFrame:
    """A4: mean price per (key, year).

    Default is the plain mean over utilities; ``weighted_by`` + ``revenue``
    gives the sales-weighted price sum(revenue) / sum(sales) instead.
    """
    if weighted_by is None:
        return group_mean(sales, keys=[key, time], value=price, out=out)
    return sales.groupBy(key, time).agg(
        F.try_divide(F.sum(revenue), F.sum(weighted_by)).alias(out))


def price_integration(panel: DataFrame, prices: DataFrame, *, key: str = "State",
                      time: str = "Year", value: str = "Avg_kWh") -> DataFrame:
    """J4 + F11: keep panel rows that have a non-NULL price.

    The original writes a left join followed by a NULL drop; that is an inner
    join, written as one so the optimizer does not have to discover it.
    """
    return panel.join(prices.filter(F.col(value).isNotNull()), on=[key, time], how="inner")


def cumulative_sum_column(df: DataFrame, *, key: str = "State", time: str = "Year",
                          value: str, base: str | None = None, out: str) -> DataFrame:
    """Running total of any value column (e.g. capacity)."""
    return running_total(df, key=key, time=time, value=value, base=base, out=out)


def cumulative_panel(facilities: DataFrame | None, sales: DataFrame, *, key: str = "State",
                     event_time: str = "Opening_Year", time: str = "Year",
                     price: str = "Price_Per_kWh", counts: DataFrame | None = None,
                     materialize_inputs: bool = True) -> tuple[DataFrame, DataFrame]:
    """(grid with yearly and running counts, average prices).

    Each input is reduced once - events to (key, year, n), sales to the mean
    price per (key, year) - and the bounds come from the price table (same
    years as the sales rows).  Left to itself the optimizer pushes each
    branch's filters and projections into its own copy of the scan, so the
    two small aggregates are materialized and every branch reads them.
    """
    counts = (event_counts(facilities, key=key, event_time=event_time)
              if counts is None else counts)
    prices = avg_price(sales, key=key, time=time, price=price)
    if materialize_inputs:
        # both are bounded by keys x years; written once, read by every branch
        counts, prices = materialize_all(counts, prices, names=("event_counts", "prices"))
    bounds = year_bounds(prices, time=time)
    grid = panel_grid(counts, bounds, key=key, time=time)
    by_year = openings_by_year(counts, bounds, key=key, event_time=event_time, time=time,
                               weight="n")
    pre = pre_period_count(counts, bounds, key=key, event_time=event_time, weight="n")
    return cumulative_openings(grid, by_year, pre, key=key, time=time), prices


def build_panel(facilities: DataFrame | None, sales: DataFrame, *, key: str = "State",
                event_time: str = "Opening_Year", time: str = "Year",
                price: str = "Price_Per_kWh", preceding: int | None = None,
                following: int | None = None, keep_recent: bool = False,
                counts: DataFrame | None = None) -> DataFrame:
    """The flagship panel: bounds -> grid -> openings -> running count ->
    average price -> lag -> recent-activity filter.

    Output: key, time, DC_Opened, Cumulative_DC, Avg_kWh, PrevPrice.
    """
    from panelkit.operators import features
    from panelkit.schemas import RECENT_FOLLOWING, RECENT_PRECEDING

    cum, prices = cumulative_panel(facilities, sales, key=key, event_time=event_time,
                                   time=time, price=price, counts=counts)
    full = price_integration(cum, prices, key=key, time=time)
    lagged = features.lag_feature(full, key=key, time=time)
    rolled = features.rolling_sum(
        lagged, key=key, time=time,
        preceding=RECENT_PRECEDING if preceding is None else preceding,
        following=RECENT_FOLLOWING if following is None else following)
    return features.recent_activity_filter(rolled, drop=not keep_recent)
