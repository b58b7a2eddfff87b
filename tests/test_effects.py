"""Two-way effects (X7) and bootstrap intervals of the errors."""

from __future__ import annotations

import numpy as np
import pytest

from panelkit.operators import effects
from panelkit.operators import model as ml

SCHEMA = "State string, Year int, Avg_kWh double, DC_Opened double"


def _panel(keys, years, seed=1, drop=0.0):
    rng = np.random.default_rng(seed)
    a, g = rng.normal(size=keys), rng.normal(size=years)
    rows = []
    for i in range(keys):
        for t in range(years):
            x = rng.normal() + a[i] + g[t]
            y = 1.5 * x + 3 * a[i] - 2 * g[t] + rng.normal()
            if rng.random() >= drop:
                rows.append((f"k{i}", 2000 + t, float(y), float(x)))
    return rows


def _dummies(rows):
    """The same regression by least squares on dummies, with clustered error."""
    keys, years = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    m = np.zeros((len(rows), len(keys) + len(years)))
    for i, r in enumerate(rows):
        m[i, keys.index(r[0])] = m[i, len(keys) + years.index(r[1])] = 1
    y, x = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    clean = lambda v: v - m @ np.linalg.lstsq(m, v, rcond=None)[0]
    y, x = clean(y), clean(x)
    e = x @ y / (x @ x)
    u = y - e * x
    meat = sum((x[c] @ u[c]) ** 2 for c in ([j for j, r in enumerate(rows) if r[0] == k] for k in keys))
    return e, np.sqrt(meat) / (x @ x)


@pytest.mark.parametrize("drop", [0.0, 0.35])
def test_two_way_effect_equals_dummies(spark, drop):
    rows = _panel(23, 9, drop=drop)
    got = effects.two_way_effect(spark.createDataFrame(rows, SCHEMA).repartition(5)).first()
    effect, error = _dummies(rows)
    assert got.n == len(rows) and got.n_keys == 23 and got.n_times == 9
    assert got.effect == pytest.approx(effect, rel=1e-8) and got.std_error == pytest.approx(error, rel=1e-8)


def test_two_way_effect_closed_form_on_a_balanced_panel(spark):
    rows = _panel(12, 6)
    v = np.array([r[2:] for r in rows]).reshape(12, 6, 2)
    v = v - v.mean(axis=1, keepdims=True) - v.mean(axis=0, keepdims=True) + v.mean(axis=(0, 1), keepdims=True)
    got = effects.two_way_effect(spark.createDataFrame(rows, SCHEMA)).first()
    assert got.effect == pytest.approx((v[..., 0] * v[..., 1]).sum() / (v[..., 1] ** 2).sum(), rel=1e-9)


def test_two_way_effect_odd_rows(spark):
    rows = _panel(8, 5)
    odd = [(None, 2000, 1.0, 1.0), ("k0", None, 1.0, 1.0), ("k0", 2050, None, 1.0), ("k0", 2051, 1.0, float("nan")),
           ("k0", 2052, float("inf"), 1.0)]
    plain = effects.two_way_effect(spark.createDataFrame(rows, SCHEMA)).first()
    got = effects.two_way_effect(spark.createDataFrame(rows + odd, SCHEMA)).first()
    assert (got.n, got.n_times) == (plain.n, plain.n_times) and got.effect == pytest.approx(plain.effect, rel=1e-9)
    none = effects.two_way_effect(spark.createDataFrame([], SCHEMA)).first()
    assert tuple(none) == (0, 0, 0, None, None)
    # exposure that is the sum of a key's and a year's part leaves nothing to learn from
    flat = [(k, t, y, float(int(k[1:]) + 10 * t)) for k, t, y, _ in rows]
    assert effects.two_way_effect(spark.createDataFrame(flat, SCHEMA)).first().effect is None
    with pytest.raises(ValueError, match="several rows"):
        effects.two_way_effect(spark.createDataFrame(rows + rows[:1], SCHEMA))


def test_bootstrap_replicates(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(5 + rng.normal()), float(5 + rng.normal())) for i in range(4000)]
    df = spark.createDataFrame(rows + [(9999, None, 1.0), (9998, 1.0, None)], "id int, label double, prediction double")
    reps = ml.bootstrap_metrics(df, ["id"], replicates=30)
    got = {r.replicate: r for r in reps.collect()}
    assert sorted(got) == list(range(30))
    # the same draws whatever the partitions
    again = {r.replicate: r for r in ml.bootstrap_metrics(df.repartition(7), ["id"], replicates=30).collect()}
    for k, r in got.items():
        assert r.n == again[k].n and r.rmse == pytest.approx(again[k].rmse)
    # counts are Poisson(1): mean 1, so replicates hold about all rows, and differ
    assert all(abs(r.n - 4000) < 5 * 4000 ** 0.5 for r in got.values()) and len({r.n for r in got.values()}) > 20
    e = np.array([p - y for _, y, p in rows])
    spread = np.std([r.mae for r in got.values()])
    assert spread == pytest.approx(np.abs(e).std() / 4000 ** 0.5, rel=0.5)
    spans = {r.metric: r for r in ml.error_intervals(df, ["id"], replicates=60).collect()}
    assert set(spans) == set(ml.INTERVAL_METRICS)
    assert spans["rmse"].value == pytest.approx(np.sqrt((e ** 2).mean()))
    assert all(r.low < r.value < r.high for r in spans.values())


def test_bootstrap_of_nothing(spark):
    df = spark.createDataFrame([], "id int, label double, prediction double")
    assert ml.bootstrap_metrics(df, ["id"]).collect() == []
