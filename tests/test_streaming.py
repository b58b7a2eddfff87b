"""File-stream price table: batches, restart from the checkpoint, same
result as the batch operator."""

from __future__ import annotations

from panelkit import schemas as S
from panelkit.operators import panel
from panelkit.sinks import writers
from panelkit.streaming import yearly_prices

COLS = ", ".join(f"{n} {t.simpleString()}" for n, t in S.POWER_FIELDS)


def _year(spark, year, rows):
    return spark.createDataFrame(
        [(f"U{i}", st, year, f"{i}.0", 10.0, sales, cust, price)
         for i, (st, sales, cust, price) in enumerate(rows)], COLS)


def test_stream_resumes_from_checkpoint(spark, scratch):
    src, out, ckpt = scratch("src"), scratch("out"), scratch("ckpt")
    y1 = _year(spark, 2019, [("VA", 500.0, 500.0, 0.10), ("VA", 500.0, 500.0, 0.20),
                             ("TX", 500.0, 10.0, 0.50),            # too few customers
                             ("TX", 600.0, 600.0, 0.30)])
    writers.write_csv(y1.coalesce(1), src + "/2019")
    q = yearly_prices.run_until_caught_up(
        yearly_prices.price_stream(spark, src + "/*", files_per_batch=1), out, ckpt)
    first = {(r.State, r.Year): r.Avg_kWh for r in spark.read.parquet(out).collect()}
    assert first == {("VA", 2019): 0.15000000000000002, ("TX", 2019): 0.3}
    n_batches = len(q.recentProgress)

    # a new yearly file arrives; the restarted query reads only that file and
    # keeps the 2019 state from the checkpoint
    y2 = _year(spark, 2020, [("VA", 500.0, 500.0, 0.40)])
    writers.write_csv(y2.coalesce(1), src + "/2020")
    q2 = yearly_prices.run_until_caught_up(
        yearly_prices.price_stream(spark, src + "/*", files_per_batch=1), out, ckpt)
    second = {(r.State, r.Year): r.Avg_kWh for r in spark.read.parquet(out).collect()}
    assert second == {**first, ("VA", 2020): 0.4}
    assert sum(p["numInputRows"] for p in q2.recentProgress) == 1
    assert n_batches >= 1

    # the stream equals the batch mean over the same filtered rows
    batch = panel.avg_price(y1.unionByName(y2).filter("Customers > 400 AND Sales_MWh > 400"))
    assert {(r.State, r.Year): r.Avg_kWh for r in batch.collect()} == second
