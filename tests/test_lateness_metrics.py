import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import DAY, at, rows
from ledgerwatch.operators import lateness, metrics

ARRIVALS = "id LONG, part INT, offset LONG, occurred_at TIMESTAMP_NTZ, arrived_at TIMESTAMP_NTZ"


def arrivals(spark, items):
    return spark.createDataFrame(
        [(i, p, i, t, DAY + timedelta(seconds=7 * i)) for i, (p, t) in enumerate(items)],
        ARRIVALS)


def test_grace_ends_exactly(spark):
    for seen, dropped in (("11:00:30", True), ("11:00:29.999", False)):
        data = arrivals(spark, [(0, at(seen)), (0, at("10:59:00"))])
        out = lateness.late_audit(data, arrival=["offset"], partition="part")
        assert out.filter("id = 1").first().dropped is dropped
        assert out.filter("id = 1").first().window_end == at("11:00:00")


@pytest.mark.parametrize("arrival,slice_len", [
    (["offset"], 7), (["offset"], None), (["arrived_at", "id"], "1 minute")])
def test_stream_time_against_brute_force(spark, arrival, slice_len):
    rnd = random.Random(3)
    items = [(0 if rnd.random() < 0.7 else rnd.randrange(3),
              DAY + timedelta(seconds=20 * i + rnd.randrange(-5000, 5000)))
             for i in range(300)]
    out = lateness.late_audit(arrivals(spark, items), arrival=arrival, partition="part",
                              slice_len=slice_len)
    got = {r.id: r for r in out.collect()}
    assert len(got) == out.count() == 300
    top = {}
    for i, (p, t) in enumerate(items):
        top[p] = max(top.get(p, t), t)
        end = t.replace(minute=0, second=0, microsecond=0) + timedelta(hours=1)
        assert got[i].stream_time == top[p]
        assert got[i].window_end == end
        assert got[i].dropped == (end <= top[p] - timedelta(seconds=30))
    kept = lateness.on_time(arrivals(spark, items), arrival=arrival, partition="part",
                            slice_len=slice_len)
    assert kept.count() == sum(not r.dropped for r in got.values())


def test_stream_time_plan_cuts_partitions(spark, capsys):
    lateness.late_audit(arrivals(spark, [(0, DAY)]), arrival=["offset"],
                        partition="part").explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan
    assert "hashpartitioning(part" in plan and "_slice" in plan


def test_rates(spark):
    data = spark.createDataFrame(
        [("a", at("10:00:00")), ("a", at("10:00:59")), ("a", at("10:01:00")),
         ("b", at("10:00:30"))], "name STRING, ts TIMESTAMP_NTZ")
    assert rows(metrics.rate_per_second(data, "ts", ["name"]), "name", "window_start",
                "rate") == [("a", at("10:00:00"), 2 / 60), ("a", at("10:01:00"), 1 / 60),
                            ("b", at("10:00:00"), 1 / 60)]


def test_counter_resets_and_slices(spark):
    data = spark.createDataFrame(
        [("a", at("10:00:00"), 5.0), ("a", at("10:00:15"), 11.0),
         ("a", at("10:00:30"), 2.0), ("a", at("13:00:00"), 8.0)],
        "name STRING, ts TIMESTAMP_NTZ, total DOUBLE")
    out = metrics.rate_per_second(data, "ts", ["name"], value="total")
    assert rows(out, "window_start", "rate") == [
        (at("10:00:00"), 8.0 / 60), (at("13:00:00"), 6.0 / 60)]


@pytest.mark.parametrize("scale", [1 / 300, 1.0, 1e7])
def test_exact_quantiles(spark, scale):
    rnd = random.Random(5)
    data = spark.createDataFrame(
        [("hot" if rnd.random() < 0.6 else f"g{rnd.randrange(3)}",
          None if rnd.random() < 0.05 else scale * round(rnd.uniform(-50, 300), 1))
         for _ in range(500)] + [("one", 4.0), (None, 1.0), (None, 2.0)],
        "g STRING, v DOUBLE")
    got = metrics.quantiles(data, "v", ["g"], (0.5, 0.95, 0.99, 0.0, 1.0))
    want = data.groupBy("g").agg(*[
        F.percentile("v", q).alias(c) for q, c in (
            (0.5, "p50"), (0.95, "p95"), (0.99, "p99"), (0.0, "p0"), (1.0, "p100"))])
    a = {r.g: r for r in got.collect()}
    b = {r.g: r for r in want.collect()}
    assert a.keys() == b.keys()
    for g in a:
        for c in ("p50", "p95", "p99", "p0", "p100"):
            assert a[g][c] == pytest.approx(b[g][c])


def test_buckets_are_narrow_and_in_order(spark):
    """On every scale a bucket spans little, also with far outliers and odd values."""
    values = [float("-inf"), -1e300, -5.0, -1e-9, -5e-324, 0.0, 5e-324, 1e-9, 0.5, 5.0, 1e9,
              1e300, float("inf"), float("nan")]
    got = [r.b for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                                              "i INT, v DOUBLE")
           .select("i", metrics._magnitude(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got) and len(set(got)) == len(got)
    for low in (1e-6, 1.0, 1e9):
        spread = spark.range(10_000).select(
            metrics._magnitude(F.lit(low) * (1 + F.col("id") / 10_000)).alias("b"))
        assert spread.distinct().count() > 2500


def test_sketched_quantiles(spark):
    out = metrics.quantiles(spark.range(1001).selectExpr("id as v", "1 as g"), "v", ["g"],
                            exact=False).first()
    assert (out.p50, out.p95, out.p99) == (500, 950, 990)


def test_quantiles_of_buckets(spark):
    buckets = spark.createDataFrame(
        [("a", 1.0, 10), ("a", 2.0, 30), ("a", float("inf"), 40),
         ("b", 1.0, 0), ("b", 2.0, 4)], "g STRING, le DOUBLE, cumulative LONG")
    out = metrics.histogram_quantile(buckets, (0.5, 0.99), ["g"])
    assert {(r.g, r.q): round(r.value, 6) for r in out.collect()} == {
        ("a", 0.5): 1.5, ("a", 0.99): 2.0, ("b", 0.5): 1.5, ("b", 0.99): 1.99}


def test_lag_and_health(spark):
    records = spark.createDataFrame([(p, o) for p in (0, 1) for o in range(150 * (p + 1))],
                                    "partition INT, offset LONG")
    committed = spark.createDataFrame([(0, 100)], "partition INT, offset LONG")
    lags = metrics.lag(records, committed)
    assert rows(lags, "partition", "lag") == [(0, 50), (1, 300)]
    assert metrics.total_lag(lags).first().lag == 350
    data = spark.createDataFrame(
        [("dlq", 0), ("dlq", 1), ("outbox_failed", 1), ("duplicates", 1), ("lag", 99),
         ("lag", 100), ("lag", 1000), ("sent", 10 ** 6)], "name STRING, value LONG")
    assert [r.status for r in metrics.health(data).collect()] == [
        "green", "red", "red", "yellow", "green", "yellow", "red", "green"]


def test_copies(spark):
    data = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "event_id STRING")
    assert rows(metrics.copies_histogram(data), "copies", "events") == [(1, 2), (2, 1)]
    assert metrics.counters(data, ["event_id"]).count() == 3
