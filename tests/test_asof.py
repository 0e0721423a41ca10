"""Versions current at a time, against a loop over all of them."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from helpers import A1, DAY, rows, tx
from pyspark.sql import functions as F
from test_streaming import add_file, source, split

from ledgerwatch.operators import asof, rules
from ledgerwatch.streaming import accounts, fraud, runner

VERSIONS = "account_id STRING, since TIMESTAMP_NTZ, nr INT, tier STRING"


def at(minutes):
    return DAY + timedelta(minutes=minutes)


def data(seed, n=400):
    rnd = random.Random(seed)

    def account():
        return "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(5)}"

    asked = [(account(), 60000 + i, at(rnd.randrange(600))) for i in range(n)]
    versions = [(account(), at(rnd.randrange(600)), i, rnd.choice(["ELITE", "STANDARD", None]))
                for i in range(n // 4)]
    return asked, versions


def expected(asked, versions):
    out = []
    for account, amount, when in asked:
        mine = [v for v in versions if v[0] == account and v[1] <= when]
        last = max(mine, key=lambda v: (v[1], v[2]), default=None)
        if last is not None and last[3] is not None:
            out.append((account, amount, last[1], last[2], last[3]))
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_len", ["1 minute", "1 hour", "30 days"])
def test_equals_the_loop(spark, slice_len):
    asked, versions = data(1)
    got = asof.current_versions(
        tx(spark, asked), spark.createDataFrame(versions, VERSIONS), order_by=["nr"],
        deleted=F.col("tier").isNull(), slice_len=slice_len)
    found = sorted(((r.account_id, int(r.amount), r.since, r.nr, r.tier)
                    for r in got.collect()), key=str)
    assert found == expected(asked, versions)
    assert 0 < len(found) < len(asked)


def test_odd_rows(spark):
    asked = tx(spark, [("a", 1, at(5)), ("a", 2, at(4)), (None, 3, at(9)), ("b", 4, at(9)),
                       ("a", 1, at(5))])
    asked = asked.unionByName(asked.limit(1).withColumns(
        {"occurred_at": F.lit(None).cast("timestamp_ntz"), "amount": F.lit(5).cast("decimal(15,2)")}))
    versions = spark.createDataFrame(
        [("a", at(5), 1, "x"), ("a", at(5), 2, "y"), ("a", at(5), 2, "y"), (None, at(1), 3, "z"),
         ("a", None, 4, "w")], VERSIONS)
    got = asof.current_versions(asked, versions, order_by=["nr"])
    assert [(int(r.amount), r.tier) for r in got.collect()] == [(1, "y"), (1, "y")]
    left = asof.current_versions(asked, versions, order_by=["nr"], how="left")
    assert sorted((int(r.amount), r.tier or "") for r in left.collect()) == [
        (1, "y"), (1, "y"), (2, ""), (3, ""), (4, ""), (5, "")]
    assert asof.current_versions(asked, versions.limit(0)).count() == 0
    assert asof.current_versions(asked.limit(0), versions).count() == 0
    with pytest.raises(ValueError, match="both have"):
        asof.current_versions(asked.withColumn("tier", F.lit(1)), versions)


def test_offsets_as_time(spark):
    asked = spark.range(1000).select(F.lit(1).alias("account_id"), F.col("id").alias("pos"))
    versions = spark.range(0, 1000, 7).select(
        F.lit(1).alias("account_id"), F.col("id").alias("since"))
    got = asof.current_versions(asked, versions, at="pos", slice_len=10)
    assert got.count() == 1000
    assert got.filter("since <> pos - pos % 7").count() == 0


def test_a_hot_key_is_many_groups_and_nothing_is_joined(spark):
    asked, versions = data(2)
    got = asof.current_versions(tx(spark, asked), spark.createDataFrame(versions, VERSIONS),
                                slice_len="1 minute")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert "_slice" in plan


def test_a_replayed_batch_raises_the_same_alerts(spark, tmp_path):
    work = str(tmp_path)
    asked, versions = data(3, 60)
    everything = split(spark, asked, f"{work}/in", parts=3)
    log = [(a, s, t) for a, s, _, t in versions if t]
    ddl = "account_id STRING, since TIMESTAMP, tier STRING"
    for part in (log[::2], log[1::2]):
        add_file(spark.createDataFrame(part, ddl), f"{work}/changes")

    def follow():
        runner.drain(accounts.start_version_log(
            source(spark, f"{work}/changes"), f"{work}/versions", f"{work}/vcp", every=None))

    def alerts(run):
        runner.drain(fraud.start_high_value(
            source(spark, f"{work}/in"), lambda s: accounts.account_versions(s, f"{work}/versions"),
            runner.write_alerts(f"{work}/{run}"), f"{work}/cp-{run}", work=f"{work}/st-{run}",
            since="since", every=None))
        found = runner.latest_alerts(spark, f"{work}/{run}")
        return rows(found, "alert_id", "account_tier", "amount")

    follow()
    first = alerts("one")
    whole = rules.high_value_alerts(everything, spark.createDataFrame(log, ddl), since="since")
    assert first == rows(whole, "alert_id", "account_tier", "amount")
    assert first
    later = max(a[2] for a in asked) + timedelta(seconds=1)
    add_file(spark.createDataFrame(
        [(a, later, "STANDARD") for a in ("hot", "k0", A1)], ddl), f"{work}/changes")
    follow()
    assert alerts("two") == first
