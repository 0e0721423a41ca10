import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import A1, A2, DAY, rows, tx
from ledgerwatch.operators import rules, velocity

FIVE = timedelta(minutes=5)
TICK = timedelta(milliseconds=1)


def test_three_in_five_minutes_inclusive(spark):
    data = [(A2, 500, "10:00:00"), (A2, 500, "10:02:00"), (A2, 500, "10:05:00")]
    assert rows(rules.velocity_alerts(tx(spark, data)), "account_id", "reason",
                "amount", "account_tier", "transaction_id") == [
        (A2, "3 transactions in 5-minute window", 0.0, "UNKNOWN", "MULTIPLE")]


def test_one_millisecond_too_late(spark):
    data = [(A2, 500, "10:00:00"), (A2, 500, "10:02:00"), (A2, 500, "10:05:00.001")]
    assert rules.velocity_alerts(tx(spark, data)).count() == 0


def test_two_are_not_enough_and_equal_times_count(spark):
    assert rules.velocity_alerts(tx(spark, [(A2, 1, "10:00:00")] * 2)).count() == 0
    assert rows(rules.velocity_alerts(tx(spark, [(A2, 1, "10:00:00")] * 3)),
                "reason") == [("3 transactions in 5-minute window",)]


def test_accounts_are_apart(spark):
    data = [(A1, 1, "10:00:00"), (A1, 1, "10:00:01"), (A2, 1, "10:00:02")]
    assert rules.velocity_alerts(tx(spark, data)).count() == 0


def sample(seed, n=250, keys=3, span_s=7200):
    rnd = random.Random(seed)
    # one key holds most rows, some times repeat
    return [(A1 if rnd.random() < 0.6 else f"k{rnd.randrange(keys)}", 1,
             DAY + timedelta(milliseconds=rnd.randrange(span_s * 1000) // 500 * 500))
            for _ in range(n)]


def brute(data, window, all_windows):
    out = {}
    for key in {d[0] for d in data}:
        times = [d[2] for d in data if d[0] == key]
        starts = {t - window for t in times}
        if all_windows:
            starts |= {t + TICK for t in times}
        for s in starts:
            n = sum(s <= t <= s + window for t in times)
            if n:
                out[(key, s)] = n
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("all_windows", [False, True])
@pytest.mark.parametrize("slice_len", ["5 minutes", "7 minutes", "1 hour"])
def test_against_brute_force(spark, seed, all_windows, slice_len):
    data = sample(seed)
    got = velocity.sliding_windows(tx(spark, data), all_windows=all_windows,
                                   slice_len=slice_len)
    found = {(r.account_id, r.window_start): r.n for r in got.collect()}
    assert found == brute(data, FIVE, all_windows)
    assert got.count() == len(found)


def test_flagged_accounts_agree(spark):
    """An account over the count in any window is over it in a trailing one."""
    data = sample(7, n=150)
    hits = [velocity.sliding_windows(tx(spark, data), all_windows=a)
            .filter("n >= 3").select("account_id").distinct() for a in (False, True)]
    assert rows(hits[0], "account_id") == rows(hits[1], "account_id")


def test_trailing_counts_keep_every_row(spark):
    data = sample(4)
    out = velocity.trailing_counts(tx(spark, data)).collect()
    assert len(out) == len(data)
    for r in out:
        assert r.n == sum(d[0] == r.account_id and r.occurred_at - FIVE <= d[2]
                          <= r.occurred_at for d in data)


def test_hot_account_is_cut_by_time(spark, capsys):
    df = velocity.sliding_windows(tx(spark, sample(5)))
    df.explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(account_id" in plan and "slice" in plan
    assert "partial_count" in plan
    assert "Join" not in plan and "Cartesian" not in plan


def test_timestamp_with_zone_gives_the_same(spark):
    data = tx(spark, sample(6))
    zoned = data.withColumn("occurred_at", F.col("occurred_at").cast("timestamp"))
    one = velocity.sliding_windows(data)
    other = velocity.sliding_windows(zoned)
    assert dict(other.dtypes)["window_start"] == "timestamp"
    assert rows(one, "account_id", "window_start", "n") == rows(
        other.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")),
        "account_id", "window_start", "n")
