"""Operational metrics over rows (AGG4-AGG10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.durations import epoch_micros, floor_to, micros
from .joins import lookup_join
from .slices import earlier

QUANTILES = (0.5, 0.95, 0.99)

# Status ladders as (level, at least), worst first.
LADDERS = {
    "dlq": (("red", 1),),
    "outbox_failed": (("red", 1),),
    "duplicates": (("yellow", 1),),
    "lag": (("red", 1000), ("yellow", 100)),
}


def counters(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Number of events per label (AGG4)."""
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("total"))


def _named(df: DataFrame, **counts: Column) -> DataFrame:
    """``name, total`` of several conditions, counted in one aggregate."""
    totals = df.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    pairs = [part for n in counts for part in (F.lit(n), F.col(n))]
    return totals.select(F.stack(F.lit(len(counts)), *pairs).alias("name", "total"))


def consumer_counters(classified: DataFrame) -> DataFrame:
    status = F.col("status")
    return _named(classified, sent=status == "SENT", dlq=status == "DLQ",
                  duplicates=status == "DUPLICATE")


def accept_counters(transactions: DataFrame) -> DataFrame:
    return _named(transactions, initiated=F.lit(True))


def outbox_counters(results: DataFrame) -> DataFrame:
    """Counters of publish results (``id, error``)."""
    return _named(results, outbox_published=F.col("error").isNull(),
                  outbox_failed=F.col("error").isNotNull())


def rate_per_second(df: DataFrame, ts: str, dims: Sequence[str],
                    window: str = "1 minute", value: str | None = None,
                    slice_len: str = "10 minutes") -> DataFrame:
    """``dims, window_start, rate`` (AGG5).

    Without ``value`` each row is one event. With it, rows are samples of a
    cumulative counter: a sample adds its increase over the series' previous one,
    or its whole value after a reset. A series is followed in slices of
    ``slice_len``, each starting from the last sample before it.
    """
    seconds = micros(window) / 1_000_000
    if value is None:
        added, rows = F.count(F.lit(1)), df
    else:
        rows = _increases(df, ts, list(dims), value, slice_len)
        added = F.sum("_increase")
    return (rows.groupBy(F.window(ts, window).alias("w"), *dims)
            .agg((added / F.lit(seconds)).alias("rate"))
            .select(*dims, F.col("w.start").alias("window_start"),
                    F.col("rate").cast("double").alias("rate")))


def _increases(samples: DataFrame, ts: str, dims: list[str], value: str,
               slice_len: str) -> DataFrame:
    """Samples with ``_increase``; a series' first sample adds nothing."""
    rows = (samples.select(*dims, ts, F.col(value).alias("_value"))
            .withColumn("_slice", floor_to(epoch_micros(F.col(ts)), micros(slice_len)))
            .withColumn("_carried", F.lit(False)))
    last = earlier(rows, dims, "_slice", F.struct(ts, "_value"), "_last")
    carried = last.select(*dims, F.col("_last").getField(ts).alias(ts),
                          F.col("_last").getField("_value").alias("_value"),
                          "_slice", F.lit(True).alias("_carried"))
    series = W.partitionBy(*dims, "_slice").orderBy(ts, "_value")
    before = F.lag("_value").over(series)
    grown = F.when(F.col("_value") >= before, F.col("_value") - before) \
        .when(before.isNotNull(), F.col("_value")).otherwise(F.lit(0))
    return (rows.unionByName(carried).withColumn("_increase", grown)
            .filter(~F.col("_carried")))


def _name(q: float) -> str:
    return f"p{q * 100:g}".replace(".", "_")


#: Buckets for each power of e that values span; and what sets apart the signs.
BUCKETS = 4096
SIGN = 1000 * BUCKETS


def _magnitude(value: Column) -> Column:
    """A bucket number that never falls as ``value`` grows: equal steps of the logarithm,
    so buckets are as fine for values under 1 as for those over 10^9."""
    log = (F.when(F.isnan(value), 900.0)
           .otherwise(F.least(F.log(F.abs(value)), F.lit(800.0))))
    size = F.floor(log * BUCKETS) + SIGN
    return F.when(value == 0, F.lit(0).cast("long")).when(value < 0, -size).otherwise(size)


def quantiles(df: DataFrame, value: str, by: Sequence[str],
              qs: Sequence[float] = QUANTILES, exact: bool = True) -> DataFrame:
    """Quantiles of ``value`` per group (AGG6).

    ``exact=False`` is Spark's sketch. The exact form interpolates between the two
    nearest ranks. It folds equal values map-side, counts values per bucket of their
    magnitude, and ranks only inside the few buckets that hold a wanted rank: a task
    gets the distinct values within 1 / BUCKETS of each other, on any scale, and a
    group's bucket counts, whose number has a bound.
    """
    if not exact:
        return df.groupBy(*by).agg(*[
            F.percentile_approx(value, q, 10_000).alias(_name(q)) for q in qs])

    by = list(by)
    values = (df.filter(F.col(value).isNotNull())
              .select(*by, F.col(value).cast("double").alias("_v"))
              .groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_b", _magnitude(F.col("_v"))))
    per_bucket = values.groupBy(*by, "_b").agg(F.sum("_n").alias("_bn"))
    up_to = (W.partitionBy(*by).orderBy("_b")
             .rowsBetween(W.unboundedPreceding, 0))
    placed = (per_bucket.withColumn("_end", F.sum("_bn").over(up_to))
              .withColumn("_total", F.sum("_bn").over(W.partitionBy(*by)))
              .withColumn("_start", F.col("_end") - F.col("_bn")))

    def rank(q: float) -> Column:
        return F.lit(float(q)) * (F.col("_total") - 1)

    def holds(lo: str, hi: str) -> Column:
        """Whether 0-based ranks [lo, hi) include a rank some quantile needs."""
        wanted = F.lit(False)
        for q in qs:
            for r in (F.floor(rank(q)), F.ceil(rank(q))):
                wanted = wanted | ((r >= F.col(lo)) & (r < F.col(hi)))
        return wanted

    needed = (placed.filter(holds("_start", "_end"))
              .select(*by, "_b", "_start", "_total"))
    inside = (W.partitionBy(*by, "_b").orderBy("_v")
              .rowsBetween(W.unboundedPreceding, 0))
    # Null-safe, so that a group without a name is kept; it also leaves both readers
    # of ``values`` the same plan, which Spark then runs once.
    wanted = needed.withColumnsRenamed({c: f"_at_{c}" for c in [*by, "_b"]})
    same = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in [*by, "_b"]]
    ranked = (values.join(wanted, reduce(and_, same))
              .withColumn("_hi", F.col("_start") + F.sum("_n").over(inside))
              .withColumn("_lo", F.col("_hi") - F.col("_n")))

    def at(r: Column) -> Column:
        return F.max(F.when((r >= F.col("_lo")) & (r < F.col("_hi")), F.col("_v")))

    picked = []
    for q in qs:
        low, high = at(F.floor(rank(q))), at(F.ceil(rank(q)))
        part = F.max(rank(q) - F.floor(rank(q)))
        picked.append((low + (high - low) * part).alias(_name(q)))
    return ranked.groupBy(*by).agg(*picked)


def histogram(df: DataFrame, value: str, edges: Column, by: Sequence[str] = (),
              ) -> DataFrame:
    """Cumulative buckets ``by, le, cumulative`` of a value.

    ``edges`` gives a row's bucket: the smallest upper edge at or above it.
    """
    per = (df.groupBy(*by, edges.cast("double").alias("le"))
           .agg(F.count(F.lit(1)).alias("_n")))
    up_to = (W.partitionBy(*by).orderBy("le")
             .rowsBetween(W.unboundedPreceding, 0))
    return (per.withColumn("cumulative", F.sum("_n").over(up_to))
            .select(*by, "le", "cumulative"))


def histogram_quantile(buckets: DataFrame, qs: Sequence[float] = QUANTILES,
                       by: Sequence[str] = ()) -> DataFrame:
    """``by, q, value`` from cumulative buckets (AGG7): linear within the first
    bucket that reaches ``q`` of the total. The lowest bucket starts at 0; a rank
    in the infinite bucket gives the highest finite edge."""
    ordered = W.partitionBy(*by).orderBy("le")
    rows = (
        buckets
        .withColumn("_total", F.max("cumulative").over(W.partitionBy(*by)))
        .withColumn("_low", F.coalesce(F.lag("le").over(ordered), F.lit(0.0)))
        .withColumn("_before", F.coalesce(F.lag("cumulative").over(ordered), F.lit(0)))
        .withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs]))))
    rank = F.col("q") * F.col("_total")
    share = (rank - F.col("_before")) / (F.col("cumulative") - F.col("_before"))
    inside = F.col("_low") + (F.col("le") - F.col("_low")) * share
    value = F.when(F.col("le") == float("inf"), F.col("_low")).otherwise(inside)
    reached = (F.col("cumulative") >= rank) & (F.col("cumulative") > F.col("_before"))
    return (rows.filter(reached).groupBy(*by, "q")
            .agg(F.min(F.struct("le", value.alias("value"))).alias("_first"))
            .select(*by, "q", F.col("_first.value").alias("value")))


def lag(offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """``partition, lag``: records after the committed offset (AGG8).

    ``offsets`` has one row per record, ``committed`` the next offset to read per
    partition; a partition without a commit is read from offset 0.
    """
    end = (offsets.groupBy("partition")
           .agg((F.max("offset") + 1).alias("end_offset")))
    done = committed.select("partition", F.col("offset").alias("_committed"))
    return (lookup_join(end, done, "partition", "left")
            .select("partition", (F.col("end_offset")
                                  - F.coalesce("_committed", F.lit(0))).alias("lag")))


def total_lag(lags: DataFrame) -> DataFrame:
    return lags.agg(F.sum("lag").alias("lag"))


def health(metrics: DataFrame, ladders: Mapping = LADDERS) -> DataFrame:
    """``metrics(name, value)`` with its ``status`` (AGG9)."""
    status = F
    for name, ladder in ladders.items():
        for level, least in ladder:
            status = status.when(
                (F.col("name") == name) & (F.col("value") >= least), F.lit(level))
    return metrics.withColumn("status", status.otherwise(F.lit("green")))


def copies_histogram(df: DataFrame, id: str = "event_id") -> DataFrame:
    """``copies, events``: how many events were delivered how often (AGG10)."""
    return (df.groupBy(id).agg(F.count(F.lit(1)).alias("copies"))
            .groupBy("copies").agg(F.count(F.lit(1)).alias("events")))
