"""Accepting requests from a stream, and the relay job (OP8, OP9, OP16).

Accepted outbox rows are appended per micro-batch. A relay pass takes pending rows,
publishes them, and appends their results; a row is pending when it has no result or its
last one is a failure. Nothing is updated in place, and what a pass writes grows with
the rows it tries, not with the backlog.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import metrics
from ..operators import outbox as ob
from ..operators.joins import lookup_join
from ..operators.reference import latest_per_key
from . import manifest, runner

TRANSACTIONS = "transactions"
OUTBOX = "outbox"
REJECTED = "rejected"
RESULTS = "results"
FOLDED = "results_folded"
#: Passes after which their results are folded.
FOLD_EVERY = 64
#: A pass of more rows is cut by ranges; Spark merges a smaller one in one task.
MERGED = 100_000
ACCEPT_COUNTERS = "accept_counters"
RELAY_COUNTERS = "relay_counters"


def start_accept(requests: DataFrame, accounts: Callable[[SparkSession], DataFrame],
                 tables: str, checkpoint: str, request_key: str | list[str],
                 created_at: str | None = None,
                 prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
                 body: Callable[[], Column] | None = None, schema_id: int = 1,
                 every: str | None = runner.ONE_SECOND) -> StreamingQuery:
    """Write transactions, outbox rows and rejects of each micro-batch.

    All three come from one staged result, for which accounts are looked up once, and
    ids are hashes of the request key: the tables agree and a replay repeats the same
    rows. ``body`` encodes events (JSON unless given). ``prepare`` is applied to
    the micro-batch, for example to number requests that have no key of their own.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        now = F.current_timestamp() if created_at is None else F.col(created_at)
        judged = runner.staged(
            ob.with_known_account(prepare(batch).withColumn("created_at", now),
                                  accounts(batch.sparkSession)),
            f"{tables}/staged", batch_id)
        done = ob.accept(judged, None, request_key, now=F.col("created_at"),
                         body=body and body(), schema_id=schema_id)
        runner.write_all(batch_id, {
            f"{tables}/{TRANSACTIONS}": done.transactions,
            f"{tables}/{OUTBOX}": done.outbox,
            f"{tables}/{REJECTED}": done.rejected,
            f"{tables}/{ACCEPT_COUNTERS}": metrics.accept_counters(done.transactions)})

    return runner.run_stream(requests, handle, checkpoint, every=every)


def _results(spark: SparkSession, tables: str, state: dict) -> DataFrame | None:
    """Results of all committed passes: of those since the last fold, and the fold with
    the number of the pass it was made after."""
    parts = [runner.read_batches(spark, f"{tables}/{RESULTS}", state.get("passes", []))]
    if state.get("fold"):
        parts.append(spark.read.parquet(f"{tables}/{state['fold']}").withColumn(
            runner.BATCH, F.lit(state["folded"])))
    parts = [p for p in parts if p is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _state(spark: SparkSession, tables: str) -> tuple[int, dict, DataFrame | None,
                                                      DataFrame | None]:
    """Number and content of the last commit; accepted rows never tried, with their batch
    as ``accepted``; results of all committed passes."""
    commit, state = manifest.latest(spark, tables)
    low = state.get("low", 0)
    results = _results(spark, tables, state)
    accepted = [v for v in runner.versions(spark, f"{tables}/{OUTBOX}") if v >= low]
    untried = runner.read_batches(spark, f"{tables}/{OUTBOX}", accepted)
    if untried is not None:
        untried = untried.withColumnRenamed(runner.BATCH, "accepted")
        if results is not None:
            tried = results.filter(F.col("accepted") >= low).select("id")
            untried = lookup_join(untried, tried, "id", "left_anti")
    return commit, state, untried, results


def _failed(results: DataFrame) -> DataFrame:
    """Rows whose last try failed. Only rows that ever failed are read."""
    return (latest_per_key(results.filter("retry_count > 0"), "id", runner.BATCH)
            .filter(~F.col("published")).drop(runner.BATCH))


def _oldest(backlog: DataFrame, limit: int | None, first: list[str], folder: str,
            number: int) -> DataFrame:
    """``ob.outbox_pending``, for a limit of any size: a large one is found by ranges of the
    order, of which only the sizes and the last row of the pass are looked up, so no task
    merges it. Only what rows are ordered by is staged; copies of the last row go with it."""
    if limit is None or limit <= MERGED:
        return ob.outbox_pending(backlog, limit, first)
    order = [*first, "created_at", "id"]
    pending = ob.outbox_pending(backlog, None)
    # A row's place in its task; range partitions are in order of their numbers.
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranges = runner.staged(
        pending.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), place.alias("_place")),
        folder, number)
    left = limit
    for part, size in sorted(map(tuple, ranges.groupBy("_part").count().collect())):
        if left <= size:
            cut = (ranges.filter((F.col("_part") == part) & (F.col("_place") == left - 1))
                   .select(F.struct(*order).alias("_cut")))
            return (pending.join(F.broadcast(cut), F.struct(*order) <= F.col("_cut"))
                    .drop("_cut"))
        left -= size
    return pending


def current_outbox(spark: SparkSession, tables: str) -> DataFrame | None:
    """All outbox rows as they are now; none before the first request."""
    untried, results = _state(spark, tables)[2:]
    parts = []
    if untried is not None:
        parts.append(untried.drop("accepted"))
    if results is not None:
        parts.append(latest_per_key(results, "id", runner.BATCH)
                     .drop(runner.BATCH, "accepted", "needs_manual"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def untried_left(spark: SparkSession, tables: str) -> bool:
    """Whether rows are pending that no pass has tried."""
    untried = _state(spark, tables)[2]
    return untried is not None and not untried.isEmpty()


def relay(spark: SparkSession, tables: str, publish: Callable[[DataFrame, int], None],
          limit: int | None = ob.BATCH, now: Column | None = None,
          manual_last: bool = False, fold_every: int = FOLD_EVERY) -> DataFrame | None:
    """One pass: take the oldest pending rows, publish, record the results.

    ``publish`` gets ``id, topic, key, value, created_at`` rows, those of a key in one
    task and in order of creation, and the number of the pass; if it raises, all of them
    count as failed with its message. Returns the rows tried, or nothing when none is
    pending. With ``manual_last``, rows that failed too often wait until no other is
    pending, instead of holding up what came later.

    A pass writes the rows it tried and, with a large limit, the order of the backlog. It is finished by its commit;
    one that dies before runs again under its number: at least once. It reads the
    accepted batches from the first with untried rows on, and the rows that ever failed.
    After ``fold_every`` passes their results are folded into one part.
    """
    commit, state, untried, results = _state(spark, tables)
    parts = [] if untried is None else [
        untried.withColumn("needs_manual", F.lit(False))]
    if results is not None:
        parts.append(_failed(results))
    if not parts:
        return None
    backlog = reduce(DataFrame.unionByName, parts)
    number, low = state.get("last", -1) + 1, state.get("low", 0)
    first = ["needs_manual"] if manual_last else []
    rows = _oldest(backlog, limit, first, f"{tables}/order", number)
    batch = runner.staged(rows, f"{tables}/relay", number)
    if batch.isEmpty():
        return None

    records = ob.publishable(batch)
    error = None
    try:
        publish(ob.in_order(records.filter(F.col("value").isNotNull())), number)
    except Exception as failure:  # noqa: BLE001  any sink error is a failed publish
        error = F.lit(str(failure))
    outcome = ob.publish_results(records, error)
    after = ob.outbox_apply(batch.drop("needs_manual"), outcome,
                            F.current_timestamp() if now is None else now)
    tried = runner.stored(after, f"{tables}/{RESULTS}", number)
    runner.write_batch(metrics.outbox_counters(outcome), f"{tables}/{RELAY_COUNTERS}", number)
    if untried is not None:
        left = lookup_join(untried, tried.select("id"), "id", "left_anti")
        known = runner.versions(spark, f"{tables}/{OUTBOX}")[-1]
        lowest = left.agg(F.min("accepted")).first()[0]
        low = known + 1 if lowest is None else lowest
    passes = [*state.get("passes", []), number]
    manifest.commit(spark, tables, commit + 1,
                    {**state, "last": number, "low": low, "passes": passes})
    if len(passes) >= fold_every:
        _fold(spark, tables, lambda rows: rows)
    return tried.drop("accepted")


def _fold(spark: SparkSession, tables: str,
          keep: Callable[[DataFrame], DataFrame]) -> None:
    """The results as one new part with what ``keep`` leaves of them, committed; then what
    no commit names any more goes. Dying before the commit leaves the state as it was,
    dying after it leaves parts for the next fold to remove."""
    commit, state, _, results = _state(spark, tables)
    if results is None:
        return
    part = manifest.new_part(FOLDED)
    last_state = latest_per_key(results, "id", runner.BATCH).drop(runner.BATCH)
    keep(last_state).write.parquet(f"{tables}/{part}")
    manifest.commit(spark, tables, commit + 1, {
        **state, "passes": [], "fold": part, "folded": state["last"]})
    for number in runner.versions(spark, f"{tables}/{RESULTS}"):
        if number <= state["last"]:
            runner.remove(spark, f"{tables}/{RESULTS}/{runner.BATCH}={number}")
    for name in runner.children(spark, f"{tables}/{FOLDED}"):
        if f"{FOLDED}/{name}" != part:
            runner.remove(spark, f"{tables}/{FOLDED}/{name}")
    runner.remove_before(spark, f"{tables}/{OUTBOX}", state["low"])


def retain(spark: SparkSession, tables: str, now: Column, keep: str = ob.KEEP) -> None:
    """Fold the results of all finished passes into one part: the last state of each
    row, without those published longer than ``keep`` ago (OP10). Accepted batches
    that were tried as a whole go, as soon as their results are folded.

    The commit names either the old parts or the fold. Old parts are removed after it, so
    run it between passes.
    """
    _fold(spark, tables, lambda rows: ob.outbox_retain(rows, now, keep))
