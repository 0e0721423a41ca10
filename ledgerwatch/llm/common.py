"""Staged tables, ranks and connected components shared by the operators."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..streaming.runner import remove

#: Words of the corpus contracts: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, UPPER, UPPER.lower())


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which all executors share.

    Only a single-process local session may leave the setting out; it then gets a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        base = os.path.join(tempfile.gettempdir(), "ledgerwatch-scratch")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh shared folder for tables that nothing reads after the block; it is removed
    then."""
    root = scratch(spark, name)
    try:
        yield root
    finally:
        remove(spark, root)


def staged(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder (or below ``root``) and read
    back. What follows does not depend on executors that computed it.
    """
    path = f"{root}/{name}-{uuid.uuid4().hex}" if root else scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tables of up to this many rows of fixed width are broadcast where that spares a
#: shuffle of texts; larger ones are joined by shuffle.
SMALL = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if it has no more than SMALL rows. ``df`` must be a
    staged table of fixed-width columns."""
    return F.broadcast(df) if df.count() <= SMALL else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of fixed width that are worth a task.
TASK_ROWS = 20_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows of fixed width, in as many tasks as these are worth
    (as many as run at once, at least). Shuffle partitions are made for large tables; a
    loop over a small one would mostly start tasks."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))
    return df.coalesce(tasks) if tasks < partitions(spark) else df


def ranked(df: DataFrame, key: str, order: Sequence[str], rank: str) -> DataFrame:
    """``df`` with a gapless rank from 0 within each ``key``, in the given order.

    Rows are dealt by ranges of key and order and sorted, so a key with any share of the
    rows is spread over tasks. They are staged once with their place in the task; a
    row's rank is that place, less the place where its key begins in the task, plus the
    key's rows in the tasks before, and these come from one row for each task and key.
    Repeated rows get different ranks; null keys are a key.
    """
    spark = df.sparkSession
    local = staged(df.repartitionByRange(partitions(spark), key, *order)
                   .sortWithinPartitions(key, *order)
                   .withColumn("__lw_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__lw_at", 33)
    before = (Window.partitionBy("__lw_of").orderBy("__lw_part")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (local.groupBy(part.alias("__lw_part"), F.col(key).alias("__lw_of"))
               .agg(F.count("*").alias("__lw_n"), F.min("__lw_at").alias("__lw_first"))
               .withColumn("__lw_before", F.coalesce(F.sum("__lw_n").over(before), F.lit(0))))
    return (local.join(offsets, (part == offsets["__lw_part"])
                       & local[key].eqNullSafe(offsets["__lw_of"]))
            .withColumn(rank, (F.col("__lw_at") - F.col("__lw_first") + F.col("__lw_before"))
                        .cast("long"))
            .select(*df.columns, rank))


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``(node, root)`` of every node that has an edge; ``root`` is the smallest
    node reachable.

    ``edges`` has columns ``a``, ``b``. Rounds of large and small stars: each node
    passes the smallest neighbour on, so no neighbourhood is ever collected. Rounds
    are staged in the shared folder; their number grows with the logarithm of the
    longest chain. ``rows`` is about the number of edges, if that is known.
    """
    def star(links: DataFrame, large: bool) -> DataFrame:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(both.select(F.col("v").alias("u"),
                                                F.col("u").alias("v")))
        least = few(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), size)
        joined = both.join(F.broadcast(least) if size <= SMALL else least, "u")
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("a"),
                                                F.col("m").alias("b"))
        else:
            out = (joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
                   .unionByName(least.select(F.col("u").alias("a"),
                                             F.col("m").alias("b"))))
        return few(out.filter("a > b").distinct(), size)

    links = edges.select(F.greatest("a", "b").alias("a"),
                         F.least("a", "b").alias("b")).filter("a > b").distinct()
    links = staged(links if rows is None else few(links, rows), "links")
    seen = None
    size = links.count()  # rounds never make more links
    while True:
        links = staged(star(star(links, True), False), "links")
        # A star forest stays as it is; the sums tell whether anything moved.
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                        ).first()
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
