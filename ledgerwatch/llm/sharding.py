"""Sharding by longest processing time: groups of equal texts stay together, and go,
largest first, to the shard with the least bytes so far."""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, staged

SHARDS = 40
#: Bytes that a row takes beside its text.
ROW_BYTES = 16
#: Groups of at least 1 / SINGLES of all bytes are placed one by one, so there are no
#: more than SINGLES of them, whatever the input.
SINGLES = 10_000
#: Smaller groups are placed in bundles: half of them in the first level's bundles, a
#: quarter in the second's and so on, so that the last to be placed are tiny.
LEVELS = 12
BUNDLES_PER_SHARD = 2


def place(items: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """``{name: shard}`` of ``(size, name)``, largest first, ties by name."""
    loads = [(0, s) for s in range(shards)]
    out = {}
    for size, name in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = loads[0]
        heapq.heapreplace(loads, (load + size, shard))
        out[name] = shard
    return out


def _bundle(group, shards: int):
    """The bundle of a small group: its level is the number of zero bits at the end of
    a hash."""
    width = BUNDLES_PER_SHARD * shards
    bits = F.xxhash64(group)
    level = F.least(F.length(F.regexp_extract(F.bin(bits), "0*$", 0)), F.lit(LEVELS - 1))
    return (level * width + F.pmod(F.xxhash64(group, F.lit(1)), F.lit(width))).cast("int")


def assigned(rows: DataFrame, shards: int = SHARDS, group: str = "group",
             size: str = "size") -> DataFrame:
    """``rows`` plus ``shard``, by the columns ``group`` and ``size``.

    A group of any share of the rows is summed within tasks first. The driver gets at
    most SINGLES groups and LEVELS * BUNDLES_PER_SHARD * shards bundles; their places
    are broadcast.
    """
    spark = rows.sparkSession
    groups = staged(rows.groupBy(F.col(group).alias("group"))
                    .agg(F.sum(size).alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = F.col("bytes") * SINGLES >= total
    singles = [(r["bytes"], r["group"]) for r in
               groups.filter(large).select("bytes", "group").toLocalIterator()]
    bundles = [(r["bytes"], f"bundle {r['b']:06}") for r in
               groups.filter(~large).groupBy(_bundle(F.col("group"), shards).alias("b"))
               .agg(F.sum("bytes").alias("bytes")).collect()]
    places = place(singles + bundles, shards)
    single = spark.createDataFrame([(name, places[name]) for _, name in singles],
                                   "__lw_group string, __lw_shard int")
    width = LEVELS * BUNDLES_PER_SHARD * shards
    bundle_shards = F.from_json(
        F.lit(json.dumps([places.get(f"bundle {b:06}", 0) for b in range(width)])), "array<int>")
    return (rows.join(F.broadcast(single), F.col(group) == F.col("__lw_group"), "left")
            .select(*rows.columns, F.coalesce(
                "__lw_shard", F.get(bundle_shards, _bundle(F.col(group), shards)))
                .alias("shard")))


def text_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` plus ``size``, ``text_crc32`` and ``group`` of each row's text. Null
    texts are a group of their own, with the size and checksum of an empty one."""
    text = F.col("text")
    return docs.select(
        *columns,
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.sha2(text, 256), F.lit("null")).alias("group"))


def shard_documents(docs: DataFrame, shards: int = SHARDS,
                    order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``: rows of a shard numbered from 0 without
    gaps, in the order of the columns ``order``.

    Shards differ in bytes by no more than the smallest bundle or group placed last,
    unless a single group of equal texts is larger than a shard's fair share; it then
    has a shard of its own. Repeated rows get slots of their own, null ids come first.
    Columns named ``shard`` or ``slot`` are replaced, names that begin with ``__lw_``
    are reserved.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    text = F.col("text")
    rows = docs.select(*kept).withColumns({
        "__lw_key": F.coalesce(F.sha2(text, 256), F.lit("null")),
        "__lw_bytes": (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")})
    placed = assigned(rows, shards, "__lw_key", "__lw_bytes")
    return ranked(placed.drop("__lw_key", "__lw_bytes"), "shard", order, "slot")


def shard_report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The contract's row for each document."""
    rows = staged(text_rows(docs, "doc_id"), "sizes")
    placed = ranked(assigned(rows, shards).drop("group"), "shard", ["doc_id"], "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
