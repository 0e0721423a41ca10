"""Mixing sources to target weights by proportionate-fair scheduling.

A source's rows are cut into blocks. Block j (from 1) of a source of weight w has
release time floor((j - 1) / w) and deadline ceil(j / w); at every slot the released
block with the earliest deadline goes out. After any number of slots each source is
then less than one block from its exact share. The schedule repeats after as many slots
as there are parts in the weights, so a block's slot is arithmetic on its number; only
that one cycle is ever simulated.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ranked, small, staged

#: Rows in a block.
BLOCK = 8
REST = "rest"
#: Target weights of the registered query, in parts; sources not named share one.
TARGETS = {"src0": 10, **{f"src{i}": 5 for i in range(1, 10)}, REST: 45}


def cycle(weights: Mapping[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks in one cycle of ``sum(weights)`` slots: earliest
    deadline first among released blocks, ties by name."""
    total = sum(weights.values())
    coming = [(0, name, 1) for name in sorted(weights)]
    heapq.heapify(coming)
    ready: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {name: [] for name in weights}
    for slot in range(total):
        while coming and coming[0][0] <= slot:
            _, name, j = heapq.heappop(coming)
            heapq.heappush(ready, (-(-j * total // weights[name]), name, j))
        deadline, name, j = heapq.heappop(ready)
        assert slot < deadline
        slots[name].append(slot)
        if j < weights[name]:
            heapq.heappush(coming, (j * total // weights[name], name, j + 1))
    return slots


def phases(weights: Mapping[str, int], blocks: Mapping[str, int]) -> list[tuple]:
    """``(source, first block, block after the last, first slot, slots in a cycle,
    slots of its blocks in the cycle)`` until all blocks have a slot.

    A phase ends when a source has no block left for its turn; the others go on with
    their weights. There are no more phases than sources.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    out, start = [], 0
    while left:
        active = {s: weights[s] for s in left}
        slots, total = cycle(active), sum(active.values())
        rounds = min(left[s] // active[s] for s in left)
        # In the cycle after these, the first turn that finds no block ends the phase.
        lacks = [slots[s][left[s] - rounds * active[s]] for s in left
                 if left[s] - rounds * active[s] < active[s]]
        end = min(lacks)
        for s in sorted(left):
            n = rounds * active[s] + sum(x < end for x in slots[s])
            if n:
                out.append((s, done[s], done[s] + n, start, total, slots[s]))
            done[s] += n
            left[s] -= n
        start += rounds * total + end
        left = {s: n for s, n in left.items() if n}
    return out


def _classes(source: Column, targets: Mapping[str, int]) -> Column:
    named = [s for s in targets if s != REST]
    return F.when(source.isin(named), source).otherwise(F.lit(REST))


def schedule(rows: DataFrame, targets: Mapping[str, int], source: str = "source",
             doc: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """``rows`` (narrow) with ``class``, ``block``, ``slot`` and ``place``.

    ``targets`` are whole parts above 0 by source; ``REST`` stands for all sources not
    named, null among them, and has one part if it is left out. A class's rows come in
    the order of a hash of the id, cut into blocks of ``block`` rows; ``place`` orders
    the mix. All rows get a place: where a source has run out, the others keep their
    proportions. Null ids come first in their class, repeated rows follow each other.

    The driver holds one count for each class and one cycle of slots, both bounded by
    ``targets``; the phases are broadcast.
    """
    spark = rows.sparkSession
    weights = dict(targets)
    weights.setdefault(REST, 1)
    if min(weights.values()) < 1:
        raise ValueError("weights are whole parts above 0")
    classed = rows.withColumns({"class": _classes(F.col(source), weights),
                                "__lw_order": F.xxhash64(F.col(doc))})
    numbered = ranked(classed, "class", ["__lw_order", doc], "__lw_rank")
    numbered = staged(numbered.drop("__lw_order"), "numbered")
    counts = {r["class"]: -(-r["count"] // block)
              for r in numbered.groupBy("class").count().collect()}
    plan = spark.createDataFrame(
        phases(weights, counts), "__lw_class string, __lw_from long, __lw_to long, "
        "__lw_start long, __lw_cycle long, __lw_slots array<long>")
    at = F.floor(F.col("__lw_rank") / block)
    since = F.col("block") - F.col("__lw_from")
    turns = F.size("__lw_slots")
    slot = (F.col("__lw_start") + F.floor(since / turns) * F.col("__lw_cycle")
            + F.get("__lw_slots", (since % turns).cast("int")))
    return (numbered.withColumn("block", at)
            .join(F.broadcast(plan), (F.col("class") == F.col("__lw_class"))
                  & (F.col("block") >= F.col("__lw_from")) & (F.col("block") < F.col("__lw_to")))
            .withColumn("slot", slot.cast("long"))
            .withColumn("place", (F.col("slot") * block + F.col("__lw_rank") % block)
                        .cast("long"))
            .select(*rows.columns, "class", "block", "slot", "place"))


def mixed(docs: DataFrame, targets: Mapping[str, int], source: str = "source",
          doc: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """``docs`` in the order of the mix, columns as they were: a table written from it
    has the mix in the order of its files and their rows.

    Rows equal in id, source and text share a place. The schedule is made from ids,
    sources and hashes of texts alone; texts are shuffled to their places, and sorted.
    """
    keyed = docs.withColumn("__lw_text", F.xxhash64(F.col("text")))
    key = [F.col(doc).alias("doc"), F.col(source).alias("source"),
           F.col("__lw_text").alias("text")]
    places = small(staged(
        schedule(keyed.select(*key).distinct(), targets, "source", "doc", block).select(
            F.col("doc").alias("__lw_d"), F.xxhash64("source").alias("__lw_s"),
            F.col("text").alias("__lw_t"), F.col("place").alias("__lw_place")), "places"))
    return (keyed.join(places, F.col(doc).eqNullSafe(F.col("__lw_d"))
                       & (F.xxhash64(source) == F.col("__lw_s"))
                       & (F.col("__lw_text") == F.col("__lw_t")))
            .orderBy("__lw_place").select(*[keyed[c] for c in docs.columns]))


def written_order(docs: DataFrame) -> DataFrame:
    """``docs``, read from files that one write left, with ``__lw_file`` and ``__lw_row``:
    the number of the file and of the row in it, which order the rows as written."""
    return docs.select("*", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
                       .cast("long").alias("__lw_file"),
                       F.col("_metadata.row_index").alias("__lw_row"))


def mix_report(docs: DataFrame) -> DataFrame:
    """A row for each document with its place in the mix."""
    return schedule(docs.select("doc_id", "source"), TARGETS)
