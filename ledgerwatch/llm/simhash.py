"""Near-duplicates by SimHash: fingerprints within a few differing bits are linked,
links make groups.

Distinct fingerprints are joined with themselves by walking a binary trie in pairs of
nodes. Two fingerprints within ``distance`` bits agree on all but ``distance`` of any
``n`` blocks of bits, so each fingerprint goes to one bucket for each choice of
``n - distance`` blocks, and every linked pair meets in at least one bucket. Within a
bucket, node pairs go down together, add up the bits in which they differ, and are left
when the sum exceeds the distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import components, partitions, staged

SHINGLE = 4
DISTANCE = 4
SEED = 42

#: Shingles whose bits are counted at once.
CHUNK = 1 << 15
#: A bucket of more fingerprints than this is cut into parts, whose pairs are joined in
#: cells of their own.
CELL = 20_000
#: Fingerprints walked at once in a task (whole cells).
SLAB = 50_000
#: Node pairs with no more pairs of fingerprints than this are compared directly.
LEAF = 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text, as a signed number; 0 without words."""
    import xxhash
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    plain = b" ".join(words)
    size = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    stops = (ends[size - 1:] - 1).tolist()
    digest, n = xxhash.xxh64_intdigest, len(starts)
    hashes = np.fromiter((digest(plain[a:b], SEED) for a, b in zip(starts, stops, strict=True)),
                         dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, CHUNK):
        part = hashes[i:i + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint",
                 shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint as a long. Only the text goes to Python; a text
    that a batch holds more than once is worked on once."""
    @pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            known: dict = {}
            yield pd.Series([
                known[t] if t in known else known.setdefault(t, fingerprint(t, shingle))
                for t in batch.tolist()], dtype="int64")

    return docs.withColumn(out, simhash(F.col(text)))


def _walk(values: np.ndarray, first: np.ndarray, last: np.ndarray, middle: np.ndarray,
          distance: int) -> np.ndarray:
    """Joins ranges of ``values`` with themselves by tries.

    Each range ``first..last`` holds sorted distinct values; where ``middle`` lies
    inside, only pairs across it count (both halves sorted), else all pairs. Returns
    for each place the smallest place that links lead to. Node pairs whose values are
    all known to hang together are left, so a dense group costs no more than its trie.
    """
    n = len(values)
    roots = np.arange(n, dtype=np.int64)
    cross = middle > first
    end_a = np.where(cross, middle, last)
    start_b = np.where(cross, middle, first)
    waiting: dict[int, dict[int, list[np.ndarray]]] = {e: {} for e in range(distance + 1)}

    def later(e: int, depth: int, pairs: np.ndarray) -> None:
        if e <= distance and pairs.shape[1]:
            keep = (pairs[0] < pairs[1]) & (pairs[2] < pairs[3])
            same = pairs[0] == pairs[2]
            keep &= ~(same & (pairs[1] - pairs[0] < 2))
            pairs = pairs[:, keep]
            if pairs.shape[1]:
                waiting[e].setdefault(depth, []).append(pairs)

    def link(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal roots
        while len(a):
            x, y = roots[a], roots[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            low = np.minimum(x, y)
            np.minimum.at(roots, np.maximum(x, y), low)
            while True:
                higher = roots[roots]
                if (higher == roots).all():
                    break
                roots = higher

    def compare(pairs: np.ndarray) -> None:
        wide = pairs[3] - pairs[2]
        count = (pairs[1] - pairs[0]) * wide
        of = np.repeat(np.arange(len(count)), count)
        at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        a, b = pairs[0][of] + at // wide[of], pairs[2][of] + at % wide[of]
        near = (a != b) & (np.bitwise_count(values[a] ^ values[b]) <= distance)
        link(a[near], b[near])

    later(0, 0, np.stack([first, end_a, start_b, last]))
    for e in range(distance + 1):
        for depth in range(65):
            group = waiting[e].pop(depth, None)
            if not group:
                continue
            pairs = np.concatenate(group, axis=1)
            steps = np.concatenate([[0], np.cumsum(roots[1:] != roots[:-1])])
            known = ((steps[pairs[1] - 1] == steps[pairs[0]])
                     & (steps[pairs[3] - 1] == steps[pairs[2]])
                     & (roots[pairs[0]] == roots[pairs[2]]))
            pairs = pairs[:, ~known]
            small = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2]) <= LEAF
            leaves, pairs = pairs[:, small], pairs[:, ~small]
            for i in range(0, leaves.shape[1], 1 << 18):
                compare(leaves[:, i:i + (1 << 18)])
            if not pairs.shape[1]:
                continue
            bit = ((values >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64)
            ones = np.concatenate([[0], np.cumsum(bit)])
            a0, a1, b0, b1 = pairs
            am = a1 - (ones[a1] - ones[a0])
            bm = b1 - (ones[b1] - ones[b0])
            same = a0 == b0
            later(e, depth + 1, np.stack([a0, am, b0, bm]))
            later(e, depth + 1, np.stack([am, a1, bm, b1]))
            later(e + 1, depth + 1, np.stack([a0, am, bm, b1]))
            other = ~same
            later(e + 1, depth + 1, np.stack([am, a1, b0, bm])[:, other])
    return roots


def _joined(batches: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    """Links of whole cells; rows come sorted by bucket, cell, side and value."""
    held: list[pd.DataFrame] = []
    rows = 0

    def links(cells: pd.DataFrame) -> pd.DataFrame:
        values = cells.fp.to_numpy().view(np.uint64)
        side = cells.side.to_numpy()
        keys = cells[["bucket", "i", "j"]].to_numpy()
        order = np.lexsort((values, side, keys[:, 2], keys[:, 1], keys[:, 0]))
        values, side, keys = values[order], side[order], keys[order]
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        last = np.r_[first[1:], len(values)]
        sided = np.concatenate([[0], np.cumsum(side)])
        middle = np.where(keys[first, 1] < keys[first, 2], last - (sided[last] - sided[first]),
                          first)
        roots = _walk(values, first, last, middle, distance)
        moved = np.flatnonzero(roots != np.arange(len(roots)))
        signed = values.view(np.int64)
        return pd.DataFrame({"a": signed[moved], "b": signed[roots[moved]]})

    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows < SLAB:
            continue
        all_rows = pd.concat(held, ignore_index=True)
        tail = all_rows.iloc[-1]
        open_cell = ((all_rows.bucket == tail.bucket) & (all_rows.i == tail.i)
                     & (all_rows.j == tail.j))
        if open_cell.all():
            held = [all_rows]
            continue
        yield links(all_rows[~open_cell])
        held = [all_rows[open_cell]]
        rows = len(held[0])
    if rows:
        yield links(pd.concat(held, ignore_index=True))


def linked(values: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a``, ``b``: links that join exactly the distinct values of ``fp`` (long) that
    chains of values within ``distance`` bits join; at most one row for each value and
    bucket, not all pairs.

    The number of blocks grows with the number of values, so that buckets stay small.
    Buckets beyond CELL are cut into parts by a hash, and each pair of parts is joined
    in a cell of its own.
    """
    spark = values.sparkSession
    values = staged(values.select("fp").distinct(), "values")
    n = values.count()
    blocks = distance + 1 if n < 1 << 24 else distance + 2 if n < 1 << 32 else distance + 3
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    width = max(b - a for a, b in zip(edges, edges[1:], strict=False))

    def block(k: int):
        low, high = edges[k], edges[k + 1]
        return F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1))

    buckets = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        key = F.lit(number).cast("long")
        for k in chosen:
            key = F.shiftleft(key, width).bitwiseOR(block(k))
        buckets.append(key)
    dealt = values.select("fp", F.explode(F.array(*buckets)).alias("bucket"))
    large = staged(dealt.groupBy("bucket").agg(F.count("*").alias("n"))
                   .filter(F.col("n") > CELL)
                   .select(F.col("bucket").alias("big"), F.ceil(F.col("n") / CELL).alias("parts")),
                   "large")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    celled = (dealt.join(large, F.col("bucket") == F.col("big"), "left")
              .withColumn("parts", F.coalesce("parts", F.lit(1)).cast("int"))
              .withColumn("mine", part)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select("bucket", F.least("mine", "other").alias("i"),
                      F.greatest("mine", "other").alias("j"),
                      (F.col("mine") > F.col("other")).cast("int").alias("side"), "fp"))
    return (celled.repartition(partitions(spark), "bucket", "i", "j")
            .sortWithinPartitions("bucket", "i", "j")
            .mapInPandas(lambda batches: _joined(batches, distance), "a long, b long"))


def grouped(prints: DataFrame, doc: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """``prints`` (``doc`` and ``fingerprint``) with ``component_id``, the smallest id
    of the group; null ids only count in a group that has no other."""
    values = staged(prints.groupBy(F.col("fingerprint").alias("fp"))
                    .agg(F.min(doc).alias("least")), "least")
    roots = components(linked(values, distance))
    rooted = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(least, "root").select(F.col("fp").alias("__lw_fp"), "component_id")
    return prints.join(found, F.col("fingerprint") == F.col("__lw_fp")).drop("__lw_fp")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for each group; columns as they were.

    It is the row of the smallest id (null ids last), then of the smallest hash of the
    text; of equal rows one stays. Null and empty texts have fingerprint 0 and so are
    one group with whatever else is within the distance of 0.
    """
    ids = staged(fingerprints(docs.select(
        "doc_id", F.xxhash64("text").alias("key"), "text"), shingle=shingle).drop("text"),
        "prints")
    # Groups by fingerprint; the smallest (id, hash of text) of each.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    values = staged(ids.groupBy(F.col("fingerprint").alias("fp"))
                    .agg(F.min(order).alias("least")), "least")
    roots = components(linked(values, distance))
    kept = (values.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("one"))
            .select(F.col("one.doc_id").alias("__lw_doc"), F.col("one.key").alias("__lw_key")))
    keyed = docs.withColumn("__lw_text", F.xxhash64("text"))
    return (keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["__lw_doc"])
                       & (keyed["__lw_text"] == kept["__lw_key"]), "left_semi")
            .dropDuplicates(["doc_id", "__lw_text"]).select(*docs.columns))


def simhash_report(docs: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    prints = staged(fingerprints(docs.select("doc_id", "text")).drop("text"), "prints")
    return grouped(prints).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id")
