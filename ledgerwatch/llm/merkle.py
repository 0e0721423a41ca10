"""A Merkle manifest of a dataset: one root, and for every row a witness that leads to it.

Rows are leaves of a binary tree for each language, the trees' roots are leaves of a tree
above them. Trees are built by appending: a block of BLOCK leaves, aligned to its size,
is streamed into a stack of open subtrees, each leaf has the witness it has so far, and
whenever two subtrees of one height join, every leaf below is handed the other's digest.
The blocks' roots are appended in the same way to blocks of their own, and a leaf's
witness goes on with that of its block's root.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, ranked, staged

#: Nodes that one task appends; a power of two.
BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER = 7


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Frontier:
    """Open subtrees of the leaves appended so far, tallest first.

    ``lefts[i]`` and ``rights[i]`` are leaf i's witness up to its open subtree: for each
    level the sibling's digest on its side, both empty where a node was alone.
    """

    def __init__(self) -> None:
        self.lefts: list[list[str]] = []
        self.rights: list[list[str]] = []
        self._open: list[tuple[int, str, int, int]] = []

    def append(self, node: str) -> None:
        place = len(self.lefts)
        self.lefts.append([])
        self.rights.append([])
        self._join(0, node, place, place + 1)

    def _extend(self, first: int, end: int, left: str, right: str) -> None:
        for path in self.lefts[first:end]:
            path.append(left)
        for path in self.rights[first:end]:
            path.append(right)

    def _join(self, height: int, node: str, first: int, end: int) -> None:
        while self._open and self._open[-1][0] == height:
            _, left, start, _ = self._open.pop()
            self._extend(start, first, "", node)
            self._extend(first, end, left, "")
            height, node, first = height + 1, digest(left, node), start
        self._open.append((height, node, first, end))

    def close(self, height: int) -> str:
        """The root at ``height``; nodes without a sibling are hashed alone."""
        while True:
            low, node, first, end = self._open.pop()
            upper = self._open[-1][0] if self._open else height
            for _ in range(low, upper):
                self._extend(first, end, "", "")
                node = digest(node)
            if not self._open:
                return node
            self._join(upper, node, first, end)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**changed: Column) -> Column:
    """The digest of a row of FIELDS, with other values for ``changed`` ones."""
    return F.sha2(F.concat(*[_field(changed.get(f, F.col(f))) for f in FIELDS]), 256)


def _appended(nodes: DataFrame) -> DataFrame:
    """One round: every block of ``nodes`` (``tree``, ``place``, ``node``) streamed into
    a frontier. Adds ``block``, the witness up to the block's root, and that root as
    ``top``. A tree's only block is as high as its leaves ask for."""
    sizes = staged(nodes.groupBy("tree").agg(F.count("*").alias("size")), "sizes")
    dealt = nodes.join(sizes, "tree").withColumn("block", F.shiftright("place", BLOCK_BITS))
    more = "lefts array<string>, rights array<string>, top string"
    columns = [c for c in dealt.columns if c != "size"]
    schema = ", ".join(f"{c} {dealt.schema[c].dataType.simpleString()}" for c in columns)

    def append(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", kind="stable")
        size, frontier = int(rows["size"].iloc[0]), Frontier()
        for node in rows.node.tolist():
            frontier.append(node)
        top = frontier.close(BLOCK_BITS if size > BLOCK else (size - 1).bit_length())
        return rows[columns].assign(lefts=frontier.lefts, rights=frontier.rights, top=top)

    # Dealt by both keys: the join alone would leave a tree's blocks in one task.
    spread = dealt.repartition(partitions(nodes.sparkSession), "tree", "block")
    return staged(spread.groupBy("tree", "block").applyInPandas(append, f"{schema}, {more}"),
                  "blocks")


def witnesses(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``tree`` without nulls; ``place`` from 0 without gaps in each tree;
    ``node``; any others) with ``lefts``, ``rights`` and ``root`` of their tree.

    Rounds shrink the nodes to a BLOCK-th; each is staged. Blocks are dealt by tree and
    number, so a tree with any share of the leaves is spread over tasks.
    """
    keep = leaves.columns
    rounds = [_appended(leaves)]
    while rounds[-1].agg(F.max("block")).first()[0]:
        tops = rounds[-1].groupBy("tree", F.col("block").alias("place")).agg(
            F.any_value("top").alias("node"))
        rounds.append(_appended(tops))
    found = rounds.pop().withColumnRenamed("top", "root")
    for low in reversed(rounds):
        upper = found.select("tree", F.col("place").alias("block"), F.col("lefts").alias("__l"),
                             F.col("rights").alias("__r"), "root")
        found = (low.join(upper, ["tree", "block"])
                 .withColumn("lefts", F.concat("lefts", "__l"))
                 .withColumn("rights", F.concat("rights", "__r")))
    return found.select(*keep, "lefts", "rights", "root")


def folded(node: Column, lefts: Column, rights: Column) -> Column:
    """The root that ``node`` and its witness lead to."""
    return F.aggregate(
        F.arrays_zip(lefts.alias("l"), rights.alias("r")), node,
        lambda at, step: F.sha2(F.concat(step["l"], at, step["r"]), 256))


def proof(lefts: Column, rights: Column) -> Column:
    """The digests of a witness, level by level."""
    return F.array_join(F.zip_with(lefts, rights, lambda a, b: F.concat(a, b)), "")


def manifest(docs: DataFrame, **more: Column) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, and the witness from leaf to root as
    ``lefts`` and ``rights``, for every row; ``more`` are further columns of the rows.

    Null values, also a null id, are ``-``; null ids come first, rows of one id in order
    of their leaves, and repeated rows are leaves of their own. A null ``lang`` is a tree
    of its own, before all others. A single leaf is its tree's root, with an empty
    witness. An empty table has no rows and no root. Other columns are left out.
    """
    tree = F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "lang"))
    rows = docs.select("doc_id", tree.alias("tree"), leaf().alias("node"),
                       *[c.alias(n) for n, c in more.items()])
    placed = ranked(staged(rows, "leaves"), "tree", ("doc_id", "node"), "place")
    low = staged(witnesses(staged(placed, "placed")), "witnesses")
    tops = (low.groupBy("tree").agg(F.any_value("root").alias("node"))
            .select(F.col("tree").alias("lang_tree"), F.lit("").alias("tree"), "node"))
    ordered = staged(ranked(staged(tops, "tops"), "tree", ("lang_tree",), "place"), "placed")
    high = witnesses(ordered).select(
        F.col("lang_tree").alias("tree"), F.col("node").alias("subroot"),
        F.col("lefts").alias("__l"), F.col("rights").alias("__r"), F.col("root").alias("__root"))
    return low.join(high, "tree").select(
        "doc_id", F.col("node").alias("leaf"), "subroot", F.col("__root").alias("root"),
        F.concat("lefts", "__l").alias("lefts"), F.concat("rights", "__r").alias("rights"),
        *more)


def manifest_report(docs: DataFrame) -> DataFrame:
    """The contract's row for each document: every TAMPER-th, by a checksum of its id, has
    one character more when its root is computed again. A null id is not tampered with."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    longer = F.col("n_chars").cast("decimal(20,0)") + 1
    rows = manifest(docs, tampered=F.when(hit, leaf(n_chars=longer)))
    again = folded(F.coalesce("tampered", "leaf"), F.col("lefts"), F.col("rights"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(proof(F.col("lefts"), F.col("rights")), 256).alias("proof_sha256"),
        again.alias("folded_root")).withColumn(
            "verified", F.col("folded_root") == F.col("root"))
