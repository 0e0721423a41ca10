"""Near-duplicates by the chosen-path set similarity join.

A document is the set of its distinct two-word shingles. Starting from one node that holds
every set, a node sends each of its sets on to the children named by the minwise tokens of
a few chosen functions; sets of high Jaccard similarity mostly choose the same tokens and
stay together, others part. A node that got small is compared exhaustively. Independent
trees repeat this, as many as the target recall asks for.

Groups of copies never get small. Each large node is first joined with a few of its own
sets, pivots: what hangs together after that needs no further look, so a node goes on only
while it holds sets that are not known to be connected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, few, partitions, small, staged

SHINGLE = 2
PERCENT = 80

#: Minwise functions of a set.
FUNCTIONS = 64
#: A pair is looked at if this many of its functions agree. At a similarity of 0.8 the
#: number is binomial, and smaller with a probability below 1e-3; above 0.85, 1e-5.
AGREE = 41
#: Nodes of up to this many sets are compared exhaustively, larger ones go on.
CELL = 2048
PIVOTS = 3
#: Levels after which nodes are compared whatever their size, cut into cells.
DEPTH = 12
#: Chance that a pair at the threshold meets in a small node of one of the trees.
RECALL = 0.9999
#: Pairs of a task that are compared at once.
SLAB = 1 << 18
#: Shingles of a part of a group whose whole sets are compared.
TOKENS = 1 << 20

_RANDOM = np.random.default_rng(13)
_MULTIPLY = _RANDOM.integers(0, 1 << 31, (FUNCTIONS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RANDOM.integers(0, 1 << 32, (FUNCTIONS, 1), dtype=np.uint32)


def functions_of(level: int) -> float:
    """Expected functions that a node at ``level`` branches by: two at the top, where
    dissimilar sets part at once, then 1 / threshold."""
    return 2.0 if level < 2 else 100 / PERCENT


def met(levels: int, similarity: float = PERCENT / 100) -> float:
    """Chance that a pair shares a node after ``levels`` levels of one tree."""
    chance = 1.0
    for level in reversed(range(levels)):
        more = functions_of(level) - 1
        one = similarity * chance
        chance = (1 - more) * one + more * (1 - (1 - one) ** 2)
    return chance


def trees(recall: float = RECALL, levels: int = 4) -> int:
    """Trees for which a pair is missed by all with a chance of at most 1 - recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - met(levels)))


class _Hashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, known: dict[bytes, int]) -> np.ndarray:
    """The set of a text in UTF-8 as sorted 64-bit hashes: of neighbouring words, or of a
    single word. Words are cut at ASCII white space, and only A-Z is lower-cased."""
    words = (text or b"").lower().split()
    hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(words) > 1:
        first = (hashes[:-1] << np.uint64(17)) | (hashes[:-1] >> np.uint64(47))
        hashes = _mixed(first * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    return np.unique(hashes)


def minima(tokens: np.ndarray) -> np.ndarray:
    """The minwise token of each function, as 32 bits of its hash. Tokens are mixed hashes
    already, so an odd factor and a shift make a function."""
    least = np.full(FUNCTIONS, np.iinfo(np.uint32).max, dtype=np.uint32)
    folded = (tokens >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(folded), 1024):
        part = _MULTIPLY * folded[i:i + 1024]
        part += _ADD
        np.minimum(least, part.min(axis=1), out=least)
    return least.view(np.int32)


KEYS = ("key", "n", "high", "low")
SETS = "doc_id long, key long, n long, high long, low long, signature array<int>, sketch binary"
WHOLE = "key long, n long, high long, low long, tokens array<long>"


def _sets(batches: Iterator[pa.RecordBatch]
          ) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[pa.Array]]]:
    """Some rows, their sets and KEYS."""
    import xxhash
    known = _Hashes()
    for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
        sets = []
        for text in batch.column("text").cast(pa.binary()):
            sets.append(shingles(text.as_py(), known))
            if len(known) > 1 << 18:
                known.clear()
        sizes = np.array([len(x) for x in sets], dtype=np.int64)
        keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.tobytes()) for x in sets),
                             dtype=np.int64).reshape(-1, 2)
        yield batch, sets, [batch.column("key"), pa.array(sizes), pa.array(keys[:, 0]),
                            pa.array(keys[:, 1])]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, sets, keys in _sets(batches):
        least = np.array([minima(x) for x in sets], dtype=np.int32).reshape(-1, FUNCTIONS)
        yield pa.record_batch(
            [batch.column("doc_id"), *keys, pa.ListArray.from_arrays(
                np.arange(len(sets) + 1, dtype=np.int32) * FUNCTIONS, least.ravel()),
             pa.array([x.tobytes() for x in least.astype(np.uint8)], pa.binary())],
            names=["doc_id", *KEYS, "signature", "sketch"])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, sets, keys in _sets(batches):
        offsets = np.r_[0, np.cumsum([len(x) for x in sets])].astype(np.int32)
        tokens = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
        yield pa.record_batch([*keys, pa.ListArray.from_arrays(offsets, tokens)],
                              names=[*KEYS, "tokens"])


def token_sets(docs: DataFrame) -> DataFrame:
    """What stands for each row's set, with its ``doc_id`` and a number ``id``; staged. Equal
    sets have equal ``high`` and ``low`` (128 bits of a hash); ``key`` is a hash of the text,
    by which ``whole_sets`` reads it again."""
    sets = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"),
                       "text").mapInArrow(_read, SETS)
    return staged(sets.withColumn("id", F.monotonically_increasing_id()), "sets")


def whole_sets(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` (staged, with KEYS; no two equal) with the ``tokens`` of each, made again
    from the texts: few sets are ever compared, and all of them would take more room than the
    texts. A text of many rows is read once."""
    texts = (docs.select(F.xxhash64("text").alias("key"), "text")
             .join(small(asked.select("key")), "key", "left_semi").distinct())
    return texts.mapInArrow(_tokens, WHOLE).join(small(asked), list(KEYS))


def _flat(parent: list[int]) -> np.ndarray:
    """The root of each node of a forest."""
    roots = np.array(parent, dtype=np.int64)
    while (roots[roots] != roots).any():
        roots = roots[roots]
    return roots


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of whole cells that agree in AGREE functions and have different roots, with
    their roots ``ra`` and ``rb``: not all of them, but a forest of each cell and a pair of
    each set that has one, so at most two for each row. Rows come sorted by cell; ``side``
    tells the halves of a cell of two parts, of which only pairs across count."""
    held: list[pd.DataFrame] = []

    def pairs(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        keys = rows[["node", "i", "j"]].to_numpy()
        ids, roots, side = (rows[c].to_numpy() for c in ("id", "root", "side"))
        sketch = np.frombuffer(b"".join(rows.sketch), dtype=np.uint8).reshape(-1, FUNCTIONS)
        new = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]
        starts = np.flatnonzero(new)
        ends = np.r_[starts[1:], len(rows)]
        place = np.arange(len(rows))
        partners = np.repeat(ends, ends - starts) - place - 1  # rows after each in its cell
        reach = np.cumsum(partners)
        # What hangs together in its cell, and the rows that have a pair.
        _, tree = np.unique(np.stack([np.cumsum(new), roots]), axis=1, return_inverse=True)
        tree = tree.ravel()
        parent = list(range(int(tree.max()) + 1))
        seen = np.zeros(len(rows), dtype=bool)

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        at = 0
        while at < len(rows):  # rows whose pairs fill a slab
            done = max(at + 1, int(np.searchsorted(
                reach, (reach[at - 1] if at else 0) + SLAB, side="right")))
            a = np.repeat(place[at:done], partners[at:done])
            first = np.cumsum(partners[at:done]) - partners[at:done]
            b = a + 1 + np.arange(len(a)) - np.repeat(first, partners[at:done])
            at = done
            open_ = (roots[a] != roots[b]) & ((keys[a, 1] == keys[a, 2]) | (side[a] != side[b]))
            a, b = a[open_], b[open_]
            now = _flat(parent)[tree]
            fresh = (now[a] != now[b]) | ~seen[a] | ~seen[b]
            a, b = a[fresh], b[fresh]
            near = (sketch[a] == sketch[b]).sum(axis=1) >= AGREE
            chosen = []
            for x, y in zip(a[near].tolist(), b[near].tolist(), strict=True):
                one, two = find(tree[x]), find(tree[y])
                if one != two or not (seen[x] and seen[y]):
                    parent[two] = one
                    seen[x] = seen[y] = True
                    chosen.append((x, y))
            a, b = np.array(chosen, dtype=np.int64).reshape(-1, 2).T
            yield pd.DataFrame({"a": ids[a], "b": ids[b], "ra": roots[a], "rb": roots[b]})

    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size < 4 * CELL:
            continue
        rows = pd.concat(held, ignore_index=True)
        tail = rows.iloc[-1]
        open_cell = (rows.node == tail.node) & (rows.i == tail.i) & (rows.j == tail.j)
        held = [rows[open_cell]]
        size = len(held[0])
        if not open_cell.all():
            yield from pairs(rows[~open_cell])
    if size:
        yield from pairs(pd.concat(held, ignore_index=True))


def _cells(rows: DataFrame, parts: Column, *columns: str) -> DataFrame:
    """``rows`` of each node cut into ``parts``; each pair of parts is a cell (``node``,
    ``i``, ``j``), whose rows come together and in the order of ``side``."""
    parts = parts.cast("int")
    mine = F.pmod(F.xxhash64("id", "node"), parts).cast("int")
    cells = (rows.withColumn("parts", parts).withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("node", F.least("mine", "other").cast("long").alias("i"),
                     F.greatest("mine", "other").cast("long").alias("j"),
                     (F.col("mine") > F.col("other")).cast("int").alias("side"),
                     "id", "root", *columns))
    return (cells.repartition(partitions(rows.sparkSession), "node", "i", "j")
            .sortWithinPartitions("node", "i", "j", "side"))


def _exhaustive(rows: DataFrame) -> DataFrame:
    """Candidate pairs of all pairs of each node (``node``, ``size``, ``id``, ``root``,
    ``sketch``), as many as hold together what all of them would. Nodes beyond CELL are cut
    into parts, each pair of parts a cell."""
    return (_cells(rows, F.ceil(F.col("size") / CELL), "sketch")
            .mapInPandas(_compared, "a long, b long, ra long, rb long"))


def _links(ids: np.ndarray, roots: np.ndarray, side: np.ndarray, across: bool,
           sizes: np.ndarray, tokens: np.ndarray) -> list[tuple[int, int]]:
    """A forest of the links of one cell; whole sets are compared wherever two rows do not
    hang together yet. ``across``: only rows of different sides."""
    known, codes = np.unique(tokens, return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    second = int(np.searchsorted(side, 1))
    tree, found = roots.copy(), []
    mark = np.zeros(len(known), dtype=np.int32)
    for i in range(second if across else len(ids) - 1):
        first = second if across else i + 1
        n = sizes[first:]
        apart = tree[first:] != tree[i]
        apart &= np.minimum(n, sizes[i]) * 100 >= np.maximum(n, sizes[i]) * PERCENT
        asked = np.flatnonzero(apart)
        if not len(asked):
            continue
        own = codes[starts[i]:ends[i]]
        mark[own] = 1
        if len(asked) > 16:
            both = np.add.reduceat(mark[codes[starts[first]:]], starts[first:] - starts[first])
            both = both[asked].astype(np.int64)
        else:
            both = np.array([int(mark[codes[starts[first + j]:ends[first + j]]].sum())
                             for j in asked.tolist()], dtype=np.int64)
        mark[own] = 0
        alike = both * 100 >= (n[asked] + sizes[i] - both) * PERCENT
        for j in (first + asked[alike]).tolist():
            if tree[j] != tree[i]:
                tree[tree == tree[j]] = tree[i]
                found.append((int(ids[i]), int(ids[j])))
    return found


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forests of links of all cells; rows come sorted by cell and side."""
    held: list[tuple[np.ndarray, ...]] = []
    cell: tuple[int, int, int] | None = None

    def done() -> pa.RecordBatch:
        ids, roots, side, sizes, tokens = (np.concatenate(x) for x in zip(*held, strict=True))
        found = _links(ids, roots, side, cell[1] != cell[2], sizes, tokens)
        a, b = np.array(found, dtype=np.int64).reshape(-1, 2).T
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("node", "i", "j")], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            now = tuple(keys[begin].tolist())
            if held and now != cell:
                yield done()
                held = []
            cell, part = now, batch.slice(begin, end - begin)
            held.append((*(part.column(c).to_numpy() for c in ("id", "root", "side", "n")),
                         part.column("tokens").flatten().to_numpy()))
    if held:
        yield done()


def _grouped(near: DataFrame, docs: DataFrame, sets: DataFrame,
             roots: DataFrame | None) -> DataFrame | None:
    """The roots after the candidates ``near`` (``a``, ``b``, their roots) were looked at:
    what candidates hold together is a group, and within it whole sets are compared, each
    read once. Groups beyond CELL sets or TOKENS shingles are cut into parts, each pair of
    parts a cell."""
    near = staged(near, "near")
    rows = near.count()
    if not rows:
        return roots
    groups = components(near.select(F.col("ra").alias("a"), F.col("rb").alias("b")), rows)
    ends = F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("ra").alias("of")),
                             F.struct(F.col("b").alias("id"), F.col("rb").alias("of"))))
    asked = (few(near.select(ends.alias("x")).select("x.*").distinct(), 2 * rows)
             .join(groups.select(F.col("node").alias("of"), F.col("root").alias("node")), "of")
             .withColumnRenamed("of", "root"))
    asked = staged(asked.join(sets.select("id", *KEYS), "id"), "asked")
    size = asked.count()
    parts = few(asked.groupBy("node").agg(F.greatest(
        F.ceil(F.count("*") / CELL), F.ceil(F.sum("n") / TOKENS)).alias("cut")), size)
    members = staged(asked.join(parts, "node"), "members")
    cells = _cells(whole_sets(docs, members), F.col("cut"), "n", "tokens")
    links = staged(cells.mapInArrow(_confirmed, "a long, b long"), "links")
    return roots if links.isEmpty() else _merged(roots, links)


def _alike(pairs: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` whose whole sets are similar enough."""
    count = pairs.count()
    asked = few(pairs.select("a").union(pairs.select("b")).distinct(), 2 * count)
    asked = staged(sets.select("id", *KEYS).join(
        small(staged(asked.withColumnRenamed("a", "id"), "asked")), "id", "left_semi"), "keys")
    wanted = staged(whole_sets(docs, asked).select("id", "tokens", "n"), "wanted")
    left = wanted.select(F.col("id").alias("a"), F.col("tokens").alias("ta"),
                         F.col("n").alias("na"))
    right = wanted.select(F.col("id").alias("b"), F.col("tokens").alias("tb"),
                          F.col("n").alias("nb"))
    both = F.size(F.array_intersect("ta", "tb")).cast("long")
    # Sets of too different sizes are left out before any is compared.
    sized = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT)
    return (pairs.join(left, "a").join(right, "b").filter(sized)
            .filter(both * 100 >= (F.col("na") + F.col("nb") - both) * PERCENT)
            .select("a", "b"))


def _rooted(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``rows`` with the ``root`` of their ``id``, itself where it has no link."""
    if roots is None:
        return rows.withColumn("root", F.col("id"))
    return (rows.join(roots, F.col("id") == F.col("of"), "left")
            .withColumn("root", F.coalesce("to", "id")).drop("of", "to"))


def _merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """``of``, ``to``: every id with a link, and the smallest id it is connected with."""
    if roots is not None:
        links = links.unionByName(roots.select(F.col("of").alias("a"), F.col("to").alias("b")))
    return staged(components(links, links.count()).select(F.col("node").alias("of"), F.col("root").alias("to")),
                  "roots")


def _connected(pairs: DataFrame, docs: DataFrame, sets: DataFrame,
               roots: DataFrame | None) -> DataFrame | None:
    """The roots after all candidate ``pairs`` (none twice) were looked at."""
    links = staged(_alike(staged(pairs, "pairs"), docs, sets), "links")
    return roots if links.isEmpty() else _merged(roots, links)


def _pivots(large: DataFrame, rows: int) -> DataFrame:
    """A few sets of each node (``rows`` in all), those with the smallest hashes."""
    chosen = [F.min(F.struct(F.xxhash64("id", "node", F.lit(p)).alias("h"), "id", "root",
                             "sketch")).alias(f"p{p}") for p in range(PIVOTS)]
    return (few(large.groupBy("node").agg(*chosen), rows)
            .select("node", F.explode(F.array(*[f"p{p}" for p in range(PIVOTS)])).alias("p"))
            .select(F.col("node").alias("at"), F.col("p.id").alias("pivot"),
                    F.col("p.root").alias("pivot_root"), F.col("p.sketch").alias("pivot_sketch"))
            .distinct())


def _near_pivots(large: DataFrame, rows: int) -> DataFrame:
    """Candidate pairs of each set of a node (``rows`` in all) with the node's pivots."""
    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            mine, other = (np.frombuffer(b"".join(rows[c]), dtype=np.uint8).reshape(-1, FUNCTIONS)
                           for c in ("sketch", "pivot_sketch"))
            rows = rows[(mine == other).sum(axis=1) >= AGREE]
            yield pd.DataFrame({"a": np.minimum(rows["id"], rows["pivot"]),
                                "b": np.maximum(rows["id"], rows["pivot"])})

    return (large.join(small(staged(_pivots(large, rows), "pivots")), F.col("node") == F.col("at"))
            .filter("root <> pivot_root").select("id", "sketch", "pivot", "pivot_sketch")
            .mapInPandas(near, "a long, b long"))


def _children(rows: DataFrame, level: int) -> DataFrame:
    """``tree``, ``node``, ``id``: where ``rows`` (``tree``, ``node``, ``id``,
    ``signature``) go on to. Below the roots, which have functions of their own, a node's
    functions follow from its path, so that a pair has a new chance in each node."""
    more = functions_of(level) - 1
    one = F.pmod(F.xxhash64("node"), F.lit(FUNCTIONS))
    two = F.pmod(one + 1 + F.pmod(F.xxhash64("node", F.lit(1)), F.lit(FUNCTIONS - 1)),
                 F.lit(FUNCTIONS))
    if level == 0:
        one, two = (F.pmod(2 * F.col("tree") + j, F.lit(FUNCTIONS)) for j in (0, 1))
    kids = [F.struct("tree", F.xxhash64("node", F.lit(j), F.element_at(
        "signature", (at + 1).cast("int"))).alias("node")) for j, at in enumerate((one, two))]
    chosen = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(1000)) < int(1000 * more)
    kids = F.array_compact(F.array(kids[0], F.when(chosen, kids[1])))
    return rows.select("id", F.explode(kids).alias("kid")).select("kid.tree", "kid.node", "id")


def similar_sets(docs: DataFrame, sets: DataFrame, ids: DataFrame,
                 count: int | None = None) -> DataFrame:
    """``of``, ``to``: every set of ``ids`` (their ``id``; no two equal) that is linked with
    another, and the smallest id that links lead to. ``sets`` has each id's KEYS,
    ``signature`` and ``sketch``, ``docs`` the texts (``text``) that they are of.

    Rows of a level are small (a node, an id) until their node has another set; then they
    get the sketch. Nodes are hashes of paths, so a large one is only ever joined by id or
    cut into cells. Every level is staged; what its large nodes' pivots connect is
    confirmed on whole sets before the next one begins.
    """
    count = count or trees()
    start = (sets.select("id", "signature").join(small(ids.select("id")), "id", "left_semi")
             .withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
             .withColumn("node", F.col("tree").cast("long")))
    rows, roots = staged(_children(start, 0), "level"), None
    compared = rows.select("node", F.lit(0).cast("long").alias("size"), "id",
                           F.lit(None).cast("binary").alias("sketch")).limit(0)
    for level in range(1, DEPTH + 1):
        sizes = staged(few(rows.groupBy("node").agg(F.count("*").alias("size")), rows.count())
                       .filter("size > 1"), "sizes")
        rows = staged(rows.join(sizes, "node").join(sets.select("id", "sketch"), "id"), "members")
        ready = rows if level == DEPTH else rows.filter(F.col("size") <= CELL)
        compared = compared.unionByName(ready.select(*compared.columns))
        large = rows.filter(F.col("size") > CELL)
        many = large.count()
        if level == DEPTH or not many:
            break
        near = few(_near_pivots(few(_rooted(large, roots), many), many).distinct(), PIVOTS * many)
        roots = _connected(near, docs, sets, roots)
        large = staged(_rooted(large, roots), "large")
        apart = staged(few(large.groupBy("node").agg(F.min("root").alias("a"),
                                                     F.max("root").alias("b")), many)
                       .filter("a <> b").select("node"), "apart")
        going = large.join(apart, "node", "left_semi").select("tree", "node", "id")
        rows = staged(_children(going.join(sets.select("id", "signature"), "id"), level), "level")
    # All other pairs are compared where they are still apart.
    roots = _grouped(_exhaustive(_rooted(compared, roots)), docs, sets, roots)
    if roots is None:
        return ids.select(F.col("id").alias("of"), F.col("id").alias("to")).limit(0)
    return roots


def similar_report(docs: DataFrame) -> DataFrame:
    """The contract's row for each document. Null and empty texts have no shingles and are
    linked with nothing, also not with one another; their component is their own id. Rows
    of equal sets are linked, as are repeated rows. Null ids are no smallest id: a group
    of only such rows has a null component and keeps them. Other columns are not read."""
    sets = token_sets(docs)
    key = ("high", "low", "n")
    copies = staged(few(sets.filter("n > 0").groupBy(*key).agg(
        F.min("id").alias("id"), F.min("doc_id").alias("least")), sets.count()), "copies")
    rooted = _rooted(copies, similar_sets(docs, sets, copies))
    least = few(rooted.groupBy("root").agg(F.min("least").alias("component_id")), copies.count())
    found = staged(rooted.join(least, "root").select(*key, "component_id"), "found")
    rows = sets.select("doc_id", *key).join(small(found), list(key), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
