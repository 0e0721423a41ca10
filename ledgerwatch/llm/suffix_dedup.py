"""Removal of repeated byte strings across documents.

A byte goes if a string of LENGTH bytes that covers it also starts earlier. A suffix
array of the whole corpus would move every byte's suffix; here windows of LENGTH bytes
are dealt by the least hash of the GRAM-byte strings inside them, so that equal windows
meet, and neighbouring windows with the same least string travel as one run. Runs whose
bytes are equal (64 bits of the string's hash and 64 of the run's) keep only their first;
where different runs share a string, the bytes on either side of it are put in order by
the hash-compared suffix sort of ``suffix_sort``, verified byte by byte, which tells how
far any two runs agree.
"""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import partitions, staged
from .suffix_sort import PrefixHashes, depths

LENGTH = 100
GRAM = 32
#: Bytes hashed at once; a longer document is worked on in pieces.
PIECE = 1 << 22
#: Bytes of text whose runs are reduced before they are shuffled.
SLAB_BYTES = 1 << 26
#: Runs, and bytes of runs, that are compared at once (whole groups).
SLAB_ROWS = 500_000
SLAB_TEXT = 1 << 22
#: Up to this many document ids are broadcast to choose texts before a shuffle; beyond,
#: all texts are shuffled.
SMALL = 1_000_000

NULL_ID = -(1 << 63)
ROWS = "kind int, h long, e long, doc long, key long, lo long, n int"
NAMES = [x.split()[0] for x in ROWS.split(", ")]
REP, SPAN, REQUEST = 0, 1, 2


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs_of(text: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Runs of windows with the same least string: ``first`` window, ``count``, hash.

    ``text`` holds documents that end at ``ends``; windows lie within one. The least
    string is the one with the smallest hash, the leftmost of equals, which depends on
    the window's bytes alone.
    """
    import xxhash
    n = len(text)
    empty = np.zeros(0, dtype=np.int64)
    if n < length:
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    hashes = PrefixHashes(text)
    strings = _mixed(hashes.of(np.arange(n - gram + 1), gram))
    bits = np.uint64(int(n).bit_length())
    least = (strings >> bits << bits) | np.arange(len(strings), dtype=np.uint64)
    width, need = 1, length - gram + 1
    while width * 2 <= need:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if need > width:
        least = np.minimum(least[:len(least) - (need - width)], least[need - width:])
    place = (least & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    windows = np.arange(len(place))
    fits = np.zeros(len(place), dtype=bool)
    begins = np.r_[0, ends[:-1]]
    edge = np.zeros(n + 2, dtype=np.int64)
    long_enough = ends - begins >= length
    np.add.at(edge, begins[long_enough], 1)
    np.add.at(edge, ends[long_enough] - length + 1, -1)
    fits = np.cumsum(edge)[:len(place)] > 0
    change = np.r_[True, (place[1:] != place[:-1]) | (fits[1:] != fits[:-1])]
    first = windows[change]
    count = np.diff(np.r_[first, len(place)])
    keep = fits[first]
    first, count = first[keep], count[keep]
    raw = text.tobytes()
    digest = xxhash.xxh3_64_intdigest
    whole = np.fromiter((digest(raw[a:b]) for a, b in zip(
        first.tolist(), (first + count + length - 1).tolist(), strict=True)),
        dtype=np.uint64, count=len(first))
    return first, count, strings[place[first]], whole


def _reduced(parts: list[pd.DataFrame], length: int) -> pd.DataFrame:
    """First of equal runs as REP; the bytes of the others as SPAN."""
    rows = pd.concat(parts, ignore_index=True).drop_duplicates(["doc", "key", "lo"])
    rows = rows.sort_values(["h", "e", "doc", "key", "lo"], ignore_index=True)
    again = ((rows.h == rows.h.shift()) & (rows.e == rows.e.shift())).to_numpy()
    rows["kind"] = np.where(again, SPAN, REP)
    gone = _joined_spans(rows[again], length)
    return pd.concat([rows[~again][NAMES], gone], ignore_index=True)


def _joined_spans(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Windows ``lo .. lo + n`` as spans of bytes, touching windows joined."""
    rows = rows.sort_values(["doc", "key", "lo"])
    doc, key, lo, n = (rows[c].to_numpy() for c in ("doc", "key", "lo", "n"))
    if len(lo) == 0:
        return pd.DataFrame(columns=NAMES)
    new = np.r_[True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (lo[1:] != lo[:-1] + n[:-1])]
    heads = np.flatnonzero(new)
    total = np.add.reduceat(n, heads)
    spread = _mixed(doc[heads].view(np.uint64)).view(np.int64)
    return pd.DataFrame({"kind": SPAN, "h": spread, "e": 0, "doc": doc[heads],
                         "key": key[heads], "lo": lo[heads], "n": total + length - 1})[NAMES]


def _runs(batches: Iterator[pd.DataFrame], length: int, gram: int) -> Iterator[pd.DataFrame]:
    parts: list[pd.DataFrame] = []
    held = 0

    def add(texts: list[np.ndarray], docs: list[tuple]) -> None:
        ends = np.cumsum([len(t) for t in texts])
        first, count, h, e = runs_of(np.concatenate(texts), ends, length, gram)
        of = np.searchsorted(ends, first, side="right")
        begins = np.r_[0, ends[:-1]]
        ids = np.array([d[0] for d in docs], dtype=np.int64)[of]
        keys = np.array([d[1] for d in docs], dtype=np.int64)[of]
        offsets = np.array([d[2] for d in docs], dtype=np.int64)[of]
        parts.append(pd.DataFrame({"kind": REP, "h": h.view(np.int64), "e": e.view(np.int64),
                                   "doc": ids, "key": keys, "lo": first - begins[of] + offsets,
                                   "n": count}))

    for batch in batches:
        texts: list[np.ndarray] = []
        docs: list[tuple] = []
        size = 0
        for doc, key, raw in zip(batch.doc.tolist(), batch.key.tolist(), batch.raw.tolist(),
                                 strict=True):
            if len(raw) < length:
                continue
            for at in range(0, len(raw) - length + 1, PIECE):
                piece = np.frombuffer(raw[at:at + PIECE + length - 1], dtype=np.uint8)
                if texts and size + len(piece) > PIECE:
                    add(texts, docs)
                    texts, docs, size = [], [], 0
                texts.append(piece)
                docs.append((doc, key, at))
                size += len(piece)
                held += len(piece)
        if texts:
            add(texts, docs)
        if held >= SLAB_BYTES:
            yield _reduced(parts, length)
            parts, held = [], 0
    if parts:
        yield _reduced(parts, length)


def _whole_groups(batches: Iterator[pd.DataFrame], limit: int,
                  size) -> Iterator[pd.DataFrame]:
    """Rows sorted by ``h``, in pieces that hold every row of an ``h``."""
    held: list[pd.DataFrame] = []
    total = 0
    for batch in batches:
        held.append(batch)
        total += size(batch)
        if total < limit:
            continue
        rows = pd.concat(held, ignore_index=True)
        last = (rows.h == rows.h.iloc[-1]).to_numpy()
        held, total = [rows[last]], 0
        if not last.all():
            yield rows[~last]
    if held:
        yield pd.concat(held, ignore_index=True)


def _compared(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Spans of runs with an equal one before; requests for the first of each where
    runs of one string differ."""
    for rows in _whole_groups(batches, SLAB_ROWS, len):
        ready = rows[rows.kind == SPAN]
        reps = rows[rows.kind == REP]
        if len(ready):
            yield ready[NAMES]
        if not len(reps):
            continue
        shared = reps.h.duplicated(keep=False)
        reps = reps[shared].sort_values(["h", "e", "doc", "key", "lo"], ignore_index=True)
        if not len(reps):
            continue
        same = (reps.h == reps.h.shift()) & (reps.e == reps.e.shift())
        place = (reps.doc == reps.doc.shift()) & (reps.key == reps.key.shift()) & (
            reps.lo == reps.lo.shift())
        yield _joined_spans(reps[same & ~place], length)
        first = reps[~same]
        first = first[first.h.duplicated(keep=False)]
        yield first.assign(kind=REQUEST)[NAMES]


def _cut(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out: dict[str, list] = {c: [] for c in ("h", "doc", "key", "lo", "n", "bytes")}
        for row in batch.itertuples(index=False):
            for want in row.wanted:
                h, lo, n = want["h"], want["lo"], want["n"]
                for name, value in zip(out, (h, row.doc, row.key, lo, n,
                                             row.raw[lo:lo + n + length - 1]), strict=True):
                    out[name].append(value)
        yield pd.DataFrame(out)


def _sorted_windows(batches: Iterator[pd.DataFrame], length: int,
                    gram: int) -> Iterator[pd.DataFrame]:
    """Windows that equal an earlier one, within each string's group.

    A window that begins ``d`` bytes before the string is known by the ``d`` bytes to its
    left and ``length - gram - d`` to its right. Both contexts of every run are suffix
    sorted, the left ones read backwards; runs whose contexts agree to some depth then
    stand together, and a window is repeated if an earlier run has the same place on
    either side at its depths. The work grows with the runs, not with pairs of them.
    """
    size = lambda b: int(b.bytes.map(len).sum())
    deep = length - gram
    for rows in _whole_groups(batches, SLAB_TEXT, size):
        rows = rows.sort_values(["h", "doc", "key", "lo"], ignore_index=True)
        text = np.frombuffer(b"".join(rows.bytes.tolist()), dtype=np.uint8)
        n = rows.n.to_numpy().astype(np.int64)
        ends = np.cumsum(n + length - 1)
        begins = ends - (n + length - 1)
        hashes = PrefixHashes(text)
        group = rows.h.to_numpy()
        anchors = np.array([_anchor(hashes, b, k, gram, h) for b, k, h in zip(
            begins.tolist(), (n + length - 1).tolist(), group.tolist(), strict=True)])
        number = np.cumsum(np.r_[False, group[1:] != group[:-1]])

        def context(at: np.ndarray, step: int, low=begins, high=ends, bytes_=text) -> np.ndarray:
            """``deep`` bytes from ``at`` on; zeros beyond the run, where no window lies."""
            place = at[:, None] + step * np.arange(deep)
            inside = (place >= low[:, None]) & (place < high[:, None])
            return np.where(inside, bytes_[np.clip(place, 0, len(bytes_) - 1)], 0).astype(np.uint8)

        left = depths(context(begins + anchors - 1, -1), number)
        right = depths(context(begins + anchors + gram, 1), number)
        again = [np.zeros(0, dtype=np.int64)] * 2
        for d in range(max(0, int((anchors - n).min()) + 1), min(deep, int(anchors.max())) + 1):
            have = np.flatnonzero((anchors >= d) & (anchors - n < d))
            seen = pd.Series(left(d)[have] * (len(rows) + 1) + right(deep - d)[have]).duplicated()
            found = have[seen.to_numpy()]
            again = [np.r_[again[0], found], np.r_[again[1], anchors[found] - d]]
        row, offset = again
        yield _joined_spans(pd.DataFrame({
            "doc": rows.doc.to_numpy()[row], "key": rows.key.to_numpy()[row],
            "lo": rows.lo.to_numpy()[row] + offset, "n": 1}), length)


def _anchor(hashes: PrefixHashes, begin: int, size: int, gram: int, h: int) -> int:
    """Where the string of hash ``h`` first lies in a run."""
    found = _mixed(hashes.of(np.arange(begin, begin + size - gram + 1), gram))
    return int(np.argmax(found.view(np.int64) == h))


def _chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` whose ``doc`` is among ``ids``, if few enough to broadcast; else all."""
    wanted = staged(ids.select(F.col("doc").alias("__lw_doc")).distinct(), "ids")
    if wanted.count() > SMALL:
        return docs
    return docs.join(F.broadcast(wanted), F.col("doc") == F.col("__lw_doc"), "left_semi")


def _keyed(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """``doc``, ``key``, ``raw``: the id (null as the smallest number), a hash of the
    text where ids repeat (else 0), and the bytes."""
    ids = docs.agg(F.count("*").alias("n"), F.count_distinct(doc).alias("d")).first()
    key = F.lit(0).cast("long") if ids["n"] == ids["d"] else F.xxhash64(F.col(text))
    return docs.select(
        F.coalesce(F.col(doc), F.lit(NULL_ID)).cast("long").alias("doc"), key.alias("key"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))


def repeated_spans(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc``, ``key``, ``spans`` (array of ``lo``, ``n`` in bytes, which may overlap)
    of every document with bytes to remove. ``keyed`` has ``doc``, ``key``, ``raw``.

    Rows of equal ``doc`` and ``key`` are one document. Equal runs are reduced to one
    for each slab of a task before the shuffle, so a text with any share of the rows
    counts once for each slab.
    """
    spark = keyed.sparkSession
    runs = keyed.mapInPandas(lambda batches: _runs(batches, length, gram), ROWS)
    found = staged(runs.repartition(partitions(spark), "h").sortWithinPartitions("h")
                   .mapInPandas(lambda batches: _compared(batches, length), ROWS), "runs")
    requests = found.filter(F.col("kind") == REQUEST)
    wanted = requests.groupBy("doc", "key").agg(
        F.collect_list(F.struct("h", "lo", "n")).alias("wanted"))
    cuts = (_chosen(keyed, requests)
            .join(wanted, ["doc", "key"])
            .mapInPandas(lambda batches: _cut(batches, length),
                         "h long, doc long, key long, lo long, n int, bytes binary")
            .dropDuplicates(["h", "doc", "key", "lo"]))
    windows = staged(
        cuts.repartition(partitions(spark), "h").sortWithinPartitions("h")
        .mapInPandas(lambda batches: _sorted_windows(batches, length, gram), ROWS), "windows")
    return (found.filter(F.col("kind") == SPAN).unionByName(windows)
            .groupBy("doc", "key").agg(F.collect_list(F.struct("lo", "n")).alias("spans")))


def _kept(raw: bytes, spans) -> tuple[bytes, int, int]:
    """The bytes outside the spans, how many are inside, and their maximal runs."""
    out, at, gone, runs = [], 0, 0, 0
    for lo, n in sorted((s["lo"], s["n"]) for s in spans):
        if runs and lo <= at:
            if lo + n > at:
                gone += lo + n - at
                at = lo + n
            continue
        out.append(raw[at:lo])
        runs += 1
        gone += n
        at = lo + n
    out.append(raw[at:])
    return b"".join(out), gone, runs


def without_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text",
                    length: int = LENGTH) -> DataFrame:
    """``doc`` (as ``doc``, null as the smallest number), ``key``, ``kept`` (bytes),
    ``n_removed``, ``n_spans`` of the documents that lose bytes.

    Order of occurrence: id (null first), then a hash of the text where ids repeat, then
    place. Rows equal in id and text are one document and no copies of each other. Null
    texts are empty; texts shorter than ``length`` bytes lose nothing.
    """
    keyed = _keyed(docs, doc, text)
    spans = staged(repeated_spans(keyed, length), "spans")

    @pandas_udf("kept binary, n_removed long, n_spans long")
    def cut(raw: pd.Series, gone: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_kept(r, s) for r, s in zip(raw, gone, strict=True)],
                            columns=["kept", "n_removed", "n_spans"])

    return (_chosen(keyed, spans).join(spans, ["doc", "key"])
            .select("doc", "key", cut("raw", "spans").alias("x")).select("doc", "key", "x.*"))


def suffix_report(docs: DataFrame) -> DataFrame:
    """The contract's row for each document. Texts that lose nothing are hashed where
    they are read."""
    docs = docs.select("doc_id", "text")
    changed = without_repeats(docs).select(
        F.col("doc").alias("d"), F.col("key").alias("k"), "n_removed", "n_spans",
        F.sha2("kept", 256).alias("sha")).dropDuplicates(["d", "k"])
    keyed = _keyed(docs, "doc_id", "text")
    base = keyed.select(
        F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "doc", "key",
        F.octet_length("raw").cast("long").alias("n_bytes"), F.sha2("raw", 256).alias("all"))
    return (base.join(changed, (F.col("doc") == F.col("d")) & (F.col("key") == F.col("k")), "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long")
                    .alias("n_removed"),
                    F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
                    F.coalesce("sha", "all").alias("kept_sha256")))
