"""Token ids of documents in compressed files that decode in parallel.

A file is a Parquet table of blocks in ascending document order. A block holds whole
documents: their ids and lengths, their token ids encoded by ``rans``, the frequency
table that it shares with the neighbouring blocks of its group (written once per file
where Parquet keeps equal values in its dictionary), and checksums of the payload and of
the token ids. Parquet's own commit makes the files safe against lost executors.
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import rans
from .common import partitions, scratch

END_ID = 2
#: Token ids that share a frequency table, and token ids in a block, at least (a block
#: ends with a document).
GROUP = 8_000_000
BLOCK = 1_000_000
#: Characters tokenised at once.
BATCH_CHARS = 4_000_000
#: Pieces of text whose ids a worker keeps, and their greatest length.
KNOWN = 1_000_000
KNOWN_LENGTH = 48
#: Pieces tokenised as one text.
TOGETHER = 500

BLOCKS = ("part int, block int, first_token long, n_tokens long, doc_ids array<long>, "
          "lengths array<long>, freq binary, payload binary, payload_crc32 long, "
          "ids_crc32 long")

#: White space, and where it is beside a space, so that pieces cannot be told by that space.
_WHITE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"
          + "".join(map(chr, range(0x2000, 0x200B))))
_UNEVEN = f"[{_WHITE}] | [{_WHITE}]|^ | $"
_CUTS = re.compile(r"(?<=\S)(?= \S)")

#: Letters, digits and marks (no apostrophe) that are sure to be a pre-token each, and pieces
#: that hold nothing else but single line ends between them.
_LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F"
_MARKS = r"!-&(-/:-@\[-`{-~"
_PARTS = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\n")
_PLAIN = re.compile(rf" (?:[{_LETTERS}0-9{_MARKS}]++\n?)++(?<!\n)")


class Encoder:
    """Ids of texts by a tokenizer of the tokenizers library.

    For a byte-level BPE without normaliser, a single space between two characters that
    are not white space always begins a new pre-token; so texts are cut there, and each
    distinct piece is tokenised once and kept. Texts that hold the string of an added
    token, and tokenizers of other kinds, are encoded as a whole.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        parts = json.loads(spec)
        before = parts.get("pre_tokenizer") or {}
        self.in_pieces = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                          and not before.get("add_prefix_space") and not parts.get("normalizer")
                          and not parts.get("truncation") and not parts.get("padding"))
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # In a byte-level vocabulary a token has a character for each of its bytes.
        self.widths = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.widths[number] = len(token)
        self.known: dict[str, bytes] = {}  # pieces and their parts, with the space before

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that begin with a space or line end. They are tokenised as one text,
        in which each begins a pre-token; the bytes of the tokens tell the pieces apart."""
        ids = np.array(self.tokenizer.encode_batch_fast(
            ["".join(pieces)], add_special_tokens=False)[0].ids, dtype=self.kind)
        ends = np.cumsum([len(x.encode()) for x in pieces])
        cuts = np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1
        flat, size = ids.tobytes(), self.kind.itemsize
        return [flat[a * size:b * size]
                for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]

    def _learn(self, pieces: list[str]) -> None:
        """Keep the ids of pieces and parts that are not known. What is not after a space is
        tokenised after a line end, a pre-token of its own."""
        self.known["\n"] = self._whole(["\n"])[0]
        line = len(self.known["\n"])
        for lead, some in (("", [x for x in pieces if x[0] == " "]),
                           ("\n", [x for x in pieces if x[0] not in " \n"])):
            for at in range(0, len(some), TOGETHER):
                now = some[at:at + TOGETHER]
                found = self._pieces([lead + x for x in now] if lead else now)
                self.known.update(zip(now, [x[line:] for x in found] if lead else found,
                                      strict=True))

    def _made_up(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that are _PLAIN, put together from those of their parts."""
        known = self.known
        if not pieces:
            return []
        parts = _PARTS.findall("".join(pieces))
        self._learn(list({x for x in parts if x not in known}))
        ids = list(map(known.__getitem__, parts))
        flat, at = b"".join(ids), np.cumsum([0, *map(len, ids)])
        first = at[:-1][np.fromiter((x[0] == " " for x in parts), dtype=bool, count=len(parts))]
        return [flat[a:b] for a, b in zip(first.tolist(), [*first[1:].tolist(), len(flat)],
                                          strict=True)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=self.kind).tobytes() for x in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids (``kind``) of each text."""
        if len(self.known) > KNOWN:
            self.known.clear()
        # Texts are cut at every space, some by hand; the first piece of a text is its head.
        given = pa.array(texts, pa.large_string())
        uneven = pc.match_substring_regex(given, _UNEVEN).to_numpy(zero_copy_only=False)
        whole = [not self.in_pieces or any(a in text for a in self.added) for text in texts]
        by_hand = np.flatnonzero(uneven | np.array(whole, dtype=bool)).tolist()
        if not by_hand:
            return self._put(*_cut(given))
        out = dict(zip(by_hand, self._put(*_listed(
            [[texts[i]] if whole[i] else _CUTS.split(texts[i]) for i in by_hand])), strict=True))
        others = [i for i in range(len(texts)) if i not in out]
        out.update(zip(others, self._put(*_cut(given.take(pa.array(others, pa.int64())))),
                       strict=True))
        return [out[i] for i in range(len(texts))]

    def _put(self, pieces: pa.Array, counts: np.ndarray) -> list[bytes]:
        """Ids of texts of which the first has the first ``counts[0]`` pieces, and so on."""
        known = self.known
        ends = np.cumsum(counts)
        first = np.zeros(len(pieces), dtype=bool)
        first[ends - counts] = True
        heads = _strings(pieces.filter(pa.array(first)))
        # Pieces are numbered, so that each is looked up once and numpy puts its ids in place.
        numbered = pieces.filter(pa.array(~first)).dictionary_encode()
        distinct = _strings(numbered.dictionary)
        parts = list(map(known.get, distinct))
        missing = [i for i, ids in enumerate(parts) if ids is None]
        blank = [i for i in missing if distinct[i][1].isspace() or distinct[i][-1].isspace()]
        for i, ids in zip(blank, self._whole([distinct[i] for i in blank]), strict=True):
            parts[i] = ids
        missing = [i for i in missing if parts[i] is None]
        plain = [i for i in missing if _PLAIN.fullmatch(distinct[i])]
        for i, ids in zip(plain, self._made_up([distinct[i] for i in plain]), strict=True):
            parts[i] = ids
        missing = [i for i in missing if parts[i] is None]
        self._learn([distinct[i] for i in missing])
        for i in missing:
            parts[i] = known[distinct[i]]
        for x in [x for x in map(distinct.__getitem__, missing) if len(x) > KNOWN_LENGTH]:
            del known[x]
        parts += self._whole(heads)
        flat, size = np.frombuffer(b"".join(parts), dtype=self.kind), self.kind.itemsize
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // size
        order = np.empty(len(pieces), dtype=np.int64)
        order[first] = len(distinct) + np.arange(len(counts))
        order[~first] = numbered.indices.to_numpy()
        lengths = sizes[order]
        reach = np.cumsum(lengths)
        moved = (np.cumsum(sizes) - sizes)[order] - (reach - lengths)
        out = flat[np.repeat(moved, lengths) + np.arange(lengths.sum())].tobytes()
        cuts = [0, *(reach[ends - 1] * size).tolist()]
        return [out[a:b] for a, b in zip(cuts, cuts[1:])]


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def _listed(pieces: list[list[str]]) -> tuple[pa.Array, np.ndarray]:
    return (pa.array([x for some in pieces for x in some], pa.large_string()),
            np.array([len(some) for some in pieces], dtype=np.int64))


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts, cut before each space, and their number in each text."""
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    space = np.flatnonzero(np.frombuffer(data, dtype=np.uint8)[:at[-1]] == 32) if data else at[:0]
    # An empty text is one empty piece.
    places = np.sort(np.r_[at, space], kind="stable")
    counts = np.searchsorted(space, at[1:]) - np.searchsorted(space, at[:-1]) + 1
    return pa.LargeStringArray.from_buffers(
        len(places) - 1, pa.py_buffer(places), data or pa.py_buffer(b"")), counts


def _encoder(spec: str) -> Encoder:
    """One encoder for a worker process, kept from task to task."""
    store = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders"))
    key = f"e{zlib.crc32(spec.encode())}_{len(spec)}"
    if not hasattr(store, key):
        setattr(store, key, Encoder(spec))
    return getattr(store, key)


def _blocks(batches: Iterator[pd.DataFrame], spec: str, end_id: int) -> Iterator[pd.DataFrame]:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    encoder = _encoder(spec)
    end = np.array([end_id], dtype=encoder.kind).tobytes()
    part = TaskContext.get().partitionId()
    size = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
    ids: list[bytes] = []
    docs: list[int | None] = []
    state = {"held": 0, "block": 0, "first": 0}

    def written() -> pd.DataFrame:
        everything = np.frombuffer(b"".join(ids), dtype=encoder.kind)
        freq = rans.pack_table(rans.quantised(np.bincount(everything, minlength=size)))
        table = rans.Table(freq)
        lengths = np.array([len(x) // encoder.kind.itemsize for x in ids], dtype=np.int64)
        ends = np.cumsum(lengths)
        rows, at, begin = [], 0, 0
        while at < len(lengths):
            stop = min(len(lengths), int(np.searchsorted(ends, begin + BLOCK)) + 1)
            own = everything[begin:ends[stop - 1]].astype(np.uint32)
            payload = rans.encode(own, table)
            rows.append((part, state["block"], state["first"], len(own), docs[at:stop],
                         lengths[at:stop].tolist(), freq, payload, zlib.crc32(payload),
                         zlib.crc32(own.astype("<u4"))))
            state["block"] += 1
            state["first"] += len(own)
            at, begin = stop, int(ends[stop - 1])
        ids.clear()
        docs.clear()
        state["held"] = 0
        return pd.DataFrame(rows, columns=[x.split()[0] for x in BLOCKS.split(", ")])

    for batch in batches:
        doc_ids = [None if pd.isna(x) else int(x) for x in batch.doc_id.tolist()]
        texts = ["" if x is None else x for x in batch.text.tolist()]
        at = 0
        while at < len(texts):
            stop, chars = at, 0
            while stop < len(texts) and (stop == at or chars + len(texts[stop]) <= BATCH_CHARS):
                chars += len(texts[stop])
                stop += 1
            for found in encoder.encode(texts[at:stop]):
                ids.append(found + end)
                state["held"] += len(ids[-1]) // encoder.kind.itemsize
            docs.extend(doc_ids[at:stop])
            at = stop
            if state["held"] >= GROUP:
                yield written()
    if ids:
        yield written()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Writes the ids of ``docs`` (``doc_id``, ``text``) to ``path``.

    Null texts count as empty: their only id is ``end_id``, which ends every document.
    Documents come in ascending id (null first), equal ids in the order of a hash of the
    text; repeated rows are all written. ``tokenizer`` is a file of the tokenizers
    library that the driver reads; it goes to the tasks by broadcast (its size does not
    depend on the data). A task holds the ids of one group of blocks at a time.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())
    ordered = (docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
               .repartitionByRange(partitions(spark), "doc_id", "key")
               .sortWithinPartitions("doc_id", "key").select("doc_id", "text"))
    (ordered.mapInPandas(lambda batches: _blocks(batches, spec.value, end_id), BLOCKS)
     .write.parquet(path))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def decoded(blocks: DataFrame) -> DataFrame:
    """``part``, ``first_token`` (of the document, within its part), ``doc_id``, ``ids``:
    a row for each document, blocks decoded in parallel. Wrong checksums raise."""
    return blocks.mapInPandas(
        lambda batches: _documents(batches, False),
        "part int, first_token long, doc_id long, ids array<int>")


def _documents(batches: Iterator[pd.DataFrame], digest: bool) -> Iterator[pd.DataFrame]:
    last: tuple[bytes, rans.Table] | None = None
    for batch in batches:
        for row in batch.itertuples(index=False):
            if zlib.crc32(row.payload) != row.payload_crc32:
                raise rans.Corrupt(f"payload of part {row.part}, block {row.block}")
            if last is None or last[0] != row.freq:
                last = row.freq, rans.Table(row.freq)
            ids = rans.decode(row.payload, last[1]).astype("<u4")
            if len(ids) != row.n_tokens or zlib.crc32(ids) != row.ids_crc32:
                raise rans.Corrupt(f"ids of part {row.part}, block {row.block}")
            lengths = np.array(row.lengths, dtype=np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
            doc_ids = pd.array([None if pd.isna(x) else int(x) for x in row.doc_ids], "Int64")
            out = {"part": row.part, "first_token": row.first_token + starts, "doc_id": doc_ids}
            if digest:
                out |= {"n_tokens": lengths,
                        "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in spans]}
            else:
                out |= {"ids": [ids[a:b].astype(np.int32) for a, b in spans]}
            yield pd.DataFrame(out)


def token_report(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """The contract's row for each document, from the files. Only one count for each
    part is summed up in order."""
    spark = docs.sparkSession
    path = path or scratch(spark, "tokens")
    write_tokens(docs.select("doc_id", "text"), path, tokenizer)
    blocks = read_blocks(spark, path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select(F.col("part").alias("of"),
                     F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    rows = blocks.mapInPandas(
        lambda batches: _documents(batches, True),
        "part int, first_token long, doc_id long, n_tokens long, ids_crc32 long")
    return rows.join(parts, F.col("part") == F.col("of")).select(
        "doc_id", (F.col("before") + F.col("first_token")).alias("start"), "n_tokens",
        "ids_crc32")
