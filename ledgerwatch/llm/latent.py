"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of PASSAGE words, cut at every STRIDE, weighted by TF-IDF over the
whole corpus. Those that can share enough words with an item are embedded by a
distributed randomised SVD, each is compared with the windows of these items by cosine,
and every candidate is judged by the longest common subsequence with its item and by
whether the item's answer (its last sentence) is there as well.

A passage is left out only where no place around it can be judged a leak: a common
subsequence of h of an item's m words holds at least j of any m - h + j of them, so a
place without j of the item's rarest m - h + j words is none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, workspace

PASSAGE = 16
STRIDE = 8
QUERY_STRIDE = 4
#: Items of fewer words occur by chance in parts; they are searched for word by word.
MIN_ITEM = 8
#: Items searched at once; a larger benchmark is searched in blocks.
BLOCK_ITEMS = 2_000
#: Words are counted by the low bits of their hash: the table has a fixed size.
BUCKETS = 1 << 18
CHUNK = 1 << 12
RANK = 128
DAMPING = 4
OVERSAMPLE = 8
#: One in this many of an item's words is j (see above), at least one.
SPARE = 4
COSINE = 0.5
#: Passages embedded at once, and words searched at once (or one text).
ROWS = 2_000
#: Pairs of a passage and an item compared at once.
NEAR = 20_000
SPAN = 50_000
#: Pairs of features are counted in a table if no more features than this make it (four
#: bytes a pair), and from as many rows on as the table has places for PAIR_ROWS each.
PAIR_SIDE = 6_000
PAIR_ROWS = 200
PAIR_BATCH = 20_000
#: A passage is a leak if this share of the item's words is there in order, or the lower
#: one together with ANSWER of the words of its answer.
MATCH = 0.8
MATCH_WITH_ANSWER = 0.5
ANSWER = 0.6
#: Words looked at beyond the item's own length, as a share of it.
SLACK = 0.25

#: Scripts without spaces between words (Thai, Lao, Burmese, Khmer, kana, Han): each
#: character, also a vowel sign, is a word.
_SINGLE = ("\u0E01-\u0E4E\u0E50-\u0E59\u0E81-\u0EDF\u1000-\u1049\u1050-\u109F\u1780-\u17D3"
           "\u17E0-\u17E9\u3005-\u3007\u3041-\u3096\u30A1-\u30FA\u30FC-\u30FF\u31F0-\u31FF"
           "\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\U00020000-\U0003FFFF")
_WORD = re.compile(rf"[{_SINGLE}]|[^\W_{_SINGLE}]+")
_GAP = re.compile(rf"[\W_{_SINGLE}]")
#: Characters whose words are hashed at once (or one word).
CHARS = 1 << 19

WORDS = "kind int, doc_id long, key long, ids binary"
#: A stretch of a text: its words from ``from`` on, where its passages begin (``at``),
#: and pairs of a place in ``at`` and an item.
PASSAGES = ("doc_id long, key long, from long, around binary, at array<int>, "
            "passage array<int>, item array<int>")
FINDS = ("doc_id long, key long, item_id long, n_common long, n_words long, place long, "
         "answer boolean, cosine double")


def _kinds() -> np.ndarray:
    """Of each code point: 0 between words, 1 in a word, 2 a word of its own."""
    every = "".join(map(chr, range(0x110000)))
    out = np.zeros(len(every), dtype=np.uint8)
    for pattern, kind in ((rf"[^\W_{_SINGLE}]+", 1), (rf"[{_SINGLE}]+", 2)):
        for run in re.finditer(pattern, every):
            out[run.start():run.end()] = kind
    return out


def _pieces(texts: list[str], which: list[int]) -> Iterator[tuple[list[str], list[int]]]:
    """Texts and which they are, about CHARS characters at a time; a longer text is cut
    between words."""
    some, owners, size = [], [], 0
    for i in which:
        text, at = texts[i], 0
        while at < len(text):
            cut = _GAP.search(text, at + CHARS) if len(text) - at > CHARS else None
            end = cut.start() if cut else len(text)
            some.append(text[at:end])
            owners.append(i)
            size += end - at
            at = end
            if size >= CHARS:
                yield some, owners
                some, owners, size = [], [], 0
    if some:
        yield some, owners


def _xxh32(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH32 (seed 0) of the bytes of each word, a step of all words at once; of words of
    16 bytes or more one by one. ``data`` goes on for 3 bytes or more after the last."""
    import xxhash
    one, two, three, four, five = np.array(
        [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)
    raw = np.frombuffer(data, dtype=np.uint8)
    quads = np.ndarray(len(raw) - 3, dtype="<u4", buffer=data, strides=(1,))  # from each byte
    out = size.astype(np.uint32) + five
    for k in range(3):
        some = np.flatnonzero(size >= 4 * k + 4)
        h = out[some] + quads[start[some] + 4 * k] * three
        out[some] = (h << np.uint32(17) | h >> np.uint32(15)) * four
    rest, tail = size & 3, start + (size & ~3)
    for k in range(3):
        some = np.flatnonzero(rest > k)
        h = out[some] + raw[tail[some] + k] * five
        out[some] = (h << np.uint32(11) | h >> np.uint32(21)) * one
    out ^= out >> np.uint32(15)
    out *= two
    out ^= out >> np.uint32(13)
    out *= three
    out ^= out >> np.uint32(16)
    known: dict[bytes, int] = {}
    for i in np.flatnonzero(size >= 16).tolist():
        word = data[start[i]:start[i] + size[i]]
        if word not in known:
            known[word] = xxhash.xxh32_intdigest(word)
        out[i] = known[word]
    return out


def word_hashes(texts: list[str | None], kinds: np.ndarray | None = None) -> list[np.ndarray]:
    """32-bit hashes of the words (letters and digits, lower-cased; single characters in
    scripts without spaces) of each text. ``kinds`` are those of ``_kinds``."""
    kinds = _kinds() if kinds is None else kinds
    lower = [(text or "").lower() for text in texts]
    out: list[list[np.ndarray]] = [[] for _ in lower]
    plain = [text.isascii() for text in lower]
    for ascii_only in (True, False):
        which = [i for i, x in enumerate(plain) if x == ascii_only]
        for some, owners in _pieces(lower, which):
            joined = "\n".join(some) + "\n"
            data = joined.encode()
            points = np.frombuffer(data if ascii_only else joined.encode("utf-32-le"),
                                   dtype=np.uint8 if ascii_only else "<u4")
            kind = kinds[points]
            word, single = kind == 1, kind == 2
            begins = word.copy()
            begins[1:] &= ~word[:-1]
            ends = word
            ends[:-1] &= ~word[1:]
            start = np.flatnonzero(begins | single)
            size = np.flatnonzero(ends | single) + 1 - start
            texts_at = np.cumsum([0, *(len(text) + 1 for text in some)])
            cuts = np.searchsorted(start, texts_at[1:-1])
            if not ascii_only:  # from characters to bytes
                width = ((points > 0x7F).view(np.int8) + (points > 0x7FF).view(np.int8)
                         + (points > 0xFFFF).view(np.int8) + np.int8(1))
                before = np.cumsum(width, dtype=np.int64) - width
                size = before[start + size] - before[start]
                start = before[start]
            found = _xxh32(data + bytes(3), start, size)
            for i, hashes in zip(owners, np.split(found, cuts), strict=True):
                out[i].append(hashes)
    return [x[0] if len(x) == 1 else np.concatenate([np.zeros(0, dtype=np.uint32), *x]) for x in out]


@dataclass
class Block:
    """The items of one block and what is derived from them."""
    items: list[tuple[int, np.ndarray, np.ndarray]]  # item_id, words, words of the answer
    short: list[tuple[int, np.ndarray]]  # items under MIN_ITEM words
    vocabulary: np.ndarray = field(default=None)
    first: np.ndarray = field(default=None)  # for each word of the vocabulary, its items
    holders: np.ndarray = field(default=None)
    need: np.ndarray = field(default=None)  # for each item, j and the reach of a place
    reach: np.ndarray = field(default=None)

    def prepare(self, idf: np.ndarray) -> None:
        self.vocabulary = np.unique(np.concatenate([w for _, w, _ in self.items]))
        need, reach, pairs = [], [], []
        for i, (_, words, _) in enumerate(self.items):
            spare = max(1, len(words) // SPARE)
            rarest = np.argsort(-idf[words & np.uint32(BUCKETS - 1)], kind="stable")
            rarest = np.unique(words[rarest[:len(words) - least_common(len(words)) + spare]])
            need.append(spare)
            reach.append(len(words) + slack_of(len(words)))
            pairs.append(np.stack([np.searchsorted(self.vocabulary, rarest),
                                   np.full(len(rarest), i)]))
        pairs = np.concatenate(pairs, axis=1)
        pairs = pairs[:, np.argsort(pairs[0], kind="stable")]
        self.first = np.searchsorted(pairs[0], np.arange(len(self.vocabulary) + 1))
        self.holders = pairs[1].astype(np.uint16)  # sorted by radix
        self.need, self.reach = np.array(need), np.array(reach)


def least_common(n: int) -> int:
    """Least common words of a leak of an item of ``n`` words."""
    return math.ceil(MATCH_WITH_ANSWER * n)


def slack_of(n: int) -> int:
    return max(4, int(n * SLACK))


def answer_of(text: str) -> str:
    """The last sentence, or the last five words where that has fewer than two."""
    sentences = [s for s in re.split(r"[.!?\n。！？]+", text) if _WORD.search(s)]
    last = sentences[-1] if sentences else ""
    return last if len(_WORD.findall(last)) >= 2 else " ".join(_WORD.findall(text)[-5:])


def _masks(a: list[int]) -> dict[int, int]:
    """The places of each word as the bits of one number."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    return masks


def common_length(a, b, masks: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence; ``a``'s places are the bits of one
    number, all of which move at once for each of ``b``."""
    masks = _masks(a) if masks is None else masks
    full = row = (1 << len(a)) - 1
    for y in b:
        if y in masks:
            hit = row & masks[y]
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _hashed(batches: Iterator[pd.DataFrame], kinds: np.ndarray) -> Iterator[pd.DataFrame]:
    """Word hashes of each document, then the task's document frequencies."""
    seen = np.zeros(BUCKETS, dtype=np.int64)
    last = np.zeros(BUCKETS, dtype=np.int64)  # where a document has a bucket last
    for batch in batches:
        hashes = word_hashes(batch.text.tolist(), kinds)
        for h in hashes:
            bucket, at = h & np.uint32(BUCKETS - 1), np.arange(len(h))
            last[bucket] = at
            seen[bucket[last[bucket] == at]] += 1
        yield pd.DataFrame({"kind": 0, "doc_id": batch.doc_id.astype("Int64"),
                            "key": batch.key, "ids": [h.tobytes() for h in hashes]})
    yield pd.DataFrame({"kind": 1, "doc_id": range(BUCKETS // CHUNK), "key": 0, "ids": [
        seen[i:i + CHUNK].tobytes() for i in range(0, BUCKETS, CHUNK)]})


def _summed(rows: pd.DataFrame, kind) -> bytes:
    return np.sum([np.frombuffer(x, dtype=kind) for x in rows], axis=0).tobytes()


def _total(parts: DataFrame, kind: str) -> bytes:
    """Sums arrays (``doc_id`` is their place, ``ids`` their bytes) over tasks; what the
    driver gets has a fixed size."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": [rows.doc_id.iloc[0]], "ids": [_summed(rows.ids, kind)]})

    found = parts.groupBy("doc_id").applyInPandas(add, "doc_id long, ids binary").collect()
    return b"".join(bytes(r["ids"]) for r in sorted(found, key=lambda r: r["doc_id"]))


def _spread(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges, and which range each is of."""
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + first[of], of


def _finder(vocabulary: np.ndarray):
    """A function that gives the place in the sorted ``vocabulary`` where each id belongs
    (the last one at most) and whether it is there. The leading bits of an id lead to the
    first word that has them, and from there it is a few places on."""
    bits = min(max(len(vocabulary).bit_length() + 4, 8), 22)
    shift, last = np.uint32(32 - bits), len(vocabulary) - 1
    lead = np.searchsorted(vocabulary, (np.arange(1 << bits) << int(shift)).astype(np.uint32))
    steps = int(np.diff(np.r_[lead, len(vocabulary)]).max())
    lead = np.minimum(lead, last)

    def find(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = lead[ids >> shift]
        word = vocabulary[place]
        some = np.flatnonzero(word < ids)
        for _ in range(steps):
            if not len(some):
                break
            place[some] = np.minimum(place[some] + 1, last)
            word[some] = vocabulary[place[some]]
            some = some[(word[some] < ids[some]) & (place[some] < last)]
        return place, word == ids

    return find


def _texts(batch: pd.DataFrame) -> Iterator[list[tuple]]:
    """Texts that have words, SPAN words or one text at a time."""
    some, size = [], 0
    for doc_id, key, raw in zip(batch.doc_id.tolist(), batch.key.tolist(),
                                batch.ids.tolist(), strict=True):
        if not raw:
            continue
        if some and size + len(raw) // 4 > SPAN:
            yield some
            some, size = [], 0
        some.append((doc_id, key, np.frombuffer(raw, dtype=np.uint32)))
        size += len(raw) // 4
    if some:
        yield some


def _starts(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the passages of texts of these lengths begin in their text, and which it is."""
    last = np.maximum(0, lengths - PASSAGE)
    step, text = _spread(np.zeros(len(lengths), dtype=np.int64), -(-last // STRIDE) + 1)
    return np.minimum(step * STRIDE, last[text]), text


def _all_features(batches: Iterator[pd.DataFrame], vocabulary: np.ndarray
                  ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The features of every passage that has any, one after another, and their number in
    each passage, ROWS passages at a time."""
    find = _finder(vocabulary)
    for batch in batches:
        for texts in _texts(batch):
            lengths = np.array([len(ids) for _, _, ids in texts])
            place, inside = find(np.concatenate([ids for _, _, ids in texts]))
            starts, text = _starts(lengths)
            begin = (np.cumsum(lengths) - lengths)[text] + starts
            own, features = np.r_[0, np.cumsum(inside)], place[inside]
            low = own[begin]
            size = own[begin + np.minimum(PASSAGE, lengths[text])] - low
            low, size = low[size > 0], size[size > 0]
            for i in range(0, len(low), ROWS):
                which, _ = _spread(low[i:i + ROWS], size[i:i + ROWS])
                yield features[which], size[i:i + ROWS]


def _passages(batches: Iterator[pd.DataFrame], block: Block) -> Iterator[pd.DataFrame]:
    """The stretches of texts that can hold a leak, with the items in question."""
    far = int(block.reach.max())
    count = np.diff(block.first)
    find = _finder(block.vocabulary)
    for batch in batches:
        rows = []
        for texts in _texts(batch):
            lengths = np.array([len(ids) for _, _, ids in texts])
            base = np.cumsum(lengths + 4 * far) - lengths - 4 * far  # no place spans two
            ids = np.concatenate([ids for _, _, ids in texts])
            at = np.arange(len(ids)) + np.repeat(
                base - np.cumsum(lengths) + lengths, lengths)
            place, inside = find(ids)
            some = np.flatnonzero(inside & (count > 0)[place])
            which, of = _spread(block.first[place[some]], count[place[some]])
            item = block.holders[which]
            order = np.argsort(item, kind="stable")
            item, pos = item[order].astype(np.int64), at[some[of[order]]]
            end = np.arange(len(item)) + block.need[item] - 1
            i = np.flatnonzero(end < len(item))
            i = i[item[end[i]] == item[i]]
            i = i[pos[end[i]] - pos[i] < 2 * block.reach[item[i]]]
            end, reach = end[i], block.reach[item[i]]
            if not len(i):
                continue

            starts, text = _starts(lengths)
            low = np.searchsorted(base[text] + starts, pos[end] - reach)
            high = np.searchsorted(base[text] + starts, pos[i] + reach, side="right")
            which, of = _spread(low, np.maximum(high - low, 0))
            pairs = np.unique(which * len(block.items) + item[i][of])
            which, item = np.divmod(pairs, len(block.items))

            begin = (np.cumsum(lengths) - lengths)[text] + starts
            stop = begin + np.minimum(PASSAGE, lengths[text])
            own = np.r_[0, np.cumsum(inside)]
            told = own[stop] > own[begin]
            which, item = which[told[which]], item[told[which]]
            kept, pair = np.unique(which, return_index=True)
            if not len(kept):
                continue
            new = (np.diff(text[kept]) != 0) | (np.diff(starts[kept]) > 2 * far + PASSAGE)
            cuts = [0, *(np.nonzero(new)[0] + 1).tolist(), len(kept)]
            pair = [*pair.tolist(), len(which)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                doc_id, key, words = texts[text[kept[a]]]
                at_ = starts[kept[a:b]]
                since = max(0, int(at_[0]) - far)
                of = slice(pair[a], pair[b])
                rows.append((doc_id, key, since,
                             words[since:int(at_[-1]) + PASSAGE + far].tobytes(),
                             at_.astype(np.int32),
                             np.searchsorted(kept[a:b], which[of]).astype(np.int32),
                             item[of].astype(np.int32)))
        yield pd.DataFrame(rows, columns=["doc_id", "key", "from", "around", "at", "passage",
                                          "item"]).astype({"doc_id": "Int64"})


def _flat(features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The features of some rows one after another, and their number in each row."""
    return np.concatenate(features), np.array([len(f) for f in features])


def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``_flat`` of a column ``features``."""
    for batch in batches:
        if len(batch):
            yield _flat([np.asarray(x) for x in batch.features.tolist()])


def _embedded(flat: np.ndarray, sizes: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Rows times a matrix whose rows carry the weights of their feature."""
    order = np.argsort(-sizes, kind="stable")
    first, long = (np.cumsum(sizes) - sizes)[order], np.sort(sizes)
    sums = np.zeros((len(sizes), matrix.shape[1]), dtype=matrix.dtype)
    for k in range(long[-1] if len(long) else 0):  # the k-th feature of all that have one
        n = len(long) - np.searchsorted(long, k, side="right")
        sums[:n] += matrix.take(flat[first[:n] + k], axis=0)
    out = np.empty_like(sums)
    out[order] = sums
    return out


def _add_back(out: np.ndarray, flat: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> None:
    """Add the transposed matrix of the features, without weights, times ``rows``."""
    order = np.argsort(flat, kind="stable")
    of, flat = np.repeat(np.arange(len(sizes)), sizes)[order], flat[order]
    first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    columns = np.ascontiguousarray(rows.T)  # sums along rows in memory
    out[flat[first]] += np.add.reduceat(columns.take(of, axis=1), first, axis=1).T


class _Pairs:
    """How often two features stand in one row, for all rows added."""

    def __init__(self, n: int) -> None:
        self.n, self.added = n, 0
        self.own = np.zeros(n, dtype=np.int64)
        self.table = np.zeros(n * n, dtype=np.uint32)  # earlier feature, later feature

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.own += np.bincount(flat, minlength=self.n)
        begin, order = np.cumsum(sizes) - sizes, np.argsort(sizes)
        for of in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            place = flat[begin[of] + np.arange(sizes[of[0]])[:, None]]  # rows of one size
            first = place * self.n
            for k in range(1, len(place)):
                pairs = (first[:-k] + place[k:]).reshape(-1)
                np.add.at(self.table, pairs, np.uint32(1))
                self.added += len(pairs)

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """The transposed matrix of the rows, without weights, times itself and ``matrix``."""
        matrix, table = matrix.astype("f8"), self.table.reshape(self.n, self.n)
        out = self.own[:, None] * matrix
        for i in range(0, self.n, 512):
            both = table[i:i + 512].astype("f8")
            both += table[:, i:i + 512].T
            out[i:i + 512] += both @ matrix
        return out


def latent_basis(passages: DataFrame, queries: list[np.ndarray], idf: np.ndarray,
                 rank: int = RANK, read=_listed) -> np.ndarray:
    """The leading right singular vectors of the TF-IDF matrix of all passages and queries
    (features x rank), by a randomised range finder with one power step. Each is divided by
    its singular value, with DAMPING queries' weight added to the square: a direction that
    many passages share then counts no more than one that a few do, which tells passages
    apart that have common words only, while those that a few share keep their likeness.

    ``read`` makes the features of batches of ``passages``. Tasks send sums of fixed shape
    (features x rank, then rank x rank); no passage comes to the driver. A task of many
    passages and few features counts pairs of features and multiplies once, which gives the
    same sums.
    """
    width = min(rank + OVERSAMPLE, len(idf))
    start = np.random.default_rng(0).standard_normal((len(idf), width))
    start = (start * idf[:, None]).astype(np.float32)

    def over(batches: Iterator[pd.DataFrame], add, fold, shape) -> Iterator[pd.DataFrame]:
        total, side = np.zeros(shape), len(idf)
        held, number, pairs = [], 0, None
        for flat, sizes in read(batches):
            if side > PAIR_SIDE:
                add(total, flat, sizes)
                continue
            held.append((flat, sizes))
            number += len(sizes)
            if number >= PAIR_BATCH and (pairs or number * PAIR_ROWS > side * side):
                if pairs is None or pairs.added > 1 << 31:  # before a count overflows
                    if pairs:
                        fold(total, pairs)
                    pairs = _Pairs(side)
                pairs.add(*map(np.concatenate, zip(*held, strict=True)))
                held, number = [], 0
        for rows in held:
            add(total, *rows)
        if pairs:
            fold(total, pairs)
        if total.any():
            sums = total.reshape(-1)
            chunks = range(0, len(sums), CHUNK)
            yield pd.DataFrame({"doc_id": [i // CHUNK for i in chunks],
                                "ids": [sums[i:i + CHUNK].tobytes() for i in chunks]})

    def summed(add, fold, shape) -> np.ndarray:
        parts = passages.mapInPandas(
            lambda batches: over(batches, add, fold, shape), "doc_id long, ids binary")
        raw = _total(parts, "f8")
        found = np.frombuffer(raw, dtype="f8").reshape(shape) if raw else np.zeros(shape)
        found = found.copy()
        add(found, *_flat(queries))
        return found

    def sketch(total: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        _add_back(total, flat, sizes, _embedded(flat, sizes, start))

    def sketch_pairs(total: np.ndarray, pairs: _Pairs) -> None:
        total += pairs.times(start)

    basis, _ = np.linalg.qr(summed(sketch, sketch_pairs, (len(idf), width)) * idf[:, None])
    scaled = (basis * idf[:, None]).astype(np.float32)

    def gram(total: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        rows = _embedded(flat, sizes, scaled)
        total += rows.T @ rows

    def gram_pairs(total: np.ndarray, pairs: _Pairs) -> None:
        total += scaled.T @ pairs.times(scaled)

    values, vectors = np.linalg.eigh(
        summed(gram, gram_pairs, (basis.shape[1], basis.shape[1])))
    best = [i for i in np.argsort(-values)[:rank] if values[i] > 1e-9 * values.max()]
    floor = DAMPING * np.mean([float((idf[q] ** 2).sum()) for q in queries])
    return basis @ (vectors[:, best] / np.sqrt(values[best] + floor))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Stretches:
    """Some stretches of texts and, one after another, their passages and pairs."""
    rows: list[tuple]  # doc_id, key, from, words
    at: np.ndarray  # where each passage begins in its text
    of: np.ndarray  # and the row it is of
    passage: np.ndarray  # for each pair, its passage and its item
    item: np.ndarray


def _stretches(batch: pd.DataFrame) -> Iterator[Stretches]:
    """The rows of PASSAGES, four times SPAN words or one row at a time."""
    def together(some: list[tuple]) -> Stretches:
        number = np.array([len(x[4]) for x in some])
        before = np.cumsum(number) - number
        return Stretches([x[:4] for x in some], np.concatenate([x[4] for x in some]),
                         np.repeat(np.arange(len(some)), number),
                         np.concatenate([x[5] + n for x, n in zip(some, before, strict=True)]),
                         np.concatenate([x[6] for x in some]))

    some, size = [], 0
    columns = ("doc_id", "key", "from", "around", "at", "passage", "item")
    for doc_id, key, since, raw, at, passage, item in zip(
            *(batch[c].tolist() for c in columns), strict=True):
        words = np.frombuffer(raw, dtype=np.uint32)
        if some and size + len(words) > 4 * SPAN:
            yield together(some)
            some, size = [], 0
        some.append((doc_id, key, since, words, np.asarray(at, dtype=np.int64),
                     np.asarray(passage, dtype=np.int64), np.asarray(item, dtype=np.int64)))
        size += len(words)
    if some:
        yield together(some)


def _near(texts: Stretches, find, scaled: np.ndarray, vectors: np.ndarray, first: np.ndarray
          ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Passages, items, queries and cosines of the pairs that reach COSINE, in the order of
    the pairs, ROWS passages at a time."""
    place, inside = find(np.concatenate([x[3] for x in texts.rows]))
    end = np.cumsum([len(x[3]) for x in texts.rows])
    since = np.array([x[2] - e + len(x[3]) for x, e in zip(texts.rows, end, strict=True)])
    begin = texts.at - since[texts.of]
    own, features = np.r_[0, np.cumsum(inside)], place[inside]
    low = own[begin]
    size = own[np.minimum(begin + PASSAGE, end[texts.of])] - low
    number = np.diff(first)
    for i in range(0, len(size), ROWS):
        which, _ = _spread(low[i:i + ROWS], size[i:i + ROWS])
        rows = _unit(_embedded(features[which], size[i:i + ROWS], scaled))
        a, b = np.searchsorted(texts.passage, [i, i + ROWS])
        for j in range(a, b, NEAR):
            k = min(j + NEAR, b)
            p, item = texts.passage[j:k], texts.item[j:k]
            where = np.cumsum(number[item]) - number[item]
            near = np.empty(number[item].sum(), dtype=np.float32)
            order = np.argsort(item, kind="stable")
            cuts = np.flatnonzero(np.diff(item[order])) + 1
            for of in np.split(order, cuts):  # an item's passages with its queries
                x = item[of[0]]
                near[where[of][:, None] + np.arange(number[x])] = (
                    rows[p[of] - i] @ vectors[first[x]:first[x + 1]].T)
            found = np.flatnonzero(near >= COSINE)
            of = np.searchsorted(where, found, side="right") - 1
            yield p[of], item[of], first[item[of]] + found - where[of], near[found]


def _first_of_each(*columns: np.ndarray) -> np.ndarray:
    """The places of the first of equal rows, in order."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for x in columns:
        new[1:] |= np.diff(x[order]) != 0
    return np.sort(order[new])


def _judged(batches: Iterator[pd.DataFrame], block: Block, local: np.ndarray,
            basis: np.ndarray, vectors: np.ndarray, first: np.ndarray,
            offset: np.ndarray) -> Iterator[pd.DataFrame]:
    """Leaks among the passages: cosine search, then common subsequences. A place is
    judged once for each item, whichever of its windows led there. ``first`` has the
    place of each item's first query."""
    known = [_masks(words.tolist()) for _, words, _ in block.items]
    slacks = np.array([slack_of(len(words)) for _, words, _ in block.items])
    find = _finder(block.vocabulary)
    scaled = (basis * local[:, None]).astype(np.float32)
    for batch in batches:
        rows, seen = [], set()
        for texts in _stretches(batch):
            for p, which, q, cosine in _near(texts, find, scaled, vectors, first):
                begins = texts.at[p] - offset[q]
                cells = begins // slacks[which]
                new = _first_of_each(texts.of[p], which, cells)
                for of, begin, owner, cell, near in zip(
                        *(x[new].tolist() for x in (texts.of[p], begins, which, cells, cosine)),
                        strict=True):
                    item_id, words, answer = block.items[owner]
                    doc_id, key, since, around = texts.rows[of]
                    what = (doc_id, key, owner, cell)
                    if what in seen:
                        continue
                    seen.add(what)
                    masks, slack = known[owner], int(slacks[owner])
                    low = max(0, begin - slack - since)
                    high = max(0, begin + len(words) + slack - since)
                    text = around[low:high].tolist()
                    shared = [x for x in text if x in masks]
                    if len(shared) < MATCH_WITH_ANSWER * len(words):
                        continue
                    n = common_length(words, shared, masks)
                    if n < MATCH_WITH_ANSWER * len(words):
                        continue
                    told = len(answer) > 0 and (
                        common_length(answer.tolist(), text) >= ANSWER * len(answer))
                    if told or n >= MATCH * len(words):
                        rows.append((doc_id, key, item_id, n, len(words), low + since, told,
                                     near))
        yield pd.DataFrame(rows, columns=["doc_id", "key", "item_id", "n_common", "n_words",
                                          "place", "answer", "cosine"]
                           ).astype({"doc_id": "Int64"})


def _copies(batches: Iterator[pd.DataFrame],
            short: list[tuple[int, np.ndarray]]) -> Iterator[pd.DataFrame]:
    """The first place of each short item in each text, all its words in a row."""
    def mixed(ids: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(len(ids) - n + 1, dtype=np.uint64)
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + ids[k:len(ids) - n + 1 + k]
        return out

    tables: dict[int, dict[int, list]] = {}
    for item_id, words in short:
        group = tables.setdefault(len(words), {})
        group.setdefault(int(mixed(words, len(words))[0]), []).append((item_id, words))
    wanted = {n: np.array(sorted(group), dtype=np.uint64) for n, group in tables.items()}
    for batch in batches:
        rows = []
        for doc_id, key, raw in zip(batch.doc_id.tolist(), batch.key.tolist(),
                                    batch.ids.tolist(), strict=True):
            ids = np.frombuffer(raw, dtype=np.uint32)
            for n, table in wanted.items():
                if len(ids) < n:
                    continue
                grams = mixed(ids, n)
                at = np.minimum(np.searchsorted(table, grams), len(table) - 1)
                places = np.nonzero(table[at] == grams)[0]
                some, first = np.unique(grams[places], return_index=True)
                for gram, place in zip(some.tolist(), places[first].tolist(), strict=True):
                    rows.extend((doc_id, key, item_id, n, n, place, True, 1.0)
                                for item_id, words in tables[n][gram]
                                if np.array_equal(words, ids[place:place + n]))
        yield pd.DataFrame(rows, columns=["doc_id", "key", "item_id", "n_common", "n_words",
                                          "place", "answer", "cosine"]
                           ).astype({"doc_id": "Int64", "item_id": "Int64"})


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The items in blocks; one block at a time is on the driver."""
    kinds = _kinds()
    items = benchmark.filter("text is not null").select("item_id", "text")
    number = -(-max(items.count(), 1) // BLOCK_ITEMS)
    for i in range(number):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == i).collect()
        found, short = [], []
        for row in rows:
            words, answer = word_hashes([row["text"], answer_of(row["text"])], kinds)
            if len(words) >= MIN_ITEM:
                found.append((row["item_id"], words, answer))
            elif len(words):
                short.append((row["item_id"], words))
        if found or short:
            yield Block(found, short)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (hash of the text), ``item_id``, ``n_common`` (words of the
    item found in order), ``n_words`` (of the item), ``place`` (word where the search
    began), ``answer``, ``cosine``: the best place for each document and item.

    Null and empty texts and items leak nothing; a null id stays null. Repeated documents
    and items give repeated finds, folded to one for each document, text and item. A text
    of any length is searched as a whole, in windows; a document copied to any share of
    the rows costs its own rows only.
    """
    spark = docs.sparkSession
    with workspace(spark, "leaks") as root:
        return _leaks(docs, benchmark, root)


def _leaks(docs: DataFrame, benchmark: DataFrame, root: str) -> DataFrame:
    spark, path = docs.sparkSession, f"{root}/words"
    (docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
     .mapInPandas(lambda batches, kinds=_kinds(): _hashed(batches, kinds), WORDS).write.option("compression", "zstd").parquet(path))
    words = spark.read.schema(WORDS).parquet(path)
    table = words.filter("kind = 1").select("doc_id", "ids")
    seen = np.frombuffer(_total(table, "i8") or bytes(8 * BUCKETS), dtype="i8")
    total = words.filter("kind = 0").count()
    idf = np.log((total + 1) / (seen + 1)) + 1e-3

    found = None
    for block in _blocks(benchmark):
        if block.short:
            copies = words.filter("kind = 0").select("doc_id", "key", "ids").mapInPandas(
                lambda batches, short=block.short: _copies(batches, short), FINDS)
            found = copies if found is None else found.unionByName(copies)
        if not block.items:
            continue
        block.prepare(idf)
        local = idf[block.vocabulary & np.uint32(BUCKETS - 1)]
        queries, owner, offset = [], [], []
        for i, (_, item, _) in enumerate(block.items):
            last = max(0, len(item) - PASSAGE)
            for a in sorted({*range(0, last + 1, QUERY_STRIDE), last}):
                queries.append(np.searchsorted(block.vocabulary, item[a:a + PASSAGE]))
                owner.append(i)
                offset.append(a)
        texts = words.filter("kind = 0").select("doc_id", "key", "ids")
        passages = staged(texts.mapInPandas(
            lambda batches, b=block: _passages(batches, b), PASSAGES),
            "passages", root)
        basis = latent_basis(texts, queries, local, read=(
            lambda batches, v=block.vocabulary: _all_features(batches, v)))
        vectors = _unit(_embedded(*_flat(queries), basis * local[:, None])).astype(np.float32)
        first = np.searchsorted(owner, np.arange(len(block.items) + 1))
        judged = passages.mapInPandas(
            lambda batches, a=(block, local, basis, vectors, first, np.array(offset)):
            _judged(batches, *a),
            FINDS)
        found = judged if found is None else found.unionByName(judged)
    if found is None:
        return spark.createDataFrame([], FINDS)
    best = F.max(F.struct("n_common", (-F.col("place")).alias("p"), "n_words", "answer",
                          "cosine")).alias("x")
    return staged(found.groupBy("doc_id", "key", "item_id").agg(best).select(
        "doc_id", "key", "item_id", "x.n_common", "x.n_words", (-F.col("x.p")).alias("place"),
        "x.answer", "x.cosine"), "leaks")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without leaks; columns as they were."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("__lw_doc"),
                                        F.col("key").alias("__lw_key")).distinct()
    keyed = docs.withColumn("__lw_text", F.xxhash64("text"))
    return keyed.join(bad, keyed["doc_id"].eqNullSafe(bad["__lw_doc"])
                      & (keyed["__lw_text"] == bad["__lw_key"]), "left_anti").select(*docs.columns)


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and item it leaks."""
    return leaks(docs, benchmark).select(
        "doc_id", "item_id", "n_common", "n_words", "place", "answer",
        F.round("cosine", 3).alias("cosine"))
