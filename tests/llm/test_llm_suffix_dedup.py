import hashlib
import random

import numpy as np
import pytest

from ledgerwatch.llm import suffix_dedup as sd
from ledgerwatch.llm import suffix_sort as ss
from llm_fixtures import empty_documents, odd_documents, table


def brute(rows, length=100):
    """{(doc, text): (bytes, removed, spans, digest of the rest)}"""
    seen, out = set(), {}
    order = sorted(set(rows), key=lambda x: (x[0] is not None, x[0] or 0))
    for doc, text in order:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            part = raw[i:i + length]
            if part in seen:
                gone[i:i + length] = b"\1" * length
            else:
                seen.add(part)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc, text] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    got = sorted((tuple(r)[1:], r.doc_id or -1) for r in sd.suffix_report(docs).collect())
    assert got == sorted((expected[r], r[0] or -1) for r in rows)


def test_table(spark):
    check(spark, [tuple(r) for r in table(spark, "documents").select("doc_id", "text").collect()])


def variants(seed, n):
    """Copies with edits, shifted passages, runs of one letter, periodic texts."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(80, 900))) for _ in range(6)]
    rows = []
    for i in range(n):
        text = rng.choice(base)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["X", "", "yy", rng.choice(base)[:150]]) + text[at + 1:]
        if i % 9 == 0:
            text += rng.choice(["a", "ab", "abc" * 20 + "d"]) * rng.randint(40, 200)
        rows.append((rng.randint(0, 10 ** 6), text))
    return rows


def test_variants(spark, monkeypatch):
    check(spark, variants(1, 60))
    monkeypatch.setattr(sd, "PIECE", 256)
    monkeypatch.setattr(sd, "SLAB_BYTES", 1000)
    monkeypatch.setattr(sd, "SLAB_ROWS", 50)
    monkeypatch.setattr(sd, "SLAB_TEXT", 1000)
    monkeypatch.setattr(sd, "SMALL", 0)
    check(spark, variants(2, 60))


@pytest.mark.parametrize("letters, most", [(1, 20), (2, 20), (3, 100), (200, 5), (2, 1)])
def test_sort(letters, most):
    rng = np.random.default_rng(letters)
    rows = rng.integers(0, letters, (400, most)).astype(np.uint8)
    rows[200:300] = rows[:100]
    segment = np.sort(rng.integers(0, 5, 400))
    order, common = ss.sorted_rows(rows, segment)
    key = [(segment[i], rows[i].tobytes()) for i in range(400)]
    assert order.tolist() == sorted(range(400), key=lambda i: (key[i], i))
    for i in range(1, 400):
        a, b = key[order[i - 1]], key[order[i]]
        same = next((k for k in range(most) if a[1][k] != b[1][k]), most)
        assert common[i] == (same if a[0] == b[0] else 0)
    number = ss.depths(rows, segment)
    for d in (0, 1, most // 2, most):
        assert len(set(number(d))) == len({(s, r[:d]) for s, r in key})


def test_collisions_are_caught(monkeypatch):
    """With hashes that call all strings equal, the bytes still decide."""
    monkeypatch.setattr(ss.PrefixHashes, "of", lambda self, at, n: np.zeros(len(at), np.uint64))
    rows = np.frombuffer(b"abdabcabeabc", dtype=np.uint8).reshape(4, 3)
    order, common = ss.sorted_rows(rows, np.zeros(4, dtype=np.int64))
    assert [rows[i].tobytes() for i in order] == [b"abc", b"abc", b"abd", b"abe"]
    assert common.tolist() == [0, 3, 2, 2]


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd_documents(spark).collect()]
    docs = odd_documents(spark)
    expected = brute(rows)
    got = sorted((tuple(r)[1:], r.doc_id or -1) for r in sd.suffix_report(docs).collect())
    assert got == sorted((expected[r], r[0] or -1) for r in rows)
    assert sd.suffix_report(empty_documents(spark)).count() == 0
