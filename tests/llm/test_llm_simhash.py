import random
import re

import numpy as np
import xxhash

from ledgerwatch.llm import simhash as sh
from ledgerwatch.llm.common import components
from llm_fixtures import empty_documents, odd_documents, table


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, distance=4):
    """{place: smallest place reachable}"""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = np.array(prints, dtype=np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance):
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    return [find(i) for i in range(len(prints))]


def test_table(spark):
    docs = table(spark, "documents")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    rows = sh.simhash_report(docs).orderBy("doc_id").collect()
    assert [int(r.fingerprint, 16) for r in rows] == [brute_print(t) for t in texts]
    assert [r.component_id for r in rows] == brute_groups([int(r.fingerprint, 16) for r in rows])


def test_dense_balls_chains_and_large_buckets(spark, monkeypatch):
    rng = random.Random(7)
    monkeypatch.setattr(sh, "CELL", 40)
    values = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        values.add(centre)
        for _ in range(80):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 7))))
    chain = rng.getrandbits(64)
    for _ in range(40):
        chain ^= sum(1 << b for b in rng.sample(range(64), 4))
        values.add(chain)
    values |= {rng.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1}
    values = list(values)
    expected = brute_groups(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fingerprint long")
    got = {r.doc_id: r.component_id for r in sh.grouped(prints).collect()}
    assert [got[i] for i in range(len(values))] == expected


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 2), (9, 8), (8, 9), (7, 7)],
                                  "a long, b long")
    assert {(r.node, r.root) for r in components(edges).collect()} == {
        (2, 2), (3, 2), (4, 2), (5, 2), (8, 8), (9, 8)}
    assert components(edges.limit(0)).count() == 0


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = sh.simhash_report(docs).collect()
    assert len(rows) == 15
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {2}
    kept = sh.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 2 and 8 not in ids and ids.count(None) == 1 and 6 not in ids
    assert sh.one_of_each(empty_documents(spark)).count() == 0
    assert sh.simhash_report(empty_documents(spark)).count() == 0
