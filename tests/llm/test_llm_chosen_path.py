import random

import numpy as np
import pandas as pd

from ledgerwatch.llm import chosen_path as cp
from llm_fixtures import empty_documents, odd_documents


def brute_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {" ".join(words[i:i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


def brute(rows):
    """[(doc_id, n, component)] by comparing all pairs."""
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((doc, len(sets[i]), doc if not sets[i] else least.get(find(i)))
                   for i, (doc, _) in enumerate(rows)), key=str)


def result(docs):
    rows = cp.similar_report(docs)
    assert rows.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = rows.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str)


def family(rng, base, share, n):
    """Copies of ``base`` with up to ``share`` of its words replaced."""
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, int(share * len(words)))):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def test_families_chains_and_large_nodes(spark, monkeypatch):
    """Nodes are large, cut into cells, and hold sets just below and above the threshold."""
    monkeypatch.setattr(cp, "CELL", 25)
    monkeypatch.setattr(cp, "SLAB", 50)
    rng = random.Random(3)
    texts = []
    for share in (0.04, 0.08, 0.15):
        texts += family(rng, [f"w{rng.randrange(300)}" for _ in range(120)], share, 60)
    words = [f"c{i}" for i in range(100)]
    for i in range(40):  # a chain whose ends share little
        words = list(words)
        words[(7 * i) % 100] = f"d{i}"
        texts.append(" ".join(words))
    texts += [" ".join(f"r{rng.randrange(60)}" for _ in range(40)) for _ in range(100)]
    texts += texts[:30] + [None, "", "one", "One ", "two"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(docs) == brute(rows)


def test_candidates_of_a_group_grow_with_its_sets():
    """In a group whose sets are all candidates of one another, what is passed on still holds
    the group together, has every set, and is no square of it."""
    n = 500
    rows = pd.DataFrame({"node": [1] * n + [2, 2], "i": 0, "j": 0, "side": 0,
                         "id": range(n + 2), "root": [*range(n), n, n],
                         "sketch": [bytes(cp.FUNCTIONS)] * (n + 2)})
    found = pd.concat(list(cp._compared(iter([rows]))))
    assert len(found) <= 2 * n
    assert set(found.a) | set(found.b) == set(range(n))
    group = {0}
    for _ in range(n):
        group |= {y for x, y in zip(found.ra, found.rb) if x in group}
        group |= {x for x, y in zip(found.ra, found.rb) if y in group}
    assert group == set(range(n))


def test_links_of_a_cell_are_a_forest():
    """Whole sets decide; parts of a cell are compared across only."""
    sets = [np.arange(k, k + 100) for k in (0, 5, 10, 40, 1000, 1005)]
    args = [np.arange(6), np.arange(6), np.array([0, 0, 0, 1, 1, 1])]
    tail = [np.full(6, 100), np.concatenate(sets)]
    assert cp._links(*args, False, *tail) == [(0, 1), (0, 2), (4, 5)]
    assert cp._links(*args, True, *tail) == []
    args[2] = np.array([0, 0, 1, 1, 1, 1])
    assert cp._links(*args, True, *tail) == [(0, 2), (1, 2)]


def test_recall_of_pairs_at_the_threshold(spark):
    """Pairs of similarity 0.80 to 0.82 in one crowd: at least 0.99 of them are found."""
    rng = random.Random(8)
    rows = []
    for i in range(300):
        words = [f"a{rng.randrange(10 ** 9)}" for _ in range(101)]
        other = list(words)
        for at in (10, 20, 30, 40, 50):
            other[at] = f"b{rng.randrange(10 ** 9)}"
        rows += [(2 * i, " ".join(words + ["of the"])), (2 * i + 1, " ".join(other + ["of the"]))]
    expected = {d: c for d, _, c in brute(rows)}
    got = {d: c for d, _, c in result(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert sum(c != d for d, c in expected.items()) == 300
    assert sum(got[d] == c for d, c in expected.items() if c != d) >= 297
    assert 1 - (1 - cp.met(4)) ** cp.trees() >= cp.RECALL


def test_minima_agree_as_often_as_sets_are_similar():
    known = cp._Hashes()
    text = " ".join(f"x{i}" for i in range(2000))
    other = text + " " + " ".join(f"y{i}" for i in range(500))
    a, b = (cp.shingles(t.encode(), known) for t in (text, other))
    share = (cp.minima(a) == cp.minima(b)).mean()
    assert abs(share - 0.8) < 0.2 and len(np.intersect1d(a, b)) == 1999
    assert len(cp.shingles(None, known)) == 0


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(docs) == brute(rows)
    assert result(empty_documents(spark)) == []
    blank = spark.createDataFrame([(3, None), (4, "  ")], "doc_id long, text string")
    assert result(blank) == brute([(3, None), (4, "  ")])


def test_only_compared_sets_are_made_whole(spark, monkeypatch):
    """Sets without candidates are not written with their shingles; a repeated text is read
    once, and equal sets of different texts are one."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    near = [" ".join(base), " ".join([*base[:-1], "x"]), " ".join(base).upper()]
    texts = [" ".join(f"u{rng.randrange(10 ** 9)}" for _ in range(60)) for _ in range(80)]
    rows = list(enumerate(texts + near * 3))
    made, staged = [], cp.staged

    def seen(df, name, *rest):
        out = staged(df, name, *rest)
        if "tokens" in out.columns:
            made.append(name)
        return out

    whole = []
    monkeypatch.setattr(cp, "staged", seen)
    monkeypatch.setattr(cp, "whole_sets", lambda *a, of=getattr(cp, "whole_sets", None): (
        whole.append(of(*a).count()) or of(*a)), raising=False)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(docs) == brute(rows)
    assert "sets" not in made
    assert whole == [2]
