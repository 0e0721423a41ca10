import random
import re
from collections import Counter
from math import comb

import numpy as np
import pytest

from ledgerwatch.llm import quality as q
from llm_fixtures import LONG, empty_documents, labels, odd_documents, table, words


def brute(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(found[i:i + 8]) for i in range(len(found) - 7)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup,
            len(covered))


def test_metrics(monkeypatch):
    rng = random.Random(3)
    texts = [None, "", " \t", "a", LONG, "x\nx\n\nx\n x", "a b c d e f g h " * 5, "é ü \x1c z",
             "a b c d e f g h i j a b c d e f g h"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    for limit in (q.BATCH_WORDS, 50):
        monkeypatch.setattr(q, "BATCH_WORDS", limit)
        got = q.text_metrics(texts)[list(q.METRICS[:5])]
        assert [tuple(r) for r in got.itertuples(index=False)] == [brute(t) for t in texts]


def test_report_of_a_table(spark):
    docs = table(spark, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in q.quality_report(docs, table(spark, "labels")).collect():
        expected = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                r.n_repeat_words) == expected
        failed = expected[0] < 20 or 100 * expected[4] > 30 * expected[0]
        assert r.base_failed == failed and (not failed or not r.kept)
        assert r.kept == (not failed and not r.rejected_by)


@pytest.mark.parametrize("k, n, p", [(0, 50, 0.02), (3, 50, 0.02), (7, 40, 0.3), (40, 40, 0.3)])
def test_tail(k, n, p):
    exact = sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
    assert q.binomial_tail(k, n, p) == pytest.approx(exact)


def test_certified_cutoffs_keep_their_promise():
    """The share of runs with a certified cutoff whose true false rejections exceed the
    bound stays below the level."""
    rng = np.random.default_rng(0)
    broken = 0
    for _ in range(300):
        good = np.bincount(rng.integers(0, 101, 2000), minlength=101)  # P(value > c) = 1 - c/100
        broken += any((100 - c) / 101 > 0.05 for c in q.certified(good, 0.05, 0.05))
    assert broken / 300 < 0.08
    assert q.certified(np.zeros(101), 0.05, 0.05) == []
    few = np.zeros(101)
    few[0] = 10
    assert q.certified(few, 0.05, 0.05) == []


def test_learned_rule_rejects_symbols_and_keeps_clean(spark):
    """A stratum with enough labels gets a rule, one with few gets none."""
    rows, marks = [], []
    for i in range(3000):
        bad = i % 5 == 0
        text = words(i, 30).replace(" ", "## " if bad else " ")
        rows.append((i, text, "en" if i < 2900 else "de"))
        marks.append((i, 0 if bad else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks += [(5, None, None), (None, 1, 0), (1, 1, 0)]
    kept = {r.doc_id for r in q.good_documents(docs, labels(spark, marks)).collect()}
    assert kept == {i for i in range(3000) if i >= 2900 or i % 5}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    kept = q.good_documents(docs, labels(spark, [(1, 1, 0), (1, 0, 0), (None, None, None)]))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 1, 5, 6, 8, 9]
    assert q.quality_report(docs, labels(spark)).count() == 15
    assert q.quality_report(empty_documents(spark), labels(spark)).count() == 0


def test_texts_go_to_python_once(spark, capsys):
    docs = table(spark, "documents")
    q.good_documents(docs, table(spark, "labels")).explain("formatted")
    plan = capsys.readouterr().out.split("\n\n")[0]
    assert plan.count("ArrowEvalPython") == 1
    assert "SortMergeJoin" not in plan and "Exchange hash" not in plan
