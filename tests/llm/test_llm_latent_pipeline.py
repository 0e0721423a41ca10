import random
import re
import subprocess
import sys
import time

import numpy as np
import xxhash
from pyspark import cloudpickle
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerwatch.llm import latent, quality, simhash
from ledgerwatch.llm.common import staged
from llm_fixtures import PASSAGE, SMALL, empty_documents, odd_documents, table, words


def plain(text):
    return " " + " ".join(re.findall(r"[^\W_]+", (text or "").lower())) + " "


def whole_passages(docs, benchmark):
    return {(d.doc_id, b.item_id) for d in docs for b in benchmark if plain(b.text) in plain(d.text)}


def test_exact_passages_of_a_table(spark):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    found = {(r.doc_id, r.item_id) for r in latent.leak_report(docs, bench).collect()}
    assert found == whole_passages(docs.collect(), bench.collect())


def test_paraphrases_and_clean_texts(spark):
    rng = random.Random(5)
    items = [(i, words(100 + i, rng.randint(12, 60)).replace(" ", ", ", 1) + ". "
              + words(500 + i, 6) + ".") for i in range(60)]
    docs, leaky = [], set()
    for i in range(400):
        text = words(1000 + i, 120).split(" ")
        if i % 4 == 0:
            item, part = rng.choice(items)
            part = part.upper().split(" ") if i % 8 else part.split(" ")
            for _ in range(len(part) // 10):  # a tenth of the words changed
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(text))
            text[at:at] = part
            leaky.add((i, item))
        docs.append((i, " ".join(text)))
    found = {(r.doc_id, r.item_id) for r in latent.leak_report(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found <= leaky and len(found) >= 0.95 * len(leaky)


def test_common_items_among_rare_words(spark):
    """Items of common words whose copies hold or stand among rare ones, which outweigh
    them: recall against the longest common subsequence at every place."""
    rng = random.Random(9)
    pool = words(70, 150).split(" ")
    items = [(i, rng.sample(pool, 16 if i % 2 else 8)) for i in range(40)]
    docs, planted = [], set()
    for i in range(400):
        rare = words(5_000 + i, 90).split(" ")
        if i < 300:
            text = rng.choices(pool, k=60)
        else:
            item, part = items[i % 40]
            part = list(part)
            for k in (3, 8, 12) if len(part) > 8 else ():
                part[k] = rare.pop() + "x"
            text = rare[:40] + part + rare[40:]
            planted.add((i, item))
        docs.append((i, " ".join(text)))
    found = {(r.doc_id, r.item_id) for r in latent.leak_report(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items],
                              "item_id long, text string")).collect()}

    def leaks(text, item):
        slack = max(4, len(item) // 4)
        for at in range(-slack, len(text)):
            part = text[max(0, at):at + len(item) + 2 * slack]
            n = latent.common_length(item, part)
            if n >= 0.6 * len(item):  # one sentence, which is the answer too
                return True
        return False

    expected = {(d, i) for d, text in docs if d >= 300 for i, w in items
                if leaks(text.split(" "), w)}
    assert planted <= expected
    assert {x for x in found if x[0] >= 300} == expected


def test_short_items_and_scripts_without_spaces(spark):
    thai, han = "เมืองหลวงของประเทศฝรั่งเศสคืออะไร", "法国的首都是哪一座城市？巴黎是法国的首都。"
    items = [(1, "What is the capital of France?"), (2, "Paris"), (3, thai), (4, han),
             (5, "首都"), (6, "?"), (7, "What is the capital of France?")]
    docs = [(1, "well, what is the CAPITAL of France then"), (2, "the capital of France is what"),
            (3, f"คำถาม{thai}ครับ"), (4, f"问题：{han}谢谢"), (5, "巴黎是首都"), (6, "in paris"),
            (7, "parisian"), (8, han[:5]), (9, None), (10, "")]
    found = {(r.doc_id, r.item_id) for r in latent.leak_report(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == {(1, 1), (1, 7), (3, 3), (4, 4), (4, 5), (5, 5), (6, 2), (8, 5)}


def test_common_length():
    rng = random.Random(1)
    for _ in range(50):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
        assert latent.common_length(a, b) == row[-1]


def test_words_are_hashed_within_twice_the_time_a_pattern_finds_them():
    """The hashes are those of the words that the pattern finds."""
    texts = [words(i, 2_000) for i in range(100)] + [
        words(i, 2_000).replace("a", "é") for i in range(100)]

    def found():
        return [latent._WORD.findall(text.lower()) for text in texts]

    def least(step):
        spent = []
        for _ in range(3):
            start = time.process_time()
            step()
            spent.append(time.process_time() - start)
        return min(spent)

    kinds = latent._kinds()
    assert least(lambda: latent.word_hashes(texts, kinds)) < 2 * least(found)
    for hashes, expected in zip(latent.word_hashes(texts), found(), strict=True):
        assert hashes.tolist() == [xxhash.xxh32_intdigest(w) for w in expected]


def test_words_of_every_script(monkeypatch):
    rng = random.Random(2)
    texts = [None, "", " ", "İSTANBUL", "ΟΔΟΣ. Σ ΑΣ", "a" * 300 + " _b_", "日本語 text 日", "\U0001F600x"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 0xD800),
                                      rng.randrange(0xE000, 0x110000)]))
                      for _ in range(rng.randrange(80))) for _ in range(200)]
    for size in (1 << 19, 40, 3):  # texts longer than that are cut between words
        monkeypatch.setattr(latent, "CHARS", size)
        for text, hashes in zip(texts, latent.word_hashes(texts), strict=True):
            assert hashes.dtype == np.uint32 and hashes.tolist() == [
                xxhash.xxh32_intdigest(w) for w in latent._WORD.findall((text or "").lower())]


def test_task_functions_need_no_package():
    steps = [latent._hashed, latent._all_features, latent._passages, latent._judged,
             latent._copies, latent._Pairs, latent.latent_basis]
    code = "import sys; from pyspark import cloudpickle; cloudpickle.loads(sys.stdin.buffer.read())"
    subprocess.run([sys.executable, "-I", "-c", code], input=cloudpickle.dumps(steps), check=True,
                   cwd="/", timeout=120)


def test_places_in_a_vocabulary():
    rng = np.random.default_rng(4)
    top = np.iinfo(np.uint32).max
    for vocabulary in ([7], [top], range(300), [0, *range(top - 300, top)],
                       rng.integers(0, top, 5_000)):
        vocabulary = np.unique(np.array(vocabulary, dtype=np.uint32))
        ids = np.concatenate([vocabulary, vocabulary + np.uint32(1), vocabulary - np.uint32(1),
                              rng.integers(0, top, 5_000, dtype=np.uint32)])
        place, inside = latent._finder(vocabulary)(ids)
        expected = np.minimum(np.searchsorted(vocabulary, ids), len(vocabulary) - 1)
        assert np.array_equal(place, expected)
        assert np.array_equal(inside, np.isin(ids, vocabulary))


def test_pairs_of_features_give_the_same_space(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [([int(x) for x in rng.integers(0, 40, rng.integers(1, 17))],) for _ in range(500)]
    passages = spark.createDataFrame(rows, "features array<int>")
    idf, queries = rng.uniform(1, 3, 40), [np.array([0, 1, 1])]
    monkeypatch.setattr(latent, "PAIR_SIDE", 0)
    direct = latent.latent_basis(passages, queries, idf, rank=8)
    monkeypatch.setattr(latent, "PAIR_SIDE", 40)
    monkeypatch.setattr(latent, "PAIR_ROWS", 1 << 20)
    monkeypatch.setattr(latent, "PAIR_BATCH", 50)
    counted = latent.latent_basis(passages, queries, idf, rank=8)
    assert np.allclose(direct @ direct.T, counted @ counted.T, atol=1e-5)
    matrix = np.zeros((len(rows), 40))
    for i, (f,) in enumerate(rows):
        np.add.at(matrix[i], f, 1)
    pairs = latent._Pairs(40)
    pairs.add(*latent._flat([np.array(f) for f, in rows]))
    assert np.allclose(pairs.times(np.eye(40)), matrix.T @ matrix)


def test_basis_spans_the_leading_directions(spark):
    rng = np.random.default_rng(0)
    topics = np.split(rng.permutation(60)[:12], 3)  # far apart, so the spectrum has a gap
    rows = [([int(x) for x in rng.choice(topics[i % 3], 16)],) for i in range(300)]
    passages = spark.createDataFrame(rows, "features array<int>")
    basis = latent.latent_basis(passages, [np.array([0, 1])], np.ones(60), rank=6)
    matrix = np.zeros((301, 60))
    for i, (f,) in enumerate([*rows, ([0, 1],)]):
        np.add.at(matrix[i], f, 1)
    exact = np.linalg.svd(matrix)[2][:3]
    span, _ = np.linalg.qr(basis)
    assert np.linalg.norm(exact @ span, axis=1).min() > 0.98
    sizes = np.linalg.norm(matrix @ basis, axis=0)  # divided by singular values, damped
    values = np.linalg.norm(matrix @ span, axis=0) ** 2
    assert sizes.max() < 1 and sizes[0] ** 2 > 0.9 * values[0] / (values[0] + 8)


def test_the_space_is_fitted_to_every_passage(spark, monkeypatch):
    """Also to those of common words and those that no item can be in."""
    pool = words(70, 60).split(" ")
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choices(pool, k=rng.randint(1, 70)) + ["x%d" % i])) for i in range(50)]
    docs += [(50, None), (51, ""), (52, "nothing shared")]
    items = [(i, " ".join(rng.sample(pool, 12))) for i in range(5)]
    seen, fit = [], latent.latent_basis

    def record(passages, queries, idf, **more):
        read = more.get("read") or (lambda batches: (
            (np.concatenate(b.features.tolist()), np.array(list(map(len, b.features))))
            for b in batches if len(b)))
        seen.extend(tuple(sorted(x)) for flat, sizes in read([passages.toPandas()])
                    for x in np.split(flat, np.cumsum(sizes)[:-1]))
        return fit(passages, queries, idf, **more)

    monkeypatch.setattr(latent, "latent_basis", record)
    latent.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                 spark.createDataFrame(items, "item_id long, text string"))
    known = np.unique(np.concatenate(latent.word_hashes([t for _, t in items]))).tolist()
    expected = []
    for ids in latent.word_hashes([t for _, t in docs]):
        last = max(0, len(ids) - latent.PASSAGE)
        for at in sorted({*range(0, last, latent.STRIDE), last}):
            row = [known.index(x) for x in ids[at:at + latent.PASSAGE].tolist() if x in known]
            expected += [tuple(sorted(row))] if row else []
    assert sorted(seen) == sorted(expected)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    bench = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (2, None), (3, ""), (None, "a b c"),
                                   (4, words(77, 30))], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in latent.leak_report(docs, bench).collect()] == [(9, 1)]
    clean = latent.clean_documents(docs, bench)
    assert clean.columns == docs.columns and clean.count() == 14
    assert latent.leak_report(empty_documents(spark), bench).count() == 0
    assert latent.leak_report(docs, bench.limit(0)).count() == 0


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(latent, "BLOCK_ITEMS", 7)
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    found = {(r.doc_id, r.item_id) for r in latent.leak_report(docs, bench).collect()}
    assert found == whole_passages(docs.collect(), bench.collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.collect()}
        out = staged(stage(spark, docs, SMALL), name)
        kept[name] = (before, {r.doc_id for r in out.collect()}, docs)
        if name != "shards":
            assert out.columns == docs.columns
        docs = out
    report = {r.doc_id: r.kept for r in quality.quality_report(
        kept["quality_rules"][2], table(spark, "labels")).collect()}
    assert kept["quality_rules"][1] == {d for d, k in report.items() if k}
    groups = simhash.simhash_report(kept["near_duplicates"][2]).collect()
    assert kept["near_duplicates"][1] == {r.component_id for r in groups}
    before, after, source = kept["decontamination"]
    leaky = {d for d, _ in whole_passages(source.collect(), table(spark, "benchmark").collect())}
    assert after == before - leaky
    assert kept["mix"][0] == kept["mix"][1] == kept["shards"][1]
    assert docs.columns[-2:] == ["shard", "slot"]
    gaps = docs.groupBy("shard").agg((F.count("*") - F.max("slot")).alias("x"))
    assert {r.x for r in gaps.collect()} == {1}


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() == rows.select("doc_id").distinct().count() > 0
