import hashlib
import random
import zlib

from ledgerwatch.llm import merkle
from llm_fixtures import empty_documents, odd_documents, table


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([h(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return out


def climb(tree, at):
    """[(left, right)] from place ``at`` to the root."""
    steps = []
    for nodes in tree[:-1]:
        other = at ^ 1
        sibling = nodes[other] if other < len(nodes) else ""
        steps.append((sibling, "") if at & 1 else ("", sibling))
        at //= 2
    return steps


def brute(rows):
    """The contract by full trees in memory; rows are (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0,
                                             h(*map(field, row)), row))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda x: x[:3])
        built[lang] = levels([x[2] for x in trees[lang]])
    top = levels([built[lang][-1][0] for lang in order])
    out = []
    for i, lang in enumerate(order):
        for at, (_, _, leaf, row) in enumerate(trees[lang]):
            steps = climb(built[lang], at) + climb(top, i)
            node, changed = leaf, list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                changed[3] += 1
                node = h(*map(field, changed))
            for left, right in steps:
                node = h(left, node, right)
            root = top[-1][0]
            out.append((row[0], leaf, built[lang][-1][0], root,
                        h(*[a + b for a, b in steps]), node, node == root))
    return sorted(out, key=str)


def result(docs):
    rows = merkle.manifest_report(docs)
    assert rows.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                            "verified"]
    return sorted((tuple(r) for r in rows.collect()), key=str)


def plain(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_table(spark):
    docs = table(spark, "documents")
    got = result(docs)
    assert got == brute(plain(docs))
    assert {r[-1] for r in got} == {True, False}


def test_blocks_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_BITS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 4)
    rng = random.Random(4)
    sizes = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 5, "f": 16, "g": 17, "h": 67, None: 33}
    rows = [(rng.randrange(10 ** 6), f"s{i % 3}", lang, i, f"t {lang} {i}")
            for lang, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(
        rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert result(docs) == brute(rows)


def test_changed_rows_do_not_verify(spark):
    rows = merkle.manifest(table(spark, "documents"))
    first = rows.first()
    assert len(first.lefts) == len(first.rights)
    for n in range(1, 40):
        f = merkle.Frontier()
        leaves = [h(str(i)) for i in range(n)]
        for x in leaves:
            f.append(x)
        root = f.close((n - 1).bit_length())
        assert root == levels(leaves)[-1][0]
        for x, lefts, rights in zip(leaves, f.lefts, f.rights, strict=True):
            node = x
            for a, b in zip(lefts, rights, strict=True):
                node = h(a, node, b)
            assert node == root


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert result(docs) == brute(plain(docs))
    assert result(empty_documents(spark)) == []
    most = spark.createDataFrame([(i, "s", "en", 2 ** 63 - 1, "x") for i in range(1, 30)],
                                 "doc_id long, source string, lang string, n_chars long, text string")
    assert result(most) == brute(plain(most))
    one = docs.filter("doc_id = 7")
    assert result(one)[0][1:4] == (result(one)[0][1],) * 3
