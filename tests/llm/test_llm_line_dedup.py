import hashlib

from ledgerwatch.llm import line_dedup as ld
from llm_fixtures import empty_documents, odd_documents, table


def brute(rows):
    """{(doc, text): (lines, removed, kept text)} of distinct (doc, text)."""
    docs = sorted({(d, t) for d, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0))
    seen, out = set(), {}
    for d, t in docs:
        lines = (t or "").split("\n")
        full = [(i, x.strip(" \t\r")) for i, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for k in range(len(full) - 2):
            window = tuple(x for _, x in full[k:k + 3])
            if window in seen:
                gone.update(i for i, _ in full[k:k + 3])
            seen.add(window)
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out[d, t] = (len(lines) if t is not None else 0, len(gone), kept)
    return out


def test_whole_table(spark):
    docs = table(spark, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    expected = brute(texts.items())
    rows = ld.line_report(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        lines, removed, kept = expected[r.doc_id, texts[r.doc_id]]
        assert (r.n_lines, r.n_removed, r.kept_sha256) == (
            lines, removed, hashlib.sha256(kept.encode()).hexdigest())


def test_overlap_and_repeats(spark):
    rows = [(2, "a\nb\n\nc\nd\nz"), (1, "q\n a\nb\t\nc\nd"), (1, "q\n a\nb\t\nc\nd"),
            (3, "a\nb\nx"), (4, "u\nu\nu\nu\nu")]
    out = ld.remove_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((r.doc_id, r.line_dedup.text) for r in out.collect())
    assert got == [(1, "q\n a\nb\t\nc\nd"), (1, "q\n a\nb\t\nc\nd"), (2, "\nz"), (3, "a\nb\nx"),
                   (4, "u")]


def test_odd_rows(spark):
    out = ld.remove_repeated_lines(odd_documents(spark))
    assert out.count() == 15 and out.columns[-1] == "line_dedup"
    assert all(r.line_dedup.text is None and r.line_dedup.n_lines == 0
               for r in out.filter("text is null").collect())
    assert ld.line_report(empty_documents(spark)).count() == 0
