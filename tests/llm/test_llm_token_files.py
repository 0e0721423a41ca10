import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerwatch.llm import rans
from ledgerwatch.llm import token_files as tf
from ledgerwatch.llm.common import scratch
from llm_fixtures import LONG, empty_documents, odd_documents, table

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n, size", [(1, 1), (63, 2), (64, 5), (1000, 50_000), (70_000, 300),
                                     (600_000, 60_000)])
def test_rans_round_trip(n, size):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n) - 1, size - 1).astype(np.uint32)
    table_ = rans.Table(rans.pack_table(rans.quantised(np.bincount(ids, minlength=size))))
    payload = rans.encode(ids, table_)
    assert (rans.decode(payload, table_) == ids).all()
    last = rans.segments(payload) - 1  # each checkpoint decodes on its own
    lanes = max(1, min(rans.LANES, n // 64))
    assert (rans.decode_segment(payload, table_, last) == ids[last * rans.STRIDE * lanes:]).all()


def test_quantised_sums_up_with_many_rare_symbols():
    counts = np.ones(200_000, dtype=np.int64)
    counts[0] = 10 ** 12
    freq = rans.quantised(counts)
    assert freq.sum() == 1 << rans.PRECISION and freq.min() == 1


def test_pieces_equal_whole_texts(tokenizer):
    encoder = tf.Encoder(open(PATH, encoding="utf-8").read())
    texts = ["", " ", "a  b", " a", "a ", "a\n b", "x \ny", "don't  'll 's it's", "é ü z",
             "a\x1c b", "　 a b", "1 2 3² ½ x", "hi<|endoftext|> w", "日本 語 ", "a\t b\r\n d",
             "... !!! ?", "\x85 q x", "a​ b", "𝒳 y", LONG, "z" * 5000 + " q", "a b\n", "\n a b"]
    for _ in range(2):  # the second time from kept pieces
        got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_piece_is_looked_up_once_for_all_its_places(tokenizer):
    class Counted(dict):
        asked = 0

        def get(self, key):
            self.asked += 1
            return super().get(key)

    encoder = tf.Encoder(open(PATH, encoding="utf-8").read())
    encoder.known = Counted()
    texts = ["the quick fox " * 500 + "end", "", "  fox the", "quick"] * 3
    got = [np.frombuffer(x, encoder.kind).tolist() for x in encoder.encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert 0 < encoder.known.asked < 20
    assert encoder.encode([]) == [] and encoder.encode([""]) == [b""]


def test_a_word_is_tokenised_once_whatever_follows_it(tokenizer, monkeypatch):
    encoder, asked = tf.Encoder(tokenizer.to_str()), []
    pieces = encoder._pieces
    monkeypatch.setattr(encoder, "_pieces", lambda some: (
        asked.extend(x.strip() for x in some) or pieces(some)))
    texts = ["a wondrously b", "a wondrously, b", "a wondrously.\nGeschöß %%% c", "x don't's 's. t",
             "a b.\n\nc d", "q it's.\nIt're!'ll e", "a 12th,34.5%x _y_ z\n\u00aam \u0130\u01c5.", "a \n. b",
             "a !\u00d7? b\u00b2.c", "a\u00a0. b\u3000 c.", "a x.\ry. b\tc,d", "", "\n",
             " ", "b \u2003c d", "e  f. g ", "\na b\n"]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(ids, encoder.kind).tolist() == tokenizer.encode(
                text, add_special_tokens=False).ids
    assert asked.count("wondrously") == 1
    assert not {"wondrously,", "wondrously.\nGeschöß"} & set(asked)


def expected(rows, tokenizer):
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_report_and_files(spark, tokenizer):
    docs = table(spark, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = tf.token_report(docs, PATH).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected(rows, tokenizer)


def test_small_groups_and_blocks(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(tf, "GROUP", 2000)
    monkeypatch.setattr(tf, "BLOCK", 300)
    monkeypatch.setattr(tf, "BATCH_CHARS", 500)
    path = scratch(spark, "tokens")
    docs = odd_documents(spark)
    tf.write_tokens(docs, path, PATH)
    blocks = tf.read_blocks(spark, path)
    assert blocks.count() > 4
    rows = tf.decoded(blocks).collect()
    got = sorted((r.doc_id or -1, tuple(r.ids)) for r in rows)
    assert got == sorted((r.doc_id or -1, tuple(tokenizer.encode(
        r.text or "", add_special_tokens=False).ids + [2])) for r in docs.collect())


def test_corruption_is_seen():
    ids = np.arange(1000, dtype=np.uint32) % 7
    packed = rans.pack_table(rans.quantised(np.bincount(ids)))
    payload = rans.encode(ids, rans.Table(packed))
    import pandas as pd
    row = {"part": 0, "block": 0, "first_token": 0, "n_tokens": 1000, "doc_ids": [[1]],
           "lengths": [[1000]], "freq": [packed], "payload": [payload],
           "payload_crc32": zlib.crc32(payload), "ids_crc32": zlib.crc32(ids.astype("<u4"))}
    assert len(list(tf._documents(iter([pd.DataFrame(row)]), True))[0]) == 1
    for change in ({"payload": [payload[:-1] + b"\0"]}, {"ids_crc32": 1}):
        with pytest.raises(rans.Corrupt):
            list(tf._documents(iter([pd.DataFrame(row | change)]), True))


def test_odd_rows(spark):
    rows = tf.token_report(odd_documents(spark), PATH).orderBy("start").collect()
    assert len(rows) == 15 and [r.doc_id for r in rows[:3]] == [None] * 3
    starts = [0]
    for r in rows:
        assert r.start == starts[-1]
        starts.append(r.start + r.n_tokens)
    assert tf.token_report(empty_documents(spark), PATH).count() == 0
