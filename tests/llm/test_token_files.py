from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillroll.llm import token_files as tf

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "Hello, World!", "a\n\n b\tc\r\n", "<|endoftext|> <|ENDOFTEXT|> x", "ΣΑΣ Σ", "İstanbul İ", "Á e ́x", "日本語　テスト", "a\x0bb\x1cc\x85d e", "it's we'LL 12345 !!,, ..", "x" * 5000, "😀 ﬁ ǅ"]


def expect(rows):
    tok = Tokenizer.from_file(PATH)
    coded = [(d, np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for d, t in rows]
    return sorted(((d, len(x), zlib.crc32(x.tobytes())) for d, x in coded), key=str)


def check(got, rows):
    """The rows are right, in ascending order of doc_id, and starts add up."""
    got = sorted(got, key=lambda r: r.start)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == expect(rows)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    ids = [-(2**63) - 1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)


@given(st.lists(st.integers(0, 2**32 - 1)))
@settings(max_examples=60, deadline=None)
def test_pack_round_trip(values):
    r = np.array(values, "<u4")
    control, data = tf.pack(r)
    assert tf.unpack(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(r)).tolist() == values


def test_block_round_trip():
    table = np.arange(1000, dtype="<u4")[::-1]
    ranks = np.array([0, 1, 999, 300, 255, 256, 7], np.uint32)
    docs, nulls, counts, ids = tf.read_block(tf.write_block([None, 9], np.array([3, 4]), ranks), table)
    assert (docs.tolist(), nulls, counts.tolist(), ids.tolist()) == ([0, 9], 1, [3, 4], (999 - ranks.astype(int)).tolist())
    with pytest.raises(ValueError):
        tf.read_block(b"TID0" + bytes(24), table)


def test_against_whole_text_encoding(spark, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK_IDS", 200)
    monkeypatch.setattr(tf, "FILE_GROUP", 2)
    rows = [(7 * i % 101, t) for i, t in enumerate(ODD)] + [(3, "tie one"), (3, "tie one"), (3, "tie two"), (None, "no id"), (-(2**63), "least id"), (None, "")]
    docs = spark.createDataFrame([(d, t, 1, "z") for d, t in rows], "doc_id long, text string, n long, ids string").repartition(4)
    check(tf.token_files(docs, PATH).collect(), rows)


def test_long_text_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(tf, "BATCH_BYTES", 1000)
    rows = [(1, "Some words, and more. " * 250_000), (2, "x" * 30_000), *((k, f"short {k}") for k in range(3, 40))]
    check(tf.token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), PATH).collect(), rows)


def test_whole_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    check(tf.token_files(docs, PATH).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    assert tf.token_files(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_ids_are_kept(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    path = tf.scratch_path(spark, "t")
    tf.write_token_files(docs, path, PATH)
    tok = Tokenizer.from_file(PATH)
    assert {r.doc_id: r.ids for r in tf.read_token_files(spark, path, keep_ids=True).collect()} == {1: [*tok.encode("a b", add_special_tokens=False).ids, 1], 2: [1]}
