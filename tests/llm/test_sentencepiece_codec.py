from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from tillroll.llm import common, sentencepiece_codec
from tillroll.llm.sentencepiece_codec import Codec, build, encode_pieces, merges, read_model

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a  b ", "a\n\n b\t", "日本語 テスト", "<s> </s> <0x41> <unk>", "é", "aba ababa", "x" * 3000, "ab " * 50, "\x00 ퟿", "  ", "naïve   ,. ", "a" + " " * 40 + "b"]


def test_parity_with_the_reference():
    c, ref = Codec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids, n = c.encode([t.encode() for t in ODD])
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [ref.encode(t) for t in ODD]
    assert c.decode(ids, n) == [t.encode() for t in ODD]
    # Only a run of forty spaces falls to pieces of equal score in another order.
    assert c.differ <= 1 and c.compared > 20


def test_model_is_read():
    with open(PATH, "rb") as f:
        model = read_model(f.read())
    ref = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert [p[0] for p in model.pieces] == [ref.id_to_piece(i) for i in range(ref.get_piece_size())]
    assert merges(model)[0] == ("▁", "t")
    assert build(model).decode([13]) == ref.decode([13])


def test_unigram_model():
    from tillroll.llm.sentencepiece_codec import NORMAL, UNIGRAM, UNKNOWN, Model

    pieces = [("<unk>", 0.0, UNKNOWN), ("▁a", -1.0, NORMAL), ("b", -1.5, NORMAL), ("▁ab", -4.0, NORMAL), ("▁", -3.0, NORMAL), ("a", -2.0, NORMAL)]
    assert build(Model(pieces, UNIGRAM)).encode(" ab a").ids == [1, 2, 1]


def test_query_against_the_reference(spark, sf_small):
    ref = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(None, "x"), (-1, None), (-1, None), (-2, "▁")]
    table = spark.createDataFrame([(d, t, 5, "x") for d, t in rows], "doc_id long, text string, n_tokens int, ids string")
    want = sorted(((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes()), t != "▁", i) for d, t in rows for i in [ref.encode(t or "")]), key=str)
    got = encode_pieces(table, PATH).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32, r.round_trip, r.ids) for r in got), key=str) == want
    assert sum(r.n_differ for r in got) == 0
    assert encode_pieces(table.limit(0), PATH).count() == 0


def test_differences_are_counted(spark):
    runs = "a" + " " * 40 + "b"
    rows = [(1, runs), (2, f"x {runs} y{' ' * 40}b"), (3, "plain words"), (4, None)]
    got = {r.doc_id: r.n_differ for r in encode_pieces(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), PATH).collect()}
    c = Codec(PATH)
    c.encode([t.encode() for _, t in rows if t])
    assert got[3] == got[4] == 0 and got[2] == 2 * got[1] == 2 * len(c.unlike)


def test_model_that_normalises(tmp_path):
    """The same pieces, with runs of spaces made one: whole texts are compared."""
    with open(PATH, "rb") as f:
        data = f.read()
    # A later field of the normaliser's message adds to the earlier one.
    path = str(tmp_path / "collapsing.model")
    with open(path, "wb") as f:
        f.write(data + bytes([0x1A, 2, 0x20, 1]))
    c, ref = Codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["a  b", "  lead and trail  ", "", "two words", "tab\tand\nline", "a" + " " * 40 + "b", "é 日本"]
    assert ref.encode("a  b") == ref.encode("a b") and c.whole
    ids, n = c.encode([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [ref.encode(t) for t in texts]
    assert (c.compared, c.differ) == (len(texts), 0)


def test_long_text():
    c, ref = Codec(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    text = "some long words, 日本 and more of them\n" * 40_000
    ids, n = c.encode([text.encode(), b"x"])
    assert ids[: n[0]].tolist() == ref.encode(text) and c.decode(ids, n) == [text.encode(), b"x"]


def test_workspace_of_a_batch_stays_small():
    """Hashing 4 MB of text takes memory for what it returns, and powers for a piece; words
    that reach over a piece hash like others."""
    gap, long = common.gap_table(b" "), b"x" * (common.HASH_BYTES + 7)
    texts = [b"some words of text " * 55_000, long + b" some " + long] * 3
    common.hashed_words([b"a"], gap, common.BYTE_VALUES)
    tracemalloc.start()
    buffer, start, end, h, n = common.hashed_words(texts, gap, common.BYTE_VALUES)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(buffer) and sum(p.nbytes for p in common._powers) <= 16 * common.HASH_BYTES
    data = buffer.tobytes()
    by_word = {}
    for a, z, x in zip(start.tolist(), end.tolist(), h.tolist(), strict=True):
        assert by_word.setdefault(data[a:z], x) == x
    assert set(by_word) == {b"some", b"words", b"of", b"text", long} and len(set(by_word.values())) == 5
    assert n.tolist() == [220_000, 3] * 3


def test_slices_hold_rows_and_bytes():
    texts = ["a" * 10] * 1300 + [None, "", "b" * (3 << 20), "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    parts = list(sentencepiece_codec._slices(batch, 1))
    assert [x for b in parts for x in b.column(1).to_pylist()] == texts
    assert [b.num_rows for b in parts] == [512, 512, 278, 1, 1]
    assert list(sentencepiece_codec._slices(batch.slice(0, 0), 1)) == []
