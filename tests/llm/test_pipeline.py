from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import sentencepiece

from tests.llm import test_decontaminate, test_line_dedup, test_quality


def near(rows):
    sets = {}
    for d, t in rows:
        w = [x.translate(test_decontaminate.LOWER) for x in test_quality.re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets[d] = frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [(d, t) for d, t in rows if find(d) == d]


def test_stages_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(d, t) for d, t in rows if test_quality.brute(t)[-1]]
    rows = [(d, t) for d, n, g, t in test_line_dedup.brute(rows) if g == 0 or g < n]
    rows = near(rows)
    rows = [(d, t) for d, t in rows if not next(iter(test_decontaminate.brute([(d, t)], items, 10)))[-1]]
    ref = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {d: (t, ref.encode(t)) for d, t in rows}
    out = corpus_pipeline.run(spark, sf_small)
    assert out.columns == [*docs.columns, "n_tokens", "ids"]
    got = {r.doc_id: (r.text, r.ids) for r in out.collect()}
    assert got == want and 50 < len(got) < docs.count()


def test_odd_rows_in_each_stage(spark, sf_small):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, gone int, `a.b` int, _dropped int, n_hit int, text_hash int"
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None), (4, ""), (None, None)]
    docs = spark.createDataFrame([(d, t, *[None] * 9) for d, t in rows], schema)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_small)
        assert out.columns[: len(docs.columns)] == docs.columns and out.count() > 0
        assert stage(spark, docs.limit(0), sf_small).count() == 0
        if k == 2:
            assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "4", "None", "None"]


def test_long_texts_in_each_stage(spark, sf_small):
    """A text of a megabyte and a near copy of it; the copy goes, the text stays whole."""
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{k}" for k in range(120_000)]
    long = "\n".join(" ".join(words[k : k + 12]) for k in range(0, len(words), 12))
    rows = [(1, long), (2, long.replace("wa", "xa", 50)), (3, " ".join(f"own{k}" for k in range(40)))]
    now = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", corpus_pipeline.F.length("text").cast("long"))
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.materialize(stage(spark, now, sf_small), name.replace(" ", "-"))
    got = {r.doc_id: (r.text, r.n_tokens) for r in now.collect()}
    assert sorted(got) == [1, 3] and got[1][0] == long
    assert got[1][1] == len(sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")).encode(long))


def test_documents_without_an_id_go_by_their_text(spark, sf_small):
    item = next(r.text for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect() if r.text and len(r.text.split()) > 12)
    docs = spark.createDataFrame([(None, f"a {item} b"), (None, "clean one"), (None, None), (7, f"x {item}"), (7, "clean two")], "doc_id long, text string")
    out = corpus_pipeline.decontaminate(spark, docs, sf_small)
    assert sorted(str(r.text) for r in out.collect()) == ["None", "clean one", "clean two"]


def test_columns_of_the_codec_give_way(spark):
    docs = spark.createDataFrame([(1, "a b", "old", 5)], "doc_id long, text string, ids string, n_tokens int")
    out = corpus_pipeline.sentencepiece(spark, docs, "")
    assert out.columns == ["doc_id", "text", "n_tokens", "ids"] and len(out.first().ids) == out.first().n_tokens


def test_near_dedup_tells_rows_of_one_id_apart(spark):
    text = lambda k, n=40: " ".join(f"{k}word{i}" for i in range(n))
    rows = [(1, text("a"), "x"), (1, text("b"), "x"), (2, text("b"), "x"), (3, text("c"), "y"), (3, text("c"), "x"), (4, text("c", 42), "x")]
    rows += [(None, text("d"), "x")] * 5 + [(None, text("d", 41), "x"), (None, text("e"), "x"), (5, " ", "x"), (6, " ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [corpus_pipeline.near_dedup(spark, docs.repartition(k), "").collect() for k in (1, 3)]
    assert sorted(map(str, got[0])) == sorted(map(str, got[1]))
    left = sorted((str(r.doc_id), r.text[:1]) for r in got[0])
    assert left == [("1", "a"), ("1", "b"), ("3", "c"), ("5", " "), ("6", " "), ("None", "d"), ("None", "e")]
