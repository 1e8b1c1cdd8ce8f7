from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tillroll.llm.token_counts import Counter, count_tokens, cut, edit_trees, encoding, redactions, token_trees
from tillroll.session import materialize

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = ["a", "b", " ", "  ", "\n", "é", "12", ".", "'s", "日", "word ", "the "]


def count(text):
    return len(encoding(RANKS, PATTERN).encode_ordinary(text))


@pytest.mark.parametrize("seed", range(4))
def test_edits_against_whole_encoding(seed):
    rnd = random.Random(seed)
    for _ in range(40):
        t = "".join(rnd.choices(PARTS, k=rnd.randint(0, 150)))
        c = Counter(t, count, rnd.choice([1, 5, 20]))
        for _ in range(8):
            a, x = rnd.randint(0, len(t) + 2), "".join(rnd.choices(PARTS, k=rnd.choice([0, 1, 3, 60])))
            z = a + rnd.randint(0, 20)
            c.edit(a, z, x)
            t = t[: min(a, len(t))] + x + t[min(z, len(t)) :]
            assert c.text() == t and c.tokens == count(t) and c.length == len(t)


def test_an_edit_costs_its_surroundings():
    text = " ".join(f"word{i}" for i in range(50_000))
    c = Counter(text, count)
    c.encoded = 0
    c.edit(200_000, 200_010, "changed")
    assert c.encoded < 4 * 600 and c.tokens == count(c.text())


def test_cut_joins_to_the_text():
    text = "a  b c\n d " * 500
    assert "".join(cut(text, 10)) == text and sum(map(count, cut(text, 10))) == count(text)


def test_query_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(None, "mail a.b@c.de now 0123 456 789"), (-1, None), (-2, ""), (-2, "")], "doc_id long, text string"))
    edited = redactions(docs)
    want = []
    for r in edited.collect():
        t = r.text or ""
        for e in r.edits:
            t = t[: e.start] + e.text + t[e.end :]
        want.append((r.doc_id, count(r.text or ""), len(r.edits), count(t), len(t)))
    got = [tuple(r)[:5] for r in count_tokens(edited, RANKS, PATTERN).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(w[2] for w in want) > 2
    assert count_tokens(edited.limit(0), RANKS, PATTERN).count() == 0


def test_trees_serve_a_second_batch_of_edits(spark):
    """Later edits read the written trees, encode what they touch, and count as anew."""
    texts = {1: "some words here, " * 2000, 2: "short", 3: "", 4: None, 5: "日本 " * 500}
    docs = spark.createDataFrame([(d, t, "x") for d, t in texts.items()], "doc_id long, text string, counts string")
    trees = materialize(token_trees(docs, RANKS, PATTERN), "trees")
    now = {d: t or "" for d, t in texts.items()}
    for start, end, new in ((3, 9, "other"), (20_000, 20_010, "more text put in "), (0, 0, "at first "), (10**6, 10**6, " at last")):
        edits = F.array(F.struct(F.lit(start).alias("start"), F.lit(end).alias("end"), F.lit(new).alias("text")))
        out = materialize(edit_trees(trees.withColumn("edits", edits), RANKS, PATTERN), "trees")
        trees = out.select("doc_id", "leaves", "counts")
        before, now = now, {d: t[:start] + new + t[end:] if start < len(t) else t + new for d, t in now.items()}
        for r in out.collect():
            assert "".join(r.leaves) == now[r.doc_id]
            assert (r.n_tokens, r.n_tokens_edited) == tuple(count(x[r.doc_id]) for x in (before, now))
            assert r.n_reencoded < 3000 and sum(r.counts) == r.n_tokens_edited


def test_clashing_columns_and_empty_table(spark):
    rows = [(1, "call 0123456789 now", "x", 2), (1, "call 0123456789 now", "x", 2), (None, None, None, None), (2, "", "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits string, n_tokens int")
    got = count_tokens(redactions(docs), RANKS, PATTERN)
    assert sorted(((r.doc_id, r.n_edits, r.n_chars_edited) for r in got.collect()), key=str) == [(1, 1, 19), (1, 1, 19), (2, 0, 0), (None, 0, 0)]
    assert count_tokens(redactions(docs.limit(0)), RANKS, PATTERN).count() == 0
