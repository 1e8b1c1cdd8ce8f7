from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest

from tillroll.llm.decontaminate import ORACLE, Shard, contamination, find_benchmark

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def brute(docs, items, size):
    grams = []
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            grams.append((i, w[k : k + size]))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for i, g in grams:
            for k in range(len(w) - len(g) + 1):
                if w[k : k + len(g)] == g:
                    hit.update(range(k, k + len(g)))
                    ids.add(str(i))
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def tables(spark, seed):
    rnd = random.Random(seed)
    vocab = ["the", "The", "of", "é", "Ünder", "x1", "a-b", "c.d", "日本"]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([0, 1, 2, 4, 5, 9])))) for i in range(12)] + [(50, None), (51, ""), (3, "twin item words here now"), (3, "twin item words here now")]
    docs = [(i, ", ".join(rnd.choices(vocab, k=rnd.randint(0, 60)))) for i in range(30)] + [(7, None), (8, ""), (9, "x twin item words here now y"), (9, "x twin item words here now y"), (None, "é é")]
    a = spark.createDataFrame([(d, t, "q", 1) for d, t in docs], "doc_id long, text string, items string, n_hit int").repartition(3)
    b = spark.createDataFrame([(d, t, "q") for d, t in items], "item_id long, text string, doc_id string")
    return docs, items, a, b


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs, items, a, b = tables(spark, seed)
    assert sorted((tuple(r) for r in contamination(a, b, 4).collect()), key=str) == brute(docs, items, 4)
    cols = ["doc_id", "n_words", "n_hit", "spans", "items"]
    whole = sorted((str(tuple(r)) for r in find_benchmark(a, b, 4).select(*cols).collect()))
    assert whole == sorted(str(tuple(r)) for r in find_benchmark(a, b, 4, block_words=20).select(*cols).collect())


def test_oracle_agrees(spark, sf_small):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    got = contamination(*(spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark")))
    rel = con.sql(ORACLE)
    assert got.columns == rel.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(rel.fetchall())


def test_empty_tables(spark):
    _, _, a, b = tables(spark, 3)
    assert contamination(a.limit(0), b).count() == 0
    assert {r.n_hit for r in contamination(a, b.limit(0)).collect()} == {0}


def test_proximity():
    shard = Shard([b"gamma x x alpha beta", b"alpha x x x x x x gamma", b"beta"], {b"alpha": 0, b"beta": 1, b"gamma": 2})
    assert shard.document(shard.near([0, 1, 2], 2)).tolist() == [0]
    assert shard.document(shard.near([0, 2], 10)).tolist() == [0, 1]
    assert shard.find([0, 1]).tolist() == [3] and len(shard.find([1, 0])) == 0


def brute_near(docs, items, size, slack):
    """Items of which some window's words all stand in a stretch of its length and ``slack``
    words more, of any order."""
    out = []
    for d, t in docs:
        w, ids = words(t), set()
        for i, text in items:
            own = words(text)
            for k in range(max(1, len(own) - size + 1) if own else 0):
                g = own[k : k + size]
                if any(set(g) <= set(w[a : a + len(g) + slack]) for a in range(len(w))):
                    ids.add(str(i))
        out.append((d, tuple(sorted(ids))))
    return sorted(out, key=str)


@pytest.mark.parametrize("slack,block", [(1, 10**6), (3, 10**6), (2, 8)])
def test_proximity_against_brute_force(spark, slack, block):
    docs, items, a, b = tables(spark, 3)
    got = find_benchmark(a, b, 4, slack=slack, block_words=block).collect()
    assert sorted(((r.doc_id, tuple(r.near_items)) for r in got), key=str) == brute_near(docs, items, 4, slack)
    exact = find_benchmark(a, b, 4).collect()
    assert all(not r.near_items for r in exact)
    assert sorted(((r.doc_id, tuple(r["items"])) for r in exact), key=str) == sorted(((r.doc_id, tuple(r["items"])) for r in got), key=str)


def test_long_text(spark):
    text = " ".join(f"w{k % 977}" for k in range(400_000))
    docs = spark.createDataFrame([(1, text + " these ten words stand at the end of the text"), (2, text)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "these ten words stand at the end of the text")], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.spans) for r in find_benchmark(docs, items).collect()}
    assert got[1][:2] == (400_010, 10) and [tuple(s) for s in got[1][2]] == [(400_000, 400_010)] and got[2] == (400_000, 0, [])
