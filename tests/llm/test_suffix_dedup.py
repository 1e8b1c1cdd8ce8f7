from __future__ import annotations

import hashlib
import random

import pytest

from tillroll.llm.suffix_dedup import dedup_substrings


def brute(rows, window):
    texts = [(d, (t or "").encode()) for d, t in rows]
    low: dict[bytes, int] = {}
    big = 1 << 62
    for d, b in texts:
        for i in range(len(b) - window + 1):
            g = b[i : i + window]
            low[g] = min(low.get(g, big), big if d is None else d)
    out = []
    for d, b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if low[b[i : i + window]] < (big if d is None else d):
                gone[i : i + window] = [True] * window
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(docs, **kw):
    rows = dedup_substrings(docs, **kw).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted((tuple(r) for r in rows), key=str)


def texts(seed: int, n: int):
    rnd = random.Random(seed)
    words = ["the", "of", "näive", "a", "ba", "abab", "日本", "zz", "x" * 20]
    shared = [" ".join(rnd.choices(words, k=30)) for _ in range(4)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            p = rnd.choice(shared)
            a = rnd.randint(0, len(p) // 2)
            parts += [p[a : a + rnd.randint(20, len(p))], " ".join(rnd.choices(words, k=rnd.randint(0, 15)))]
        out.append((i, rnd.choice(["", " "]).join(parts)))
    out += [(n, "ab" * 400), (n + 1, "ab" * 300), (n + 2, None), (n + 3, ""), (n + 4, "y" * 200), (None, shared[0]), (None, shared[0]), (5, shared[1]), (5, shared[1]), (n + 9, shared[1])]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rows = texts(seed, 40)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, kept string, block int")
    assert result(docs, block_bytes=700) == brute(rows, 50)


def test_long_text_is_whole(spark):
    rnd = random.Random(7)
    long = "".join(rnd.choices("abcdefgh ", k=400_000))
    rows = [(1, long), (2, "q" + long[150_000:380_000]), (3, long[131_000:131_160])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in dedup_substrings(docs).collect()}
    assert got == {1: (400_000, 0, 0), 2: (230_001, 230_000, 1), 3: (160, 160, 1)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert result(docs) == []


def test_rows_of_one_id_are_spread(spark):
    rows = [(None if i % 2 else 7, f"{i} " + " ".join(f"w{(i * k) % 101}" for k in range(60))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(docs, block_bytes=2000) == brute(rows, 50)
    # Each block is one group of the last step: no task has most of the rows.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [len(x) for x in dedup_substrings(docs, block_bytes=2000).rdd.glom().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < len(rows) // 2
