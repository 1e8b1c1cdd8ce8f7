from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import source_audit as sa

_TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, top=200):
    """(lang, source, part, item, value, rank) with Python's integers, by the contract's words."""
    docs, groups = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = _TERM.findall(text)
        docs[lang or ""].update(set(words))
        groups[lang or "", source or ""].update(words)
    out = []
    for lang, seen in docs.items():
        kept = [t for t, n in seen.items() if n >= 3]
        own = {s: Counter({t: c[t] for t in kept if c[t]}) for (x, s), c in groups.items() if x == lang}

        def p(c):
            n = sum(c.values())
            return {t: 1 + 1000000000 * (c[t] + 1) // (n + len(kept)) for t in kept}

        q, shares = p(sum(own.values(), Counter())), {s: p(c) for s, c in own.items()}
        for s, mine in shares.items():
            pair = [(o, sum((mine[t] - v[t]) ** 2 // v[t] for t in kept)) for o, v in shares.items() if o != s]
            term = [(t, (mine[t] - q[t]) ** 2 // q[t]) for t in kept if own[s][t] and mine[t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, *r, k) for k, r in enumerate(found, 1) if part == "pair" or k <= top]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@given(st.lists(st.binary(min_size=1, max_size=9), unique=True, max_size=300), st.lists(st.binary(min_size=1, max_size=9), max_size=50))
@settings(max_examples=60, deadline=None)
def test_shard_is_minimal_and_verifies(keys, others):
    shard = sa.Shard(*sa.Shard.build(keys))
    assert sorted(shard.slots(keys, sa.hashes(keys)).tolist()) == list(range(len(keys))) if keys else len(shard) == 0
    if keys:
        slots = shard.slots(others, sa.hashes(others)) if others else []
        assert [shard.key(s) if s >= 0 else None for s in slots] == [o if o in set(keys) else None for o in others]


def test_keys_of_one_hash(monkeypatch):
    monkeypatch.setattr(sa, "hashes", lambda words: np.array([len(w) for w in words], np.uint64))
    keys = [b"a", b"b", b"cc", b"dd", b"e"]
    shard = sa.Shard(*sa.Shard.build(keys))
    slots = shard.slots([*keys, b"f"], sa.hashes([*keys, b"f"])).tolist()
    assert sorted(slots[:-1]) == list(range(5)) and slots[-1] == -1 and [shard.key(s) for s in slots[:-1]] == keys


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    plain = sa.terms([b"ab cd ab", b"", "É ab".encode()])
    assert [plain[0][k] for k in plain[1]] == [b"ab", b"cd", b"ab", "É".encode().lower(), b"ab"] and plain[2].tolist() == [3, 0, 2]
    assert sa.terms([b"", b" 1"])[0] == []
    real = sa.hashed_words

    def collided(*args):
        buffer, start, end, h, n = real(*args)
        return buffer, start, end, h * np.uint64(0) if hide else (end - start).astype(np.uint64), n

    monkeypatch.setattr(sa, "hashed_words", collided)
    for hide in (True, False):
        words, number, n = sa.terms([b"ab cd ab x", b"y x"])
        assert [words[k] for k in number] == [b"ab", b"cd", b"ab", b"x", b"y", b"x"] and len(words) == 4 and n.tolist() == [4, 2]


def test_language_numbers_its_shards():
    words = [f"w{k}".encode() for k in range(500)]
    dealt = [[w for w, h in zip(words, sa.hashes(words).view(np.int64).tolist(), strict=True) if h % 5 == s] for s in range(5)]
    lang = sa.Language([sa.Shard(*sa.Shard.build(d)) for d in dealt])
    assert sorted(lang.slots(words).tolist()) == list(range(500))
    assert set(lang.slots([b"other", b"w500"]).tolist()) == {-1}


@given(st.integers(0, 10**15), st.integers(1, 10**9), st.integers(0, 10**15))
@settings(max_examples=200, deadline=None)
def test_share_is_exact(count, kept, more):
    assert sa.share(np.array([count]), count + more, kept).tolist() == [1 + 10**9 * (count + 1) // (count + more + kept)]


ROWS = [
    ("The the cat", "en", "a"), ("the dog THE", "en", "b"), ("the CAT dog", "en", "a"), ("cat dog owl", "en", None), ("the end", "en", "c"), (None, "en", "empty"), ("", "en", "empty"),
    ("É é naïve", None, "a"), ("é é naïve", None, "b"), ("é naïve É", None, "b"), ("x y", "fr", "a"), ("z", "fr", "b"), ("", "de", "a"), ("7 8 9", "xx", None), ("the", "", "a"), ("é", "", "b"),
    ("ab_cd ab`cd ab{cd", "en", "b"), ("ab1cd", "en", "b"), ("ab@cd", "en", "c"), ("the cat " * 50_000, "en", "c"), ("日本 日本。", "ja", "a"), ("日本", "ja", "a"), ("日本", "ja", "b"), ("日本。", "ja", "b"),
]


@pytest.mark.parametrize("broadcast_bytes", [sa.BROADCAST_BYTES, 0])
def test_both_ways_against_brute_force(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(sa, "SHARD_TERMS", 2)
    docs = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "text string, lang string, source string, shard int, term string").repartition(3)
    want = brute(ROWS, 2)
    assert {r[2] for r in want} == {"pair", "term"}
    assert got(sa.source_divergence(docs, top=2, broadcast_bytes=broadcast_bytes)) == want
    assert sa.source_divergence(docs.limit(0), broadcast_bytes=broadcast_bytes).count() == 0


def test_query_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = brute([(r.text, r.lang, r.source) for r in docs.collect()])
    assert got(sa.source_divergence(docs)) == want
