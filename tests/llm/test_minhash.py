from __future__ import annotations

import random
import re

import pytest

from tillroll.llm import minhash
from tillroll.llm.components import connected_components
from tillroll.llm.minhash import near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(zip(w, w[1:], w[2:])) if len(w) >= 3 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                root[y] = x
    return sorted((d, len(s), find(d), find(d) == d) for (d, _), s in zip(rows, sets, strict=True))


def corpus(seed, groups, copies, edits):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["The", "the", "Ärger", "of"]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "two one"), (7, "a\x0bb c\x1cd e"), (8, "a b c\x1cd e")]
    for _ in range(groups):
        base = rnd.choices(words, k=rnd.randint(30, 120))
        for _ in range(rnd.randint(1, copies)):
            w = list(base)
            for _ in range(rnd.randint(0, edits)):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            rows.append((len(rows), " ".join(w)))
    order = list(range(len(rows)))
    rnd.shuffle(order)
    return [(order[i], t) for i, t in rows]


@pytest.mark.parametrize("seed,groups,copies,edits", [(1, 25, 8, 4), (2, 2, 150, 3)])
def test_against_brute_force(spark, seed, groups, copies, edits):
    rows = corpus(seed, groups, copies, edits)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, rep string, label int").repartition(5)
    got = near_duplicates(docs, tile=16)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = "a b c d e f g"
    docs = spark.createDataFrame([(4, text), (4, text), (9, text), (None, text), (None, "x y z"), (None, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted([(4, 5, 4, True), (4, 5, 4, True), (9, 5, 4, False), (None, 5, 4, False), (None, 1, None, True), (None, 0, None, True)], key=str)
    assert near_duplicates(docs.limit(0)).count() == 0


def alike(n, seed=3):
    """Texts that share half of their words, in order, and are linked with none."""
    rnd = random.Random(seed)
    base = [f"t{i}" for i in range(120)]
    return [(d, " ".join([*base, *(f"o{d}x{i}" for i in range(rnd.randint(75, 90)))])) for d in range(n)]


def test_alike_but_unlinked_texts_go_to_cells_in_proportion(spark, monkeypatch):
    """The buckets of such texts grow with their number, and so do the cells."""
    handed = {}
    for n in (150, 300):
        seen = []
        real = minhash._cells

        def cells(*args, real=real, seen=seen):
            out = real(*args)
            seen.append(out.count())
            return out

        monkeypatch.setattr(minhash, "_cells", cells)
        docs = spark.createDataFrame(alike(n), "doc_id long, text string")
        got = near_duplicates(docs, tile=16, bands=64, rows=10)
        assert all(r.component_id == r.doc_id and r.kept for r in got.collect())
        handed[n] = sum(seen)
        monkeypatch.undo()
    assert 0 < handed[300] < 3 * max(handed[150], 100)


def test_copies_with_few_stragglers_are_handed_out_once(spark, monkeypatch):
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    near = [(d, " ".join([*base[: d % 100], f"x{d}", *base[d % 100 + 1 :]])) for d in range(200)]
    # Alike, but not enough to be linked.
    far = [(500 + d, " ".join(w if rnd.random() < 0.94 else f"y{d}z{k}" for k, w in enumerate(base))) for d in range(6)]
    rows, seen, real = near + far, [], minhash._cells

    def cells(*args):
        out = real(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(minhash, "_cells", cells)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), tile=16)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    assert sum(seen) < 3 * len(rows)


def test_buckets_wider_than_a_cell(spark):
    """Few rows in a band make wide buckets: every pair is compared all the same."""
    rows = corpus(5, 3, 90, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in near_duplicates(docs, tile=8, bands=30, rows=2).collect()) == brute(rows)


def test_share_of_equal_minima_is_the_similarity():
    rnd = __import__("numpy").random.default_rng(1)
    sets = []
    for _ in range(300):
        v = rnd.integers(0, 2**64, size=100, dtype="uint64")
        sets += [v[:90], v[10:]]
    low = minhash.minima(sets, 640)
    assert abs((low[:, ::2] == low[:, 1::2]).mean() - 0.8) < 0.01


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 180)] + [(7, 7), (None, 3), (200, 150)]
    rows = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {**{i: 0 for i in range(1, 61)}, **{x: 100 for x in range(101, 180)}, 200: 100}


def test_long_text(spark):
    words = [f"w{i % 5000}x{i}" for i in range(300_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-3000])), (3, " ".join(words[: len(words) // 2]))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {1: (299_998, 1), 2: (296_998, 1), 3: (149_998, 3)}


def test_hashes_tell_words_apart():
    h, n = minhash.word_hashes([b"ab ba", b"", b"AB  abab a b"])
    assert n.tolist() == [2, 0, 4] and h[0] == h[2] and len(set(h.tolist())) == 5
