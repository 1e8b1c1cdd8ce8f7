from __future__ import annotations

import zlib

import numpy as np

from tillroll.llm import language_id as li


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in li.language_report(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [(r.lang, got[r.doc_id].lang_pred) for r in rows if got[r.doc_id].held_out and r.lang]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(spark):
    rows = [(i, t, lang) for i in range(40) for t, lang in (("the cat and the dog with them", "en"), ("der hund und die katze mit ihnen", "de"))]
    rows += [(900, None, "en"), (901, "", None), (902, "12 %", "de"), (None, "the dog", None), (903, "日本", None), (904, "a", "en"), (904, "a", "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    out = li.language_report(docs).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in out if r.doc_id is None or r.doc_id >= 900}
    assert len(out) == len(rows)
    assert got[900] == got[901] == got[902] == ("und", 0.0) and got[None][0] == "en" and got[903][1] == 0.0
    assert li.language_report(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in li.language_report(docs.withColumn("lang", li.F.lit(None).cast("string"))).collect()} == {"und"}


def test_look_up_returns_all_languages_of_a_gram():
    h, _ = li.grams([b"word"])
    masks = np.zeros((1 << li.SLOT_BITS, 2), np.uint64)
    for s in li.slots(h):
        masks[s, 1] |= np.uint64(1)
    f = li.Filters([f"l{i:02}" for i in range(65)], [1] * 65, masks)
    assert f.predict([b"word", b"other"])[0] == ["l64", "l00"]


def _brute_grams(text):
    clean = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    every = [clean[k : k + 4] for k in range(len(clean) - 3)]
    return [g for g in every if len(g.replace(" ", "")) >= 2]


def test_grams_are_of_characters():
    for texts in (["word"], ["Ünï 12—ab", "日本語", "да нет"], ["", " ", "a"], ["x" * 9]):
        h, owner = li.grams([t.encode() for t in texts])
        want = [(k, g) for k, t in enumerate(texts) for g in _brute_grams(t)]
        assert owner.tolist() == [k for k, _ in want]
        by_gram = dict(zip((g for _, g in want), h.tolist(), strict=True))
        assert [by_gram[g] for _, g in want] == h.tolist() and len(set(by_gram.values())) == len(by_gram)


def test_predictions_against_one_filter_for_each_language(spark, sf_small):
    """The same Bloom filters as sets of bits, one for each language, and all counts by
    whole lists; the grams of a language by the rule over all of its documents."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    train = {(t, lang) for d, t, lang in rows if lang and t and zlib.crc32(str(d).encode()) % 4 != 2}
    df = {}
    for t, lang in train:
        for g in set(_brute_grams(t)):
            df.setdefault(g, {}).setdefault(lang, 0)
            df[g][lang] += 1
    size = {x: sum(lang == x for _, lang in train) for x in {lang for _, lang in train}}
    bits = {x: set() for x in size}

    def at(g):
        return [int(s[0]) for s in li.slots(HASH[g])]

    every = sorted({g for _, t, _ in rows if t for g in _brute_grams(t)})
    # The hash of a gram, from a text that has it.
    HASH = {}
    for _, t, _ in rows:
        for g, h in zip(_brute_grams(t or ""), li.grams([(t or "").encode()])[0], strict=True):
            HASH[g] = np.array([h], np.uint64)
    assert set(HASH) == set(every)
    for g, by in df.items():
        top = max(n / size[x] for x, n in by.items())
        for x, n in by.items():
            if n / size[x] >= li.SHARE * top and n >= min(2, size[x]):
                bits[x].update(at(g))
    chance = {x: (len(b) / (1 << li.SLOT_BITS)) ** li.HASHES for x, b in bits.items()}
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.language_report(docs).collect()}
    for d, t, _ in rows:
        g = _brute_grams(t or "")
        fair = {x: max(0.0, sum(set(at(y)) <= bits[x] for y in g) - len(g) * chance[x]) / (1 - chance[x]) for x in size}
        best = max(sorted(fair), key=lambda x: fair[x])
        if sum(fair.values()) > 0:
            assert got[d][0] == best and abs(got[d][1] - fair[best] / sum(fair.values())) < 1e-9


def test_long_text(spark):
    rows = [(k, "the cat and the dog with them", "en") for k in range(20)] + [(50 + k, "der hund und die katze mit ihnen", "de") for k in range(20)]
    rows += [(900, "der hund und die katze mit ihnen " * 100_000, None)]
    got = {r.doc_id: r for r in li.language_report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[900].lang_pred == "de" and got[900].score > 0.9
