from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tillroll.llm.quality import ORACLE, Rule, base_rules, cascade, first_failure, form_rules, order_rules, quality_report

TEXTS = [
    None, "", " \n\t", "one", "a b c d e f g h i", "w " * 8, "w " * 9, "a b c d e f g h " * 2, "x\x0by\x0cz é日本 😀", "l\nl\n\n \nl2\nl",
    " ".join(f"w{i}" for i in range(40)), "#*$%&|<> " * 30, " ".join(f"w{i}" for i in range(20)) + " a b c d e f g h a b c d e f g h a b",
    "\n".join(["same line of words here now"] * 9), "abcdefghijklmnop " * 25, " ".join(f"word{i}" for i in range(30_000)),
    (" ".join(f"word{i}" for i in range(700)) + " ") * 3, "\x1ca\x85b c　d" * 9,
]


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    rep = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    ls = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars, sym, dup = sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(ls) - len(set(ls))
    base = len(w) < 20 or 100 * len(rep) > 30 * len(w)
    bad = base or not 3 * len(w) <= chars <= 10 * len(w) or 10 * sym > len(w) or 10 * dup > 3 * len(ls)
    return (len(w), chars, sym, dup, len(rep), base, not bad)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(3, "one", "x", 1), (None, "one", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int").repartition(3)


def test_against_brute_force(docs):
    got = sorted((tuple(r) for r in quality_report(docs).collect()), key=str)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=str)


def test_oracle_agrees(spark, sf_small):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    got = quality_report(spark.read.parquet(f"{sf_small}/documents.parquet"))
    rel = con.sql(ORACLE)
    assert got.columns == rel.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(rel.fetchall())


def test_cascade_keeps_what_the_report_keeps(docs):
    kept = cascade(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == sorted(t for t in TEXTS if brute(t)[-1])
    assert cascade(docs.limit(0)).count() == 0 and quality_report(docs.limit(0)).count() == 0


def test_order_is_by_rejection_per_cost(docs):
    never, always = Rule("never", lambda t, w: F.size(w) < 0), Rule("always", lambda t, w: F.size(w) >= 0)
    assert [r.name for r in order_rules(docs, [never, always])] == ["always", "never"]
    assert {r.name for r in order_rules(docs, [*base_rules(), *form_rules()])} == {"short", "repeated", "word_length", "symbols", "dup_lines"}


def test_dear_rules_are_not_computed_for_rejected_documents(docs):
    """A rule that fails when it is computed, after one that rejects most documents."""
    fails = Rule("fails", lambda t, w: F.raise_error(F.lit("computed")).cast("boolean"))
    short = Rule("short", lambda t, w: F.size(w) < 20)
    few = docs.where("text IS NULL OR length(text) < 30")
    assert few.count() > 8
    assert {r.why for r in few.select(first_failure([short, fails]).alias("why")).collect()} == {"short"}
    with pytest.raises(Exception, match="computed"):
        few.select(first_failure([fails, short])).collect()
    with pytest.raises(Exception, match="computed"):
        docs.select(first_failure([short, fails])).collect()


def test_first_failure_names_each_rule(docs):
    rules = [*base_rules(), *form_rules()]
    got = {(r.text, r.why) for r in docs.select("text", first_failure(rules).alias("why")).collect()}
    assert {t for t, why in got if why is None} == {t for t in TEXTS if brute(t)[-1]}
    assert {t for t, why in got if why in ("short", "repeated")} == {t for t in TEXTS if brute(t)[-2]}
