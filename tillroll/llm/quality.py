"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

A rule is a condition under which a document goes. What each rule costs beyond
the splitting into words, which is done once for all, and how much it rejects is
estimated on a bounded sample, and the rules are tried in the order of rejections
per cost, so that most bad documents fall to a cheap rule and only what passes all
before pays for the dear ones.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Documents of the sample on which the order of the rules is estimated.
SAMPLE = 500
WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
_SPACES = r"[\x20\x09-\x0D]+"


#: Runs of a rule on the sample, after a first one that compiles it.
RUNS = 2


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, bound with transform over an array
    of one."""
    return F.element_at(F.transform(F.array(value), then), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACES), "")


def n_words(w: Column) -> Column:
    return F.size(w).cast("long")


def n_symbols(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), SPACE, "")).cast("long")


def lines(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)


def n_dup_lines(own: Column) -> Column:
    """Of a text's lines: those that are equal to an earlier one."""
    return (F.size(own) - F.size(F.array_distinct(own))).cast("long")


def n_repeat_words(w: Column) -> Column:
    """Words in windows of ``WINDOW`` words that stand in the text twice or more.

    Windows are known by a 64-bit hash. Only a text that has repeated ones pays
    for finding where they stand: windows in order of their hash show repeats as
    neighbours, and their places, in order again, give the words they cover.
    """
    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            twice = F.filter(
                p,
                lambda x, k: (F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False))) | (F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False))),
            )
            at = F.sort_array(F.transform(twice, lambda x: x["i"]))
            return let(at, lambda a: F.aggregate(a, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), _cover, lambda s: s["n"]))

        return let(pairs, places)

    def _cover(s: Column, i: Column) -> Column:
        return F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last"))

    def joined(a: Column, k: int) -> Column:
        """Each hash with that ``k`` places on."""
        n = F.size(a) - k
        return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(k + 1), n), lambda x, y: F.xxhash64(x, y))

    def windows(hw: Column) -> Column:
        # Of two words, of four, of eight.
        eight = let(joined(hw, 1), lambda two: let(joined(two, 2), lambda four: joined(four, 4)))
        return F.when(F.size(hw) > WINDOW, eight)

    def count(h: Column) -> Column:
        return F.when(h.isNull() | (F.size(F.array_distinct(h)) == F.size(h)), F.lit(0)).otherwise(covered(h))

    hashed = F.transform(w, lambda x: F.xxhash64(x))
    return let(let(hashed, windows), count).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects`` gives a condition over a text and its words that is never null."""

    name: str
    rejects: Callable[[Column, Column], Column]


def base_rules() -> list[Rule]:
    """Too short; too much of it repeated."""
    return [
        Rule("short", lambda t, w: F.size(w) < 20),
        Rule("repeated", lambda t, w: 100 * n_repeat_words(w) > 30 * n_words(w)),
    ]


def form_rules() -> list[Rule]:
    """Words too short or too long on average; a symbol for every tenth word or
    more; three tenths of the lines, or more, copies of earlier ones."""
    return [
        Rule("word_length", lambda t, w: let(word_chars(t), lambda c: (c < 3 * n_words(w)) | (c > 10 * n_words(w)))),
        Rule("symbols", lambda t, w: 10 * n_symbols(t) > n_words(w)),
        Rule("dup_lines", lambda t, w: let(lines(t), lambda own: 10 * n_dup_lines(own) > 3 * F.size(own))),
    ]


def order_rules(docs: DataFrame, rules: list[Rule], sample: int = SAMPLE) -> list[Rule]:
    """The rules by rejections per cost on a sample of about ``sample``
    documents, drawn row by row, so that a text that many rows have can't swell
    it; the order changes no result."""
    total = docs.count()
    some = docs.select("text").sample(min(1.0, sample / max(1, total)), seed=1).persist()
    try:
        n = max(1, some.count())

        def timed(condition: Callable[[Column, Column], Column]) -> tuple[float, int]:
            count = some.agg(F.count_if(let(words(F.col("text")), lambda w: condition(F.col("text"), w))))
            took = []
            for _ in range(1 + RUNS):
                began = time.perf_counter()
                out = count.first()[0]
                took.append(time.perf_counter() - began)
            return min(took[1:]), out

        split = timed(lambda t, w: F.size(w) >= 0)[0]
        worth = {}
        for k, rule in enumerate(rules):
            cost, rejected = timed(rule.rejects)
            worth[rule.name] = (-(rejected / n) / max(cost - split, 1e-3), k)
        return sorted(rules, key=lambda r: worth[r.name])
    finally:
        some.unpersist()


def first_failure(rules: list[Rule], text: Column | str = "text") -> Column:
    """The name of the first rule that rejects the document, or null. The text is
    split into words once; later rules aren't computed."""
    t = F.col(text) if isinstance(text, str) else text

    def named(w: Column) -> Column:
        out = F
        for rule in rules:
            out = out.when(rule.rejects(t, w), rule.name)
        return out.otherwise(F.lit(None).cast("string"))

    return let(words(t), named) if rules else F.lit(None).cast("string")


def cascade(docs: DataFrame, rules: list[Rule] | None = None, sample: int = SAMPLE) -> DataFrame:
    """All columns of the documents that no rule rejects.

    A null or empty text has no words and goes as too short. Repeated rows are
    judged alike; an empty table stays empty; long texts are judged whole; other
    columns pass unread.
    """
    rules = order_rules(docs, rules or [*base_rules(), *form_rules()], sample)
    return docs.where(first_failure(rules).isNull())


def quality_report(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, for each row of the documents. Null and empty texts have no
    words and fail as too short; repeated rows come back as often; an empty table gives
    no rows. As all measures are wanted of all documents, each is computed once, and
    the rules compare them in the cascade's order."""
    texts = docs.select("doc_id", "text")
    order = [r.name for r in order_rules(texts, form_rules(), sample)]
    t = F.col("text")

    def measures(w: Column) -> Column:
        own = let(lines(t), lambda x: F.struct(F.size(x).alias("n"), n_dup_lines(x).alias("dup")))
        return F.struct(
            n_words(w).alias("n_words"), word_chars(t).alias("word_chars"), n_symbols(t).alias("n_symbols"),
            own.alias("lines"), n_repeat_words(w).alias("n_repeat_words"),
        )

    parts = texts.select("doc_id", F.inline(F.array(let(words(t), measures)))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", F.col("lines.dup").alias("n_dup_lines"), "n_repeat_words", F.col("lines.n").alias("n_lines")
    )
    verdict = {
        "word_length": F.expr("word_chars < 3 * n_words OR word_chars > 10 * n_words"),
        "symbols": F.expr("10 * n_symbols > n_words"),
        "dup_lines": F.expr("10 * n_dup_lines > 3 * n_lines"),
    }
    base = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    failed = F.when(F.col("base_failed"), "base")
    for name in order:
        failed = failed.when(verdict[name], name)
    return parts.withColumn("base_failed", base).withColumn("kept", failed.isNull()).drop("n_lines")


#: The same rows in DuckDB.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM rep) GROUP BY doc_id),
f AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines
  FROM d LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines) AS kept
FROM b
"""
