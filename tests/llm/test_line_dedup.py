from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from tillroll.llm.line_dedup import dedup_lines, line_report, masked, templates


BIG = (1 << 63) - 1


def brute(rows, min_contexts=3, min_short=10):
    """(doc_id, lines, dropped, kept text) by whole lists: a template recurs by the
    different texts that have it (compared without their digits), or by its different
    surroundings; that of a short line by the texts alone, and by more of them."""
    seen_in, around, first, per = defaultdict(set), defaultdict(set), {}, []
    for d, t in rows:
        lines = (t or "").split("\n")
        marks = [" ".join(masked(x)) for x in lines]
        own = []
        for k, x in enumerate(lines):
            tokens = masked(x)
            short = len(tokens) < 4
            paths = [("short", " ".join(tokens))] if short and set(tokens) - {"<*>"} else [] if short else [("long", p) for p in templates(tokens)]
            for p in paths:
                seen_in[p].add(tuple(marks))
                around[p].add((marks[k - 1] if k else None, marks[k + 1] if k + 1 < len(marks) else None))
                first[p] = min(first.get(p, BIG), BIG if d is None else d)
            own.append(paths)
        per.append(own)

    def recurs(p):
        return len(seen_in[p]) >= min_short if p[0] == "short" else max(len(seen_in[p]), len(around[p])) >= min_contexts

    out = []
    for (d, t), own in zip(rows, per, strict=True):
        gone = {k for k, paths in enumerate(own) if any(recurs(p) and (BIG if d is None else d) > first[p] for p in paths)}
        text = t if not gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
        out.append((d, len(t.split("\n")) if t else 0, len(gone), text))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    own = lambda: " ".join(f"w{chr(97 + rnd.randrange(26))}{chr(97 + rnd.randrange(26))}" for _ in range(rnd.randint(4, 20)))
    rows = []
    for d in range(40):
        lines = [own() for _ in range(rnd.randint(0, 4))]
        if rnd.random() < 0.6:
            lines.insert(rnd.randint(0, len(lines)), f"Copyright {rnd.randint(1990, 2024)} by the authors of this page all rights are reserved here")
        if rnd.random() < 0.4:
            lines.insert(rnd.randint(0, len(lines)), f"Posted on {rnd.choice(['Mon', 'Tue'])} in the news")
        if d % 3 == 0:  # a block whose middle line has one surrounding
            lines += ["This notice is shared by all", "its middle has two fixed neighbours", "and here the notice ends today"]
        if d % 2 == 0:
            lines.insert(rnd.randint(0, len(lines)), "All rights reserved.")
        if d % 8 == 0:  # too rare for a short line
            lines.append("Rare words.")
        rows.append((d, "\n".join(lines)))
    copied = own() + "\n" + own()
    return [*rows, *((100 + i, copied) for i in range(30)), (200, None), (201, ""), (202, "\n \n"), (None, rows[3][1]), (None, "All rights reserved.\n" + own()), (5, rows[5][1])]


def test_against_brute_force(spark):
    rows = corpus(1)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, gone int, line string").repartition(3)
    got = dedup_lines(docs)
    assert got.columns == [*docs.columns, "_lines", "_dropped"]
    want = brute(rows)
    assert sorted(((r.doc_id, r["_lines"], r["_dropped"], r.text) for r in got.collect()), key=str) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 10
    # All three cases are there: blocks of lines, short lines, and short lines too rare to go.
    kept = "\n".join(w[3] for w in want if w[3] and w[0] not in (0, None)).split("\n")
    assert kept.count("its middle has two fixed neighbours") == kept.count("All rights reserved.") == 0 and kept.count("Rare words.") == 4
    # A group of copies has one surrounding and keeps its lines.
    assert all(w[2] == 0 for w in want if w[0] is not None and 100 <= w[0] < 200)


def test_query_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    want = [(d, n, g, hashlib.sha256((t or "").encode()).hexdigest()) for d, n, g, t in brute([(r.doc_id, r.text) for r in docs.collect()])]
    assert sorted(tuple(r) for r in line_report(docs).collect()) == sorted(want)
    assert line_report(docs.limit(0)).count() == 0


def test_long_text(spark):
    lines = [f"line {chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)} of a long text" for k in range(17_000)]
    foot = "the same foot stands below"
    rows = [(0, "\n".join([*lines, foot])), *((d, f"own words of {chr(96 + d)} stand here\n{foot}") for d in (1, 2, 3))]
    got = {r.doc_id: (r["_lines"], r["_dropped"], r.text) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == (17_001, 0, rows[0][1]) and all(got[d] == (2, 1, f"own words of {chr(96 + d)} stand here") for d in (1, 2, 3))


def test_variable_fields():
    a, b = (templates(masked(f"Posted by {who} on day {n} in the weekly letters page of ours")) for who, n in (("Ann", 3), ("Bob", 17)))
    assert len(set(a) & set(b)) == 1 and templates(["too", "short", "line"]) == []


def test_clashing_columns(spark):
    rows = corpus(3)
    schema = "_lines string, doc_id long, _gone int, `a.b` string, text string, _doc long, _digest string, _dropped int"
    docs = spark.createDataFrame([("l", d, 7, "x", t, 8, "y", 9) for d, t in rows], schema).repartition(3)
    got = dedup_lines(docs)
    assert got.columns == [*docs.columns, "__lines", "__dropped"]
    want = sorted(((d, n, g, t) for d, n, g, t in brute(rows)), key=str)
    assert sorted(((r.doc_id, r["__lines"], r["__dropped"], r.text) for r in got.collect()), key=str) == want
    assert {tuple(r[c] for c in ("_lines", "_gone", "a.b", "_doc", "_digest", "_dropped")) for r in got.collect()} == {("l", 7, "x", 8, "y", 9)}


def test_blocks_of_lines_go_whole(spark):
    notice = ["This notice is shared by all", "its middle has two fixed neighbours", "and here the notice ends today"]
    head, foot = ["Welcome to the weekly letters", "sent out by our own editors"], ["You can write to us", "at the address given below"]
    own = lambda d, k: f"line {'abcdefgh'[k]} of {chr(97 + d)}{chr(98 + d)} alone"
    texts = ["\n".join([*head, own(d, 0), *notice, own(d, 1), *foot]) for d in range(6)]
    copied = [(20 + i, f"one whole text of two lines\nof which there are {i} copies in all") for i in range(8)]
    got = {r.doc_id: r for r in dedup_lines(spark.createDataFrame([*enumerate(texts), *copied], "doc_id long, text string").repartition(3)).collect()}
    assert got[0].text == texts[0] and all(got[d].text == f"{own(d, 0)}\n{own(d, 1)}" for d in range(1, 6))
    # Copies, digits aside, are one text.
    assert all(got[d].text == t for d, t in copied)


def test_short_lines_go_too(spark):
    own = lambda d: f"line of {chr(97 + d)}{chr(98 + d)} alone here"
    texts = [f"{own(d)}\nAll rights reserved.\n\n{d}\n{d} of 12\n{'Rare.' if d < 9 else 'Other.'}" for d in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in dedup_lines(docs).collect()}
    assert got[0] == texts[0]
    assert all(got[d] == f"{own(d)}\n\n{d}\n{'Rare.' if d < 9 else 'Other.'}" for d in range(1, 12))
    # In fewer texts they stay.
    assert {r.doc_id: r.text for r in dedup_lines(docs.where("doc_id < 9")).collect()} == dict(enumerate(texts[:9]))
