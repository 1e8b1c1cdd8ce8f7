from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillroll.llm import alignment as al

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", "  a", "a  b ", "a\n\n b\t", "a \n b", "日本語　テスト", "<|endoftext|> <s> </s> <0x41> <unk>", "é", "mark ▁ in it", "\x00 x\x7f", "I'll don't",
    "naïve   ,. ", "x" * 3000, "some words, " * 3000, "a\u00a0 b", "😀😀 ﬁ", "tie one", "tie one", "a b c", "a" + " " * 40 + "b",
]


def tokens(texts):
    """(A ids, A bytes, B ids, B bytes) of each text, encoded whole by the libraries."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    of = al.byte_level()
    for t in texts:
        x, y = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        x_bytes = [bytes(of[c] for c in a.id_to_token(i)) for i in x]
        y_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in y for p in [b.id_to_piece(i)]]
        yield x, x_bytes, y, y_bytes


def brute(rows):
    """Groups by the offsets at which tokens of both sides end, links by all pairs of them."""
    out, links = [], []
    for (doc, text), (x, xb, y, yb) in zip(rows, tokens([t or "" for _, t in rows]), strict=True):
        whole = (" " + (text or "")).encode()
        if not text or b"".join(xb) != whole or b"".join(yb) != whole:
            out.append((doc, 0, 0, 0, ""))
            links.append(Counter())
            continue
        x_end, y_end = np.cumsum([len(t) for t in xb]).tolist(), np.cumsum([len(t) for t in yb]).tolist()
        groups, lo = [], 0
        for hi in sorted(set(x_end) & set(y_end)):
            groups.append("|".join(",".join(str(i) for i, e in zip(ids, ends, strict=True) if lo < e <= hi) for ids, ends in ((x, x_end), (y, y_end))))
            lo = hi
        y_at = dict(zip(y_end, y, strict=True))
        own = Counter((i, y_at[e]) for i, e in zip(x, x_end, strict=True) if e in y_at)
        out.append((doc, len(x), len(y), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(own)
    total = sum(links, Counter())
    top = {}
    for (_, b), n in total.items():
        top[b] = max(n, top.get(b, 0))
    return sorted(
        ((doc, n_a, n_b, n_g, sum(own.values()), sum(n for p, n in own.items() if total[p] == top[p[1]]), sum(n * total[p] for p, n in own.items()), digest) for (doc, n_a, n_b, n_g, digest), own in zip(out, links, strict=True)),
        key=str,
    )


def check(docs, rows):
    assert sorted((tuple(r) for r in al.alignment_report(docs, A, B).collect()), key=str) == brute(rows)


@given(st.sets(st.integers(1, 30)), st.sets(st.integers(1, 30)))
@settings(max_examples=200, deadline=None)
def test_coalesce(a, b):
    ends = [np.array(sorted({*x, 31}), np.int64) for x in (a, b)]
    order, side, begins = al.coalesce(*ends)
    both = np.concatenate(ends)[order]
    groups = np.split(np.arange(len(order)), np.flatnonzero(begins)[1:])
    shared = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    assert [int(both[g].max()) for g in groups] == shared
    for g, lo, hi in zip(groups, [0, *shared], shared, strict=False):
        for k in (0, 1):
            assert both[g][side[g] == k].tolist() == [e for e in ends[k].tolist() if lo < e <= hi]


@given(st.sets(st.integers(1, 30)), st.sets(st.integers(1, 30)))
@settings(max_examples=100, deadline=None)
def test_overlaps(a, b):
    x, y = (sorted({*s, 31}) for s in (a, b))
    got = list(zip(*(k.tolist() for k in al.overlaps(np.array(x), np.array(y))), strict=True))
    spans = [list(zip([0, *e], e, strict=False)) for e in (x, y)]
    assert sorted(got) == sorted((i, j) for i, (p, q) in enumerate(spans[0]) for j, (r, s) in enumerate(spans[1]) if max(p, r) < min(q, s))


def test_overlapping_links(spark):
    text = "unbelievable naïve 日本語"
    row = al.align_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B, overlap=True).first()
    ((x, xb, y, yb),) = tokens([text])
    xe, ye = np.cumsum([len(t) for t in xb]).tolist(), np.cumsum([len(t) for t in yb]).tolist()
    want = Counter(i << 32 | j for i, p, q in zip(x, [0, *xe], xe, strict=False) for j, r, s in zip(y, [0, *ye], ye, strict=False) if max(p, r) < min(q, s))
    assert dict(zip(row.links, row.times, strict=True)) == want and row.n_links == want.total() > row.n_groups


def test_bytes_of_ids():
    x = al.Aligner(A, B)
    assert sorted(al.byte_level().values()) == list(range(256))
    for t, (a, ab, b, bb) in zip(ODD[1:], tokens(ODD[1:]), strict=True):
        assert [x.bytes[0][i] for i in a] == ab and [x.bytes[1][i] for i in b] == bb, t


def test_odd_texts(spark, monkeypatch):
    # All pairs but the most frequent go by the shuffle.
    monkeypatch.setattr(al, "HOT_SHARE", 50)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (None, None), (3, "same id"), (3, "same id")]
    docs = spark.createDataFrame([(d, t, 1, "x", [2]) for d, t in rows], "doc_id long, text string, n_a long, groups string, links array<int>").repartition(3)
    check(docs, rows)


def test_query_against_whole_texts(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_groups_are_kept(spark):
    docs = spark.createDataFrame([(1, "the the"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in al.align_tokens(docs, A, B).collect()}
    a, b = Tokenizer.from_file(A).encode(" the").ids, sentencepiece.SentencePieceProcessor(model_file=B).encode("the")
    assert got[1].groups == f"{a[0]}|{b[0]};{a[0]}|{b[0]}" and got[1].links == [a[0] << 32 | b[0]] and got[1].times == [2]
    assert (got[2].groups, got[2].links) == ("", [])


def test_empty_table(spark):
    assert al.alignment_report(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
