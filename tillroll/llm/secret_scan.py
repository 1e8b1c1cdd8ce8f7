"""Secrets in text, by a trigram inverted index.

The index is dealt out by document: a segment holds some megabytes of text with,
for each trigram of its bytes (A-Z in lower case), the documents of the segment
that have it. It is written once and serves any set of rules.

A rule is a regular expression. From its syntax tree comes a Boolean query over
trigrams that every match must satisfy; its postings are put together in each
segment, the rarest first, and the expression itself runs over the documents that
remain. A rule from which no trigram follows runs over all documents. Segments
need no exchange with one another, so a trigram that all documents have costs no
more than its share in each segment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_rows
from tillroll.session import materialize


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that don't overlap; those whose ``group`` has
    fewer than ``least`` characters are dropped. Classes such as ``\\w`` and case
    are those of ASCII."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed patterns of the base, in the order of their kinds.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
#: Public formats of keys and tokens beside these.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/=-]+", 0, 27),
    Rule("login", r"[a-z][a-z0-9+.-]*://[^\x00-\x20:@/]+:[^\x00-\x20:@/]+@"),
)
RULES = BASE + MORE

#: Text of a segment.
SEGMENT_BYTES = 4 << 20
#: Bytes of a long text whose trigrams are found at a time.
_CHUNK = 1 << 20

# ------------------------------------------------- trigrams that matches must have

#: A query: ALL is satisfied by any text; else ("and" | "or", parts), parts being queries or trigrams.
ALL = ("and", frozenset())
#: Strings of a set that are told apart, and characters of a class.
STRINGS, CHARS = 64, 8


def _both(*queries):
    parts = frozenset().union(*(q[1] if isinstance(q, tuple) and q[0] == "and" else {q} for q in queries))
    return next(iter(parts)) if len(parts) == 1 else ("and", parts)


def _either(queries):
    queries = frozenset(queries)
    if ALL in queries or not queries:
        return ALL
    return next(iter(queries)) if len(queries) == 1 else ("or", queries)


def _has(strings) -> tuple | str:
    """Trigrams of a text that contains one of the strings."""
    return _either(_both(ALL, *(s[k : k + 3] for k in range(len(s) - 2))) for s in strings)


@dataclass
class _Part:
    """What is known of the matches of a part of an expression: all of them
    (``exact``), or else the strings that they begin and end with; and a query."""

    exact: frozenset | None
    head: frozenset = frozenset({""})
    tail: frozenset = frozenset({""})
    query: tuple | str = ALL


_ANY = _Part(None)
_EMPTY = _Part(frozenset({""}))


def _settled(p: _Part) -> _Part:
    """Sets that grew large give way to a query and their ends."""
    exact, head, tail, query = p.exact, p.head, p.tail, p.query
    if exact is not None:
        if len(exact) <= STRINGS and max(map(len, exact)) <= 64:
            return p
        query, head, tail, exact = _both(query, _has(exact)), exact, exact, None
    head, tail = frozenset(s[:2] for s in head), frozenset(s[-2:] if s else s for s in tail)
    none = frozenset({""})
    return _Part(exact, head if len(head) <= STRINGS else none, tail if len(tail) <= STRINGS else none, query)


def _joined(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None:
        return _settled(_Part(frozenset(x + y for x, y in product(a.exact, b.exact))))
    ends, starts = a.tail if a.exact is None else a.exact, b.head if b.exact is None else b.exact
    across = frozenset(x + y for x, y in product(ends, starts))
    head = a.head if a.exact is None else across if len(across) <= STRINGS else a.exact
    tail = b.tail if b.exact is None else across if len(across) <= STRINGS else b.exact
    return _settled(_Part(None, head, tail, _both(a.query, b.query, _has(across))))


def _chosen(parts: list[_Part]) -> _Part:
    if all(p.exact is not None for p in parts):
        return _settled(_Part(frozenset().union(*(p.exact for p in parts))))
    heads = frozenset().union(*(p.head if p.exact is None else p.exact for p in parts))
    tails = frozenset().union(*(p.tail if p.exact is None else p.exact for p in parts))
    return _settled(_Part(None, heads, tails, _either(p.query if p.exact is None else _has(p.exact) for p in parts)))


def _char(code: int) -> str:
    """A character's bytes, A-Z in lower case, as characters below 256."""
    return chr(code).encode("utf-8", "surrogatepass").lower().decode("latin-1")


def _class(items) -> _Part:
    codes: set[int] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            codes.add(value)
        elif kind is sre.RANGE and value[1] - value[0] < 2 * CHARS:
            codes.update(range(value[0], value[1] + 1))
        else:
            return _ANY
    chars = frozenset(map(_char, codes))
    return _Part(chars) if chars and len(chars) <= CHARS else _ANY


def _part(tree) -> _Part:
    out = _EMPTY
    for kind, value in tree:
        if kind is sre.LITERAL:
            p = _Part(frozenset({_char(value)}))
        elif kind is sre.IN:
            p = _class(value)
        elif kind is sre.BRANCH:
            p = _chosen([_part(t) for t in value[1]])
        elif kind is sre.SUBPATTERN:
            p = _part(value[-1])
        elif kind is sre.ATOMIC_GROUP:
            p = _part(value)
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            least, most, inner = value[0], value[1], _part(value[2])
            if (least, most) == (0, 1):
                p = _chosen([_EMPTY, inner])
            else:
                p = _EMPTY
                for _ in range(min(least, 4)):
                    p = _joined(p, inner)
                if least > 4 or most != least:
                    p = _joined(p, _ANY)
                    if least and inner.exact is not None:
                        p = _settled(_Part(None, p.head, inner.exact, p.query))
        elif kind in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            p = _EMPTY
        else:
            p = _ANY
        out = _joined(out, p)
    return out


def trigram_query(pattern: str):
    """A Boolean query over trigrams that each match's text satisfies; ``ALL`` where
    none follows."""
    p = _part(sre_parser.parse(pattern, re.ASCII))
    return p.query if p.exact is None else _has(p.exact)


# ------------------------------------------------------------------------- index


def _lower(b: np.ndarray) -> np.ndarray:
    return b + (32 * ((b >= 65) & (b <= 90))).astype(np.uint8)


def _code(trigram: str) -> int:
    a, b, c = trigram.encode("latin-1")
    return a << 16 | b << 8 | c


def trigrams(text: bytes) -> np.ndarray:
    """Codes of the distinct trigrams of a text, in order."""
    out = np.zeros(0, np.uint32)
    for lo in range(0, max(1, len(text)), _CHUNK):
        b = _lower(np.frombuffer(text[lo : lo + _CHUNK + 2], np.uint8)).astype(np.uint32)
        own = np.unique(b[:-2] << 16 | b[1:-1] << 8 | b[2:]) if len(b) > 2 else out[:0]
        out = np.union1d(out, own) if lo else own
    return out


#: Columns of a segment: of its documents, and the index of these.
_SEGMENT = ("ids", "sizes", "texts", "terms", "counts", "postings")


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for ids, texts in text_rows(batches, SEGMENT_BYTES):
        own = [trigrams(t) for t in texts]
        term, doc = np.concatenate(own), np.repeat(np.arange(len(own), dtype=np.uint32), [len(x) for x in own])
        order = np.argsort(term, kind="stable")
        terms, counts = np.unique(term, return_counts=True)
        doc = doc[order]
        # Differences within each list.
        step = np.diff(doc, prepend=np.uint32(0))
        first = (np.cumsum(counts) - counts)[counts > 0]
        step[first] = doc[first]
        packed = [press.compress(x) for x in (b"".join(texts), terms.astype("<u4").tobytes(), counts.astype("<u4").tobytes(), step.astype("<u4").tobytes())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), *(pa.array([x], pa.binary()) for x in packed)],
            names=list(_SEGMENT),
        )


def trigram_index(docs: DataFrame) -> DataFrame:
    """The trigram index of the documents' whole texts, a row for each segment. Null
    texts are empty; a text longer than a segment has one of its own; repeated rows
    are indexed like others."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(_indexed, "ids array<long>, sizes array<long>, texts binary, terms binary, counts binary, postings binary")


class Segment:
    """Postings of a segment."""

    def __init__(self, documents: int, terms: bytes, counts: bytes, postings: bytes):
        press = zstandard.ZstdDecompressor()
        self.documents = documents
        self.terms, counts, step = (np.frombuffer(press.decompress(x), "<u4") for x in (terms, counts, postings))
        self.cuts = np.append(0, np.cumsum(counts, dtype=np.int64))
        self.steps = step

    def postings(self, trigram: str) -> np.ndarray:
        code = _code(trigram)
        at = int(np.searchsorted(self.terms, code))
        if at == len(self.terms) or self.terms[at] != code:
            return np.zeros(0, np.int64)
        return np.cumsum(self.steps[self.cuts[at] : self.cuts[at + 1]], dtype=np.int64)

    def size(self, query) -> int:
        """Documents that satisfy a query, at most."""
        if isinstance(query, str):
            at = int(np.searchsorted(self.terms, code := _code(query)))
            return int(self.cuts[at + 1] - self.cuts[at]) if at < len(self.terms) and self.terms[at] == code else 0
        sizes = [self.size(q) for q in query[1]]
        return min([self.documents, *sizes]) if query[0] == "and" else min(self.documents, sum(sizes))

    def find(self, query) -> np.ndarray:
        """Documents that satisfy a query, in order."""
        if isinstance(query, str):
            return self.postings(query)
        if query[0] == "or":
            out = np.zeros(0, np.int64)
            for q in query[1]:
                out = np.union1d(out, self.find(q))
            return out
        found = None
        for q in sorted(query[1], key=self.size):
            own = self.find(q)
            found = own if found is None else np.intersect1d(found, own, assume_unique=True)
            if not len(found):
                break
        return np.arange(self.documents) if found is None else found


# -------------------------------------------------------------------------- scan


def _matcher(rule: Rule):
    """Spans of a rule in a text, as (start, end) in characters."""
    pattern, group, least = re.compile(rule.pattern, re.ASCII), rule.group, rule.least

    def spans(text: str) -> list[tuple[int, int]]:
        return [m.span() for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]

    tree = list(sre_parser.parse(rule.pattern, re.ASCII))
    if group or least < 2 or len(tree) != 1 or tree[0][0] is not sre.MAX_REPEAT or tree[0][1][:2] != (1, sre.MAXREPEAT):
        return spans
    inner = list(tree[0][1][2])
    if len(inner) != 1 or inner[0][0] is not sre.IN:
        return spans
    # Runs of a class: those of enough characters are found without the shorter ones.
    runs = re.compile(f"{rule.pattern[:-1]}{{{least},}}", re.ASCII)
    return lambda text: [m.span() for m in runs.finditer(text)]


def find_secrets(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Matches of the rules in the documents of a trigram index.

    Returns doc_id and ``spans``: kind, start and end (characters, end exclusive),
    ordered by start, then by the rules' order. Texts without a match, empty and null
    ones have an empty list; repeated rows come back as often, and rows without a
    doc_id with none; an empty index gives no rows."""
    queries = [trigram_query(r.pattern) for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, find = zstandard.ZstdDecompressor(), [_matcher(r) for r in rules]
        for batch in batches:
            for ids, sizes, data, *lists in zip(*(batch.column(n).to_pylist() for n in _SEGMENT), strict=True):
                segment = Segment(len(ids), *lists)
                found: list[list[tuple[int, int, int]]] = [[] for _ in ids]
                texts, cuts = None, np.cumsum([0, *sizes]).tolist()
                for k, query in enumerate(queries):
                    for d in segment.find(query).tolist():
                        texts = texts or press.decompress(data)
                        found[d] += [(a, k, z) for a, z in find[k](texts[cuts[d] : cuts[d + 1]].decode())]
                spans = [[{"kind": rules[k].kind, "start": a, "end": z} for a, k, z in sorted(f)] for f in found]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(spans, kind)], names=["doc_id", "spans"])

    return index.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, the numbers of the base's spans by kind, the hash of the base's spans,
    and all spans as text. Null and empty texts have no spans; extra columns are
    ignored."""
    found = find_secrets(materialize(trigram_index(docs), "trigrams"))

    def of(*rules: Rule):
        return F.filter("spans", lambda s: s["kind"].isin([r.kind for r in rules]))

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *(F.size(of(r)).cast("long").alias(f"n_{r.kind}") for r in BASE),
        F.sha2(text(of(*BASE)), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _oracle() -> str:
    """DuckDB SQL of the report: a match begins after the texts between the matches
    before it and those matches."""
    columns, kinds = [], []
    for k, r in enumerate(RULES):
        pattern = re.sub(r"\(\?i:(\(?)([^()]*)(\)?)\)", lambda m: m[1] + _either_case(m[2]) + (m[3] or ""), r.pattern).replace("'", "''")
        columns.append(f"regexp_extract_all(t, '{pattern}') AS m{k}, string_split_regex(t, '{pattern}') AS g{k}, regexp_extract_all(t, '{pattern}', {r.group}) AS v{k}")
        at = f"(list_sum(list_transform(g{k}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m{k}[1:i-1], lambda x: length(x))), 0))::BIGINT"
        kinds.append(
            f"list_transform(list_filter(range(1, len(m{k}) + 1), lambda i: length(v{k}[i]) >= {r.least}),"
            f" lambda i: {{'s': {at}, 'k': {k}, 't': '{r.kind}:' || {at} || ':' || ({at} + length(m{k}[i]))}})"
        )

    def joined(spans: str) -> str:
        return f"coalesce(list_aggregate(list_transform({spans}, lambda x: x.t), 'string_agg', ','), '')"

    return f"""
WITH found AS (SELECT doc_id, {", ".join(columns)} FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
spans AS (SELECT doc_id, list_sort(list_concat({", ".join(kinds)})) AS s FROM found)
SELECT doc_id, {", ".join(f"len(list_filter(s, lambda x: x.k = {k}))::BIGINT AS n_{r.kind}" for k, r in enumerate(BASE))},
  sha256({joined(f"list_filter(s, lambda x: x.k < {len(BASE)})")}) AS base_sha256, {joined("s")} AS spans
FROM spans
"""


ORACLE = _oracle()
