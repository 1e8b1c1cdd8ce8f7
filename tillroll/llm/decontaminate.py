"""Benchmark passages in training text, by a distributed positional index.

The index is dealt out by document: a shard holds some megabytes of text as
postings, for each term (known by a 64-bit hash) the places where it stands
among the shard's words, in order. It holds all terms, is written once, and
serves any test set. A phrase is looked up from its rarest terms: the postings
of the rarest, less the term's offset in the phrase, are the candidate places,
and each further term, rarer ones first, keeps those for which its own postings
hold the place plus its offset. Shards need no exchange with one another, so a
term that a third of the corpus has costs no more than its share in each shard.

The test set goes to the tasks in blocks of about ``BLOCK_WORDS`` words; each
block makes one pass over the index, and what the passes find is put together
by document.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import BYTE_VALUES, gap_table, hashed_words, text_hash, text_rows
from tillroll.session import materialize

SIZE = 10
#: Words of test items that go to the tasks at once.
BLOCK_WORDS = 1_000_000
#: Text of a shard.
SHARD_BYTES = 4 << 20
#: Words between documents, in the numbering of places: more than any phrase
#: with its slack.
GAP = 1 << 32

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAPS = gap_table(bytes(c for c in range(128) if not chr(c).isalnum()))
_LOWER = BYTE_VALUES.copy()
#: Upper case as lower case, so that they hash alike.
_LOWER[65:91] = _LOWER[97:123]


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: ASCII letters, in lower case, digits, and what
    isn't ASCII."""
    return _WORD.findall(text.lower())


def phrases(items: list[tuple[str, bytes]], size: int) -> dict[tuple[bytes, ...], set[str]]:
    """Windows of ``size`` words of the items with the ids of the items that
    have them; an item of fewer words is one window."""
    out: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            out[tuple(w[k : k + size])].add(item)
    return out


def posting_lists(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct terms of the texts, in order; the number of postings
    of each; the postings, as numbers of words from the first text on; the
    words of each text."""
    *_, h, words_of = hashed_words(texts, _GAPS, _LOWER)
    order = np.argsort(h, kind="stable")
    terms, counts = np.unique(h, return_counts=True)
    return terms, counts, order, words_of


def term_hashes(terms: list[bytes]) -> np.ndarray:
    """Hashes of terms as postings have them."""
    return hashed_words(terms, _GAPS, _LOWER)[3] if terms else np.zeros(0, np.uint64)


class Shard:
    """Postings of the terms of the test set in some documents."""

    def __init__(self, texts: list[bytes], vocabulary: dict[bytes, int]):
        self._load(*posting_lists(texts), term_hashes(sorted(vocabulary, key=vocabulary.get)))

    @classmethod
    def stored(cls, terms: bytes, counts: bytes, places: bytes, words_of: bytes, wanted: np.ndarray) -> Shard:
        """A shard of the index, with the postings of the ``wanted`` hashes."""
        press, shard = zstandard.ZstdDecompressor(), cls.__new__(cls)
        n, order, own = (np.frombuffer(press.decompress(x), "<u4").astype(np.int64) for x in (counts, places, words_of))
        shard._load(np.frombuffer(terms, "<u8"), n, order, own, wanted)
        return shard

    def _load(self, terms: np.ndarray, counts: np.ndarray, order: np.ndarray, words_of: np.ndarray, wanted: np.ndarray) -> None:
        self.words = words_of.astype(np.int64)
        before = np.cumsum(self.words) - self.words
        gaps = np.arange(len(self.words)) * GAP
        self.first = before + gaps
        at = np.minimum(np.searchsorted(terms, wanted), max(0, len(terms) - 1))
        held = terms[at] == wanted if len(terms) else np.zeros(len(wanted), bool)
        self.counts = np.where(held, counts[at], 0) if len(terms) else np.zeros(len(wanted), np.int64)
        self.cuts = np.append(0, np.cumsum(self.counts)).tolist()
        start = (np.cumsum(counts) - counts)[at] if len(terms) else self.counts
        own = np.repeat(start - np.array(self.cuts[:-1], np.int64), self.counts) + np.arange(self.cuts[-1])
        place = order[own]
        self.postings = place + gaps[np.searchsorted(before, place, "right") - 1] if len(place) else place

    def places(self, term: int) -> np.ndarray:
        return self.postings[self.cuts[term] : self.cuts[term + 1]]

    def find(self, phrase: list[int]) -> np.ndarray:
        """Places at which the phrase begins."""
        cuts = self.cuts
        order = sorted(range(len(phrase)), key=lambda k: cuts[phrase[k] + 1] - cuts[phrase[k]])
        found = self.places(phrase[order[0]]) - order[0]
        for k in order[1:]:
            if not len(found):
                break
            held = self.places(phrase[k])
            at = np.searchsorted(held, found + k)
            at[at == len(held)] = 0
            found = found[held[at] == found + k]
        return found

    def near(self, phrase: list[int], slack: int) -> np.ndarray:
        """Places of the phrase's rarest term that stand with all of its terms, in any
        order, in some window of the phrase's length plus ``slack`` words."""
        terms = sorted(set(phrase), key=lambda t: self.cuts[t + 1] - self.cuts[t])
        found, reach = self.places(terms[0]), len(phrase) + slack - 1
        for t in terms[1:]:
            held = self.places(t)
            found = found[np.searchsorted(held, found - reach) < np.searchsorted(held, found + reach, "right")]
        # Few are left: windows that begin at one of the terms before the place, or there.
        return np.array([p for p in found.tolist() if self._within(terms, p, reach)], np.int64)

    def _within(self, terms: list[int], place: int, reach: int) -> bool:
        own = []
        for t in terms:
            held = self.places(t)
            lo, hi = np.searchsorted(held, [place - reach, place + reach + 1])
            own.append(held[lo:hi])
        starts = np.unique(np.concatenate(own))
        starts = starts[starts <= place]
        ends = np.minimum(starts + reach, np.iinfo(np.int64).max)
        whole = ends >= place
        for held in own:
            at = np.searchsorted(held, starts)
            whole &= (at < len(held)) & (np.append(held, np.iinfo(np.int64).max)[at] <= ends)
        return bool(whole.any())

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, "right") - 1


def _search(items: list[tuple[str, bytes]], size: int, slack: int):
    by_phrase = phrases(items, size)
    vocabulary = {t: i for i, t in enumerate(sorted({t for p in by_phrase for t in p}))}
    coded = [([vocabulary[t] for t in p], sorted(ids)) for p, ids in sorted(by_phrase.items())]
    wanted = term_hashes(list(vocabulary))
    flat = np.array([t for p, _ in coded for t in p], np.int64)
    begin = np.cumsum([0, *(len(p) for p, _ in coded)])[:-1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(n).to_pylist() for n in _INDEX), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sums, *lists in rows(batches):
            shard = Shard.stored(*lists, wanted)
            starts: list[list[int]] = [[] for _ in ids]
            ends: list[list[int]] = [[] for _ in ids]
            hits: list[set[str]] = [set() for _ in ids]
            close: list[set[str]] = [set() for _ in ids]
            # A phrase can only stand where all of its terms do.
            here = np.flatnonzero(np.minimum.reduceat(shard.counts[flat], begin)) if coded else ()
            for phrase, owners in (coded[k] for k in here):
                found = shard.find(phrase)
                docs = shard.document(found)
                for d, p in zip(docs.tolist(), (found - shard.first[docs]).tolist(), strict=True):
                    starts[d].append(p)
                    ends[d].append(p + len(phrase))
                    hits[d].update(owners)
                if slack:
                    for d in set(shard.document(shard.near(phrase, slack)).tolist()):
                        close[d].update(owners)
            spans = []
            for s, e in zip(starts, ends, strict=True):
                runs: list[list[int]] = []
                for a, z in sorted(zip(s, e, strict=True)):
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(z, runs[-1][1])
                    else:
                        runs.append([a, z])
                spans.append([{"start": a, "end": z} for a, z in runs])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(shard.words),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([sorted(h) for h in hits], pa.list_(pa.string())),
                    pa.array([sorted(c) for c in close], pa.list_(pa.string())),
                ],
                names=["doc_id", "text_hash", "n_words", "spans", "items", "near_items"],
            )

    return run


#: Columns of the index: of the documents of a shard, and its postings.
_INDEX = ("ids", "hashes", "terms", "counts", "places", "words")


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    for ids, texts in text_rows(batches, SHARD_BYTES):
        terms, *lists = posting_lists(texts)
        packed = [press.compress(x.astype("<u4").tobytes()) for x in lists]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([[text_hash(t) for t in texts]], pa.list_(pa.int64())),
                *(pa.array([x], pa.binary()) for x in (terms.astype("<u8").tobytes(), *packed)),
            ],
            names=list(_INDEX),
        )


def positional_index(docs: DataFrame) -> DataFrame:
    """The positional index of the documents' whole texts: a row for each shard.
    Null texts are empty, and repeated rows are indexed like others."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(_indexed, "ids array<long>, hashes array<long>, terms binary, counts binary, places binary, words binary")


_FOUND = "doc_id long, text_hash long, n_words long, spans array<struct<start:long,end:long>>, items array<string>, near_items array<string>"


def _merged(spans):
    """Spans of several passes, put together where they meet."""
    step = (
        "aggregate(array_sort({0}), array(), (acc, s) -> if(size(acc) > 0 AND s.start <= element_at(acc, -1).end,"
        " concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', greatest(s.end, element_at(acc, -1).end)))),"
        " concat(acc, array(s))))"
    )
    return F.expr(step.format(spans).replace("array(), (acc", "cast(array() AS array<struct<start:bigint,end:bigint>>), (acc"))


def find_benchmark(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, slack: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Occurrences in each document of the test items' windows of ``size`` words.

    Words are runs of ASCII letters (A-Z in lower case), digits and characters
    beyond ASCII. An item of fewer words is one window; a null or empty item has
    none, and an item without an id is found under the empty id. With ``slack``, items also count as near where all
    words of a window stand, in any order, in some stretch of the window's length plus ``slack`` words.

    Returns doc_id, text_hash (``xxhash64`` of the text; null: of the empty one), n_words, n_hit (words inside any occurrence), spans (word
    positions from start to before end, maximal), items (ids as strings, sorted),
    near_items. Long texts are indexed whole. A null or empty text has no words and hits. Repeated rows come
    back as often; extra columns are ignored; an empty benchmark finds nothing.
    """
    index = materialize(positional_index(docs), "postings")
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").cast("binary").alias("text")
    ).where("text IS NOT NULL")
    size_words = items.agg(F.sum(F.ceil(F.octet_length("text") / 2))).first()[0] or 0
    blocks = max(1, -(-int(size_words) // block_words))
    found: DataFrame | None = None
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()
        part = index.mapInArrow(_search([(r.item, bytes(r.text)) for r in own], size, slack), _FOUND)
        if blocks > 1:
            part = materialize(part.withColumn("row", F.row_number().over(_same_rows())), "found")
        found = part if found is None else found.union(part)
    if blocks > 1:
        found = found.groupBy("doc_id", "text_hash", "row").agg(
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"),
        ).withColumn("spans", _merged("spans"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "text_hash", "n_words", hit.alias("n_hit"), "spans", "items", "near_items")


def _same_rows():
    from pyspark.sql import Window

    return Window.partitionBy("doc_id", "text_hash").orderBy("n_words")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the sorted item ids,
    comma-joined), contaminated."""
    found = find_benchmark(docs, benchmark, size)
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: The same rows in DuckDB.
ORACLE = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
hit AS (SELECT DISTINCT grams.doc_id, grams.i, grams.k, win.item_id FROM grams JOIN win ON grams.k = win.k AND grams.g = win.g),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
       sha256(coalesce(its.ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN its USING (doc_id)
"""
