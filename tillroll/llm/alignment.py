"""Alignment of the tokens of two tokenizers over the same bytes.

Each text is encoded by both, A and B, and their tokens are intervals of its bytes.
All tokens of a batch of texts are ordered by where they start (one lexsort), and the
running maximum of their ends is taken: a group ends where a token starts at that
maximum, that is where tokens of both sides end, and tokens that overlap stay in one
group. Pairs of tokens that end together are links, or all pairs that overlap, to
which groups expand; they are counted over the corpus, and each text then gets the
counts of its own links.

Pairs of one in ``HOT_SHARE`` links or more are at most as many, whatever the corpus, and
go to all tasks; the rarer ones are joined by a shuffle, in which none has more rows
than that.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import BYTE_VALUES, gap_table, text_rows
from tillroll.llm.sentencepiece_codec import BYTE, CONTROL, MARK, read_model
from tillroll.llm.units import UnitEncoder, encode_joined, threads
from tillroll.session import materialize

#: Text that is encoded at a time.
BATCH_BYTES = 1 << 20
#: Units that a worker keeps for each tokenizer.
KEEP = 400_000
#: Links among which a frequent pair has one or more.
HOT_SHARE = 1_000_000
#: Pairs that a task holds while it counts.
HELD_PAIRS = 1_000_000

_GAP = gap_table(b" ")
#: Texts with these go whole to the libraries: white space may share a token with a space beside it.
_RUNS = re.compile(r"\A\s| \s|\s |\s\Z")


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 characters for themselves, the others in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Aligner:
    """Both tokenizers in one worker."""

    def __init__(self, a_path: str, b_path: str, parallel: int = 1):
        import sentencepiece
        from tokenizers import Tokenizer

        threads(parallel)
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        of = byte_level()
        size = self.a.get_vocab_size()
        a_bytes = [b""] * size
        for token, i in self.a.get_vocab().items():
            a_bytes[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        with open(b_path, "rb") as f:
            pieces = read_model(f.read()).pieces
        b_bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(MARK, " ").encode() for p, _, kind in pieces]
        # A unit stands for itself if no piece has a space after another character.
        self.by_unit = not any(MARK in p.lstrip(MARK) for p, *_ in pieces)
        self.bytes = tuple(np.array([*x, None], object)[:-1] for x in (a_bytes, b_bytes))
        self.length = tuple(np.array([len(t) for t in x], np.int64) for x in (a_bytes, b_bytes))
        #: Ids as text, with what follows within a side, at its end in a group.
        self.within = tuple(np.array([f"{i}," for i in range(len(x))], object) for x in (a_bytes, b_bytes))
        self.ending = tuple(np.array([f"{i}{c}" for i in range(len(x))], object) for x, c in ((a_bytes, "|"), (b_bytes, ";")))
        self.units = UnitEncoder(self._a_units, KEEP), UnitEncoder(self._b_units, KEEP)

    def _a_units(self, new: list[bytes]) -> list[bytes]:
        return encode_joined(self.a, [" " + u.decode() for u in new], "")

    def _b_units(self, new: list[bytes]) -> list[bytes]:
        return [np.array(x, "<u4").tobytes() for x in self.b.encode([u.decode() for u in new], num_threads=1)]

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and B the ids of the texts side by side, and the number of each text's.
        No text is empty."""
        plain = [self.by_unit and not _RUNS.search(t.decode()) for t in texts]
        own = [t for t, p in zip(texts, plain, strict=True) if p]
        rest = [t.decode() for t, p in zip(texts, plain, strict=True) if not p]
        out = []
        for k, units in enumerate(self.units):
            ids, n = units.batch(own, _GAP, BYTE_VALUES)
            if rest:
                if k == 0:
                    whole = [e.ids for e in self.a.encode_batch_fast([" " + t for t in rest], add_special_tokens=False)]
                else:
                    whole = self.b.encode(rest, num_threads=1)
                one, two = iter(np.split(ids, np.cumsum(n)[:-1]) if own else ()), (np.array(w, np.uint32) for w in whole)
                every = [next(one if p else two) for p in plain]
                ids, n = np.concatenate(every), np.array([len(x) for x in every])
            out.append((ids.astype(np.int64), n.astype(np.int64)))
        return out


def coalesce(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of the tokens of two sides that cover the same bytes without a gap, from the
    ends of each side's tokens: the order of all tokens (A's numbers, then B's) by
    group and side, the side of each, and whether a group begins with it."""
    ends = np.concatenate((a_ends, b_ends))
    starts = np.concatenate((np.append(0, a_ends[:-1])[: len(a_ends)], np.append(0, b_ends[:-1])[: len(b_ends)]))
    side = np.repeat(np.array([0, 1], np.int8), (len(a_ends), len(b_ends)))
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    begins = np.append(True, starts[order][1:] == reach[:-1])[: len(order)]
    order = order[np.argsort(2 * np.cumsum(begins) + side[order], kind="stable")]
    return order, side[order], begins


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens of two sides that share bytes, as the tokens' numbers: each stretch
    between two neighbouring ends, of either side, lies in one token of both."""
    ends = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


_aligners: dict = {}


def aligner(a_path: str, b_path: str, parallel: int = 1) -> Aligner:
    """The tokenizers of two files, made once in each worker."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path, parallel)
    return _aligners[a_path, b_path]


def _aligned(al: Aligner, texts: list[bytes], overlap: bool) -> Iterator[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
    """Of each text: numbers of A's and B's tokens, of groups, the groups as text, links
    as distinct numbers (A's id in the upper half) and how often each."""
    (a, n_a), (b, n_b) = al.encode(texts)
    a_size, b_size = al.length[0][a], al.length[1][b]
    a_text, b_text = (np.repeat(np.arange(len(texts)), n) for n in (n_a, n_b))
    want = np.array([len(t) + 1 for t in texts], np.int64)
    good = (np.bincount(a_text, a_size, len(texts)).astype(np.int64) == want) & (np.bincount(b_text, b_size, len(texts)).astype(np.int64) == want)
    # The bytes themselves: of the texts whose lengths agree.
    data = b"".join(b" " + t for t, g in zip(texts, good.tolist(), strict=True) if g)
    for k, (ids, own) in enumerate(((a, a_text), (b, b_text))):
        if b"".join(al.bytes[k][ids[good[own]]].tolist()) != data:
            cuts = np.cumsum(np.append(0, (n_a, n_b)[k])).tolist()
            for t in np.flatnonzero(good).tolist():
                good[t] = b"".join(al.bytes[k][ids[cuts[t] : cuts[t + 1]]].tolist()) == b" " + texts[t]
            data = b"".join(b" " + t for t, g in zip(texts, good.tolist(), strict=True) if g)
    keep_a, keep_b = good[a_text], good[b_text]
    a, b, a_text, b_text = a[keep_a], b[keep_b], a_text[keep_a], b_text[keep_b]
    a_ends, b_ends = np.cumsum(a_size[keep_a]), np.cumsum(b_size[keep_b])
    order, side, begins = coalesce(a_ends, b_ends)
    ids, own = np.concatenate((a, b))[order], np.concatenate((a_text, b_text))[order]
    # The last token of a side in a group is followed by the other side, or the next group.
    last = np.append(side[1:] != side[:-1], True)[: len(side)]
    words = np.empty(len(ids), object)
    for k in (0, 1):
        for table, at in ((al.within, ~last), (al.ending, last)):
            at = at & (side == k)
            words[at] = table[k][ids[at]]
    words = words.tolist()
    cuts = np.searchsorted(own, np.arange(len(texts) + 1)).tolist()
    groups = np.bincount(own[begins], minlength=len(texts)).tolist()
    if overlap:
        x, y = overlaps(a_ends, b_ends)
        link_text, pair = a_text[x], a[x] << 32 | b[y]
    else:
        # Tokens that end together are the last ones of both sides in a group.
        link_text = own[last & (side == 1)]
        pair = ids[last & (side == 0)] << 32 | ids[last & (side == 1)]
    sort = np.lexsort((pair, link_text))
    pair, link_text = pair[sort], link_text[sort]
    first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (link_text[1:] != link_text[:-1]))[: len(pair)])
    count = np.diff(np.append(first, len(pair)))
    pair, link_text = pair[first], link_text[first]
    at = np.searchsorted(link_text, np.arange(len(texts) + 1)).tolist()
    n_a, n_b = (np.where(good, n, 0).tolist() for n in (n_a, n_b))
    for k in range(len(texts)):
        yield n_a[k], n_b[k], groups[k], "".join(words[cuts[k] : cuts[k + 1]])[:-1], pair[at[k] : at[k + 1]], count[at[k] : at[k + 1]]


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links array<long>, times array<long>"


def align_tokens(docs: DataFrame, a_path: str, b_path: str, parallel: int = 1, overlap: bool = False) -> DataFrame:
    """Align the tokens of two tokenizers over each whole text: a byte-level one of the
    tokenizers library (A, over a space and the text) and a SentencePiece model (B).
    Their files lie at these paths on every executor.

    Returns doc_id, n_a, n_b, n_groups, n_links, ``groups`` (A's ids, ``|``, B's ids, groups
    parted by ``;``), ``links`` (distinct pairs of tokens that end together or, with
    ``overlap``, share a byte, A's id in the upper 32 bits) and ``times`` (how often each
    does). Texts null or empty, and texts of
    which either side's tokens don't spell the space and the text, have no tokens.
    Repeated rows and rows without a doc_id are aligned like others; long texts are
    read whole; extra columns are ignored; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(a_path, b_path, parallel)
        for ids, texts in text_rows(batches, BATCH_BYTES):
            rows: list[tuple] = [(0, 0, 0, "", (), ())] * len(texts)
            said = [k for k, t in enumerate(texts) if t]
            if said:
                for k, row in zip(said, _aligned(al, [texts[k] for k in said], overlap), strict=True):
                    rows[k] = row
            n_a, n_b, n_groups, groups, links, times = zip(*rows, strict=True)
            cuts = pa.array(np.cumsum([0, *map(len, links)]), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([np.asarray(x, np.int64) for x in v]))) for v in (links, times)]
            columns = [pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, [int(np.sum(t)) for t in times])), pa.array(groups, pa.string()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links", "times"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _ALIGNED)


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        distinct, back = np.unique(np.concatenate([pairs, *(p for p, _ in waiting)]), return_inverse=True)
        return distinct, np.bincount(back, np.concatenate([counts, *(c for _, c in waiting)]), len(distinct)).astype(np.int64)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    for batch in batches:
        waiting.append((_flat(batch, "links"), _flat(batch, "times")))
        size += len(waiting[-1][0])
        if size > HELD_PAIRS:
            pairs, counts = added()
            waiting, size = [], 0
            if len(pairs) > HELD_PAIRS:
                yield out()
                pairs, counts = pairs[:0], counts[:0]
    if waiting:
        pairs, counts = added()
    yield out()


def link_counts(aligned: DataFrame) -> DataFrame:
    """pair, n (links of the whole corpus that have it), best (n is the highest among
    the pairs of its B id)."""
    counts = aligned.select("links", "times").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # A B id has as many rows as A has ids, at most.
    own = Window.partitionBy(F.col("pair").bitwiseAND((1 << 32) - 1))
    return counts.withColumn("best", F.col("n") == F.max("n").over(own))


def _with_frequent(hot):
    """Sums over the frequent links of each text, and its other links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = (np.frombuffer(x, t) for x, t in zip(hot.value, ("<i8", "<i8", "?"), strict=True))
        for batch in batches:
            links, times = _flat(batch, "links"), _flat(batch, "times")
            size = np.diff(batch.column("links").offsets.to_numpy()).astype(np.int64)
            own = np.repeat(np.arange(len(size)), size)
            at = np.searchsorted(pairs, links)
            at[at == len(pairs)] = 0
            held = pairs[at] == links if len(pairs) else np.zeros(len(links), bool)
            cut = np.cumsum(np.append(0, size))
            sums = []
            for value in (best, counts):
                total = np.zeros(len(links) + 1, np.int64)
                total[1:][held] = times[held] * value[at[held]]
                sums.append(pa.array(np.diff(np.cumsum(total)[cut])))
            rest = np.bincount(own[~held], minlength=len(size))
            cuts = pa.array(np.cumsum(np.append(0, rest)), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x[~held])) for x in (links, times)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *sums, *lists], names=["key", "n_best", "count_sum", "links", "times"])

    return run


def with_link_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` with n_best (links whose pair is the most frequent of its B id, ties
    included) and count_sum (of the corpus-wide counts of all links) for links and
    times. All other columns stay."""
    rest = [c for c in aligned.columns if c not in ("links", "times")]
    keyed = materialize(aligned.withColumn("key", F.monotonically_increasing_id()), "aligned")
    counts = materialize(link_counts(keyed), "link-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = F.col("n") >= max(1, -(-int(total) // HOT_SHARE))
    # At most HOT_SHARE rows.
    hot = counts.where(frequent).toArrow().sort_by("pair")
    packed = [hot.column(c).to_numpy().astype(t).tobytes() for c, t in (("pair", "<i8"), ("n", "<i8"), ("best", "?"))]
    found = keyed.select("key", "links", "times").mapInArrow(_with_frequent(aligned.sparkSession.sparkContext.broadcast(packed)), "key long, n_best long, count_sum long, links array<long>, times array<long>")
    rare = found.select("key", F.inline(F.arrays_zip("links", "times"))).withColumnRenamed("links", "pair").join(counts.where(~frequent), "pair")
    rare = rare.select("key", (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    sums = found.select("key", "n_best", "count_sum").unionByName(rare)
    sums = sums.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return keyed.select("key", *rest).join(sums, "key").drop("key")


def alignment_report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and the hash of the groups
    (empty for a text without tokens)."""
    aligned = align_tokens(docs, a_path, b_path)
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    counted = with_link_counts(aligned.withColumn("groups_sha256", digest).drop("groups"))
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
