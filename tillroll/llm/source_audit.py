"""How the sources of a language differ in their words, by recounting with minimal
perfect hashes.

A first pass counts exactly in how many documents of its language each term
stands; terms of fewer than ``min_docs`` go. For those kept, minimal perfect hashes
are built, one for each shard of a language's terms: a term's hash picks a bit in a
cascade of bit arrays, in which terms that meet move on to the next array, and the
number of bits set before it is the term's slot. Each shard stores its terms in the
order of their slots, as other terms fall into slots too.

The second pass adds up, in each task, dense arrays of slots for each group of
language and source. The hashes go to all tasks while they are under
``BROADCAST_BYTES`` together; beyond, the pre-aggregated counts go to the shards
instead. The slots are summed by Spark, and each shard then holds its slots of all
sources of its language against one another.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import BYTE_VALUES, gap_table, hashed_words, mix64
from tillroll.session import materialize

MIN_DOCS = 3
#: Ranks of terms that are reported.
TOP = 200
SCALE = 1_000_000_000
#: Terms of a shard, about.
SHARD_TERMS = 8192
#: Bytes of all shards that are sent to every task.
BROADCAST_BYTES = 48 << 20
#: Languages, and groups of language and source, that are sent to every task.
BROADCAST_ROWS = 100_000
#: Terms of a language that a task of the first pass holds, and bytes of dense slots in
#: the second.
HELD_TERMS, HELD_BYTES = 400_000, 64 << 20
#: Groups of shards in which the best terms are chosen first.
SHARD_GROUPS = 8
#: Sources that are held against all at a time.
_SOURCES = 64

#: Bytes that stand between terms, of a text in lower case.
_GAP = gap_table(bytes(c for c in range(128) if not 97 <= c <= 122))
#: Text that is split at a time.
BATCH_BYTES = 4 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def terms(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Terms of UTF-8 texts: ASCII letters, in lower case, and what isn't ASCII. Returns
    the distinct ones, the number of each that stands in the texts, one after the
    other, and the terms of each text."""
    buffer, start, end, h, words_of = hashed_words([t.lower() for t in texts], _GAP, BYTE_VALUES)
    _, first, number = np.unique(h, return_index=True, return_inverse=True)
    # Hashes find equal words; their bytes tell whether they are.
    size, data = end - start, buffer.tobytes()
    unlike = np.flatnonzero(size != size[first[number]])
    if not len(unlike) and len(start):
        upto = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(upto, size)
        same = buffer[at + np.repeat(start, size)] == buffer[at + np.repeat(start[first[number]], size)]
        unlike = np.flatnonzero(~np.logical_and.reduceat(same, upto))
    words = [data[a:z] for a, z in zip(start[first].tolist(), end[first].tolist(), strict=True)]
    if len(unlike):
        place: dict[bytes, int] = {}
        every = [place.setdefault(data[a:z], len(place)) for a, z in zip(start.tolist(), end.tolist(), strict=True)]
        words, number = list(place), np.array(every, np.int64)
    return words, number, words_of


def hashes(words: list[bytes]) -> np.ndarray:
    """Values of Spark's ``xxhash64`` of the words, as unsigned numbers."""
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words))


# ------------------------------------------------------------- perfect hashes


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit numbers."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.cumsum(bits, dtype=np.int64) - 1
        self.base = np.cumsum([0, *sizes]).tolist()

    @staticmethod
    def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix64(h + np.uint64(level + 1) * _STEP) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(h):
            size = max(8, 2 * len(h))
            at = cls._place(h, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            h = h[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slots of numbers; of others any slot, or -1."""
        out, rest = np.full(len(h), -1, np.int64), np.arange(len(h))
        for level, size in enumerate(self.sizes):
            at = self.base[level] + self._place(h[rest], level, size)
            hit = self.bits[at]
            out[rest[hit]] = self.rank[at[hit]]
            rest = rest[~hit]
            if not len(rest):
                break
        return out


class Shard:
    """A perfect hash with its keys, in the order of their slots. Keys whose 64-bit
    hashes are equal to that of another come after these, by themselves."""

    def __init__(self, sizes: list[int], bits: bytes, keys: bytes, lengths: bytes):
        self.hash = PerfectHash(sizes, np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes)).astype(bool))
        self.lengths = np.frombuffer(lengths, "<u4").astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data, self.keys = keys, np.frombuffer(keys, np.uint8)
        held = len(self.hash.rank) and int(self.hash.rank[-1]) + 1
        self.more = {self.key(k): k for k in range(held, len(self.lengths))}

    def __len__(self) -> int:
        return len(self.lengths)

    def key(self, slot: int) -> bytes:
        return self.data[self.starts[slot] : self.starts[slot] + self.lengths[slot]]

    @staticmethod
    def build(words: list[bytes]) -> tuple[list[int], bytes, bytes, bytes]:
        h = hashes(words)
        _, first = np.unique(h, return_index=True)
        perfect = PerfectHash.build(h[first])
        order = np.append(first[np.argsort(perfect.slots(h[first]))], np.setdiff1d(np.arange(len(h)), first)).astype(np.int64)
        keys = [words[k] for k in order.tolist()]
        return perfect.sizes, np.packbits(perfect.bits).tobytes(), b"".join(keys), np.array([len(k) for k in keys], "<u4").tobytes()

    def slots(self, words: list[bytes], h: np.ndarray) -> np.ndarray:
        """Slots of words, -1 for those that aren't keys."""
        out = self.hash.slots(h)
        n = np.array([len(w) for w in words], np.int64)
        out[(out >= 0) & (self.lengths[out] != n)] = -1
        at = np.flatnonzero(out >= 0)
        if len(at):
            size = n[at]
            upto = np.cumsum(size) - size
            own = self.keys[np.repeat(self.starts[out[at]] - upto, size) + np.arange(int(size.sum()))]
            same = own == np.frombuffer(b"".join([words[k] for k in at.tolist()]), np.uint8)
            out[at[~np.logical_and.reduceat(same, upto)]] = -1
        if self.more:
            for k, w in enumerate(words):
                out[k] = self.more.get(w, out[k])
        return out


class Language:
    """All shards of a language, with slots numbered through."""

    def __init__(self, shards: list[Shard]):
        self.shards = shards
        self.first = np.cumsum([0, *(len(s) for s in shards)])

    def slots(self, words: list[bytes]) -> np.ndarray:
        h = hashes(words)
        own = h.view(np.int64) % len(self.shards)
        order = np.argsort(own, kind="stable")
        cuts = np.searchsorted(own[order], np.arange(len(self.shards) + 1)).tolist()
        out = np.full(len(words), -1, np.int64)
        for k, shard in enumerate(self.shards):
            at = order[cuts[k] : cuts[k + 1]]
            if len(at) and len(shard):
                found = shard.slots([words[i] for i in at.tolist()], h[at])
                out[at] = np.where(found < 0, -1, found + self.first[k])
        return out


# ---------------------------------------------------------------------- passes


#: A slot's number has its shard above these bits.
SLOT_BITS = 32


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[int], list[bytes]]]:
    """Of (grp, lang, text) rows, some of one language at a time: the language, the numbers
    of their groups (of language and source), in order, and the texts."""
    held: dict[str, list[tuple[int, bytes]]] = defaultdict(list)
    size = 0

    def out() -> Iterator[tuple[str, list[int], list[bytes]]]:
        for lang, rows in held.items():
            rows.sort(key=lambda r: r[0])
            yield lang, [g for g, _ in rows], [t for _, t in rows]
        held.clear()

    for b in batches:
        for group, lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if size and size + len(text) > BATCH_BYTES:
                yield from out()
                size = 0
            held[lang].append((group, text))
            size += len(text) + 1
    yield from out()


def _by_group(groups: list[int], words_of: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each group of ordered ones, and where its texts' words are."""
    g = np.array(groups, np.int64)
    first = np.flatnonzero(np.append(True, g[1:] != g[:-1])[: len(g)])
    cuts = np.append(0, np.cumsum(words_of))
    for a, z in zip(first.tolist(), [*first[1:].tolist(), len(g)], strict=True):
        yield groups[a], slice(int(cuts[a]), int(cuts[z]))


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): rows with the term."""
    held: dict[str, Counter] = defaultdict(Counter)

    def out(lang: str, counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.repeat(lang, len(counts)), pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["lang", "term", "n"])

    for lang, _, texts in _texts(batches):
        words, number, words_of = terms(texts)
        once = np.unique(np.repeat(np.arange(len(texts)), words_of) * max(1, len(words)) + number)
        n = np.bincount(once % max(1, len(words)), minlength=len(words))
        held[lang].update(dict(zip(words, n.tolist(), strict=True)))
        if len(held[lang]) > HELD_TERMS:
            yield out(lang, held.pop(lang))
    for lang, counts in held.items():
        yield out(lang, counts)


def _built(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    lang, shard, shards = (k.as_py() for k in key)
    sizes, *packed = Shard.build([w for w in table.column("term").to_pylist() if w is not None])
    columns = [pa.array([lang]), pa.array([shard], pa.int64()), pa.array([shards], pa.int64()), pa.array([sizes], pa.list_(pa.int64())), *(pa.array([x], pa.binary()) for x in packed)]
    return pa.Table.from_arrays(columns, names=["lang", "shard", "shards", "sizes", "bits", "keys", "lengths"])


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A table of counted rows goes to all tasks if these are few, so that joins by
    language don't gather the rows of one."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def perfect_hashes(kept: DataFrame, langs: DataFrame) -> DataFrame:
    """Shards of (lang, term) rows, at least one for each of ``langs``."""
    shards = kept.groupBy("lang").agg(F.ceil(F.count("*") / SHARD_TERMS).alias("shards"))
    # The first shard of a language is there even without a term.
    every = langs.join(shards, "lang", "left").select("lang", F.coalesce("shards", F.lit(1)).alias("shards"))
    every = materialize(every, "languages")
    rows = kept.join(_small(every, every.count()), "lang").select("lang", F.pmod(F.xxhash64("term"), "shards").alias("shard"), "shards", "term")
    first = every.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), "shards", F.lit(None).cast("binary").alias("term"))
    schema = "lang string, shard long, shards long, sizes array<long>, bits binary, keys binary, lengths binary"
    return rows.unionByName(first).groupBy("lang", "shard", "shards").applyInArrow(_built, schema)


def _recount(packed):
    """Second pass with the shards at hand: (grp, place, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, list] = defaultdict(list)
        for lang, _, *parts in sorted(packed.value, key=lambda r: r[:2]):
            rows[lang].append(Shard(*parts))
        langs = {lang: Language(shards) for lang, shards in rows.items()}
        dense: dict[tuple[str, int], np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, group), slots in dense.items():
                at = np.flatnonzero(slots)
                first = langs[lang].first
                shard = np.searchsorted(first, at, "right") - 1
                place = shard << SLOT_BITS | at - first[shard]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), group, np.int64)), pa.array(place), pa.array(slots[at])], names=["grp", "place", "n"])
            dense.clear()

        for lang, groups, texts in _texts(batches):
            words, number, words_of = terms(texts)
            slot = langs[lang].slots(words)[number]
            for group, own in _by_group(groups, words_of):
                if (lang, group) not in dense:
                    dense[lang, group] = np.zeros(int(langs[lang].first[-1]), np.int64)
                at = slot[own]
                np.add.at(dense[lang, group], at[at >= 0], 1)
            if sum(x.nbytes for x in dense.values()) > HELD_BYTES:
                yield from out()
        yield from out()

    return run


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, lang, term, n) of some documents of a task."""
    for lang, groups, texts in _texts(batches):
        words, number, words_of = terms(texts)
        for group, own in _by_group(groups, words_of):
            found, n = np.unique(number[own], return_counts=True)
            columns = [pa.array(np.full(len(found), group, np.int64)), pa.repeat(lang, len(found)), pa.array([words[k] for k in found.tolist()], pa.binary()), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["grp", "lang", "term", "n"])


def _at_shard(left: pa.Table, right: pa.Table) -> pa.Table:
    """Slots of the terms that came to a shard."""
    row = right.to_pylist()[0]
    words = left.column("term").to_pylist()
    shard = Shard(row["sizes"], row["bits"], row["keys"], row["lengths"])
    at = shard.slots(words, hashes(words)) if words and len(shard) else np.full(len(words), -1, np.int64)
    table = left.select(["grp"]).append_column("place", pa.array(row["shard"] << SLOT_BITS | at)).append_column("n", left.column("n"))
    return table.filter(pa.array(at >= 0))


def recount(rows: DataFrame, perfect: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Occurrences (grp, place, n) of the shards' terms in (grp, lang, text) rows."""
    schema = "grp long, place long, n long"
    size = perfect.agg(F.sum(F.length("bits") + F.length("keys") + F.length("lengths") + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        packed = rows.sparkSession.sparkContext.broadcast([(r.lang, r.shard, r.sizes, bytes(r.bits), bytes(r.keys), bytes(r.lengths)) for r in perfect.collect()])
        found = rows.mapInArrow(_recount(packed), schema)
    else:
        # The sum goes before the grouping by shard, so that a shard gets each term of a source once.
        counts = rows.mapInArrow(_term_counts, "grp long, lang string, term binary, n long").groupBy("grp", "lang", "term").agg(F.sum("n").alias("n"))
        number = perfect.select(F.col("lang"), F.col("shards").alias("of")).distinct()
        counts = counts.join(_small(number, number.count()), "lang").select("grp", "lang", "term", "n", F.pmod(F.xxhash64("term"), "of").alias("shard"))
        found = counts.groupBy("lang", "shard").cogroup(perfect.groupBy("lang", "shard")).applyInArrow(_at_shard, schema)
    return found.groupBy("grp", "place").agg(F.sum("n").alias("n"))


# ----------------------------------------------------------------- divergence


def share(count: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + kept)), exactly."""
    whole, rest = np.divmod(count + 1, total + kept)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, total + kept)
        whole = whole * 1000 + step
    return whole + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _compared(top: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = right.to_pylist()[0]
        lang, kept, sources, totals = row["lang"], row["kept"], row["sources"], row["totals"]
        shard = Shard(row["sizes"], row["bits"], row["keys"], row["lengths"])
        number = {s: k for k, s in enumerate(sources)}
        counts = np.zeros((len(sources), len(shard)), np.int64)
        counts[[number[s] for s in left.column("source").to_pylist()], left.column("slot").to_numpy()] = left.column("n").to_numpy()
        out: list[tuple[str, str, str, int]] = []
        p = np.array([share(c, n, kept) for c, n in zip(counts, totals, strict=True)]).reshape(counts.shape) if kept else counts
        if len(shard):
            q = share(counts.sum(axis=0), sum(totals), kept)
            order = np.zeros(len(shard), np.int64)
            order[sorted(range(len(shard)), key=shard.key)] = np.arange(len(shard))
            for k, source in enumerate(sources):
                at = np.flatnonzero((counts[k] > 0) & (p[k] > q))
                f = divergence(p[k][at], q[at])
                for i in np.lexsort((order[at], -f))[:top].tolist():
                    out.append((source, "term", shard.key(int(at[i])).decode(), int(f[i])))
        for k, source in enumerate(sources):
            for lo in range(0, len(sources), _SOURCES):
                sums = divergence(p[k], p[lo : lo + _SOURCES]).sum(axis=1) if len(shard) else np.zeros(len(sources[lo : lo + _SOURCES]), np.int64)
                out += [(source, "pair", other, int(v)) for other, v in zip(sources[lo : lo + _SOURCES], sums, strict=True) if other != source]
        columns = [pa.repeat(lang, len(out)), pa.array([row["shard"]] * len(out), pa.int64()), *(pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.string(), pa.int64())))]
        return pa.Table.from_arrays(columns, names=["lang", "shard", "source", "part", "item", "value"])

    return run


def _groups(pairs: DataFrame) -> tuple[DataFrame, Column]:
    """Distinct (lang, source) rows with a number each, ``grp``, and the number's
    expression: the first of the hashes of both that tells all of them apart."""
    pairs = materialize(pairs, "groups")
    n, seed = pairs.count(), 0
    while pairs.select(F.xxhash64("lang", "source", F.lit(seed))).distinct().count() < n:
        seed += 1
    number = F.xxhash64("lang", "source", F.lit(seed))
    return pairs.withColumn("grp", number), number


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """How each source of a language differs from the other ones (part ``pair``: the
    item is the other source) and by which terms from the language (part ``term``).

    Returns lang, source, part, item, value, rank. Each row is a document, repeated rows
    and those of one doc_id too. A null lang, source or text is empty, and an empty
    lang or source is one like others; a group without terms has shares as any other. Ties
    are ordered by the item. Long texts are read whole; extra columns are ignored; an
    empty table gives no rows."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    groups, number = _groups(docs.select(*text[:2]).distinct())
    rows = docs.select(*text).select(number.alias("grp"), "lang", F.col("text").cast("binary").alias("text"))
    found = rows.mapInArrow(_document_counts, "lang string, term binary, n long")
    kept = materialize(found.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term"), "kept-terms")
    perfect = materialize(perfect_hashes(kept, groups.select("lang").distinct()), "perfect-hashes")
    counts = materialize(recount(rows, perfect, broadcast_bytes), "slots")
    sizes = groups.count()
    totals = groups.join(counts.groupBy("grp").agg(F.sum("n").alias("n")), "grp", "left")
    lists = totals.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n")))).alias("g"))
    lists = lists.join(kept.groupBy("lang").agg(F.count("*").alias("kept")), "lang", "left")
    lists = lists.select("lang", F.coalesce("kept", F.lit(0)).alias("kept"), F.col("g.source").alias("sources"), F.col("g.n").alias("totals"))
    shards = perfect.drop("shards").join(_small(lists, sizes), "lang")
    slots = counts.join(_small(groups, sizes), "grp").select(
        "lang", "source", F.shiftright("place", SLOT_BITS).alias("shard"), F.col("place").bitwiseAND((1 << SLOT_BITS) - 1).alias("slot"), "n"
    )
    out = slots.groupBy("lang", "shard").cogroup(shards.groupBy("lang", "shard")).applyInArrow(_compared(top), "lang string, shard long, source string, part string, item string, value long")
    out = materialize(out, "compared")
    pairs = out.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    # A term stands in one shard. The best of some shards are chosen before those of all.
    best = out.where("part = 'term'").withColumn("some", F.col("shard") % SHARD_GROUPS)
    best = _ranked(best, "lang", "source", "part", "some").where(F.col("rank") <= top)
    best = _ranked(best, "lang", "source", "part").where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return _ranked(pairs, "lang", "source", "part").select(columns).unionByName(best.select(columns))


def _ranked(df: DataFrame, *by: str) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("value"), F.asc("item"))))


#: The same rows in DuckDB SQL.
ORACLE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT d) >= {MIN_DOCS}),
groups AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM groups) g LEFT JOIN kept k USING (lang) GROUP BY ALL),
found AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
counts AS (SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN found f USING (lang, source, term)),
own AS (SELECT *, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p FROM counts JOIN sizes USING (lang)),
whole AS (
  SELECT *, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang) + v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL) JOIN sizes USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
single AS (
  SELECT o.lang, o.source, o.term AS item, (o.p - w.q) * (o.p - w.q) // w.q AS value
  FROM own o JOIN whole w USING (lang, term) WHERE o.n > 0 AND o.p > w.q),
every AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM single)
SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM every QUALIFY part = 'pair' OR rank <= {TOP}
"""
