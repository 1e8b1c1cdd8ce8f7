"""Language identification with bit-sliced Bloom filters of n-grams.

One Bloom filter for each language, all of one size and with the same hash
functions, lies bit-sliced: a slot is a mask of the languages that have its
bit, so that one look-up, the AND of a few masks, returns all languages that
contain an n-gram. A text's n-grams are counted by language, each count is
corrected for the share of n-grams that the language's filter holds by chance,
and the largest decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import _ODD, mix64, text_rows

GRAM = 4
#: Labelled documents for each language, about, that the filters are made from.
SAMPLE = 2_000
SLOT_BITS = 20
HASHES = 3
#: A language has an n-gram that at least two of its documents contain, at a rate
#: not less than this share of the rate in the language that has it most.
SHARE = 0.25

_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_letters: list[np.ndarray] = []


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode())


def letters() -> np.ndarray:
    """Whether each character is a letter, made once in each worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n-gram of ``GRAM`` characters of the texts, in lower case with what
    isn't a letter as a space, and the text of each; those of spaces alone don't count."""
    clean = [f" {t.decode().lower()} " for t in texts]
    b = np.frombuffer("".join(clean).encode("utf-32-le"), "<u4").copy()
    b[~letters()[b]] = 32
    n = max(0, len(b) - GRAM + 1)
    x = np.zeros(n, np.uint64)
    count = np.zeros(n, np.uint8)
    with np.errstate(over="ignore"):
        for k in range(GRAM):
            # Characters have 21 bits; the first three are kept as they are.
            x += b[k : k + n].astype(np.uint64) * (np.uint64(1 << 21 * k) if k < 3 else _ODD[k])
            count += b[k : k + n] != 32
        owner = np.repeat(np.arange(len(clean), dtype=np.int32), [len(c) for c in clean])
        good = (count >= 2) & (owner[:n] == owner[GRAM - 1 :]) if n else np.zeros(0, bool)
        return mix64(x[good] * _ODD[7]), owner[:n][good]


def slots(h: np.ndarray) -> list[np.ndarray]:
    return [((h * _ODD[10 + k]) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for k in range(HASHES)]


class Filters:
    """Masks of languages by slot, in words of 64 languages."""

    def __init__(self, languages: list[str], prior: list[int], masks: np.ndarray):
        self.languages, self.masks = languages, masks
        self.likely = int(np.argmax(prior)) if prior else 0
        fill = [np.mean((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(languages))]
        self.chance = np.array(fill, float) ** HASHES

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        h, owner = grams(texts)
        at = slots(h)
        counts = np.zeros((len(self.languages), len(texts)))
        for word in range(self.masks.shape[1]):
            column = np.ascontiguousarray(self.masks[:, word])
            found = column[at[0]]
            for s in at[1:]:
                found &= column[s]
            for i in range(64 * word, min(64 * word + 64, len(self.languages))):
                counts[i] = np.bincount(owner, (found >> np.uint64(i % 64)) & np.uint64(1), len(texts))
        n = np.bincount(owner, minlength=len(texts))
        chance = self.chance[:, None]
        fair = np.maximum(0, counts - n * chance) / np.maximum(1 - chance, 1e-9)
        total = fair.sum(axis=0) if len(fair) else np.zeros(len(texts))
        out, score = [], []
        for k, t in enumerate(texts):
            if not self.languages or not has_letter(t):
                out.append("und")
                score.append(0.0)
            elif total[k] <= 0:
                out.append(self.languages[self.likely])
                score.append(0.0)
            else:
                best = int(np.argmax(fair[:, k]))
                out.append(self.languages[best])
                score.append(float(fair[best, k] / total[k]))
        return out, score


def _grams_of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in text_rows(batches, 1 << 20):
        h, owner = grams(texts)
        pairs = np.unique(np.stack((owner.astype(np.uint64), h), axis=1), axis=0) if len(h) else np.zeros((0, 2), np.uint64)
        langs = np.array(ids, object)[pairs[:, 0].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(pairs[:, 1].view(np.int64) if len(pairs) else [], pa.int64())], names=["lang", "gram"])


def _slot_masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = np.asarray(batch.column("gram")).view(np.uint64)
        at = np.concatenate(slots(h))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), *(pa.concat_arrays([batch.column(k)] * HASHES) for k in ("word", "mask"))], names=["slot", "word", "mask"]
        )


def train(docs: DataFrame, sample: int = SAMPLE) -> Filters:
    """Filters from rows (text, lang) with both not null; of each language about
    ``sample`` documents, chosen by a hash of the text. Copies of a text count
    as one, so that a group of them can't swell the sample."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.col("text").cast("binary").alias("text"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    spark = docs.sparkSession
    if not languages:
        return Filters([], [], np.zeros((1 << SLOT_BITS, 1), np.uint64))
    info = spark.createDataFrame([(x, i, min(1.0, sample / counts[x])) for i, x in enumerate(languages)], "lang string, place int, part double")
    some = rows.join(F.broadcast(info), "lang").where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.col("part") * (1 << 30))
    some = some.dropDuplicates(["lang", "text"]).select("lang", "text").persist()
    try:
        held = {r.lang: r.n for r in some.groupBy("lang").agg(F.count("*").alias("n")).collect()}
        size = spark.createDataFrame([(x, i, held.get(x, 0)) for i, x in enumerate(languages)], "lang string, place int, n long")
        seen = some.mapInArrow(_grams_of_documents, "lang string, gram long").groupBy("gram", "lang").agg(F.count("*").alias("df"))
        rate = seen.join(F.broadcast(size), "lang").withColumn("rate", F.col("df") / F.col("n"))
        most = rate.groupBy("gram").agg(
            F.max("rate").alias("top"), F.collect_list(F.struct("place", "rate", "df")).alias("all")
        )
        word = most.select("gram", "top", F.explode("all").alias("x")).where(f"x.rate >= {SHARE} * top AND x.df >= least(2, x.df / x.rate)")
        word = word.groupBy("gram", F.floor(F.col("x.place") / 64).cast("long").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, x.place % 64)")).alias("mask")
        )
        table = word.mapInArrow(_slot_masks, "slot long, word long, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
        masks = np.zeros((1 << SLOT_BITS, -(-len(languages) // 64)), np.uint64)
        # At most one row for each slot.
        got = table.toArrow()
        masks[np.asarray(got["slot"]), np.asarray(got["word"])] = np.asarray(got["mask"]).view(np.uint64)
    finally:
        some.unpersist()
    return Filters(languages, [counts[x] for x in languages], masks)


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred, score of each row, from its text alone. A null text, or
    one without a letter, is ``und`` with score 0; a text with letters but no
    known n-gram gets the commonest language with score 0."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_rows(batches, 1 << 20):
            lang, score = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_report(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the documents that aren't
    held out (crc32 of the id as text, modulo 4, is 2 for those that are). A null
    doc_id isn't held out. Rows are judged one by one, repeated ones and long texts
    too; extra columns are ignored. An empty table gives no rows, and one without a
    labelled row has ``und`` for all."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    filters = train(docs.where(~held).select("text", "lang"), sample)
    return identify(docs, filters).select("doc_id", held.alias("held_out"), "lang_pred", "score")
