"""From raw documents to token ids: each stage reads what the one before wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import MAX_ID, free_name, own_columns, read_table
from tillroll.llm.decontaminate import find_benchmark
from tillroll.llm.line_dedup import dedup_lines
from tillroll.llm.minhash import near_duplicates
from tillroll.llm.quality import cascade
from tillroll.llm.sentencepiece_codec import append_pieces
from tillroll.session import materialize

#: Near duplicates: shingles of five words, a similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80
#: Band keys of 8 minima, 75 of them: a pair at that similarity shares one with
#: probability 1 - (1 - 0.8**8)**75 = 0.999999.
ROWS, BANDS = 8, 75


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects. Null and empty texts have no words and go as
    too short; repeated rows are judged alike, and long texts whole."""
    return cascade(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go; a document that loses all of its lines goes too. Null and
    empty texts have no lines and stay; repeated rows lose the same lines; long texts
    are read whole."""
    lines, dropped = (F.col(free_name(docs, n)) for n in ("_lines", "_dropped"))
    out = dedup_lines(docs).where((dropped == 0) | (dropped < lines))
    changed = F.when(dropped > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*own_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least doc_id,
    then the least hash of the text. Rows of one doc_id are told apart by their
    text; of rows of one doc_id and text, that of the least hash stays. Of the
    rows without a doc_id in a group one stays too. Null and blank texts are linked
    with nothing; long ones are compared whole."""
    own, none, key, row, left = (free_name(docs, n) for n in ("_own", "_none", "_key", "_row", "_left"))
    ident = [F.coalesce(F.col("doc_id").cast("long"), F.lit(MAX_ID)).alias(own), F.col("doc_id").isNull().alias(none), F.xxhash64("text").alias(key)]
    said = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))

    texts = docs.where(said).select(F.xxhash64("text").alias("doc_id"), "text").groupBy("doc_id").agg(F.first("text").alias("text"))
    found = near_duplicates(materialize(texts, "texts"), PERCENT, SHINGLE, BANDS, ROWS).select(F.col("doc_id").alias(key), "component_id")
    # The least of each text goes before the join, so that copies don't meet in it.
    least = docs.where(said).select(*ident).groupBy(key, none).agg(F.min(own).alias(own))
    kept = least.join(found, key).groupBy("component_id", none).agg(F.min(F.struct(own, key)).alias(row))
    kept = kept.select(F.col(row)[own].alias(own), none, F.col(row)[key].alias(key), F.lit(True).alias(left))

    # Maps have no hash of their own.
    values = [F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c for c, f in zip(own_columns(docs), docs.schema.fields, strict=True)]
    rows = docs.select(*ident, F.struct(*own_columns(docs)).alias(row), F.xxhash64(*values).alias(left))
    rows = rows.groupBy(own, none, key).agg(F.min_by(row, left).alias(row))
    joined = rows.hint("merge").join(kept, [own, none, key], "left").select(f"{row}.*", left)
    return joined.where(F.col(left) | ~said).select(*own_columns(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage. Rows of one doc_id, or of none, are
    told apart by their text. Null and empty texts have none and stay; repeated rows
    stay or go together; long texts are searched whole."""
    found = find_benchmark(docs, read_table(spark, sf_dir, "benchmark"))
    hit = found.where("n_hit > 0").select("doc_id", "text_hash").distinct()
    same = docs["doc_id"].eqNullSafe(hit["doc_id"]) & (F.xxhash64(docs["text"]) == hit["text_hash"])
    return docs.join(hit, same, "left_anti")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns with n_tokens and ids. Null and empty texts have no ids; repeated
    rows and long texts are encoded like others."""
    return append_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("sentencepiece", sentencepiece),
]

#: SQL has no SentencePiece; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
