"""Registered queries of the text operators: ``(spark, sf_dir) -> DataFrame``
over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import decontaminate, quality, secret_scan, source_audit, token_counts
from tillroll.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from tillroll.llm.suffix_dedup import dedup_substrings

    return dedup_substrings(read_table(spark, sf, "documents")).drop("kept")


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(read_table(spark, sf, "documents"))


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    docs = token_counts.redactions(read_table(spark, sf, "documents"))
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op5_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from tillroll.llm.sentencepiece_codec import encode_pieces

    return encode_pieces(read_table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from tillroll.llm.line_dedup import line_report

    return line_report(read_table(spark, sf, "documents"))


def op7_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    from tillroll.llm.html_extract import main_text

    return main_text(read_table(spark, sf, "pages"))


def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    from tillroll.llm.language_id import language_report

    return language_report(read_table(spark, sf, "documents"))


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from tillroll.llm.token_files import token_files

    return token_files(read_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from tillroll.llm.minhash import near_duplicates

    return near_duplicates(read_table(spark, sf, "documents"))


def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from tillroll.llm.alignment import alignment_report

    return alignment_report(read_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.secret_report(read_table(spark, sf, "documents"))


def op13_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return source_audit.source_divergence(read_table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_quality_rules, op3_token_counts, op4_decontaminate, op5_sentencepiece,
        op6_line_dedup, op7_html_extract, op8_language_id, op9_token_files, op10_minhash_dedup,
        op11_token_alignment, op12_secret_scan, op13_source_divergence,
    )
}

#: DuckDB SQL for the same rows, where SQL can express them.
ORACLES: dict[str, str] = {
    "op2_quality_rules": quality.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
    "op12_secret_scan": secret_scan.ORACLE,
    "op13_source_divergence": source_audit.ORACLE,
}
