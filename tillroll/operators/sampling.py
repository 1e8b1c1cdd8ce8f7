"""Row sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import free_name, quoted


def _scanned(df: DataFrame) -> bool:
    """Whether the rows come straight from files, so that each is one row of a
    file and a task that is run again reads them in the same order."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName().startswith("Relation") or node.nodeName() == "LogicalRelation"


def row_identity(df: DataFrame) -> list[Column]:
    """What tells a row that was read from a file from all others: the file, and its
    number there or, in formats without one, its split and its place among those read."""
    fields = df.select("_metadata").schema[0].dataType.fieldNames()
    if "row_index" in fields:
        return [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    return [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Sample without replacement: each row is taken or not by itself, equal rows too,
    with the probability ``fraction``, by a hash of its identity and the seed. A task
    that is run again takes the same rows, and so does a second sample of one table.
    Rows that don't come straight from files are told apart by their values and, among
    equal ones, by number. ``fraction >= 1`` returns the input."""
    if fraction >= 1.0:
        return df
    least = F.lit(int(max(0.0, fraction) * 2**64) - 2**63)
    if _scanned(df):
        return df.where(F.xxhash64(*row_identity(df), F.lit(seed)) < least)
    own = [quoted(c) for c in df.columns]
    count, number = (free_name(df.columns, n) for n in ("_count", "_number"))
    # Equal rows are counted before the exchange, so that many of them are no large task.
    rows = df.groupBy(*own).agg(F.count(F.lit(1)).alias(count))
    rows = rows.select(*own, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count))).alias(number))
    return rows.where(F.xxhash64(*own, F.col(number), F.lit(seed)) < least).select(*own)


def sample_by_text(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """A sample that depends on values alone: a row is taken if the MD5 of its text
    columns and the seed lies in the first ``fraction`` of all values, so that the same
    rows are taken wherever they stand, and rows with the same text columns go together.
    ``fraction >= 1`` returns the input."""
    if fraction >= 1.0:
        return df
    key = [c for c, kind in df.dtypes if kind == "string"] or df.columns
    drawn = F.md5(F.concat_ws("|", *[quoted(c).cast("string") for c in key], F.lit(str(seed))).cast("binary"))
    return df.where(F.substring(drawn, 1, 8) < f"{int(fraction * (1 << 32)):08x}")
