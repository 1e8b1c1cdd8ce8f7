"""Scans of the raw and cleaned zones (any Hadoop-compatible URI)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tillroll.functions.columns import quoted
from tillroll.schema import RAW_SCHEMA, REQUIRED_COLUMNS
from tillroll.sources.files import File, header_lines, list_files

# Options of the raw invoice-line CSV.
RAW_CSV_OPTIONS: dict[str, str] = {
    "header": "true",
    "encoding": "ISO-8859-1",
    "nullValue": "NA",
}

SUPPORTED_FORMATS = ("csv", "parquet")


class UnsupportedFormatError(ValueError):
    """Raised for a format other than csv / parquet."""


class MissingColumnsError(ValueError):
    """Raised when required columns are absent from an input, or from the
    files of one header (``file`` is one of them)."""

    def __init__(self, missing: list[str], file: str | None = None):
        super().__init__(f"missing required columns: {missing}" + (f" in {file}" if file else ""))
        self.missing, self.file = missing, file


class DataNotFoundError(FileNotFoundError):
    """Raised when the input path does not exist."""


def _check_format(fmt: str) -> str:
    f = (fmt or "").lower().strip()
    if f not in SUPPORTED_FORMATS:
        raise UnsupportedFormatError(f"unsupported format: {fmt!r}")
    return f


def read_text_csv(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """Raw CSV with every column as text, named by the header.

    Files of one header are one scan. A path whose files have different headers
    is read by header, each group of files in a scan of its own, and the scans
    are put together by column name; a column that a file lacks is NULL in its
    lines."""
    return _together(list(_by_header(spark, path, options).values()))


def _by_header(spark: SparkSession, path: str | list[str], options: dict[str, str]) -> dict[str, DataFrame]:
    """A scan for each header among the files of a path, by the name of a file
    that has it; of the path itself if there is one header."""
    reader = spark.read.options(**{**RAW_CSV_OPTIONS, "enforceSchema": "false", **options})
    groups: dict[bytes, list[File]] = defaultdict(list)
    files = [f for f in list_files(spark, path) if f.size]
    for file, header in zip(files, header_lines(spark, files), strict=True):
        groups[header].append(file)
    if len(groups) < 2:
        return {files[0].name if files else str(path): reader.csv(path)}
    return {own[0].name: reader.csv([f.uri for f in own]) for own in groups.values()}


def _together(scans: list[DataFrame]) -> DataFrame:
    """Scans put together by column name; a column of different types is text."""
    kinds: dict[str, set[str]] = defaultdict(set)
    for df in scans:
        for name, kind in df.dtypes:
            kinds[name].add(kind)
    mixed = {n for n, k in kinds.items() if len(k) > 1}
    if mixed:
        scans = [df.select(*[quoted(c).cast("string").alias(c) if c in mixed else quoted(c) for c in df.columns]) for df in scans]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def typed(df: DataFrame, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """The columns of ``schema`` that ``df`` has, by name and typed value by
    value (a whole number may be written ``6.0``), then all other columns."""
    out = []
    for field in schema.fields:
        if field.name in df.columns:
            c = F.col(field.name)
            if isinstance(field.dataType, LongType):
                c = c.try_cast("double").try_cast("long")
            elif not isinstance(field.dataType, StringType):
                c = c.try_cast(field.dataType)
            out.append(c.alias(field.name))
    return df.select(*out, *[quoted(c) for c in df.columns if c not in schema.fieldNames()])


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    *,
    schema: StructType | None = RAW_SCHEMA,
    infer_schema: bool = False,
) -> DataFrame:
    """Read raw invoice lines.

    CSV: header, ISO-8859-1, literal ``NA`` as NULL. Columns are found by their
    name, in any order and beside others, and typed value by value after
    ``schema`` (type inference costs an extra pass over the whole input); pass
    ``infer_schema=True`` for the inferred types instead.
    """
    f = _check_format(fmt)
    if f == "parquet":
        return spark.read.parquet(*([path] if isinstance(path, str) else path))
    if infer_schema:
        return read_text_csv(spark, path, inferSchema="true")
    df = read_text_csv(spark, path)
    return df if schema is None else typed(df, schema)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Parquet, or a plain header CSV with every column as text."""
    f = _check_format(fmt)
    if f == "parquet":
        return spark.read.parquet(path)
    return spark.read.option("header", "true").csv(path)


def missing_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> list[str]:
    """Required names absent from ``df`` (extra columns are allowed)."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def validate_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> bool:
    return not missing_columns(df, required)


def load_retail(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    *,
    infer_schema: bool = False,
) -> DataFrame:
    """Read raw lines and check the required columns.

    Raises ``DataNotFoundError`` for a missing path and ``MissingColumnsError``
    when a required column is absent, naming the file if only some lack it.
    """
    try:
        if _check_format(fmt) == "csv":
            scans = _by_header(spark, path, {"inferSchema": "true"} if infer_schema else {})
        else:
            scans = {str(path): read_raw(spark, path, fmt)}
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise DataNotFoundError(str(path)) from e
        raise
    for file, df in scans.items():
        missing = missing_columns(df)
        if missing:
            raise MissingColumnsError(missing, file if len(scans) > 1 else None)
    df = _together(list(scans.values()))
    return df if infer_schema or fmt.lower().strip() != "csv" else typed(df)
