"""Writers: raw-zone ingest, cleaned Parquet, result tables, bounded exports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.session import _filesystem
from tillroll.sources.files import copy_files, footer_rows, list_files, read_small, write_small
from tillroll.sources.readers import RAW_CSV_OPTIONS, DataNotFoundError, _check_format

# CSV output keeps leading/trailing blanks (Spark trims them by default on write).
_CSV_WRITE_OPTIONS: dict[str, str] = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# Ingest modes: overwrite the target, or leave an existing target untouched.
INGEST_MODES = ("overwrite", "skip")


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write raw lines in the raw-zone CSV layout (header in every part)."""
    (
        df.write.mode(mode)
        .options(**_CSV_WRITE_OPTIONS)
        .option("encoding", RAW_CSV_OPTIONS["encoding"])
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def ingest_raw(
    spark: SparkSession, source: str, target: str, *, mode: str = "overwrite"
) -> None:
    """Land raw files (a file or a folder) in the raw zone, byte by byte.

    ``mode="overwrite"`` replaces the target; ``mode="skip"`` leaves an
    existing target as it is. The bytes are copied by a distributed job
    (``sources.files.copy_files``) that leaves a manifest with the size and a
    digest of each file.
    """
    m = mode.lower().strip()
    if m not in INGEST_MODES:
        raise ValueError(f"unsupported ingest mode: {mode!r}")
    try:
        copy_files(spark, source, target, replace=m == "overwrite")
    except FileNotFoundError as e:
        raise DataNotFoundError(source) from e


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The cleaned zone."""
    df.write.mode(mode).parquet(path)


#: File of a result that says how many rows were written, and in which files.
ROWS = "_ROWS"


def write_result(
    df: DataFrame, path: str, mode: str = "overwrite", *, fmt: str = "csv"
) -> int:
    """A result table as multi-part CSV (UTF-8, header) or Parquet. Returns the
    rows written.

    The rows are counted as they are written, in the last stage, in which a task that
    runs again counts once; for Parquet the files' footers must say the same. The count
    and the files are kept beside the data (``written_rows``).
    """
    f = _check_format(fmt)
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if f == "parquet":
        counted.write.mode(mode).parquet(path)
    else:
        counted.write.mode(mode).options(**_CSV_WRITE_OPTIONS).option("encoding", "UTF-8").csv(path)
    rows = int(written.get.get("rows", 0))
    spark, note = df.sparkSession, f"{path.rstrip('/')}/{ROWS}"
    if mode not in ("overwrite", "error", "errorifexists"):
        # There may be files of before, which the count doesn't have.
        fs, old = _filesystem(spark, note)
        fs.delete(old, False)
        return rows
    files = list_files(spark, path)
    if f == "parquet" and footer_rows(spark, files) != rows:
        raise OSError(f"{path}: the files' footers don't have the {rows} rows that were written")
    said = {"rows": rows, "files": [[x.name, x.size] for x in files]}
    write_small(spark, note, json.dumps(said).encode())
    return rows


def written_rows(spark: SparkSession, path: str) -> tuple[int, bool] | None:
    """The rows of a result as counted when it was written, and whether its files are
    those of then; None if the result has no such note."""
    data = read_small(spark, f"{path.rstrip('/')}/{ROWS}")
    if data is None:
        return None
    said = json.loads(data)
    return said["rows"], said["files"] == [[x.name, x.size] for x in list_files(spark, path)]


def export_single_csv(df: DataFrame, path: str) -> int:
    """One CSV file (UTF-8, header) at ``path``.

    For results that are small by their nature (a row for each day, month or
    country): one task writes the file. Spark's part file is renamed to
    ``path`` and its temporary folder removed. Returns the row count.
    """
    n = df.count()
    staging = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    df.coalesce(1).write.mode("overwrite").options(**_CSV_WRITE_OPTIONS).option(
        "encoding", "UTF-8"
    ).csv(staging)
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_dir = jvm.org.apache.hadoop.fs.Path(staging)
    fs = src_dir.getFileSystem(conf)
    parts = [s.getPath() for s in fs.listStatus(src_dir) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {staging}, found {len(parts)}")
    target = jvm.org.apache.hadoop.fs.Path(path)
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(parts[0], target):
        raise RuntimeError(f"could not move the export to {path}")
    fs.delete(src_dir, True)
    return n
