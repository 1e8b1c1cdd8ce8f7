"""Helpers shared by the text operators: tables, sizing and byte hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir

#: Odd 64-bit multipliers of the mixing functions, from a fixed seed.
_ODD = np.random.default_rng(20240229).integers(1, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

MAX_ID = np.iinfo(np.int64).max


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of a table, whatever their names are."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it the table's only
    column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame) -> DataFrame:
    """The table with plain names for its columns, which Python functions over
    batches need: they take columns by place."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks_for(df: DataFrame, column: str, block_bytes: int) -> int:
    """Number of blocks of about ``block_bytes`` that hold the column, at
    least one for each shuffle partition. One aggregate over all rows."""
    total = df.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0] or 0
    return max(shuffle_partitions(df.sparkSession), -(-int(total) // block_bytes))


def mix64(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (xor-shift and multiply, in place)."""
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(31)
        x *= _ODD[0]
        x ^= x >> np.uint64(29)
        x *= _ODD[1]
        x ^= x >> np.uint64(32)
    return x


def words64(b: np.ndarray) -> np.ndarray:
    """The 8-byte little-endian word that starts at each byte of ``b``."""
    x = b.astype(np.uint64)
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        x = x[:-step] | (x[step:] << np.uint64(bits))
    return x


#: A value for each byte in hashes of words.
BYTE_VALUES = np.random.default_rng(7).integers(0, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
#: Bytes of text that are hashed at a time, and for which powers are kept.
HASH_BYTES = 1 << 18
_powers: list[np.ndarray] = []


def gap_table(gaps: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(gaps)] = True
    return out


def _powers_for(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse; a longer word has its own."""
    if size <= HASH_BYTES and _powers:
        return _powers
    found = [np.cumprod(np.full(max(size, HASH_BYTES), b, np.uint64)) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    if size <= HASH_BYTES:
        _powers[:] = found
    return found


def hashed_words(texts: list[bytes], gap: np.ndarray, values: np.ndarray):
    """Words of texts: what stands between bytes of ``gap`` (a table that has
    the space). Returns the joined text, first byte and end of each word, its
    hash (of the ``values`` of its bytes), and the words of each text."""
    buffer = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    edge = np.diff(np.append(True, gap[buffer]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    h = np.empty(len(start), np.uint64)
    # A hash doesn't depend on where its word stands, so some words at a time take their
    # powers from 0 on, and the workspace is that of one piece.
    at = 0
    while at < len(start):
        lo = int(start[at])
        upto = max(at + 1, int(np.searchsorted(end, lo + HASH_BYTES, "right")))
        a, z = start[at:upto] - lo, end[at:upto] - lo
        size = int(z[-1])
        up, down = _powers_for(size)
        with np.errstate(over="ignore"):
            total = np.zeros(size + 1, np.uint64)
            np.cumsum(values[buffer[lo : lo + size]] * up[:size], out=total[1:])
            h[at:upto] = (total[z] - total[a]) * down[a] + (z - a).astype(np.uint64) * _ODD[60]
        at = upto
    ends = np.cumsum([len(t) + 1 for t in texts])
    return buffer, start, end, mix64(h), np.diff(np.searchsorted(start, np.append(0, ends)))


def text_hash(text: bytes) -> int:
    """The value of Spark's ``xxhash64`` of a text, which tells rows of one doc_id
    and different texts apart."""
    x = xxhash.xxh64_intdigest(text, 42)
    return x - (1 << 64) if x >> 63 else x


def text_rows(batches: Iterator[pa.RecordBatch], max_bytes: int = 4 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """Rows of (id, text) batches as lists of ids and of UTF-8 bytes, cut to
    about ``max_bytes`` of text each (one longer text stands alone).
    A null text is empty."""
    ids: list = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            t = t or b""
            if texts and size + len(t) > max_bytes:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
    if texts:
        yield ids, texts
