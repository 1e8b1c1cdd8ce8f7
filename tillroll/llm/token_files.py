"""Token ids in files of byte-aligned variable-length integers.

Ids are replaced by their rank in frequency order, so that common tokens have
small numbers, and written as in a stream of control and data bytes: two control
bits for each number say how many bytes it takes (one to four), four numbers to
a control byte, and the data bytes follow by themselves. A reader needs no
branches: tables give the lengths and the sum of lengths of all 256 control
bytes, and numpy gathers the bytes.

Format of a block (little-endian): magic ``TID2``; number of documents n, of
ids m and of documents without a doc_id, which come first (three unsigned 64-bit
integers); n signed 64-bit doc_ids (0 where there is none); n numbers of ids
(unsigned 32-bit); the control bytes, (m + 3) // 4; the data bytes. The table of
the ids in rank order stands in a file of its own.

Blocks are written in ascending order of doc_id as binary values of Parquet
part files, which any store that Spark writes to can hold.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import BYTE_VALUES, gap_table, shuffle_partitions, text_rows
from tillroll.llm.units import UnitEncoder, encode_joined, encode_letters, threads
from tillroll.session import ensure_checkpoint_dir, materialize, scratch_path

MAGIC = b"TID2"
#: Id that ends each document.
END = 1
#: Ids in a block, about.
BLOCK_IDS = 1 << 20
#: Bytes of coded documents that one file is made for.
FILE_BYTES = 16 << 20
#: Text that a worker encodes at a time, and files whose sizes are added up together.
BATCH_BYTES = 2 << 20
FILE_GROUP = 4096

#: Lengths of the four numbers of each control byte, and their sums.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
SUMS = LENGTHS.sum(axis=1)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit numbers."""
    r = ranks.astype("<u4")
    size = 1 + (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    codes = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    codes[: len(r)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    used = np.arange(4) < size[:, None]
    return control.tobytes(), r.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` numbers of control and data bytes."""
    size = LENGTHS[control].ravel()[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4) < size[:, None]] = data
    return out.view("<u4").ravel()


def write_block(ids: list[int | None], counts: np.ndarray, ranks: np.ndarray) -> bytes:
    """A block of documents, those without an id first."""
    control, data = pack(ranks)
    head = MAGIC + struct.pack("<QQQ", len(ids), len(ranks), ids.count(None))
    docs = np.array([0 if i is None else i for i in ids], "<i8")
    return b"".join((head, docs.tobytes(), counts.astype("<u4").tobytes(), control, data))


def read_block(block: bytes, table: np.ndarray) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """doc_ids, how many of the first are null, numbers of ids, and ids of a block."""
    if block[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n, m, nulls = struct.unpack_from("<QQQ", block, 4)
    docs = np.frombuffer(block, "<i8", n, 28)
    counts = np.frombuffer(block, "<u4", n, 28 + 8 * n)
    at = 28 + 12 * n
    control = np.frombuffer(block, np.uint8, (m + 3) // 4, at)
    data = np.frombuffer(block, np.uint8, int(SUMS[control].sum()) - int(-m % 4), at + len(control))
    return docs, nulls, counts, table[unpack(control, data, m)]


# ------------------------------------------------------------------ encoding

_encoders: dict = {}
_GAP = gap_table(b" \t\n\x0b\x0c\r")
_LOWER = BYTE_VALUES.copy()
_LOWER[65:91] = _LOWER[97:123]
_STOPS = (".", ",")


def _body(unit: str) -> str | None:
    """The unit without a comma or full stop that ends it, where that is a word
    of its own: after a letter, which stays one in lower case."""
    if unit.endswith(_STOPS) and unit[-2:-1].isalpha() and unit[-2].lower().isalpha():
        return unit[:-1]
    return None


def _encoder(path: str, parallel: int):
    """A function that gives the unit encoder without or with regard to case, each
    made when it is first needed, and the tokenizer."""
    if path not in _encoders:
        from tokenizers import Tokenizer

        threads(parallel)
        tokenizer = Tokenizer.from_file(path)
        ends = np.zeros(tokenizer.get_vocab_size(), bool)
        ends[[i for t, i in tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        stop = {s: np.array(tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes() for s in _STOPS}

        def encode(new: list[bytes]) -> list[bytes]:
            texts = [u.decode() for u in new]
            bodies = [_body(t) for t in texts]
            apart = {b or t for t, b in zip(texts, bodies, strict=True)}
            letters = [t for t in apart if t.isalpha()]
            others = [t for t in apart if not t.isalpha()]
            coded = dict(zip(letters, encode_letters(tokenizer, ends, letters), strict=True))
            coded.update(zip(others, encode_joined(tokenizer, others, " "), strict=True))
            return [coded[b] + stop[t[-1]] if b else coded[t] for t, b in zip(texts, bodies, strict=True)]

        _encoders[path] = (cache(lambda case: UnitEncoder(encode)), tokenizer)
    return _encoders[path]


def encode_words(tokenizer_path: str, parallel: int = 1, end: int = END):
    """For mapInArrow over (doc_id, text): doc_id, number of ids, and ids as
    little-endian 16-bit integers where all fit, or else 32-bit ones.

    The tokenizer must drop white space and lower the case, as its file says; a
    token then never reaches across white space, and words are encoded once in
    a worker. A text that has the start of a special token keeps its case.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, tokenizer = _encoder(tokenizer_path, parallel)
        wide = "<u4" if tokenizer.get_vocab_size() > 1 << 16 else "<u2"
        stop = np.array([end], wide).tobytes()
        for ids, texts in text_rows(batches, BATCH_BYTES):
            coded: list[bytes] = [b""] * len(texts)
            # Where a special token may stand, letters keep their case.
            special = [b"<|" in t for t in texts]
            for case, values in ((False, _LOWER), (True, BYTE_VALUES)):
                own = [k for k, s in enumerate(special) if s is case]
                if own:
                    flat, n = units(case).batch([texts[k] for k in own], _GAP, values)
                    flat, cuts = flat.astype(wide), np.cumsum(np.append(0, n)).tolist()
                    for k, a, z in zip(own, cuts[:-1], cuts[1:], strict=True):
                        coded[k] = flat[a:z].tobytes() + stop
            n = [len(x) // len(stop) for x in coded]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(coded, pa.binary())], names=["doc_id", "n", "ids"])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for n, x in zip(batch.column("n").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            c = np.bincount(np.frombuffer(x, f"<u{len(x) // n}"), minlength=len(total))
            c[: len(total)] += total
            total = c
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, parallel: int = 1, end: int = END) -> None:
    """Encode each whole text, append ``end``, and write the ids below ``path``
    in ascending order of doc_id: ``ranks`` holds the ids by rank, ``ids`` the
    blocks. A null or empty text has the end id alone; a long one is encoded whole.
    Rows with one doc_id stand side by side in a fixed order; rows with a null
    doc_id come first. An empty table gives no blocks. Extra columns are ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    coded = materialize(rows.mapInArrow(encode_words(tokenizer_path, parallel, end), "doc_id long, n long, ids binary"), "token-ids")
    spark = docs.sparkSession
    counts = coded.mapInArrow(_counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # One row for each id of the vocabulary.
    by_rank = np.array([r.id for r in sorted(counts.collect(), key=lambda r: (-r.n, r.id))], np.int64)
    spark.createDataFrame([(by_rank.astype("<u4").tobytes(),)], "ids binary").coalesce(1).write.parquet(f"{path}/ranks")
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, number = None, 0
        ids: list[int | None] = []
        parts: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            data = write_block(ids, np.array([len(p) for p in parts]), np.concatenate(parts))
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int64()), pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([data], pa.binary())],
                names=["file", "block", "n", "data"],
            )

        for batch in batches:
            for d, n, x in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "n", "ids")), strict=True):
                if file is None:
                    from pyspark import TaskContext

                    file = TaskContext.get().partitionId()
                ids.append(d)
                parts.append(rank[np.frombuffer(x, f"<u{len(x) // n}")])
                size += n
                if size >= BLOCK_IDS:
                    yield block()
                    number, ids, parts, size = number + 1, [], [], 0
        if ids:
            yield block()

    total = coded.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    files = max(shuffle_partitions(spark), -(-total // FILE_BYTES))
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"))
    ordered = coded.repartitionByRange(files, *order).sortWithinPartitions(*order, "ids")
    ordered.mapInArrow(blocks, "file long, block long, n long, data binary").write.option("compression", "none").parquet(f"{path}/ids")


def read_token_files(spark, path: str, keep_ids: bool = False) -> DataFrame:
    """Documents of the files below ``path``: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers) and, if ``keep_ids``, ``ids``."""
    table = np.frombuffer(spark.read.parquet(f"{path}/ranks").first()[0], "<u4")
    blocks = spark.read.parquet(f"{path}/ids")
    # Sizes are added up within files, within groups of files, and over the groups.
    sizes = blocks.select("file", "block", "n", F.expr(f"file div {FILE_GROUP}").alias("group"))
    by_file = sizes.groupBy("group", "file").agg(F.sum("n").alias("n"))
    by_group = by_file.groupBy("group").agg(F.sum("n").alias("n"))

    def upto(key: str, *within: str) -> Column:
        return F.sum("n").over(Window.partitionBy(*within).orderBy(key)) - F.col("n")

    groups = by_group.select("group", upto("group").alias("before_group"))
    files = by_file.select("group", "file", upto("file", "group").alias("before_file"))
    before = sizes.select("group", "file", "block", upto("block", "group", "file").alias("before_block")).join(files, ["group", "file"]).join(groups, "group")
    before = before.select("file", "block", (F.col("before_group") + F.col("before_file") + F.col("before_block")).alias("before"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f, b, data in zip(*(batch.column(k).to_pylist() for k in ("file", "block", "data")), strict=True):
                docs, nulls, counts, ids = read_block(data, table)
                cuts = np.cumsum(np.append(0, counts.astype(np.int64)))
                raw = memoryview(ids.astype("<u4").tobytes())
                n = len(docs)
                columns = [
                    pa.array(np.full(n, f)), pa.array(np.full(n, b)), pa.array(docs, mask=np.arange(n) < nulls), pa.array(cuts[:-1]), pa.array(counts.astype(np.int64)),
                    pa.array([zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], pa.int64()),
                ]
                names = ["file", "block", "doc_id", "at", "n_tokens", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "file long, block long, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    docs = blocks.select("file", "block", "data").mapInArrow(documents, schema).join(before, ["file", "block"])
    return docs.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))


def token_files(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the files to a fresh scratch folder and read them back."""
    ensure_checkpoint_dir(docs.sparkSession)
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_path)
    return read_token_files(docs.sparkSession, path)
