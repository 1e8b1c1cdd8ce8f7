"""Files as bytes: listing, header lines, and a distributed copy.

The copy moves bytes and reads no values, so that quoting, line breaks in fields,
encodings and a missing last line end arrive as they are. Tasks stream the bytes
through the file system of either path, write below a temporary name and rename
what is complete; the whole target appears under its own name at the end.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import _filesystem

#: Bytes of which a digest is taken, and that a task of a split file copies.
BLOCK_BYTES = 128 << 20
#: Bytes in memory at a time.
_BUFFER = 8 << 20
#: Bytes of a header line that are read at first.
_HEADER = 1 << 16
#: Files written next to the data; readers pass over names that begin like this.
MANIFEST = "_MANIFEST"


@dataclass(frozen=True)
class File:
    """A file below a path: its place there, its address, and its size."""

    name: str
    uri: str
    size: int


def list_files(spark: SparkSession, path: str | list[str]) -> list[File]:
    """The files of a path, folder or pattern, with all folders below, ordered by
    name. Names that begin with ``_`` or ``.`` are no data."""
    found: list[File] = []
    for one in [path] if isinstance(path, str) else path:
        fs, hadoop_path = _filesystem(spark, one)
        for top in fs.globStatus(hadoop_path) or []:
            if top.isFile():
                found.append(File(top.getPath().getName(), top.getPath().toString(), top.getLen()))
                continue
            base = top.getPath().toString().rstrip("/") + "/"
            every = fs.listFiles(top.getPath(), True)
            while every.hasNext():
                status = every.next()
                uri = status.getPath().toString()
                name = uri.removeprefix(base)
                if not any(part[:1] in ("_", ".") for part in name.split("/")):
                    found.append(File(name, uri, status.getLen()))
    return sorted(found, key=lambda f: f.name)


def header_lines(spark: SparkSession, files: list[File], threads: int = 16) -> list[bytes]:
    """The first line of each file, unpacked if its name says that it is packed. As
    with a listing, the driver asks the file system; no more than the line is read."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(file: File) -> bytes:
        fs, path = _filesystem(spark, file.uri)
        stream = fs.open(path)
        codec = codecs.getCodec(path)
        stream = codec.createInputStream(stream) if codec is not None else stream
        try:
            line = b""
            while b"\n" not in line:
                more = bytes(stream.readNBytes(_HEADER))
                if not more:
                    break
                line += more
            return line.split(b"\n")[0].rstrip(b"\r")
        finally:
            stream.close()

    with ThreadPool(min(threads, max(1, len(files)))) as pool:
        return pool.map(first, files)


def read_small(spark: SparkSession, uri: str) -> bytes | None:
    """The bytes of a small file, or None if there is none."""
    fs, path = _filesystem(spark, uri)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def write_small(spark: SparkSession, uri: str, data: bytes) -> None:
    """Put a small file in the place of any that is there."""
    fs, path = _filesystem(spark, uri)
    stream = fs.create(path, True)
    stream.write(data)
    stream.close()


def footer_rows(spark: SparkSession, files: list[File], threads: int = 16) -> int:
    """Rows of Parquet files, as their footers say; no data is read."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def rows(file: File) -> int:
        path = jvm.org.apache.hadoop.fs.Path(file.uri)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
        try:
            return reader.getRecordCount()
        finally:
            reader.close()

    with ThreadPool(min(threads, max(1, len(files)))) as pool:
        return sum(pool.map(rows, files))


# ------------------------------------------------------------------ byte copy


def _opened(uri: str):
    """The Arrow file system of an address, and the path in its terms."""
    from pyarrow import fs

    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _blocks(uri: str, start: int, end: int) -> Iterator[bytes]:
    """The bytes of a file from ``start`` to before ``end``, some at a time."""
    system, path = _opened(uri)
    with system.open_input_file(path) as f:
        f.seek(start)
        while start < end:
            data = f.read(min(_BUFFER, end - start))
            if not data:
                raise OSError(f"{uri} ends at byte {start}; {end} were listed")
            start += len(data)
            yield data


def _tasks(spark: SparkSession, files: list[File], whole: bool) -> DataFrame:
    """A row for each block of the files, or for each file: name, uri, start, end, dealt out
    over tasks."""
    rows = []
    for f in files:
        step = max(1, f.size) if whole else BLOCK_BYTES
        rows += [(f.name, f.uri, a, min(a + step, f.size)) for a in range(0, max(1, f.size), step)]
    schema = "name string, uri string, start long, end long"
    return spark.createDataFrame(rows, schema).repartition(max(1, min(len(rows), 10_000)), "name", "start")


_DIGESTS = "name string, start long, end long, digests array<string>"


def _copied(target: str | None):
    """For mapInArrow over tasks: digests of their blocks; with a target, a copy of their
    bytes below it, under the file's name or, where a file is split, that and the block's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, uri, start, end in ((r["name"], r["uri"], r["start"], r["end"]) for b in batches for r in b.to_pylist()):
            digests, sha, held = [], hashlib.sha256(), 0
            out = None
            if target:
                system, path = _opened(f"{target}/{name}")
                part = f"{path}.{start:020d}.part"
                own = f"{part}.{uuid.uuid4().hex}"
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                out = system.open_output_stream(own)
            for data in _blocks(uri, start, end):
                if out:
                    out.write(data)
                while data:
                    take = data[: BLOCK_BYTES - held]
                    sha.update(take)
                    data, held = data[len(take) :], held + len(take)
                    if held == BLOCK_BYTES:
                        digests.append(sha.hexdigest())
                        sha, held = hashlib.sha256(), 0
            if held or not digests:
                digests.append(sha.hexdigest())
            if out:
                out.close()
                # Another attempt of this task has the same bytes.
                system.move(own, part)
            yield pa.RecordBatch.from_pylist([{"name": name, "start": start, "end": end, "digests": digests}])

    return run


def _by_file(blocks: DataFrame) -> DataFrame:
    """(name, bytes, digest): a file's digest is that of the digests of its blocks of
    ``BLOCK_BYTES``, whichever tasks took them."""
    ordered = F.array_sort(F.collect_list(F.struct("start", "digests")))
    files = blocks.groupBy("name").agg(F.max("end").alias("bytes"), ordered.alias("parts"))
    return files.select("name", "bytes", F.sha2(F.array_join(F.flatten(F.col("parts.digests")), ""), 256).alias("digest"))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(name, bytes, digest) of the files below a path, from one read of all bytes."""
    return _by_file(_tasks(spark, list_files(spark, path), False).mapInArrow(_copied(None), _DIGESTS))


def copy_files(spark: SparkSession, source: str, target: str, *, replace: bool = True) -> bool:
    """Copy the files of ``source``, a file or a folder with all below, to the folder
    ``target``, byte by byte, and write ``_MANIFEST`` there, a JSON line with name, bytes and
    digest for each file.

    An existing target is replaced once all files are there, or left as it is without
    ``replace``. Returns whether files were copied. Where the target's file system can put
    files together, tasks copy blocks of ``BLOCK_BYTES``; elsewhere a task copies a file. A
    lost task is done again: what it left stands under a name of its own."""
    fs, final = _filesystem(spark, target.rstrip("/"))
    if not replace and fs.exists(final):
        return False
    files = list_files(spark, source)
    if not files:
        raise FileNotFoundError(source)
    final = fs.makeQualified(final)
    staging = f"{final.toString()}.ingest-{uuid.uuid4().hex}"
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(jpath(staging))
    try:
        joins = fs.hasPathCapability(jpath(staging), "fs.capability.paths.concat")
        blocks = _tasks(spark, files, not joins).mapInArrow(_copied(staging), _DIGESTS)
        # One row for each file, as in the listing.
        rows = sorted(_by_file(blocks).collect(), key=lambda r: r.name)
        for f, r in zip(files, rows, strict=True):
            if (f.name, f.size) != (r.name, r.bytes):
                raise OSError(f"{f.uri}: {r.bytes} of {f.size} bytes were copied")
            _put_together(spark, fs, f"{staging}/{f.name}", range(0, max(1, f.size), BLOCK_BYTES if joins else max(1, f.size)))
        write_small(spark, f"{staging}/{MANIFEST}", "".join(json.dumps(r.asDict()) + "\n" for r in rows).encode())
        fs.delete(final, True)
        if not fs.rename(jpath(staging), final):
            raise OSError(f"could not move {staging} to {target}")
    finally:
        fs.delete(jpath(staging), True)
    return True


def _put_together(spark: SparkSession, fs, uri: str, starts: range) -> None:
    """The parts of a file as the file: no bytes are moved."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    first, *more = (jpath(f"{uri}.{a:020d}.part") for a in starts)
    if more:
        array = spark.sparkContext._gateway.new_array(jpath, len(more))
        for k, p in enumerate(more):
            array[k] = p
        fs.concat(first, array)
    if not fs.rename(first, jpath(uri)):
        raise OSError(f"could not move {first.toString()}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(name, bytes, digest) that a copy left in its target: a row for each file."""
    text = read_small(spark, f"{path.rstrip('/')}/{MANIFEST}")
    if text is None:
        raise FileNotFoundError(f"{path}/{MANIFEST}")
    rows = [json.loads(line) for line in text.decode().splitlines()]
    return spark.createDataFrame([(r["name"], r["bytes"], r["digest"]) for r in rows], "name string, bytes long, digest string")
