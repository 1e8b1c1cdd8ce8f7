"""Byte copies into the raw zone, and folders of files with different headers."""

from __future__ import annotations

import gzip
import hashlib
import json
import os

import pytest

from tillroll.sources import files as fl
from tillroll.sources import readers as rd
from tillroll.sources import sinks as sk

HEADER = b"InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
LINE = b"1,A,x,2,2010-12-01 08:26:00,1.5,17850,UK"
PROBES = {
    "quotes.csv": HEADER + b'\n1,A,"WHITE ""HEART"" MUG",2,2010-12-01 08:26:00,1.5,17850,UK\n',
    "line-break.csv": HEADER + b'\r\n1,A,"two\nlines",2,2010-12-01 08:26:00,1.5,17850,UK\r\n',
    "no-end.csv": HEADER + b"\n" + LINE,
    "latin.csv": HEADER + b"\n1,A,CAF\xc9,2,2010-12-01 08:26:00,1.5,17850,Espa\xf1a\n",
    "mark.csv": b"\xef\xbb\xbf" + HEADER + b"\n\n\n" + LINE + b"\n\n",
    "empty.csv": b"",
    "folder/below.csv": HEADER + b"\n" + LINE + b"\n",
}


def _write(folder, files):
    for name, data in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return str(folder)


def _read(folder):
    found = {}
    for top, _, names in os.walk(folder):
        for n in names:
            if not n.startswith((".", "_")):
                with open(os.path.join(top, n), "rb") as f:
                    found[os.path.relpath(os.path.join(top, n), folder)] = f.read()
    return found


def test_bytes_arrive_as_they_are(spark, tmp_path):
    source, target = _write(tmp_path / "in", PROBES), str(tmp_path / "zone")
    sk.ingest_raw(spark, source, target)
    assert _read(target) == PROBES
    with open(f"{target}/{fl.MANIFEST}") as f:
        said = {r["name"]: (r["bytes"], r["digest"]) for r in map(json.loads, f)}
    want = {n: (len(d), hashlib.sha256(hashlib.sha256(d).hexdigest().encode()).hexdigest()) for n, d in PROBES.items()}
    assert said == want == {r.name: (r.bytes, r.digest) for r in fl.file_digests(spark, target).collect()}
    assert sorted(r.name for r in fl.read_manifest(spark, target).collect()) == sorted(PROBES)
    assert sorted(os.listdir(tmp_path)) == ["in", "zone"]  # nothing is left beside


def test_overwrite_skip_and_single_file(spark, tmp_path):
    one, target = _write(tmp_path / "in", PROBES), str(tmp_path / "zone")
    sk.ingest_raw(spark, f"{one}/no-end.csv", target)
    assert _read(target) == {"no-end.csv": PROBES["no-end.csv"]}
    sk.ingest_raw(spark, one, target, mode="skip")
    assert list(_read(target)) == ["no-end.csv"]
    sk.ingest_raw(spark, f"{one}/l*.csv", target, mode="overwrite")
    assert sorted(_read(target)) == ["latin.csv", "line-break.csv"]
    with pytest.raises(rd.DataNotFoundError):
        sk.ingest_raw(spark, str(tmp_path / "nothing"), target)
    assert sorted(_read(target)) == ["latin.csv", "line-break.csv"]


def test_digest_is_by_block(spark, tmp_path, monkeypatch):
    """The same for a file that one task reads and one that is split."""
    data = bytes(range(256)) * 40
    path = _write(tmp_path / "in", {"a.csv": data})
    # Read in this process, as tasks have the module's own sizes.
    monkeypatch.setattr(fl, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(fl, "_BUFFER", 300)
    parts = [hashlib.sha256(data[k : k + 1000]).hexdigest() for k in range(0, len(data), 1000)]
    uri = f"file:{path}/a.csv"
    for cuts in ([0, len(data)], [*range(0, len(data), 1000), len(data)]):
        tasks = [{"name": "a.csv", "uri": uri, "start": a, "end": z} for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
        rows = [r for b in fl._copied(None)(iter([fl.pa.RecordBatch.from_pylist(tasks)])) for r in b.to_pylist()]
        assert [d for r in rows for d in r["digests"]] == parts
    assert b"".join(fl._blocks(uri, 123, 4567)) == data[123:4567]
    with pytest.raises(OSError, match="ends at byte"):
        list(fl._blocks(uri, 0, len(data) + 1))


def test_headers_of_long_and_packed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fl, "_HEADER", 7)
    packed = gzip.compress(HEADER + b"\n" + LINE)
    folder = _write(tmp_path / "in", {"a.csv": HEADER + b"\r\n" + LINE, "b.csv.gz": packed, "c.csv": b"x", "_SUCCESS": b"", ".a.crc": b"no"})
    files = fl.list_files(spark, folder)
    assert [f.name for f in files] == ["a.csv", "b.csv.gz", "c.csv"] and files[1].size == len(packed)
    assert fl.header_lines(spark, files) == [HEADER, HEADER, b"x"]


def test_folder_of_two_headers(spark, tmp_path):
    other = b"Store,Country,StockCode,InvoiceNo,Description,Quantity,InvoiceDate,UnitPrice,CustomerID\nS1,FR,B,2,y,3,2010-12-01 08:26:00,2.5,9\n"
    folder = _write(tmp_path / "in", {"a.csv": HEADER + b"\n" + LINE + b"\n", "b.csv": other, "c.csv": HEADER + b"\n" + LINE + b"\n", "d.csv": b""})
    rows = sorted((r.InvoiceNo, r.StockCode, r.Quantity, r.UnitPrice, r.Country, r.Store) for r in rd.load_retail(spark, folder).where("Store IS NOT NULL").collect())
    assert rows == [("2", "B", 3, 2.5, "FR", "S1")]
    assert rd.load_retail(spark, folder).count() == rd.read_raw(spark, folder).count() == 3
    assert rd.load_retail(spark, folder).columns == [*HEADER.decode().split(","), "Store"]
    # Types are inferred by header; StockCode is text in one and a number in the other.
    _write(tmp_path / "in", {"e.csv": HEADER + b",More\n3,1001,z,1,2010-12-01 08:26:00,1.5,7,UK,m\n"})
    inferred = rd.load_retail(spark, folder, infer_schema=True)
    assert dict(inferred.dtypes)["StockCode"] == "string" and inferred.count() == 4


def test_file_without_a_required_column_is_named(spark, tmp_path):
    folder = _write(tmp_path / "in", {"a.csv": HEADER + b"\n" + LINE, "b.csv": b"InvoiceNo,StockCode\n1,A\n"})
    with pytest.raises(rd.MissingColumnsError, match="b.csv") as err:
        rd.load_retail(spark, folder)
    assert err.value.file == "b.csv" and "Country" in err.value.missing
