"""Readers, writers, ingest modes, exports, the pipeline and its manifest."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import raw_frame
from tillroll.plans.registry import RESULT_NAMES, Paths, run_all, run_pipeline, verify_outputs
from tillroll.sources import readers as rd
from tillroll.sources import sinks as sk

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def _write_text(path, text, encoding="ISO-8859-1"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return str(path)


def test_csv_null_markers_and_latin1(spark, tmp_path):
    body = (
        '1,A,NA,1,2010-12-01 08:26:00,1.5,17850,UK\n'
        '2,A,,1,2010-12-01 08:26:00,1.5,17850,UK\n'
        '3,A,"",1,2010-12-01 08:26:00,1.5,17850,UK\n'
        '4,A,CAFÉ MUG,1,2010-12-01 08:26:00,1.5,17850,España\n'
    )
    p = _write_text(tmp_path / "raw.csv", HEADER + body)
    rows = {r.InvoiceNo: r for r in rd.read_raw(spark, p).collect()}
    assert rows["1"].Description is None
    assert rows["2"].Description is None
    assert rows["3"].Description == ""
    assert rows["4"].Description == "CAFÉ MUG" and rows["4"].Country == "España"


def test_inferred_schema_option(spark, tmp_path):
    p = _write_text(tmp_path / "raw.csv", HEADER + "1,A,x,2,2010-12-01 08:26:00,1.5,17850,UK\n")
    df = rd.read_raw(spark, p, infer_schema=True)
    types = dict(df.dtypes)
    assert types["Quantity"] == "int" and types["UnitPrice"] == "double"


def test_missing_column_and_path_and_format(spark, tmp_path):
    p = _write_text(tmp_path / "bad.csv", "InvoiceNo,StockCode\n1,A\n")
    with pytest.raises(rd.MissingColumnsError) as err:
        rd.load_retail(spark, p)
    assert "Country" in err.value.missing
    with pytest.raises(rd.DataNotFoundError):
        rd.load_retail(spark, str(tmp_path / "nope.csv"))
    with pytest.raises(rd.UnsupportedFormatError):
        rd.read_raw(spark, p, "json")
    with pytest.raises(rd.UnsupportedFormatError):
        sk.write_result(spark.range(1), str(tmp_path / "x"), fmt="xlsx")


def test_validate_columns_allows_extra(spark):
    df = raw_frame(spark, []).withColumn("extra", F.lit(1))
    assert rd.validate_columns(df)
    assert rd.missing_columns(df.drop("Country")) == ["Country"]


def test_ingest_overwrite_and_skip(spark, raw_small, tmp_path):
    src1 = str(tmp_path / "src1")
    src2 = str(tmp_path / "src2")
    sk.write_raw_csv(raw_small, src1)
    sk.write_raw_csv(raw_small.limit(10), src2)
    target = str(tmp_path / "zone")
    sk.ingest_raw(spark, src1, target, mode="overwrite")
    sk.ingest_raw(spark, src2, target, mode="skip")
    assert rd.read_raw(spark, target).count() == 6116
    sk.ingest_raw(spark, src2, target, mode="overwrite")
    assert rd.read_raw(spark, target).count() == 10
    with pytest.raises(ValueError):
        sk.ingest_raw(spark, src2, target, mode="append-ish")


def test_raw_csv_roundtrip_keeps_blanks(spark, raw_small, tmp_path):
    path = str(tmp_path / "raw")
    sk.write_raw_csv(raw_small, path)
    back = rd.read_raw(spark, path)
    assert back.exceptAll(raw_small).count() == 0 and raw_small.exceptAll(back).count() == 0
    assert back.filter(F.col("Description") == "  ").count() > 0


def test_export_single_csv_bound(spark, clean_small, tmp_path):
    from tillroll.operators.sales import country_sales

    out = str(tmp_path / "country_sales.csv")
    assert sk.export_single_csv(country_sales(clean_small), out) == 25
    assert os.path.isfile(out)
    visible = sorted(f for f in os.listdir(tmp_path) if not f.startswith("."))  # local .crc files
    assert visible == ["country_sales.csv"]  # staging folder removed
    with open(out, encoding="utf-8") as f:
        lines = f.read().splitlines()
    assert lines[0] == "Country,OrderCount,SalesAmount,CustomerCount" and len(lines) == 26
    assert sk.export_single_csv(country_sales(clean_small), out) == 25  # overwrite


def test_run_all_and_manifest(spark, clean_small, tmp_path):
    root = str(tmp_path / "results")
    manifest = {r.name: (r.row_count, r.ok) for r in run_all(spark, clean_small, root).collect()}
    assert list(manifest) == list(RESULT_NAMES)
    assert all(ok for _, ok in manifest.values())
    assert manifest["daily_sales"][0] == 987
    assert manifest["top20_products"][0] == 20
    assert manifest["user_behavior_summary"][0] == 7
    partial = str(tmp_path / "partial")
    run_all(spark, clean_small, partial, names=["hourly_orders"])
    got = {r.name: r.ok for r in verify_outputs(spark, partial).collect()}
    assert got["hourly_orders"] and not got["daily_sales"]


def test_run_pipeline_from_raw_zone(spark, raw_small, tmp_path):
    paths = Paths(raw=str(tmp_path / "raw"), cleaned=str(tmp_path / "clean"), results=str(tmp_path / "res"))
    sk.write_raw_csv(raw_small, paths.raw)
    manifest = run_pipeline(spark, paths, result_fmt="parquet").collect()
    assert len(manifest) == 12 and all(r.ok for r in manifest)
    assert spark.read.parquet(paths.cleaned).count() == 4923
    assert spark.read.parquet(paths.result("country_sales")).count() == 25


def test_result_csv_keeps_trailing_spaces(spark, tmp_path):
    df = spark.createDataFrame([("PAPER CRAFT  LITTLE BIRDIE ", 1)], "d string, n int")
    out = str(tmp_path / "r")
    sk.write_result(df, out)
    back = spark.read.option("header", "true").schema(df.schema).csv(out).first()
    assert back.d == "PAPER CRAFT  LITTLE BIRDIE "


def test_settings_from_conf(spark):
    from tillroll.config import Settings

    spark.conf.set("spark.tillroll.min_support", "0.05")
    spark.conf.set("spark.tillroll.concurrent_jobs", "two")  # invalid: default kept
    spark.conf.set("spark.tillroll.exact_quantiles", "false")
    try:
        s = Settings.from_conf(spark)
        assert s.min_support == 0.05 and s.concurrent_jobs == 4 and s.exact_quantiles is False
        assert s.min_confidence == 0.2 and s.result_format == "csv"
    finally:
        for k in ("min_support", "concurrent_jobs", "exact_quantiles"):
            spark.conf.unset(f"spark.tillroll.{k}")


def test_run_all_honours_settings(spark, clean_small, tmp_path):
    from tillroll.config import Settings

    root = str(tmp_path / "res")
    settings = Settings(min_support=0.02, min_confidence=0.3, result_format="parquet",
                        concurrent_jobs=1, exact_quantiles=False, rollup=False,
                        fpgrowth_partitions=3)
    run_all(spark, clean_small, root, names=["association_rules", "user_behavior_summary"],
            settings=settings)
    rules = spark.read.parquet(f"{root}/association_rules")
    assert rules.filter((F.col("support") < 0.02) | (F.col("confidence") < 0.3)).count() == 0
    assert spark.read.parquet(f"{root}/user_behavior_summary").count() == 7


def test_run_all_exports_bounded_results_once(spark, clean_small, tmp_path):
    from tillroll.plans.registry import BOUNDED_RESULTS

    root, export = str(tmp_path / "res"), str(tmp_path / "export")
    run_all(spark, clean_small, root, export_root=export)
    exported = sorted(f for f in os.listdir(export) if not f.startswith("."))
    assert exported == sorted(f"{n}.csv" for n in BOUNDED_RESULTS)
    assert all(os.path.isfile(os.path.join(export, f)) for f in exported)
    daily = spark.read.option("header", "true").csv(os.path.join(export, "daily_sales.csv"))
    assert daily.count() == 987


def test_run_all_removes_its_intermediate_tables(spark, clean_small, tmp_path):
    from tillroll.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tillroll-scratch"
    base = os.path.join(base, spark.sparkContext.applicationId)

    def intermediates():
        if not os.path.isdir(base):
            return set()
        return set(os.listdir(base))

    before = intermediates()
    manifest = run_all(spark, clean_small, str(tmp_path / "res"), fmt="parquet").collect()
    assert all(r.ok for r in manifest)
    assert intermediates() == before


def test_result_append_mode_and_parquet_table(spark, tmp_path):
    out = str(tmp_path / "r")
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    sk.write_result(df, out, fmt="parquet")
    sk.write_result(df, out, mode="append", fmt="parquet")
    assert rd.read_table(spark, out, "parquet").count() == 2
    sk.write_result(df, out, mode="overwrite", fmt="parquet")
    assert rd.read_table(spark, out, "parquet").count() == 1


def test_run_pipeline_ingests_source_and_writes_waterfall(spark, raw_small, tmp_path):
    src = str(tmp_path / "landing")
    sk.write_raw_csv(raw_small, src)
    paths = Paths(raw=str(tmp_path / "raw"), cleaned=str(tmp_path / "clean"), results=str(tmp_path / "res"))
    manifest = run_pipeline(spark, paths, result_fmt="parquet", source=src, waterfall=True).collect()
    assert all(r.ok for r in manifest)
    assert rd.read_raw(spark, paths.raw).count() == 6116
    wf = spark.read.parquet(paths.result("quality_waterfall")).orderBy("step").collect()
    assert [r.rows for r in wf] == [6116, 5680, 5467, 5385, 5063, 4923, 4923]


def _write(path, text):
    path.write_text(text, encoding="latin-1")
    return str(path)


STORE_HEADER = "Store,StockCode,InvoiceNo,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
ROW = "S1,1001,A1,Thing,{q},2011-01-03 10:00:00,1.5,77,UK"


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = _write(tmp_path / "raw.csv", "\n".join([STORE_HEADER, ROW.format(q="6.0"), ROW.format(q="many")]))
    rows = rd.load_retail(spark, path).collect()
    assert [(r.InvoiceNo, r.StockCode, r.Quantity, r.UnitPrice, r.CustomerID, r.Country, r.Store) for r in rows] == [
        ("A1", "1001", 6, 1.5, "77", "UK", "S1"),
        ("A1", "1001", None, 1.5, "77", "UK", "S1"),
    ]


def test_ingest_keeps_columns_and_values(spark, tmp_path):
    path = _write(tmp_path / "raw.csv", "\n".join([STORE_HEADER, ROW.format(q="6.0"), ROW.format(q="many"), ROW.format(q=" NA ")]))
    sk.ingest_raw(spark, path, str(tmp_path / "zone"))
    out = spark.read.option("header", "true").csv(str(tmp_path / "zone"))
    assert out.columns == STORE_HEADER.split(",")
    assert sorted(r.Quantity for r in out.collect()) == [" NA ", "6.0", "many"]


def test_missing_column_is_named(spark, tmp_path):
    path = _write(tmp_path / "raw.csv", "InvoiceNo,StockCode\nA1,1")
    with pytest.raises(rd.MissingColumnsError, match="Quantity"):
        rd.load_retail(spark, path)


def test_extra_columns_take_part_in_cleaning(spark, tmp_path):
    from tillroll.operators.clean import clean, quality_waterfall

    other = ROW.format(q="2").replace("S1", "S2")
    path = _write(tmp_path / "raw.csv", "\n".join([STORE_HEADER, ROW.format(q="2"), ROW.format(q="2"), other]))
    raw = rd.load_retail(spark, path)
    assert sorted(r.Store for r in clean(raw).collect()) == ["S1", "S2"]
    assert {r.stage: r.rows for r in quality_waterfall(raw).collect()}["final"] == 2


def test_money_is_exact_for_small_and_large_lines(spark):
    from tillroll.functions.columns import money_sum

    small = spark.range(1000).selectExpr("4e-5D AS TotalAmount")
    large = spark.range(1).selectExpr("1e15D AS TotalAmount")
    assert small.agg(money_sum("TotalAmount")).first()[0] == 0.04
    assert large.agg(money_sum("TotalAmount")).first()[0] == 1e15


def test_shared_folder_is_asked_for_off_local_mode(monkeypatch):
    from tillroll import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
