"""Customer profiles, sketches by day, and counts taken while results are written."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tillroll.operators import customers as cu
from tillroll.operators import sketches as sk
from tillroll.operators.profiles import customer_profile, is_profile
from tillroll.operators.rollup import invoice_rollup
from tillroll.plans.registry import run_all, verify_outputs
from tillroll.sources import sinks

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FOUR = (cu.customer_frequency, cu.rfm_segments, cu.first_purchase_distribution, cu.repurchase_summary)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_profile_gives_the_results_of_the_lines(spark, clean_small, tmp_path):
    path = str(tmp_path / "customers")
    customer_profile(invoice_rollup(clean_small)).write.parquet(path)
    profile = spark.read.parquet(path)
    assert is_profile(profile) and not is_profile(clean_small) and customer_profile(profile) is profile
    assert profile.count() == clean_small.select("CustomerID").distinct().count()
    for fn in FOUR:
        assert _rows(fn(profile)) == _rows(fn(clean_small))
    assert _rows(cu.user_behavior_summary(clean_small, customers=profile)) == _rows(cu.user_behavior_summary(clean_small))
    # A user's column of the name makes no profile.
    assert not is_profile(clean_small.withColumn("Lines", F.lit(1)))


def test_nothing_is_dealt_out_by_customer_again(spark, clean_small, tmp_path):
    path = str(tmp_path / "customers")
    customer_profile(clean_small).write.parquet(path)
    profile = spark.read.parquet(path)
    for fn in FOUR:
        plan = fn(profile)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(CustomerID" not in plan


def test_frequency_of_a_customer_in_two_countries_and_days(spark):
    rows = [("1", "c", "2011-01-01 10:00:00", 1.0), ("1", "c", "2011-01-02 10:00:00", 2.0), ("2", "c", "2011-01-11 09:00:00", 6.0), ("3", "d", "2011-01-11 09:00:00", 4.0)]
    df = spark.createDataFrame(rows, "InvoiceNo string, CustomerID string, t string, TotalAmount double").withColumn("InvoiceDateTime", F.col("t").cast("timestamp_ntz"))
    assert [tuple(r) for r in cu.customer_frequency(df).collect()] == [("c", 2, 9.0, 3.0), ("d", 1, 4.0, 4.0)]
    assert cu.repurchase_gap_lines(df).first().value == 5.0


def test_day_sketches_are_within_their_error(spark, clean_small):
    days = sk.day_sketches(clean_small)
    values = sorted(r.order_value for r in cu.order_values(clean_small).collect())
    assert days.agg(F.sum("invoices")).first()[0] == len(values)
    found = {r.metric: r.value for r in cu.order_value_quantiles_sketched(days).collect()}
    for p, name in zip(cu.QUANTILE_PROBS, cu.QUANTILE_METRICS, strict=True):
        below = sum(v < found[name] for v in values)
        upto = sum(v <= found[name] for v in values)
        assert below - 0.01 * len(values) <= p * len(values) <= upto + 0.01 * len(values)


def test_new_day_is_a_new_row(spark, clean_small, tmp_path):
    """The sketches of days written one after the other give the quantiles of all."""
    path = str(tmp_path / "sketches")
    first, later = (clean_small.where(F.col("InvoiceDateTime") < "1995-01-01"), clean_small.where(F.col("InvoiceDateTime") >= "1995-01-01"))
    for part in (first, later):
        sk.day_sketches(part).write.mode("append").parquet(path)
    days = spark.read.parquet(path)
    assert days.count() == days.select("day").distinct().count()
    n = cu.order_values(clean_small).count()
    assert days.agg(F.sum(F.kll_sketch_get_n_double("sketch"))).first()[0] == n
    p50 = cu.order_value_quantiles_sketched(days).where("metric = 'order_value_p50'").first().value
    below = cu.order_values(clean_small).where(F.col("order_value") <= p50).count()
    assert abs(below - n / 2) <= 0.01 * n
    assert [r.value for r in cu.order_value_quantiles_sketched(days.limit(0)).collect()] == [None] * 3


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_counts_are_those_of_the_write(spark, clean_small, tmp_path, monkeypatch, fmt):
    from tillroll.plans import registry

    root = str(tmp_path / "res")
    names = ["daily_sales", "customer_frequency", "association_rules"]
    run_all(spark, clean_small, root, names=names, fmt=fmt)
    monkeypatch.setattr(registry, "read_table", lambda *_: pytest.fail("an output was read"))
    got = {r.name: (r.row_count, r.ok, r.non_empty) for r in verify_outputs(spark, root, names, fmt=fmt).collect()}
    customers = clean_small.select("CustomerID").distinct().count()
    assert got == {"daily_sales": (987, True, True), "customer_frequency": (customers, True, True), "association_rules": (0, True, False)}
    # A file that was taken away shows.
    part = next(p for p in sorted(os.listdir(f"{root}/daily_sales")) if p.startswith("part-"))
    os.remove(f"{root}/daily_sales/{part}")
    assert not verify_outputs(spark, root, ["daily_sales"], fmt=fmt).first().ok


def test_appended_results_are_counted_anew(spark, tmp_path):
    path = str(tmp_path / "r")
    df = spark.range(5)
    assert sinks.write_result(df, f"{path}/daily_sales", fmt="parquet") == 5
    assert sinks.write_result(df, f"{path}/daily_sales", mode="append", fmt="parquet") == 5
    assert sinks.written_rows(spark, f"{path}/daily_sales") is None
    assert verify_outputs(spark, path, ["daily_sales"], fmt="parquet").first().row_count == 10


LOST = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from tillroll.sources import sinks

spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def failing(batches):
    context = TaskContext.get()
    for k, b in enumerate(batches):
        yield b
        if k == 1 and context.attemptNumber() == 0 and context.partitionId() % 2 == 0:
            raise RuntimeError("lost")

spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
df = spark.range(0, 4000, 1, 4).mapInArrow(failing, "id long")
for fmt in ("parquet", "csv"):
    path = f"{sys.argv[1]}/{fmt}"
    n = sinks.write_result(df, path, fmt=fmt)
    read = spark.read.format(fmt).option("header", "true").load(path).count()
    assert n == read == 4000 and sinks.written_rows(spark, path) == (4000, True), (fmt, n, read)
print("all rows")
"""


def test_lost_tasks_count_once(tmp_path):
    out = subprocess.run([sys.executable, "-c", LOST, str(tmp_path)], cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=300)
    assert "all rows" in out.stdout, out.stderr[-2000:]
