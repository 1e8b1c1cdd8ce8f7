"""The simplified benchmark pipeline (A13), its grid and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import raw_frame
from tillroll.operators.sampling import sample_rows
from tillroll.plans.benchmark import BENCH_KEYS, bench_lines, bench_sum_by, run_grid


def test_bench_filters_skip_trim_and_dates(spark):
    df = raw_frame(spark, [
        ("C1", "A", "x", 1, "2011-01-01 10:00:00", 1.0, "a", "UK"),
        (" C2", "A", "x", 1, "not a date", 1.0, "a", "UK"),  # no trim: kept
        ("3", "A", "x", 0, "2011-01-01 10:00:00", 1.0, "a", "UK"),
        ("4", "A", "x", 2, "2011-01-01 10:00:00", 1.5, None, "UK"),
        ("5", "A", "x", 2, "2011-01-01 10:00:00", 1.5, "b", "UK"),
        ("5", "A", "x", 2, "2011-01-01 10:00:00", 1.5, "b", "UK"),  # duplicates kept
    ])
    assert sorted(r.InvoiceNo for r in bench_lines(df).collect()) == [" C2", "5", "5"]
    by_date = {r.InvoiceDate: r.s for r in bench_sum_by(df, "InvoiceDate").collect()}
    assert by_date == {"not a date": 1.0, "2011-01-01 10:00:00": 6.0}


def test_bench_sums_agree(raw_small):
    totals = {k: bench_sum_by(raw_small, k).agg(F.sum("s")).first()[0] for k in BENCH_KEYS}
    assert len({round(v, 6) for v in totals.values()}) == 1


def test_grid_shape_and_conf_restored(spark, raw_small):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    grid = run_grid(spark, raw_small, fractions=(0.5, 1.0), shuffle_partitions=(2, 4)).collect()
    assert [(r.fraction, r.shuffle_partitions) for r in grid] == [(0.5, 2), (0.5, 4), (1.0, 2), (1.0, 4)]
    assert all(r.seconds > 0 for r in grid)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_sample_is_seeded_subset(raw_small):
    a = sample_rows(raw_small, 0.25, seed=42)
    b = sample_rows(raw_small, 0.25, seed=42)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    n = a.count()
    assert 0.15 * 6116 < n < 0.35 * 6116
    assert a.exceptAll(raw_small).count() == 0
    assert sample_rows(raw_small, 1.0) is raw_small
