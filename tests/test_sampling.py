"""Row samples by identity, and the repartition of heavy customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.operators import clean as cl
from tillroll.operators.sampling import sample_by_text, sample_rows


def _equal_rows(spark, n):
    return spark.range(n).select(F.lit("same").alias("t"), F.lit(1).alias("a.b"))


def test_equal_rows_are_drawn_by_themselves(spark, tmp_path):
    n = 20_000
    for kind in ("parquet", "csv"):
        path = str(tmp_path / kind)
        _equal_rows(spark, n).repartition(3).write.format(kind).option("header", True).save(path)
        df = spark.read.format(kind).option("header", True).load(path)
        for scan in (df, df.where("t = 'same'").select("t")):
            drawn = sample_rows(scan, 0.3, seed=7)
            assert drawn.columns == scan.columns
            count = drawn.count()
            # Five standard deviations.
            assert abs(count - 0.3 * n) < 5 * (0.21 * n) ** 0.5
            assert drawn.count() == count
        assert sample_rows(df, 0.3, seed=8).count() != sample_rows(df, 0.3, seed=7).count()
        assert sample_rows(df, 1.0).count() == n and sample_rows(df, 0.0).count() == 0


def test_rows_of_a_shuffle_go_by_value_and_number(spark, tmp_path):
    from tillroll.operators import sampling

    path = str(tmp_path / "t")
    _equal_rows(spark, 1000).write.parquet(path)
    df = spark.read.parquet(path)
    joined = df.join(spark.range(5), F.lit(True))
    assert sampling._scanned(df.where("t = 'same'")) and not sampling._scanned(joined) and not sampling._scanned(df.groupBy("t").count())
    drawn = sample_rows(joined, 0.5)
    rows = sorted(map(tuple, drawn.collect()))
    assert drawn.columns == joined.columns and 2500 - 180 < len(rows) < 2500 + 180
    # However the rows are dealt out, the same are drawn.
    assert sorted(map(tuple, sample_rows(joined.repartition(7), 0.5).collect())) == rows


def test_sample_by_text_keeps_equal_rows_together(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("string").alias("k.x"))
    counts = [r["count"] for r in sample_by_text(df, 0.5).groupBy("`k.x`").count().collect()]
    assert set(counts) == {100} and 0 < len(counts) < 10


def _customers(spark):
    """9,000 lines, a third of them of one customer."""
    ids = spark.range(9000)
    return ids.select(F.when(F.col("id") % 3 == 0, "1").otherwise(F.concat(F.lit("c"), F.col("id") % 700)).alias("CustomerID"), F.col("id").alias("v"), F.lit(0).alias("_pieces"))


def test_heavy_customer_is_cut_in_pieces(spark):
    df = _customers(spark)
    assert [(r.CustomerID, r.pieces) for r in cl.heavy_customers(df, 12).collect()] == [("1", 32)]
    assert cl.heavy_customers(df.limit(0), 12).count() == 0
    out = cl.repartition_by_customer(df, 12)
    assert out.columns == df.columns and out.rdd.getNumPartitions() == 12
    assert out.exceptAll(df).count() == 0 and df.exceptAll(out).count() == 0
    parts = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.collect_set("CustomerID").alias("c")).collect()
    assert max(r.n for r in parts) <= 2 * 9000 / 12
    # All others stay whole.
    seen = [c for r in parts for c in r.c if c != "1"]
    assert len(seen) == len(set(seen))
