"""Rank selection against its single-task twins."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import ranking
from tillroll.operators.ranking import quantiles, with_ntiles


def _check_ntiles(df, tiles, buckets=4):
    got = with_ntiles(df, tiles, "id", buckets)
    want = df.select(
        "id",
        *[
            F.ntile(buckets).over(
                Window.orderBy(F.desc(c) if desc else F.asc(c), F.asc("id"))
            ).alias(f"w_{name}")
            for name, (c, desc) in tiles.items()
        ],
    )
    joined = got.join(want, "id").cache()
    for name in tiles:
        assert joined.filter(F.col(name) != F.col(f"w_{name}")).count() == 0, name
    assert joined.count() == df.count()


def test_ntiles_with_a_third_of_rows_at_a_cut(spark):
    rnd = random.Random(7)
    # every third row has one value, which covers the first quartile cut
    rows = [(f"c{i:05d}", 5 if i % 3 == 0 else rnd.randint(0, 20), rnd.random()) for i in range(3001)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, k int, v double")
    _check_ntiles(df, {"kq": ("k", False), "kd": ("k", True), "vq": ("v", True)})


def test_ntiles_with_texts_of_shared_prefixes(spark):
    ids = ["", "a", "aa", "aaa", "aab", "ab", "a" * 300, "a" * 300 + "b", "é", "\U0001f600", "\uffee", "z"]
    df = spark.createDataFrame([(x, 1) for x in ids], "id string, k int")
    _check_ntiles(df, {"q": ("k", False), "d": ("k", True)}, 5)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 7, 8, 101])
def test_ntile_sizes(spark, n):
    df = spark.range(n).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("id"), F.lit(1).alias("k"))
    _check_ntiles(df, {"q": ("k", False)})


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(st.integers(min_value=0, max_value=5), min_size=0, max_size=60),
    buckets=st.integers(min_value=1, max_value=7),
)
def test_ntile_property(spark, values, buckets):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, v long")
    _check_ntiles(df, {"q": ("v", True)}, buckets)


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_exact_quantiles_linear(spark, n):
    rnd = random.Random(n)
    vals = [round(rnd.uniform(-50, 500), 2) for _ in range(n)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = {r.metric: r.value for r in quantiles(df, "v", [0.25, 0.5, 0.75]).collect()}
    want = np.quantile(np.array(vals), [0.25, 0.5, 0.75], method="linear")
    for name, w in zip(["p25", "p50", "p75"], want):
        assert got[name] == pytest.approx(w, rel=1e-12, abs=1e-9)


def test_quantiles_of_empty_and_null_values(spark):
    for rows in ([], [(1, None), (2, None)]):
        df = spark.createDataFrame(rows, "id long, v double")
        assert [tuple(r) for r in quantiles(df, "v", [0.5]).collect()] == [("p50", None)]


def test_quantiles_with_ties_and_values_of_all_magnitudes(spark):
    rnd = random.Random(5)
    vals = [7.5 if i % 3 == 0 else 10.0 ** rnd.uniform(-12, 12) for i in range(4000)] + [1e300, 1e-300]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = [r.value for r in quantiles(df, "v", probs).collect()]
    assert got == pytest.approx(list(np.quantile(vals, probs, method="linear")), rel=1e-12)


def test_approximate_quantiles_keep_their_rank_bound(spark):
    rnd = random.Random(9)
    vals = sorted(rnd.expovariate(0.01) for _ in range(5000))
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for row, p in zip(quantiles(df, "v", [0.25, 0.5, 0.75], rank_error=0.02).collect(), [0.25, 0.5, 0.75]):
        assert abs(vals.index(row.value) + 1 - p * 5000) <= 100


def test_rows_that_reach_the_driver_are_bounded(spark, monkeypatch):
    sizes = []

    def counted(df):
        rows = df.collect()
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(ranking, "bounded_rows", counted)
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_021).cast("double").alias("v"))
    assert quantiles(df, "v", [0.5]).first().value is not None
    assert max(sizes) <= 2 * ranking.BINS
