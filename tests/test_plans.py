"""Plan lint: shapes that would not survive 100 TB must not appear."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import baskets, customers, itemsets, ranking
from tillroll.plans.registry import ANALYSES
from tillroll.schema import CLEAN_COLUMNS


def _plan_lines(df) -> list[str]:
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def _single_partition_children(lines: list[str]) -> list[str]:
    """The operator directly below each ``Exchange SinglePartition``."""
    children = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and i + 1 < len(lines):
            children.append(re.sub(r"^[\s:+\-|*()0-9]*", "", lines[i + 1]))
    return children


def _global_windows(lines: list[str]) -> list[str]:
    """Windows whose rows all come through one partition."""
    found = []
    for i, line in enumerate(lines):
        if re.match(r"^[\s:+\-|*()0-9]*Window", line):
            exchange = next((x for x in lines[i + 1:] if "Exchange" in x), "")
            if "SinglePartition" in exchange:
                found.append(line)
    return found


@pytest.fixture
def eager_plans(monkeypatch):
    """Plans of the jobs that analyses run before they return."""
    plans = []

    def recording(run):
        def wrapped(df, *args):
            plans.append(_plan_lines(df))
            return run(df, *args)

        return wrapped

    for module in (ranking, baskets, itemsets):
        monkeypatch.setattr(module, "materialize", recording(module.materialize))
    monkeypatch.setattr(ranking, "bounded_rows", recording(ranking.bounded_rows))
    return plans


@pytest.fixture(scope="module")
def static_plans(spark):
    previous = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", previous)


@pytest.mark.parametrize("name", [n for n, _ in ANALYSES])
def test_single_partition_exchanges_sit_on_aggregates(spark, clean_small, static_plans, name):
    df = dict(ANALYSES)[name](clean_small)
    for child in _single_partition_children(_plan_lines(df)):
        assert child.startswith("HashAggregate") or child.startswith("ObjectHashAggregate"), (
            f"{name}: single-partition exchange over {child[:80]}"
        )


@pytest.mark.parametrize("name", [n for n, _ in ANALYSES])
def test_analyses_prune_columns(spark, clean_small, static_plans, name):
    df = dict(ANALYSES)[name](clean_small)
    for line in _plan_lines(df):
        m = re.search(r"ReadSchema: struct<(.*?)>", line)
        if m and "InvoiceNo" in m.group(1):  # a scan of the cleaned table
            read = re.findall(r"(?:^|,)(\w+):", m.group(1))
            assert len(read) < len(CLEAN_COLUMNS), f"{name} reads {read}"


# One row per calendar month of the data.
BOUNDED_WINDOWS = {"monthly_sales_trend"}


@pytest.mark.parametrize("name", [n for n, _ in ANALYSES])
def test_no_window_over_one_partition(spark, clean_small, static_plans, eager_plans, name):
    final = _plan_lines(dict(ANALYSES)[name](clean_small))
    for lines in [final, *eager_plans]:
        assert bool(_global_windows(lines)) == (name in BOUNDED_WINDOWS)
        for child in _single_partition_children(lines) if lines is not final else ():
            assert child.startswith(("HashAggregate", "ObjectHashAggregate", "SortAggregate")), child


def test_lint_rejects_a_global_ntile(clean_small, static_plans):
    tiled = customers.rfm_scores(clean_small).withColumn(
        "q", F.ntile(4).over(Window.orderBy("Monetary"))
    )
    assert _global_windows(_plan_lines(tiled))


def test_lint_covers_eager_jobs(clean_small, static_plans, eager_plans):
    customers.rfm_segments(clean_small)
    assert sum("HashAggregate" in "".join(p) for p in eager_plans) >= 3


def test_country_sales_does_not_expand_lines(clean_small, static_plans):
    from tillroll.operators.sales import country_sales

    assert not any("Expand" in line for line in _plan_lines(country_sales(clean_small)))
