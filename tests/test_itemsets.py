"""Frequent itemsets by blocks of baskets, against Spark ML's FP-Growth and by hand."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from tillroll.operators import baskets as bk
from tillroll.operators import itemsets as its
from tillroll.sources.fixtures import brand_order_lines


def brute(baskets, least):
    found = {}
    items = sorted(set().union(*baskets))
    for k in range(1, len(items) + 1):
        level = {c: n for c in combinations(items, k) if (n := sum(set(c) <= set(b) for b in baskets)) >= least}
        if not level:
            break
        found.update(level)
    return found


@given(st.lists(st.sets(st.integers(0, 6)), min_size=1, max_size=30), st.integers(1, 8))
@settings(max_examples=150, deadline=None)
def test_block_is_mined_whole(baskets, least):
    lists = [[b for b, x in enumerate(baskets) if item in x] for item in range(7)]
    ids, sizes = np.array(sum(lists, []), np.int32), np.array([len(x) for x in lists])
    got = dict(its.mined(ids, sizes, len(baskets), least))
    assert len(got) == len(list(its.mined(ids, sizes, len(baskets), least)))
    assert {tuple(sorted(k)): n for k, n in got.items()} == brute(baskets, least)


def _growth(lines, item, support, confidence):
    """Rules of Spark ML over the same baskets."""
    fp = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence)
    model = fp.fit(bk.baskets(lines, "InvoiceNo", item))
    rules = {
        (tuple(sorted(r.antecedent)), r.consequent[0]): (round(r.support, 12), round(r.confidence, 12), round(r.lift, 9))
        for r in model.associationRules.collect()
    }
    return {tuple(sorted(r["items"])): r["freq"] for r in model.freqItemsets.collect()}, rules


def _ours(lines, item, support, confidence, blocks=None):
    sets = bk.frequent_itemsets(lines, support, "InvoiceNo", item, blocks).collect()
    rules = bk.association_rules(lines, support, confidence, "InvoiceNo", item, blocks).collect()
    rounded = {(tuple(r.antecedent_str.split(",")), r.consequent_str): (round(r.support, 12), round(r.confidence, 12), round(r.lift, 9)) for r in rules}
    assert len(rounded) == len(rules) and all(r["size"] == len(r.items_str.split(",")) for r in sets)
    return {tuple(r.items_str.split(",")): r.freq for r in sets}, rounded


@pytest.mark.parametrize(("item", "support", "confidence", "blocks"), [("p_brand", 0.01, 0.1, None), ("p_type", 0.01, 0.2, 1), ("p_type", 0.01, 0.2, 9)])
def test_equal_to_growth(spark, sf_small, monkeypatch, item, support, confidence, blocks):
    # Blocks in which sets come short of their share.
    monkeypatch.setattr(its, "BLOCK_SUPPORT", 1)
    lines = brand_order_lines(spark, sf_small)
    assert _ours(lines, item, support, confidence, blocks) == _growth(lines, item, support, confidence)


def test_sets_that_few_blocks_report_are_counted_again(spark, monkeypatch):
    """Baskets of one block have items that the others hardly have."""
    monkeypatch.setattr(its, "CANDIDATES", 2)
    rows = [(0, ["a", "b", "c"])] * 6 + [(1, ["a", "b"])] + [(1, ["d", "e"])] * 5 + [(1, [])] + [(2, ["a", "d"])] * 3 + [(2, ["d", "e"])] * 4
    blocks = its.vertical_blocks(spark.createDataFrame(rows, "block int, items array<string>"))
    assert blocks.count() == 3
    for least in (1, 3, 7, 9, 12, 30):
        got = {tuple(r["items"]): r["freq"] for r in its.frequent_sets(blocks, len(rows), least).collect()}
        assert got == brute([b for _, b in rows], least)


def test_block_count():
    assert its.block_count(10, 1) == 1
    assert its.block_count(10**9, 10**7) == -(-(10**9) // its.BLOCK_BASKETS)
    # A low support makes larger blocks.
    assert its.block_count(10**9, 1000) == 1000 // its.BLOCK_SUPPORT
    assert its.block_count(1000, 100, 500) == 100 // its.BLOCK_SUPPORT


def test_popular_item_fills_no_task(spark, monkeypatch):
    """An item of a third of all baskets, and one of all, cost their share in each block."""
    monkeypatch.setattr(its, "BLOCK_BASKETS", 100)
    ids = spark.range(3000)
    lines = ids.select(F.col("id").cast("string").alias("InvoiceNo"), F.explode(F.array(F.lit("all"), F.when(F.col("id") % 3 == 0, "third"), F.concat(F.lit("i"), F.col("id") % 50))).alias("StockCode"))
    blocks, total, least = bk.mining_blocks(lines, 0.2, "InvoiceNo", "StockCode")
    rows = blocks.collect()
    assert (total, least) == (3000, 600) and 15 < len(rows) <= 30
    assert max(r.baskets for r in rows) < 250 and max(dict(zip(r["items"], r["sizes"], strict=True))["third"] for r in rows) < 100
    got = {(r.antecedent_str, r.consequent_str): (r.support, r.confidence) for r in bk.association_rules(lines, 0.2, 0.1).collect()}
    assert got == {("all", "third"): (1 / 3, 1 / 3), ("third", "all"): (1 / 3, 1.0)}


def test_no_baskets(spark):
    lines = spark.createDataFrame([("1", "a"), ("2", None)], "InvoiceNo string, StockCode string")
    assert bk.association_rules(lines).count() == 0 and bk.frequent_itemsets(lines).count() == 0
    assert bk.association_rules(lines.limit(0)).count() == 0
