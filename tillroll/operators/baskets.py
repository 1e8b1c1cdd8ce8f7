"""Market-basket association rules."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.itemsets import block_count, frequent_sets, vertical_blocks
from tillroll.session import materialize


def _basket_items(df: DataFrame, basket_col: str, item_col: str) -> DataFrame:
    """Distinct ``(basket, item)`` pairs; a line without an item adds none."""
    pairs = df.select(F.col(basket_col).alias("basket"), F.col(item_col).cast("string").alias("item"))
    return pairs.filter(F.col("item").isNotNull()).distinct()


def baskets(
    df: DataFrame,
    basket_col: str = "InvoiceNo",
    item_col: str = "StockCode",
    min_items: int = 2,
) -> DataFrame:
    """Sorted distinct items per basket; baskets with fewer than ``min_items``
    items are dropped (so they do not count in the support denominator)."""
    listed = _basket_items(df, basket_col, item_col).groupBy("basket").agg(
        F.sort_array(F.collect_list("item")).alias("items")
    )
    return listed.filter(F.size("items") >= min_items).withColumnRenamed("basket", basket_col)


#: Frequent items that are sent to every task; beyond, they are joined by a shuffle.
_BROADCAST_ITEMS = 1_000_000


def mining_blocks(
    df: DataFrame, min_support: float, basket_col: str, item_col: str, num_blocks: int | None = None
) -> tuple[DataFrame, int, int]:
    """Vertical blocks (``operators.itemsets``) of every basket of two or more items,
    with the items that can be in a frequent itemset; the number of baskets, and that
    of the baskets that a frequent itemset has.

    The lines are read once, for the written pairs. An item is kept if its
    baskets of any size reach the support threshold, so no frequent item is
    lost, and a basket holds at most the frequent items however long it is.
    Baskets left empty stay: they count in the support denominator.
    """
    pairs = materialize(_basket_items(df, basket_col, item_col), "basket-items")
    sizes = pairs.groupBy("basket").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.filter("n >= 2").count()
    least = max(1, math.ceil(min_support * total))
    frequent = (
        pairs.groupBy("item")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least)
        .select("item", F.col("item").alias("frequent"))
    )
    frequent = materialize(frequent, "frequent-items")
    # Their number is at most the mean size of a basket over the support.
    if frequent.count() <= _BROADCAST_ITEMS:
        frequent = F.broadcast(frequent)
    blocks = block_count(total, least, num_blocks)
    block = F.pmod(F.xxhash64("basket"), F.lit(blocks)).alias("block")
    # Dealt out by block once: a basket's lines stand in one block.
    listed = (
        pairs.join(frequent, "item", "left")
        .select(block, "basket", "frequent")
        .repartition("block")
        .groupBy("block", "basket")
        .agg(F.count(F.lit(1)).alias("n"), F.collect_list("frequent").alias("items"))
        .filter("n >= 2")
    )
    return vertical_blocks(listed.select("block", "items")), total, least


def basket_table(
    df: DataFrame, basket_col: str = "InvoiceNo", item_col: str = "StockCode"
) -> DataFrame:
    """Baskets as text: ``(basket, n_items, items_str)`` with items joined by ``,``."""
    b = baskets(df, basket_col, item_col)
    return b.select(
        F.col(basket_col),
        F.size("items").alias("n_items"),
        F.array_join("items", ",").alias("items_str"),
    )


def frequent_itemsets(
    df: DataFrame,
    min_support: float = 0.01,
    basket_col: str = "InvoiceNo",
    item_col: str = "StockCode",
    num_partitions: int | None = None,
) -> DataFrame:
    """``(items_str, size, freq)`` of every itemset with support >= ``min_support``."""
    sets, _ = _frequent(df, min_support, basket_col, item_col, num_partitions)
    return sets.select(
        F.array_join("items", ",").alias("items_str"),
        F.size("items").alias("size"),
        F.col("freq"),
    )


def _frequent(df, min_support, basket_col, item_col, num_partitions) -> tuple[DataFrame, int]:
    """Frequent itemsets (items, freq), written once, and the number of baskets."""
    blocks, total, least = mining_blocks(df, min_support, basket_col, item_col, num_partitions)
    return materialize(frequent_sets(blocks, total, least), "itemsets"), total


def association_rules(
    df: DataFrame,
    min_support: float = 0.01,
    min_confidence: float = 0.2,
    basket_col: str = "InvoiceNo",
    item_col: str = "StockCode",
    num_partitions: int | None = None,
) -> DataFrame:
    """Rules ``antecedent -> consequent`` (single-item consequent).

    support = baskets holding both / baskets, confidence = support / support of
    the antecedent, lift = confidence / support of the consequent. The itemsets
    are mined by blocks of baskets (``num_partitions`` or more, as far as the support
    allows) and the rules stay a DataFrame; none are collected.
    """
    sets, total = _frequent(df, min_support, basket_col, item_col, num_partitions)
    parts = sets.where(F.size("items") >= 2).select("items", "freq", F.explode("items").alias("consequent"))
    parts = parts.select(F.array_remove("items", F.col("consequent")).alias("antecedent"), "consequent", "freq")
    known = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("freq_a"))
    single = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("consequent"), F.col("freq").alias("freq_c"))
    confidence = F.col("freq") / F.col("freq_a")
    rules = (
        parts.join(known, "antecedent")
        .where(confidence >= min_confidence)
        .join(single, "consequent")
        .select(
            F.array_join("antecedent", ",").alias("antecedent_str"),
            F.col("consequent").alias("consequent_str"),
            (F.col("freq") / F.lit(total)).alias("support"),
            confidence.alias("confidence"),
            (confidence / (F.col("freq_c") / F.lit(total))).alias("lift"),
        )
    )
    return rules.orderBy(F.desc("lift"), "antecedent_str", "consequent_str")
