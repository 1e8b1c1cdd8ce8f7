"""Customer analyses over the cleaned table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import LINES, money_sum
from tillroll.operators.profiles import customer_profile, is_profile
from tillroll.operators.ranking import quantiles, with_ntiles
from tillroll.operators.sketches import sketched_quantiles
from tillroll.session import materialize


def customer_frequency(df: DataFrame) -> DataFrame:
    """A4: per customer, distinct invoices, total amount and mean amount per
    *line* (reported under the name AvgOrderSpending)."""
    spent = F.col("Amount").cast("double")
    return (
        customer_profile(df)
        .select(
            "CustomerID",
            F.col("Invoices").alias("PurchaseFrequency"),
            spent.alias("TotalSpending"),
            (spent / F.col("Lines").cast("double")).alias("AvgOrderSpending"),
        )
        .orderBy(F.desc("TotalSpending"), "CustomerID")
    )


def first_purchase_distribution(df: DataFrame) -> DataFrame:
    """Customers per month (``yyyy-MM``) of their first purchase.

    The earliest purchase is a per-customer ``min`` (partial aggregation, no
    sort); only its month is read, so ties do not matter.
    """
    return (
        customer_profile(df)
        .groupBy(F.date_format("FirstTime", "yyyy-MM").alias("first_month"))
        .agg(F.count(F.lit(1)).alias("NewCustomers"))
        .orderBy("first_month")
    )


# ---------------------------------------------------------------- RFM

# Segment rules, first match wins (quartile 1 is best in R, F and M).
SEGMENT_CODES: tuple[str, ...] = (
    "HIGH_VALUE",
    "HIGH_POTENTIAL",
    "WIN_BACK",
    "REGULAR",
    "CHURN_RISK",
)
SEGMENT_LABELS_EN: dict[str, str] = {c: c for c in SEGMENT_CODES}
# The reference's segment labels, in rule order.
SEGMENT_LABELS_ZH: dict[str, str] = {
    "HIGH_VALUE": "重要价值用户",
    "HIGH_POTENTIAL": "重要发展用户",
    "WIN_BACK": "重要挽留用户",
    "REGULAR": "一般用户",
    "CHURN_RISK": "流失风险用户",
}


def rfm_scores(df: DataFrame) -> DataFrame:
    """Per customer: days since the last purchase (relative to the latest
    purchase in the whole table), distinct invoices, total amount.

    The reference date is a scalar subquery, not a driver round trip. The latest
    purchase of all is that of some customer, so the lines are read once, for the
    profile, which is written.
    """
    customers = df if is_profile(df) else materialize(customer_profile(df), "customers")
    ref = customers.select(F.max("LastTime"))
    return customers.select(
        "CustomerID",
        F.datediff(ref.scalar(), F.col("LastTime")).alias("RecencyDays"),
        F.col("Invoices").alias("Frequency"),
        F.col("Amount").cast("double").alias("Monetary"),
    )


def _segment(labels: Mapping[str, str]):
    r, f, m = F.col("R_q"), F.col("F_q"), F.col("M_q")
    return (
        F.when((r <= 2) & (f <= 2) & (m <= 2), F.lit(labels["HIGH_VALUE"]))
        .when((r <= 2) & (f <= 2), F.lit(labels["HIGH_POTENTIAL"]))
        .when((r >= 3) & (f <= 2), F.lit(labels["WIN_BACK"]))
        .when((f >= 3) & (m <= 2), F.lit(labels["REGULAR"]))
        .otherwise(F.lit(labels["CHURN_RISK"]))
    )


def rfm_segments(
    df: DataFrame,
    labels: Mapping[str, str] = SEGMENT_LABELS_EN,
    buckets: int = 4,
) -> DataFrame:
    """RFM quartiles over all customers and a segment per customer.

    R ascending, F and M descending, CustomerID breaking ties. The cut points
    of all three are selected together (see ``operators.ranking``).
    """
    scored = with_ntiles(
        rfm_scores(df),
        {"R_q": ("RecencyDays", False), "F_q": ("Frequency", True), "M_q": ("Monetary", True)},
        "CustomerID",
        buckets,
    )
    return scored.select(
        "CustomerID",
        "RecencyDays",
        "Frequency",
        "Monetary",
        "R_q",
        "F_q",
        "M_q",
        _segment(labels).alias("RFM_Segment"),
    )


# ------------------------------------------------- behaviour summary

QUANTILE_PROBS: tuple[float, ...] = (0.25, 0.5, 0.75)
QUANTILE_METRICS: tuple[str, ...] = ("order_value_p25", "order_value_p50", "order_value_p75")


SUMMARY_METRICS: tuple[str, ...] = ("customer_cnt", "repeat_customers", "repurchase_rate")
GAP_METRIC = "avg_repurchase_gap_days"


def _repurchase_metrics(df: DataFrame) -> DataFrame:
    """One row: customers, those with two or more invoices, their ratio, and the
    mean days between consecutive purchase lines of a customer.

    Both come from one aggregate per customer. Consecutive day differences
    telescope: for a customer with n lines they sum to datediff(last, first)
    over n - 1 gaps, so no lines are sorted.
    """
    span = F.datediff("LastTime", "FirstTime")
    return customer_profile(df).agg(
        F.count(F.lit(1)).cast("double").alias("customer_cnt"),
        F.count_if(F.col("Invoices") >= 2).cast("double").alias("repeat_customers"),
        F.try_divide(
            F.sum(span).cast("double"), F.sum(F.col("Lines") - 1).cast("double")
        ).alias(GAP_METRIC),
    ).withColumn(
        "repurchase_rate", F.try_divide(F.col("repeat_customers"), F.col("customer_cnt"))
    )


def repurchase_summary(df: DataFrame) -> DataFrame:
    """Customers, customers with two or more invoices, and their ratio."""
    return _repurchase_metrics(df).unpivot([], list(SUMMARY_METRICS), "metric", "value")


def order_values(df: DataFrame) -> DataFrame:
    """Amount per invoice."""
    return df.groupBy("InvoiceNo").agg(money_sum("TotalAmount").alias("order_value"))


def order_value_quantiles(
    df: DataFrame, probs: Sequence[float] = QUANTILE_PROBS, rank_error: float = 0.0
) -> DataFrame:
    """Quartiles of the per-invoice amount: exact with linear interpolation, or
    with ``rank_error`` values whose rank is off by at most that share of the invoices."""
    names = QUANTILE_METRICS if tuple(probs) == QUANTILE_PROBS else None
    return quantiles(order_values(df), "order_value", probs, names, rank_error)


def order_value_quantiles_approx(
    df: DataFrame, probs: Sequence[float] = QUANTILE_PROBS, accuracy: int = 10000
) -> DataFrame:
    """Quartiles with a rank error of at most 1/accuracy of the invoices: the
    selection stops as soon as its ranges are that small."""
    return order_value_quantiles(df, probs, 1.0 / accuracy)


def repurchase_gap_lines(df: DataFrame) -> DataFrame:
    """Mean days between consecutive purchase *lines* of the same customer."""
    return _repurchase_metrics(df).unpivot([], [GAP_METRIC], "metric", "value")


def repurchase_gap_orders(df: DataFrame) -> DataFrame:
    """Mean days between consecutive *invoices* of the same customer (each
    invoice dated by its earliest line); telescoped like the line version."""
    per_order = df.groupBy("CustomerID", "InvoiceNo").agg(
        F.min("InvoiceDateTime").alias("_ts")
    )
    per_c = per_order.groupBy("CustomerID").agg(
        F.count(F.lit(1)).alias("_n"),
        F.datediff(F.max("_ts"), F.min("_ts")).alias("_span"),
    )
    return per_c.agg(
        F.try_divide(
            F.sum("_span").cast("double"), F.sum(F.col("_n") - 1).cast("double")
        ).alias("value")
    ).select(F.lit("avg_repurchase_gap_days_orders").alias("metric"), "value")


def order_value_quantiles_sketched(sketches: DataFrame) -> DataFrame:
    """Quartiles from sketches kept by day (``operators.sketches.day_sketches``)."""
    return sketched_quantiles(sketches, QUANTILE_PROBS, QUANTILE_METRICS)


def user_behavior_summary(
    df: DataFrame, *, exact_quantile: bool = True, customers: DataFrame | None = None
) -> DataFrame:
    """Seven (metric, value) rows: repurchase counts and rate, order-value
    quartiles, mean line-level repurchase gap. ``customers`` may give the customer
    profile of ``df``, if there is one; else the columns that both halves read are
    written first, so that ``df`` runs once."""
    if customers is None:
        read = ("CustomerID", "InvoiceNo", "InvoiceDateTime", "TotalAmount", LINES)
        df = materialize(df.select(*[c for c in df.columns if c in read]), "summary-input")
    quartiles = order_value_quantiles(df) if exact_quantile else order_value_quantiles_approx(df)
    layout = F.array(*[F.lit(m) for m in (*SUMMARY_METRICS, *QUANTILE_METRICS, GAP_METRIC)])
    metrics = _repurchase_metrics(df if customers is None else customers).unpivot(
        [], [*SUMMARY_METRICS, GAP_METRIC], "metric", "value"
    )
    return metrics.unionByName(quartiles).orderBy(F.array_position(layout, F.col("metric")))
