"""Column-level building blocks (all built-in Spark expressions)."""

from tillroll.functions.columns import (
    CANCELLATION_PREFIX,
    INVOICE_TS_FORMATS,
    UNKNOWN_PRODUCT,
    filled_description,
    growth_pct,
    invoice_timestamp,
    is_weekend,
    money,
    line_count,
    money_per_line,
    money_sum,
    not_cancelled,
    order_key,
    positive_line,
)

__all__ = [
    "CANCELLATION_PREFIX",
    "INVOICE_TS_FORMATS",
    "UNKNOWN_PRODUCT",
    "filled_description",
    "growth_pct",
    "invoice_timestamp",
    "is_weekend",
    "money",
    "line_count",
    "money_per_line",
    "money_sum",
    "not_cancelled",
    "order_key",
    "positive_line",
]
