"""Schemas of the raw and the cleaned invoice-line tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The eight columns every raw invoice-line input must carry,
# in their natural order.
REQUIRED_COLUMNS: tuple[str, ...] = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
)

# Typed raw schema: what an explicit read of the raw CSV zone produces.
# Quantity/UnitPrice are numeric; everything else stays text so that the
# cleaning rules (trim, prefix test, multi-format date parse) see the source.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType(), True),
        T.StructField("StockCode", T.StringType(), True),
        T.StructField("Description", T.StringType(), True),
        T.StructField("Quantity", T.LongType(), True),
        T.StructField("InvoiceDate", T.StringType(), True),
        T.StructField("UnitPrice", T.DoubleType(), True),
        T.StructField("CustomerID", T.StringType(), True),
        T.StructField("Country", T.StringType(), True),
    ]
)

# Column order of the cleaned table: the raw columns (retyped in place),
# then the derived ones.
DERIVED_COLUMNS: tuple[str, ...] = (
    "InvoiceDateTime",
    "InvoiceHour",
    "InvoiceYear",
    "InvoiceMonth",
    "InvoiceDay",
    "InvoiceWeekday",
    "IsWeekend",
    "OrderKey",
    "TotalAmount",
)
CLEAN_COLUMNS: tuple[str, ...] = REQUIRED_COLUMNS + DERIVED_COLUMNS

# Money is summed as an exact decimal and reported as double, so totals do
# not depend on the order in which partitions are combined. Eight decimals,
# and up to 1e30 for a line or a total.
MONEY = T.DecimalType(38, 8)
