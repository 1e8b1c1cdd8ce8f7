"""Customer profile: the cleaned lines at one row for each customer.

Customer frequency, RFM scores, the repurchase metrics and the first-purchase
months all need the same few values of a customer. They are aggregated once, in
two levels: to (customer, invoice), so that a customer with a third of all
lines is split by invoice, and then to the customer. What follows is a
projection or a small aggregate of that table, and nothing is dealt out by
CustomerID again.

A profile is known by a mark in a column's metadata, which Parquet keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import line_count, money

PROFILE_MARK = {"tillroll.profile": True}


def is_profile(df: DataFrame) -> bool:
    return any(f.name == "Lines" and f.metadata == PROFILE_MARK for f in df.schema.fields)


def customer_profile(df: DataFrame) -> DataFrame:
    """CustomerID, Invoices (distinct), Lines, Amount (exact), FirstTime and
    LastTime, from cleaned lines or an invoice rollup; a profile stays as it is."""
    if is_profile(df):
        return df
    invoices = df.groupBy("CustomerID", "InvoiceNo").agg(
        line_count(df).alias("lines"),
        F.sum(money("TotalAmount")).alias("amount"),
        F.min("InvoiceDateTime").alias("first"),
        F.max("InvoiceDateTime").alias("last"),
    )
    return invoices.groupBy("CustomerID").agg(
        F.count("InvoiceNo").alias("Invoices"),
        F.sum("lines").alias("Lines", metadata=PROFILE_MARK),
        F.sum("amount").alias("Amount"),
        F.min("first").alias("FirstTime"),
        F.max("last").alias("LastTime"),
    )
