"""Invoice rollup: the cleaned lines at (invoice, customer, country, date, hour) grain.

Ten of the twelve result tables only need, per invoice, its customer,
country, calendar date and hour, exact amount and quantity sums and the
number of lines. Aggregating the lines to that grain once (typically one row
per invoice, an order of magnitude fewer rows than lines) and materializing
it lets those ten analyses read the small table instead of each scanning and
shuffling the full line table again.

The rollup keeps the cleaned table's column names, so the analyses accept
either input unchanged:

* ``TotalAmount`` / ``Quantity`` are exact partial sums, and sums of partial
  sums are the sums;
* ``InvoiceDateTime`` is the earliest time in the group; every line of a
  group shares the date and hour, and the analyses read only those parts
  (months, years, day differences) or the minimum;
* ``Lines`` carries the line count for the per-line averages
  (``functions.columns.line_count``), under a mark that no column of a user's
  table has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import LINES, LINES_MARK, line_count, money

ROLLUP_KEYS: tuple[str, ...] = ("InvoiceNo", "CustomerID", "Country", "InvoiceDate", "InvoiceHour")


def invoice_rollup(df: DataFrame) -> DataFrame:
    """One row per (InvoiceNo, CustomerID, Country, InvoiceDate, InvoiceHour)."""
    return df.groupBy(*ROLLUP_KEYS).agg(
        F.min("InvoiceDateTime").alias("InvoiceDateTime"),
        F.sum(money("TotalAmount")).alias("TotalAmount"),
        F.sum("Quantity").alias("Quantity"),
        line_count(df).alias(LINES, metadata=LINES_MARK),
    )
