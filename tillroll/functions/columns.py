"""Column expressions shared by the cleaning rules and the analyses.

Every function returns a built-in Spark ``Column`` so the whole plan stays in
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.schema import MONEY

# Accepted invoice timestamp layouts, tried in this order,
# first match wins. Day-first layouts only: 12/31/2010 is rejected.
INVOICE_TS_FORMATS: tuple[str, ...] = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy H:mm",
)

# Quantities are longs: the least double that none holds.
QUANTITY_BOUND = 2.0**63

# Cancellation marker, blank-description filler, order-key separator.
CANCELLATION_PREFIX = "C"
UNKNOWN_PRODUCT = "Unknown Product"
ORDER_KEY_SEPARATOR = "|"


class ClashingColumnsError(ValueError):
    """Raised for columns whose names differ in case alone: Spark can't tell
    them apart."""


def check_names(df: DataFrame) -> None:
    """Raise ``ClashingColumnsError`` unless all column names differ."""
    names = Counter(c.lower() for c in df.columns)
    clashing = [c for c in df.columns if names[c.lower()] > 1]
    if clashing:
        raise ClashingColumnsError(f"columns of one name: {clashing}")


def quoted(name: str) -> Column:
    """The column of a name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, or with as many underscores before it as none of ``taken`` is
    called so, in any case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def _text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def not_cancelled(invoice: Column | str = "InvoiceNo", trimmed: bool = True) -> Column:
    """False for invoice numbers that start with ``C``, after trimming unless
    ``trimmed`` is off.

    NULL invoice numbers give NULL, so a filter drops them.
    """
    text = F.trim(_text(invoice)) if trimmed else _text(invoice)
    return ~text.startswith(CANCELLATION_PREFIX)


def positive_line(
    quantity: Column | str = "Quantity", price: Column | str = "UnitPrice"
) -> Column:
    """Quantity and unit price both strictly positive, compared as doubles.

    A quantity that no long holds and a price that isn't finite are no numbers
    to sum, and fail as well. NaN is greater than any number in Spark, so the
    upper bounds reject it too.
    """
    q = (F.col(quantity) if isinstance(quantity, str) else quantity).try_cast("double")
    p = (F.col(price) if isinstance(price, str) else price).try_cast("double")
    return (q > 0) & (p > 0) & (q < QUANTITY_BOUND) & (p < float("inf"))


def filled_description(description: Column | str = "Description") -> Column:
    """NULL or whitespace-only descriptions become ``Unknown Product``.

    Other descriptions are kept as they are (not trimmed).
    """
    d = _text(description)
    return F.when(d.isNull() | (F.trim(d) == ""), F.lit(UNKNOWN_PRODUCT)).otherwise(d)


def invoice_timestamp(invoice_date: Column | str = "InvoiceDate") -> Column:
    """Parse the invoice date text with the accepted layouts; NULL if none fits.

    The value is returned as ``timestamp_ntz`` (wall-clock time, no zone), so
    hour and day equal the source text. Parsing goes through the session time
    zone and back; in a UTC session (``build_session``) that is the identity.

    Texts of digits in the usual places are cast in ISO order, where an impossible
    date or time gives NULL and raises nothing inside the JVM; only other texts are
    tried with one layout after the other.
    """
    text = F.trim(_text(invoice_date))
    piece = lambda start, size: F.substring(text, start, size)
    day_first = F.concat(piece(7, 4), F.lit("-"), piece(4, 2), F.lit("-"), piece(1, 2), piece(11, 6), F.lit(":00"))
    iso = F.when(F.length(text) == 19, F.translate(text, "/", "-")).otherwise(day_first)
    tried = _tried_layouts(text)
    return F.when(text.rlike(USUAL_TEXTS), iso.try_cast("timestamp")).otherwise(tried).cast("timestamp_ntz")


# The layouts with digits in all places. They have no year 0, which a cast has.
USUAL_TEXTS = (
    r"\A(?:(?!0000)[0-9]{4}([-/])[0-9]{2}\1[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}"
    r"|[0-9]{2}/[0-9]{2}/(?!0000)[0-9]{4} [0-9]{1,2}:[0-9]{2})\z"
)


# Shorter than two texts of any layouts together, the least of 15 characters; a year has
# a sign and nine digits at most, which makes a text of 25.
LONGEST_TEXT = 29


def _tried_layouts(text: Column) -> Column:
    """The layouts in one pattern, each an optional part, so that an unusual text is parsed
    once and the generated code has one call: it stays small enough to be compiled
    together with what is around it. No text fits two of the parts, and one after the
    other they need a longer text. A text without a colon fits none: a failed parse
    raises inside the JVM, which costs more than this test."""
    layouts = "".join(f"[{fmt}]" for fmt in INVOICE_TS_FORMATS)
    possible = text.contains(":") & (F.length(text) <= LONGEST_TEXT)
    return F.when(possible, F.try_to_timestamp(text, F.lit(layouts)))


def is_weekend(ts: Column | str) -> Column:
    """1 on Saturday and Sunday (Spark ``dayofweek`` 7 and 1), else 0."""
    dow = F.dayofweek(F.col(ts) if isinstance(ts, str) else ts)
    return F.when(dow.isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def order_key(
    invoice: Column | str = "InvoiceNo", customer: Column | str = "CustomerID"
) -> Column:
    """``trim(InvoiceNo) | CustomerID``."""
    return F.concat_ws(ORDER_KEY_SEPARATOR, F.trim(_text(invoice)), _text(customer))


def money(col: Column | str) -> Column:
    """Exact decimal view of an amount."""
    return (F.col(col) if isinstance(col, str) else col).cast(MONEY)


def money_sum(col: Column | str = "TotalAmount") -> Column:
    """Order-independent sum of an amount, reported as double."""
    return F.sum(money(col)).cast("double")


# Column of an invoice rollup holding how many lines each row stands for. A
# rollup is known by a mark in the column's metadata, which Parquet keeps, and
# not by its name, which a user's table may have.
LINES = "Lines"
LINES_MARK = {"tillroll.lines": True}


def line_count(df: DataFrame) -> Column:
    """Aggregate counting invoice lines.

    On the cleaned table every row is a line; on an invoice rollup
    (``operators.rollup``) each row carries its line count in ``Lines``.
    """
    marked = [f.name for f in df.schema.fields if f.name == LINES and f.metadata == LINES_MARK]
    return F.sum(LINES) if marked else F.count(F.lit(1))


def money_per_line(df: DataFrame, col: Column | str = "TotalAmount") -> Column:
    """Mean amount per invoice line (exact sum divided by the line count)."""
    return money_sum(col) / line_count(df).cast("double")


def growth_pct(current: Column | str, previous: Column | str) -> Column:
    """``(cur - prev) / prev * 100``; NULL when prev is NULL or zero."""
    cur = F.col(current) if isinstance(current, str) else current
    prev = F.col(previous) if isinstance(previous, str) else previous
    return F.when(prev.isNull() | (prev == 0), F.lit(None).cast("double")).otherwise(
        (cur - prev) / prev * F.lit(100.0)
    )
