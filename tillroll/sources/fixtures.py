"""Raw invoice lines derived from the driver's TPC-H-style tables.

The reference's own input (one retail CSV) is not available, so test inputs
are derived, row for row, from ``lineitem ⋈ orders ⋈ part ⋈ customer ⋈
nation``. The derivation deliberately plants every case the cleaning rules
handle: cancellations (``C`` prefix, negative quantity), zero quantity and
zero price, exact duplicates (a slice of lines appears twice), missing
customers, NULL / blank / trailing-space descriptions, four timestamp layouts
and unparseable dates. Every lineitem row is used.

The same derivation exists as portable SQL (``tillroll.plans.oracle``) so an
independent engine can rebuild the identical table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Lines of a task at most, about, in tables of more than ``MANY_LINES``: more input
# makes more tasks, and not larger ones. Smaller tables are left to AQE.
LINES_PER_TASK = 250_000
MANY_LINES = 10_000_000

# Parts that are sent to all tasks, at most: some 150 MB.
FEW_PARTS = 1_500_000


def raw_retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw retail table (8 columns) for one scale-factor folder."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    li = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_discount"
    )
    # Every line once, plus a second copy of the lines of every 50th order:
    # these copies are the exact duplicates the dedup rule must remove.
    # One scan of lineitem; the copy is generated next to the original.
    copies = F.when(F.col("l_orderkey") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    lines = li.withColumn("_copy", F.explode(copies)).drop("_copy")

    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_size", "p_retailprice"
    )
    # What lines have of their order is made once for each order.
    orders = _order_columns(spark, sf_dir)
    tasks = _tasks(spark, lineitem)
    # Parts that go to all tasks do so after the lines are dealt out, which are narrow then.
    # More parts come first, and neither side is sorted, as a task has few of them.
    few = part.count() <= FEW_PARTS  # from the files' footers
    if not few:
        lines = lines.join(part.hint("shuffle_hash"), F.col("l_partkey") == F.col("p_partkey"))
    if tasks:
        lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    # A quarter of the lines' rows, so that neither side is sorted.
    joined = lines.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    if few:
        joined = joined.join(F.broadcast(part), F.col("l_partkey") == F.col("p_partkey"))

    ok = F.col("l_orderkey")
    cancelled = (F.col("l_returnflag") == "R") & (ok % 5 == 0)
    description = (
        F.when(F.col("p_size") == 1, F.lit(None).cast("string"))
        .when(F.col("p_size") == 2, F.lit("  "))
        .when(F.col("l_linenumber") == 7, F.concat(F.col("p_name"), F.lit(" ")))
        .otherwise(F.col("p_name"))
    )
    qty = F.col("l_quantity").cast("long")
    quantity = F.when(cancelled, -qty).when(ok % 41 == 0, F.lit(0).cast("long")).otherwise(qty)
    unit_price = F.when(
        (F.col("l_discount") == 0.1) & (ok % 3 == 0), F.lit(0.0)
    ).otherwise(F.col("p_retailprice"))
    invoice_no = F.when(cancelled, F.concat(F.lit("C"), ok.cast("string"))).otherwise(
        ok.cast("string")
    )
    return joined.select(
        invoice_no.alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        description.alias("Description"),
        quantity.alias("Quantity"),
        "InvoiceDate",
        unit_price.alias("UnitPrice"),
        "CustomerID",
        "Country",
    )


def _tasks(spark: SparkSession, lineitem: DataFrame) -> int | None:
    """Tasks that many lines are dealt to; None for fewer lines."""
    lines = lineitem.count()  # from the files' footers
    if lines <= MANY_LINES:
        return None
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines // LINES_PER_TASK))


def _order_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey, InvoiceDate, CustomerID and Country of each order."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("string").alias("d"),
        (F.lit(6) + F.col("o_orderkey") % 15).cast("string").alias("h"),
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation has 25 rows by definition: a fixed-size broadcast.
    nation = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )

    ok = F.col("o_orderkey")
    d, h = F.col("d"), F.col("h")
    hh = F.lpad(h, 2, "0")
    iso_day = F.substring(d, 1, 10)
    slash_ymd = F.concat_ws("/", F.substring(d, 1, 4), F.substring(d, 6, 2), F.substring(d, 9, 2))
    slash_dmy = F.concat_ws("/", F.substring(d, 9, 2), F.substring(d, 6, 2), F.substring(d, 1, 4))
    iso_text = F.concat(iso_day, F.lit(" "), hh, F.lit(":30:00"))
    invoice_date = (
        F.when(ok % 5 == 0, F.concat(slash_ymd, F.lit(" "), hh, F.lit(":30:00")))
        .when(ok % 5 == 1, F.concat(slash_dmy, F.lit(" "), hh, F.lit(":30")))
        .when(ok % 5 == 2, F.concat(slash_dmy, F.lit(" "), h, F.lit(":30")))
        .when((ok % 5 == 3) & (ok % 7 == 0), F.lit("not a date"))
        .otherwise(iso_text)
    )
    customer_id = F.when(F.col("o_custkey") % 20 == 0, F.lit(None).cast("string")).otherwise(
        F.col("o_custkey").cast("string")
    )
    return joined.select(
        "o_orderkey",
        invoice_date.alias("InvoiceDate"),
        customer_id.alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


def brand_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order, brand, type) per line: the uncleaned basket fixture."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").cast("string").alias("InvoiceNo"),
        F.col("p_brand"),
        F.col("p_type"),
    )
