"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Each query derives the raw invoice lines from the whole driver tables
(``sources.fixtures``) and runs one operator of the library on them. The
I/O queries write to a fresh folder below the shared checkpoint location and
read the written data back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import baskets as bk
from tillroll.operators import clean as cl
from tillroll.operators import customers as cu
from tillroll.operators import sales as sa
from tillroll.operators import sketches
from tillroll.operators.sampling import sample_by_text, sample_rows
from tillroll.plans import benchmark as bm
from tillroll.plans.registry import run_all, verify_outputs
from tillroll.schema import CLEAN_COLUMNS
from tillroll.session import ensure_checkpoint_dir, materialize, scratch_path
from tillroll.sources import files as fl
from tillroll.sources import readers as rd
from tillroll.sources import sinks as sk
from tillroll.sources.fixtures import brand_order_lines, raw_retail_lines

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return raw_retail_lines(spark, sf)


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return cl.clean(_raw(spark, sf))


def _on_clean(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: fn(_clean(spark, sf))


def _raw_csv_zone(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "raw-csv")
    sk.write_raw_csv(_raw(spark, sf), path)
    return path


# ------------------------------------------------------------ scans / sinks


def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    return rd.read_raw(spark, _raw_csv_zone(spark, sf), "csv")


def _with_store(df: DataFrame) -> DataFrame:
    """One more column, and the others in reverse order."""
    store = F.concat(F.lit("S-"), F.coalesce("Country", F.lit(""))).alias("Store")
    return df.select(store, *reversed(df.columns))


def scan_csv_reordered(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "raw-csv")
    sk.write_raw_csv(_with_store(_raw(spark, sf)), path)
    return rd.read_raw(spark, path, "csv")


def ingest_raw_extra_columns(spark: SparkSession, sf: str) -> DataFrame:
    source, target = scratch_path(spark, "raw-csv"), scratch_path(spark, "ingest")
    sk.write_raw_csv(_with_store(_raw(spark, sf)), source)
    sk.ingest_raw(spark, source, target)
    return rd.read_raw(spark, target, "csv")


def clean_retail_extra_column(spark: SparkSession, sf: str) -> DataFrame:
    return cl.clean(_with_store(_raw(spark, sf)))


def _with_clashing(df: DataFrame) -> DataFrame:
    """More columns, named like derived and working ones; none tells lines apart
    that the raw columns don't."""
    return df.select(
        "*",
        F.lit(7).alias("Lines"),
        F.concat(F.lit("at "), "InvoiceDate").alias("InvoiceDateTime"),
        F.length("StockCode").alias("_n"),
        (F.col("UnitPrice") / 2).alias("Unit.Cost"),
    )


def clean_retail_clashing_columns(spark: SparkSession, sf: str) -> DataFrame:
    return cl.clean(_with_clashing(_raw(spark, sf)))


def customer_frequency_clashing_columns(spark: SparkSession, sf: str) -> DataFrame:
    return cu.customer_frequency(clean_retail_clashing_columns(spark, sf))


def quality_waterfall_clashing_columns(spark: SparkSession, sf: str) -> DataFrame:
    return cl.quality_waterfall(_with_clashing(_raw(spark, sf)))


def scan_csv_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """A folder whose files have two headers: the raw columns, and one more column
    before the others in reverse order."""
    path = scratch_path(spark, "raw-csv")
    raw = _raw(spark, sf)
    late = F.coalesce(F.col("InvoiceNo") >= "3", F.lit(True))
    sk.write_raw_csv(raw.where(~late), path)
    sk.write_raw_csv(_with_store(raw.where(late)), path, mode="append")
    return rd.load_retail(spark, path, "csv")


def ingest_checksums(spark: SparkSession, sf: str) -> DataFrame:
    """Lines landed, and whether all files of the raw zone have the bytes of their
    sources, as read anew and as the manifest says, also after a landing of other files
    in skip mode."""
    source, other, target = (scratch_path(spark, n) for n in ("raw-csv", "raw-csv", "raw-zone"))
    sk.write_raw_csv(_raw(spark, sf), source)
    sk.write_raw_csv(_with_store(_raw(spark, sf)), other)
    sk.ingest_raw(spark, source, target, mode="overwrite")
    sk.ingest_raw(spark, other, target, mode="skip")
    want, got, said = fl.file_digests(spark, source), fl.file_digests(spark, target), fl.read_manifest(spark, target)
    same = [
        want.exceptAll(x).count() == 0 and x.exceptAll(want).count() == 0 for x in (got, said)
    ]  # a row for each file
    lines = rd.read_raw(spark, target, "csv").agg(F.count(F.lit(1)).alias("lines"))
    return lines.select("lines", F.lit(same[0]).alias("same_bytes"), F.lit(same[1]).alias("same_manifest"))


def scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "raw-parquet")
    sk.write_parquet(_raw(spark, sf), path)
    return rd.read_raw(spark, path, "parquet")


def scan_csv_strings(spark: SparkSession, sf: str) -> DataFrame:
    return rd.read_table(spark, _raw_csv_zone(spark, sf), "csv")


def load_retail(spark: SparkSession, sf: str) -> DataFrame:
    return rd.load_retail(spark, _raw_csv_zone(spark, sf), "csv")


def ingest_raw(spark: SparkSession, sf: str) -> DataFrame:
    source = _raw_csv_zone(spark, sf)
    target = scratch_path(spark, "raw-zone")
    sk.ingest_raw(spark, source, target, mode="overwrite")
    # A second landing in skip mode must leave the first one untouched.
    sk.ingest_raw(spark, source, target, mode="skip")
    return rd.read_raw(spark, target, "csv")


def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "cleaned")
    sk.write_parquet(_clean(spark, sf), path)
    return spark.read.parquet(path).select(*CLEAN_COLUMNS)


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "daily-csv")
    result = sa.daily_sales(_clean(spark, sf))
    sk.write_result(result, path, fmt="csv")
    return spark.read.option("header", "true").schema(result.schema).csv(path)


def export_single_csv(spark: SparkSession, sf: str) -> DataFrame:
    multi = scratch_path(spark, "country-result")
    single = scratch_path(spark, "country-export") + ".csv"
    result = sa.country_sales(_clean(spark, sf))
    sk.write_result(result, multi, fmt="parquet")
    # The export reads the written result back, so the analysis runs once.
    sk.export_single_csv(spark.read.parquet(multi), single)
    return spark.read.option("header", "true").schema(result.schema).csv(single)


def run_all_query(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = scratch_path(spark, "cleaned")
    sk.write_parquet(_clean(spark, sf), cleaned)
    return run_all(spark, spark.read.parquet(cleaned), scratch_path(spark, "results"))


def verify_outputs_query(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest after writing only the sales results: the rest are missing."""
    cleaned = scratch_path(spark, "cleaned")
    sk.write_parquet(_clean(spark, sf), cleaned)
    root = scratch_path(spark, "results")
    run_all(
        spark,
        spark.read.parquet(cleaned),
        root,
        names=["daily_sales", "country_sales", "hourly_orders"],
    )
    return verify_outputs(spark, root)


# ----------------------------------------------------------------- cleaning


def filter_cancelled(spark, sf):
    return cl.drop_cancelled(_raw(spark, sf))


def filter_positive(spark, sf):
    return _raw(spark, sf).transform(cl.drop_cancelled).transform(cl.keep_positive)


def dedup_rows(spark, sf):
    return filter_positive(spark, sf).transform(cl.drop_exact_duplicates)


def require_customer(spark, sf):
    return dedup_rows(spark, sf).transform(cl.require_customer)


def fill_description(spark, sf):
    """Lines per description after C4/C5: the filler shows up as one group."""
    return (
        require_customer(spark, sf)
        .groupBy("Description")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def parse_invoice_ts(spark, sf):
    return require_customer(spark, sf).transform(cl.parse_invoice_time)


def time_dimensions(spark, sf):
    return _clean(spark, sf).select(
        "InvoiceNo",
        "StockCode",
        "InvoiceDateTime",
        "InvoiceDate",
        "InvoiceHour",
        "InvoiceYear",
        "InvoiceMonth",
        "InvoiceDay",
        "InvoiceWeekday",
        "IsWeekend",
    )


def order_key(spark, sf):
    return _clean(spark, sf).select("InvoiceNo", "CustomerID", "OrderKey")


def total_amount(spark, sf):
    return _clean(spark, sf).select("InvoiceNo", "StockCode", "Quantity", "UnitPrice", "TotalAmount")


def repartition_by_key(spark, sf):
    return cl.clean(_raw(spark, sf), partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))


def quality_waterfall(spark, sf):
    return cl.quality_waterfall(_raw(spark, sf))


# ------------------------------------------------------------------ baskets


def association_rules_brand(spark, sf):
    return bk.association_rules(
        brand_order_lines(spark, sf), 0.01, 0.1, basket_col="InvoiceNo", item_col="p_brand"
    )


def association_rules_description(spark, sf):
    """Rules between the descriptions of the cleaned lines, of which fewer are told
    apart than of stock codes."""
    return bk.association_rules(_clean(spark, sf), 0.005, 0.05, item_col="Description")


def frequent_itemsets_brand(spark, sf):
    return bk.frequent_itemsets(
        brand_order_lines(spark, sf), 0.01, basket_col="InvoiceNo", item_col="p_brand"
    )


def association_rules_type(spark, sf):
    return bk.association_rules(
        brand_order_lines(spark, sf), 0.01, 0.2, basket_col="InvoiceNo", item_col="p_type"
    )


def order_value_rank_error(spark, sf, accuracy: int = 20):
    """Per approximate quartile: is its rank off by at most 1/accuracy of the
    invoices. The bound is coarse, so that ranges do stay open at small sizes."""
    lines = materialize(_clean(spark, sf).select("InvoiceNo", "TotalAmount"), "cleaned")
    approx = cu.order_value_quantiles_approx(lines, accuracy=accuracy)
    return _rank_error(cu.order_values(lines), approx, accuracy)


def order_value_rank_error_by_day(spark, sf, accuracy: int = 100):
    """The same of the quartiles from sketches kept by day, within a hundredth."""
    path = scratch_path(spark, "day-sketches")
    lines = materialize(_clean(spark, sf).select("InvoiceNo", "InvoiceDate", "TotalAmount"), "cleaned")
    sk.write_parquet(sketches.day_sketches(lines), path)
    approx = cu.order_value_quantiles_sketched(spark.read.parquet(path))
    return _rank_error(cu.order_values(lines), approx, accuracy)


def _rank_error(values, approx, accuracy: int):
    prob = F.create_map(
        *[F.lit(x) for pair in zip(cu.QUANTILE_METRICS, cu.QUANTILE_PROBS) for x in pair]
    )
    # Each quartile is one value, compared with every invoice as a scalar subquery.
    limits = values.withColumns(
        {m: approx.where(F.col("metric") == m).select("value").scalar() for m in cu.QUANTILE_METRICS}
    )
    value = F.col("order_value")
    row = limits.agg(
        F.count(F.lit(1)).alias("invoices"),
        *[F.count_if(value < F.col(m)).alias(f"{m}_below") for m in cu.QUANTILE_METRICS],
        *[F.count_if(value <= F.col(m)).alias(f"{m}_upto") for m in cu.QUANTILE_METRICS],
    )
    triples = [
        F.struct(
            F.lit(m).alias("metric"), F.col(f"{m}_below").alias("below"), F.col(f"{m}_upto").alias("upto")
        )
        for m in cu.QUANTILE_METRICS
    ]
    target = F.ceil(prob[F.col("metric")] * F.col("invoices"))
    off = F.greatest(F.lit(0), F.col("below") + 1 - target, target - F.col("upto"))
    return row.select("invoices", F.inline(F.array(*triples))).select(
        "metric", "invoices", (off * accuracy <= F.col("invoices")).alias("within_bound")
    )


def _bench(key: str) -> Query:
    return lambda spark, sf: bm.bench_sum_by(_raw(spark, sf), key)


def sample_rows_query(spark, sf):
    return sample_by_text(_raw(spark, sf), 0.25, seed=42)


def sample_rows_by_identity(spark, sf):
    """Rows in all, and whether a sample of a quarter is within five standard
    deviations, a part of the rows (as often as they stand there at most), the same
    when it is drawn again, and not all or none of each group of equal rows."""
    path = scratch_path(spark, "raw-parquet")
    sk.write_parquet(_raw(spark, sf), path)
    raw = spark.read.parquet(path)
    drawn = sample_rows(raw, 0.25, seed=42)
    of = F.struct(*raw.columns)
    both = raw.select(of.alias("r"), F.lit(1).alias("all"), F.lit(0).alias("a"), F.lit(0).alias("b"))
    for k in (0, 1):
        again = sample_rows(spark.read.parquet(path), 0.25, seed=42) if k else drawn
        both = both.union(again.select(F.struct(*raw.columns), F.lit(0), F.lit(1 - k), F.lit(k)))
    rows = both.groupBy("r").agg(F.sum("all").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    n, a = F.sum("n"), F.sum("a")
    return rows.agg(
        n.alias("lines"),
        (F.abs(a - n / 4) <= 5 * F.sqrt(n * 3 / 16)).alias("within_bounds"),
        F.bool_and((F.col("a") <= F.col("n")) & (F.col("a") == F.col("b"))).alias("subset_and_repeatable"),
        F.bool_or((F.col("a") > 0) & (F.col("a") < F.col("n"))).alias("equal_rows_apart"),
    )


def repartition_heavy_customer(spark, sf):
    """Lines, and whether none of 16 partitions has more than twice its share when one
    customer has a third of the lines, and all lines are there."""
    one = F.when(F.col("StockCode").cast("long") % 3 == 0, F.lit("1")).otherwise(F.col("CustomerID"))
    raw = _raw(spark, sf).withColumn("CustomerID", one)
    path = scratch_path(spark, "cleaned")
    sk.write_parquet(cl.clean(raw), path)
    lines = spark.read.parquet(path)
    dealt = cl.repartition_by_customer(lines, 16)
    hashes = F.sum(F.xxhash64(*lines.columns).cast("decimal(38,0)"))
    whole = lines.agg(hashes.alias("h")).scalar()
    parts = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), hashes.alias("h"))
    return parts.agg(
        F.sum("n").alias("lines"),
        (F.max("n") * 16 <= 2 * F.sum("n")).alias("spread"),
        (F.sum("h") == whole).alias("same_lines"),
    )


QUERIES: dict[str, Query] = {
    # scans, sinks, pipeline
    "scan_csv": scan_csv,
    "scan_parquet": scan_parquet,
    "scan_csv_strings": scan_csv_strings,
    "load_retail": load_retail,
    "ingest_raw": ingest_raw,
    "parquet_roundtrip": parquet_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "export_single_csv": export_single_csv,
    "scan_csv_reordered": scan_csv_reordered,
    "ingest_raw_extra_columns": ingest_raw_extra_columns,
    "clean_retail_extra_column": clean_retail_extra_column,
    "clean_retail_clashing_columns": clean_retail_clashing_columns,
    "customer_frequency_clashing_columns": customer_frequency_clashing_columns,
    "quality_waterfall_clashing_columns": quality_waterfall_clashing_columns,
    "scan_csv_mixed_headers": scan_csv_mixed_headers,
    "ingest_checksums": ingest_checksums,
    "run_all": run_all_query,
    "verify_outputs": verify_outputs_query,
    # cleaning
    "filter_cancelled": filter_cancelled,
    "filter_positive": filter_positive,
    "dedup_rows": dedup_rows,
    "require_customer": require_customer,
    "fill_description": fill_description,
    "parse_invoice_ts": parse_invoice_ts,
    "time_dimensions": time_dimensions,
    "order_key": order_key,
    "total_amount": total_amount,
    "clean_retail": lambda spark, sf: _clean(spark, sf),
    "repartition_by_key": repartition_by_key,
    "repartition_heavy_customer": repartition_heavy_customer,
    "quality_waterfall": quality_waterfall,
    # analyses
    "daily_sales": _on_clean(sa.daily_sales),
    "top20_products": _on_clean(sa.top_products),
    "country_sales": _on_clean(sa.country_sales),
    "customer_frequency": _on_clean(cu.customer_frequency),
    "hourly_orders": _on_clean(sa.hourly_orders),
    "rfm_scores": _on_clean(cu.rfm_scores),
    "rfm_segments": _on_clean(cu.rfm_segments),
    "baskets": _on_clean(bk.basket_table),
    "association_rules": _on_clean(bk.association_rules),
    "association_rules_description": association_rules_description,
    "association_rules_brand": association_rules_brand,
    "frequent_itemsets_brand": frequent_itemsets_brand,
    "association_rules_type": association_rules_type,
    "repurchase_summary": _on_clean(cu.repurchase_summary),
    "order_value_quantiles": _on_clean(cu.order_value_quantiles),
    "order_value_quantiles_approx": _on_clean(cu.order_value_quantiles_approx),
    "order_value_rank_error": order_value_rank_error,
    "order_value_rank_error_by_day": order_value_rank_error_by_day,
    "repurchase_gap_lines": _on_clean(cu.repurchase_gap_lines),
    "repurchase_gap_orders": _on_clean(cu.repurchase_gap_orders),
    "user_behavior_summary": _on_clean(cu.user_behavior_summary),
    "first_purchase_distribution": _on_clean(cu.first_purchase_distribution),
    "monthly_sales_trend": _on_clean(sa.monthly_sales_trend),
    "product_seasonality": _on_clean(sa.product_seasonality),
    "country_sales_growth": _on_clean(sa.country_sales_growth),
    # benchmark pipeline
    "bench_sum_by_date": _bench("InvoiceDate"),
    "bench_sum_by_country": _bench("Country"),
    "bench_sum_by_customer": _bench("CustomerID"),
    "sample_rows": sample_rows_query,
    "sample_rows_by_identity": sample_rows_by_identity,
}
