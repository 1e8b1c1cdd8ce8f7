"""The twelve result tables, the full batch pipeline and the output manifest."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.config import Settings
from tillroll.operators.baskets import association_rules
from tillroll.operators.clean import clean, clean_with_waterfall
from tillroll.operators.customers import (
    customer_frequency,
    first_purchase_distribution,
    rfm_segments,
    user_behavior_summary,
)
from tillroll.operators.sales import (
    country_sales,
    country_sales_growth,
    daily_sales,
    hourly_orders,
    monthly_sales_trend,
    product_seasonality,
    top_products,
)
from tillroll.operators.profiles import customer_profile
from tillroll.operators.rollup import invoice_rollup
from tillroll.session import materialize, scratch_scope
from tillroll.sources.readers import _check_format, load_retail, read_table
from tillroll.sources.sinks import export_single_csv, ingest_raw, write_parquet, write_result, written_rows

Analysis = Callable[[DataFrame], DataFrame]

# The result tables in their fixed run order.
ANALYSES: tuple[tuple[str, Analysis], ...] = (
    ("daily_sales", daily_sales),
    ("top20_products", top_products),
    ("country_sales", country_sales),
    ("customer_frequency", customer_frequency),
    ("hourly_orders", hourly_orders),
    ("rfm_segments", rfm_segments),
    ("association_rules", association_rules),
    ("user_behavior_summary", user_behavior_summary),
    ("first_purchase_distribution", first_purchase_distribution),
    ("monthly_sales_trend", monthly_sales_trend),
    ("product_seasonality", product_seasonality),
    ("country_sales_growth", country_sales_growth),
)
RESULT_NAMES: tuple[str, ...] = tuple(n for n, _ in ANALYSES)
# Results that need individual lines (item codes, descriptions, baskets);
# every other result is computed equally from the invoice rollup.
LINE_GRAIN: frozenset[str] = frozenset({"top20_products", "association_rules"})
# Results that are computed from one row for each customer.
CUSTOMER_GRAIN: frozenset[str] = frozenset(
    {"customer_frequency", "rfm_segments", "first_purchase_distribution"}
)
# Results whose size does not grow with the number of customers, lines or
# rules (calendar days and months, countries, hours, top 20, seven metrics):
# only these may be exported as one file.
BOUNDED_RESULTS: frozenset[str] = frozenset(RESULT_NAMES) - {
    "customer_frequency",
    "rfm_segments",
    "association_rules",
}


@dataclass(frozen=True)
class Paths:
    """Zones of one pipeline run; any Hadoop-compatible URI."""

    raw: str
    cleaned: str
    results: str

    def result(self, name: str) -> str:
        return f"{self.results.rstrip('/')}/{name}"


def configured(name: str, fn: Analysis, settings: Settings) -> Analysis:
    """Bind the run settings that an analysis takes."""
    if name == "association_rules":
        return partial(
            fn,
            min_support=settings.min_support,
            min_confidence=settings.min_confidence,
            num_partitions=settings.fpgrowth_partitions or None,
        )
    if name == "user_behavior_summary":
        return partial(fn, exact_quantile=settings.exact_quantiles)
    return fn


def run_all(
    spark: SparkSession,
    cleaned: DataFrame,
    results_root: str,
    *,
    fmt: str | None = None,
    names: Sequence[str] | None = None,
    rollup: bool | None = None,
    concurrent_jobs: int | None = None,
    settings: Settings | None = None,
    export_root: str | None = None,
) -> DataFrame:
    """Compute and write each result once; return the manifest.

    With ``export_root``, each bounded result (``BOUNDED_RESULTS``) is also
    exported as a single CSV file, read back from the written result so that
    the analysis itself runs once (S11).

    ``cleaned`` should be a scan of the cleaned zone. With ``rollup`` the
    lines are aggregated once to invoice grain, written below the checkpoint
    folder, and the ten invoice-grain results read that instead of scanning
    and shuffling the line table ten times; the results are identical. The
    results about customers share one aggregate of it, the customer profile.

    The results are independent, so up to ``concurrent_jobs`` of them are
    submitted at once from driver threads; the scheduler fills task slots a
    single small result would leave idle. ``concurrent_jobs=1`` runs them in
    the fixed order.
    """
    settings = settings or Settings.from_conf(spark)
    fmt = _check_format(fmt or settings.result_format)
    rollup = settings.rollup if rollup is None else rollup
    concurrent_jobs = concurrent_jobs or settings.concurrent_jobs
    wanted = set(names or RESULT_NAMES)
    root = results_root.rstrip("/")
    todo = [(name, configured(name, fn, settings)) for name, fn in ANALYSES if name in wanted]
    # Intermediate tables (rollup, rankings) are removed once all results are written.
    with scratch_scope(spark):
        _write_results(spark, cleaned, root, todo, fmt, rollup, concurrent_jobs,
                       export_root)
    return verify_outputs(spark, root, [n for n, _ in todo], fmt=fmt)


def _write_results(spark, cleaned, root, todo, fmt, rollup, concurrent_jobs,
                   export_root) -> None:
    wanted = {n for n, _ in todo}
    invoice_grain = customers = cleaned
    if rollup and wanted - LINE_GRAIN:
        invoice_grain = customers = materialize(invoice_rollup(cleaned), "invoice-rollup")
    if rollup and wanted & (CUSTOMER_GRAIN | {"user_behavior_summary"}):
        customers = materialize(customer_profile(invoice_grain), "customers")

    def write_one(name: str, fn: Analysis) -> None:
        if name == "user_behavior_summary":
            result = fn(invoice_grain, customers=customers)
        else:
            result = fn(cleaned if name in LINE_GRAIN else customers if name in CUSTOMER_GRAIN else invoice_grain)
        path = f"{root}/{name}"
        write_result(result, path, fmt=fmt)
        if export_root and name in BOUNDED_RESULTS:
            if fmt == "parquet":
                written = spark.read.parquet(path)
            else:  # typed read-back keeps the numbers exactly as written
                written = spark.read.option("header", "true").schema(result.schema).csv(path)
            export_single_csv(written, f"{export_root.rstrip('/')}/{name}.csv")

    if concurrent_jobs <= 1:
        for name, fn in todo:
            write_one(name, fn)
    else:
        with ThreadPoolExecutor(max_workers=concurrent_jobs) as pool:
            # A copy of this context puts the thread's tables into this run's scope.
            for done in [pool.submit(copy_context().run, write_one, n, fn) for n, fn in todo]:
                done.result()  # re-raises the first failure


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")))


def verify_outputs(
    spark: SparkSession,
    results_root: str,
    names: Sequence[str] = RESULT_NAMES,
    *,
    fmt: str = "csv",
) -> DataFrame:
    """``(name, row_count, ok, non_empty)`` for every expected result.

    ``ok`` means the output was committed (``_SUCCESS`` present) and its files
    are those that were written, ``non_empty`` that it has rows: a committed
    result may rightly have none. The rows were counted when the result was
    written (``sinks.write_result``), so no data is read; only outputs without
    such a note, as of an append, are counted anew.
    """
    root = results_root.rstrip("/")
    rows = []
    for name in names:
        path = f"{root}/{name}"
        if not _exists(spark, path):
            rows.append((name, 0, False))
        else:
            noted = written_rows(spark, path)
            rows.append((name, *(noted or (read_table(spark, path, fmt).count(), True))))
    out = spark.createDataFrame(rows, "name string, row_count long, ok boolean").coalesce(1)
    return out.withColumn("non_empty", F.col("row_count") > 0)


def run_pipeline(
    spark: SparkSession,
    paths: Paths,
    *,
    raw_fmt: str = "csv",
    result_fmt: str | None = None,
    partitions: int | None = None,
    settings: Settings | None = None,
    export_root: str | None = None,
    source: str | None = None,
    waterfall: bool = False,
) -> DataFrame:
    """[source ->] raw zone -> clean -> cleaned Parquet -> twelve results -> manifest.

    ``source`` is first landed in the raw zone (``settings.ingest_mode``:
    overwrite, or skip if present). The raw zone is loaded with the column
    check (``load_retail``). With ``waterfall`` the rows left after each
    cleaning rule are written as ``quality_waterfall`` next to the results.
    The cleaned table is written once and re-read, which cuts the lineage
    between the cleaning shuffle and the analyses. Unset arguments come from
    ``settings`` (default: ``spark.tillroll.*`` session configuration).
    """
    settings = settings or Settings.from_conf(spark)
    if source:
        ingest_raw(spark, source, paths.raw, mode=settings.ingest_mode)
    raw = load_retail(spark, paths.raw, raw_fmt)
    parts = partitions or settings.repartition or None
    with scratch_scope(spark):
        if waterfall:
            cleaned, stages = clean_with_waterfall(raw, parts)
            write_result(
                stages, paths.result("quality_waterfall"), fmt=result_fmt or settings.result_format
            )
        else:
            cleaned = clean(raw, parts)
        write_parquet(cleaned, paths.cleaned)
    return run_all(
        spark,
        spark.read.parquet(paths.cleaned),
        paths.results,
        fmt=result_fmt,
        settings=settings,
        export_root=export_root,
    )
