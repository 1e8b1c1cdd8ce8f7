"""Benchmark: the retail pipeline at one scale factor on a warm local session.

usage: BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Setup (not timed): derive the raw invoice lines from the driver tables and
land them as CSV in the raw zone. Timed, each the median of BENCH_RUNS runs,
with the ``noop`` sink so every aggregate is executed:

* clean_to_parquet   raw CSV -> cleaning plan -> cleaned Parquet
* quality_waterfall  the seven stage counts over the raw CSV
* the twelve analyses over the cleaned Parquet, one by one
* run_all            all twelve written as Parquet via the shared invoice rollup
* bench_sum_by_*     the simplified three-sum pipeline over the raw CSV

Prints one JSON line; ``value`` is the sum of the per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    from tillroll.operators.clean import clean, quality_waterfall
    from tillroll.plans.benchmark import bench_sum_by
    from tillroll.plans.registry import ANALYSES, run_all
    from tillroll.session import build_session, scratch_path
    from tillroll.sources.fixtures import raw_retail_lines
    from tillroll.sources.readers import read_raw
    from tillroll.sources.sinks import write_parquet, write_raw_csv

    spark = build_session(
        "tillroll-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, 2 * cpus)))),
        extra_conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    raw_zone = scratch_path(spark, "bench-raw")
    write_raw_csv(raw_retail_lines(spark, sf_dir), raw_zone)
    cleaned_zone = scratch_path(spark, "bench-cleaned")
    write_parquet(clean(read_raw(spark, raw_zone)), cleaned_zone)

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def clean_to_parquet() -> None:
        write_parquet(clean(read_raw(spark, raw_zone)), scratch_path(spark, "bench-clean-run"))

    jobs = [("clean_to_parquet", clean_to_parquet)]
    jobs.append(("quality_waterfall", lambda: noop(quality_waterfall(read_raw(spark, raw_zone)))))
    for name, fn in ANALYSES:
        jobs.append((name, lambda fn=fn: noop(fn(spark.read.parquet(cleaned_zone)))))
    jobs.append(
        (
            "run_all",
            lambda: run_all(
                spark, spark.read.parquet(cleaned_zone), scratch_path(spark, "bench-results"),
                fmt="parquet",
            ).collect(),
        )
    )
    for key, label in (("InvoiceDate", "date"), ("Country", "country"), ("CustomerID", "customer")):
        jobs.append(
            (f"bench_sum_by_{label}", lambda key=key: noop(bench_sum_by(read_raw(spark, raw_zone), key)))
        )

    # Warm-up: one pass over everything (JIT, file listing caches).
    for _, job in jobs:
        job()

    medians: dict[str, float] = {}
    for name, job in jobs:
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            job()
            times.append(time.perf_counter() - t0)
        medians[name] = round(statistics.median(times), 4)

    rows = spark.read.parquet(cleaned_zone).count()
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "retail_pipeline_total_median_sec",
                "value": round(sum(medians.values()), 4),
                "unit": "sec",
                "queries": medians,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "runs": runs,
                "cleaned_rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
