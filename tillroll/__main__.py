"""Command line: the full batch pipeline, or the benchmark grid.

    python -m tillroll run --raw RAW --cleaned CLEANED --results RESULTS \
        [--source CSV] [--waterfall] [--export FOLDER] \
        [--raw-format csv|parquet] [--result-format csv|parquet] [--partitions N]
    python -m tillroll perf --raw RAW [--fractions 0.25,0.5,0.75,1] [--shuffle 2,4,8,16] --out OUT
    python -m tillroll waterfall --raw RAW --out OUT
    python -m tillroll ingest --source CSV --target RAW [--mode overwrite|skip]

Paths are any Hadoop-compatible URIs. Master, memory and cores come from
``spark-submit``; run settings from ``--conf spark.tillroll.<name>=...``
(see ``tillroll.config.Settings``). Exit code 1 on failure.
"""

from __future__ import annotations

import argparse
import logging
import sys

from tillroll.config import Settings
from tillroll.operators.clean import quality_waterfall
from tillroll.plans.benchmark import run_grid
from tillroll.plans.registry import Paths, run_pipeline
from tillroll.session import build_session
from tillroll.sources.readers import read_raw
from tillroll.sources.sinks import ingest_raw, write_result

log = logging.getLogger("tillroll")


def _floats(text: str) -> list[float]:
    return [float(x) for x in text.split(",") if x]


def _ints(text: str) -> list[int]:
    return [int(x) for x in text.split(",") if x]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tillroll")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="raw zone -> cleaned Parquet -> 12 results")
    run.add_argument("--raw", required=True)
    run.add_argument("--cleaned", required=True)
    run.add_argument("--results", required=True)
    run.add_argument("--raw-format", default="csv")
    run.add_argument("--result-format", default=None, help="csv | parquet (default: settings)")
    run.add_argument("--partitions", type=int, default=None)
    run.add_argument("--export", default=None, help="folder for single-file CSVs of bounded results")
    run.add_argument("--source", default=None, help="raw CSV to land in the raw zone first")
    run.add_argument("--waterfall", action="store_true", help="also write the cleaning waterfall")
    perf = sub.add_parser("perf", help="timing grid of the simplified pipeline")
    perf.add_argument("--raw", required=True)
    perf.add_argument("--raw-format", default="csv")
    perf.add_argument("--fractions", type=_floats, default=[0.25, 0.5, 0.75, 1.0])
    perf.add_argument("--shuffle", type=_ints, default=[2, 4, 8, 16])
    perf.add_argument("--out", required=True)
    ing = sub.add_parser("ingest", help="land a raw CSV in the raw zone")
    ing.add_argument("--source", required=True)
    ing.add_argument("--target", required=True)
    ing.add_argument("--mode", default=None, help="overwrite | skip (default: settings)")
    wf = sub.add_parser("waterfall", help="rows left after each cleaning rule")
    wf.add_argument("--raw", required=True)
    wf.add_argument("--raw-format", default="csv")
    wf.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = build_session("tillroll")
    try:
        if args.cmd == "run":
            paths = Paths(args.raw, args.cleaned, args.results)
            manifest = run_pipeline(
                spark, paths, raw_fmt=args.raw_format, result_fmt=args.result_format,
                partitions=args.partitions, export_root=args.export,
                source=args.source, waterfall=args.waterfall,
            )
            rows = manifest.collect()  # one row per result table (12)
            for r in rows:
                log.info("%-28s rows=%-10d ok=%s non_empty=%s", r.name, r.row_count, r.ok, r.non_empty)
            return 0 if all(r.ok for r in rows) else 1
        if args.cmd == "ingest":
            mode = args.mode or Settings.from_conf(spark).ingest_mode
            ingest_raw(spark, args.source, args.target, mode=mode)
            return 0
        if args.cmd == "perf":
            grid = run_grid(spark, read_raw(spark, args.raw, args.raw_format),
                            args.fractions, args.shuffle)
            write_result(grid, args.out, fmt="csv")
            return 0
        write_result(quality_waterfall(read_raw(spark, args.raw, args.raw_format)), args.out)
        return 0
    except Exception:  # noqa: BLE001 - logged with stack trace, reported by exit code
        log.exception("tillroll %s failed", args.cmd)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
