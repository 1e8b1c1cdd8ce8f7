"""Run settings, read from the Spark session configuration.

Every setting can be given as ``--conf spark.tillroll.<name>=<value>`` to
``spark-submit`` (or ``SparkSession.builder.config``). A value that does not
parse as the setting's type falls back to the default with a warning, so a
typo never changes a result silently into something else.
"""

from __future__ import annotations

import dataclasses
import logging
from dataclasses import dataclass

from pyspark.sql import SparkSession

PREFIX = "spark.tillroll."
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Settings:
    min_support: float = 0.01  # association rules: itemset support threshold
    min_confidence: float = 0.2  # association rules: rule confidence threshold
    fpgrowth_partitions: int = 0  # FP-Growth item groups / partitions; 0 = input partitions
    repartition: int = 0  # C12 hash repartition by CustomerID; 0 = off
    result_format: str = "csv"  # csv | parquet
    ingest_mode: str = "overwrite"  # overwrite | skip
    concurrent_jobs: int = 4  # result tables computed at once by run_all
    exact_quantiles: bool = True  # order-value quartiles: exact, or within a rank error
    rollup: bool = True  # share one invoice rollup among the results

    @classmethod
    def from_conf(cls, spark: SparkSession, prefix: str = PREFIX) -> Settings:
        values = {}
        for f in dataclasses.fields(cls):
            raw = spark.conf.get(prefix + f.name, None)
            if raw is None:
                continue
            try:
                values[f.name] = _parse(raw, f.default)
            except ValueError:
                log.warning("ignoring %s%s=%r: not a valid %s", prefix, f.name, raw,
                            type(f.default).__name__)
        return cls(**values)


def _parse(raw: str, default):
    text = raw.strip()
    if isinstance(default, bool):
        low = text.lower()
        if low in ("1", "true", "yes", "y"):
            return True
        if low in ("0", "false", "no", "n"):
            return False
        raise ValueError(raw)
    if isinstance(default, int):
        return int(text)
    if isinstance(default, float):
        return float(text)
    if not text:
        raise ValueError(raw)
    return text
