"""tillroll: retail invoice-line analytics as Spark DataFrame plans.

Raw invoice lines are read from CSV or Parquet, cleaned in one lazy plan,
written to Parquet, and turned into twelve result tables (daily, hourly,
monthly, seasonal and country sales, growth, top products, customer
frequency, RFM segments, first purchases, repurchase behaviour and
association rules). Every step is a ``DataFrame -> DataFrame`` function.
"""

from tillroll.config import Settings
from tillroll.operators.clean import clean, quality_waterfall
from tillroll.plans.registry import ANALYSES, Paths, run_all, run_pipeline, verify_outputs
from tillroll.session import build_session
from tillroll.sources.readers import load_retail, read_raw

__all__ = [
    "ANALYSES",
    "Paths",
    "Settings",
    "build_session",
    "clean",
    "load_retail",
    "quality_waterfall",
    "read_raw",
    "run_all",
    "run_pipeline",
    "verify_outputs",
]
