"""Commerce analytics on Spark: staging, star schema, marts, quality checks and reports.

Every operator takes DataFrames and returns a DataFrame.
"""

from tradewind.pipeline import run_pipeline
from tradewind.plans.checks import WAREHOUSE_CHECKS, quality_report
from tradewind.plans.marts import build_marts
from tradewind.plans.warehouse import build_warehouse
from tradewind.settings import Settings

__all__ = [
    "Settings",
    "WAREHOUSE_CHECKS",
    "build_marts",
    "build_warehouse",
    "quality_report",
    "run_pipeline",
]
