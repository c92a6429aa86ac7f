"""Queries of the library by key, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.plans import months, period, scoring, stays, tables
from strandline.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "entry", "months", "period", "scoring", "stays", "tables"]


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query: episodes with look-back, look-ahead and readmission flags."""
    return QUERIES["build_helper_utilization"](spark, sf_dir)
