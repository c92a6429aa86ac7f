"""Data-quality checks: each gives one row of counts, all 0 where the data are sound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows on both sides, keys missing from ``a``, keys only in ``a``, and repeated keys of ``a``."""
    n = a.groupBy(key).agg(F.count("*").alias("na"))
    m = b.groupBy(key).agg(F.count("*").alias("nb"))
    both = n.join(m, key, "full")
    return both.agg(
        F.coalesce(F.sum("na"), F.lit(0)).alias("rows_a"), F.coalesce(F.sum("nb"), F.lit(0)).alias("rows_b"),
        F.count_if(F.col("na").isNull()).alias("missing"), F.count_if(F.col("nb").isNull()).alias("extra"), F.count_if(F.col("na") > 1).alias("repeated"),
    )


def unique(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, and the difference."""
    return df.agg(F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_keys")).withColumn("repeated", F.col("n_rows") - F.col("n_keys"))


def violations(df: DataFrame, **rules: Column) -> DataFrame:
    """How many rows break each rule, in one pass."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])


def nulls(df: DataFrame, *columns: str) -> DataFrame:
    """Null values of each column."""
    return violations(df, **{f"null_{c}": F.col(c).isNull() for c in columns})


def flags(df: DataFrame, *columns: str, **rules: Column) -> DataFrame:
    """Values other than 0 and 1, nulls included, whether a column is all 0, and how many rows break each further rule, in one pass."""
    bad = [F.count_if(F.col(c).isNull() | ~F.col(c).isin(0, 1)).alias(f"bad_{c}") for c in columns]
    zero = [F.coalesce((F.max(c) == 0).cast("int"), F.lit(1)).alias(f"zero_{c}") for c in columns]
    return df.agg(*bad, *zero, *[F.count_if(c).alias(n) for n, c in rules.items()])


def repeated(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def demand(report: DataFrame, *zero: str, name: str = "check") -> DataFrame:
    """The one-row report of the check ``name``; raises if any of the named counts is not 0."""
    row = report.first()
    broken = {c: row[c] for c in zero if row[c]}
    if broken:
        raise ValueError(f"{name} failed: {broken}")
    return report
