"""Grouping of events into episodes by time gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.scalars import elapsed


def gap_flag(df: DataFrame, key: str, start: str, stop: str, ident: str, hours: int = 12, running_max: bool = False, anchor: Column | None = None) -> DataFrame:
    """Add ``changed``: 0 if fewer than ``hours`` lie between the previous stop and this start, else 1.

    The previous stop is the preceding row's, or with ``running_max`` the latest so far; a first
    row takes ``anchor`` (a stored stop) where there is one.
    """
    w = Window.partitionBy(key).orderBy(start, ident)
    before = F.max(stop).over(w.rowsBetween(Window.unboundedPreceding, -1)) if running_max else F.lag(stop).over(w)
    if anchor is not None:
        before = F.coalesce(before, anchor)
    return df.withColumn("changed", F.when(elapsed("HOUR", before, F.col(start)) < hours, 0).otherwise(1))


def running_number(df: DataFrame, key: str, start: str, ident: str, changed: str = "changed") -> DataFrame:
    """Add ``episode``: the running sum of the change flags within a key."""
    w = Window.partitionBy(key).orderBy(start, ident).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("episode", F.sum(changed).over(w))


def representative(df: DataFrame, key: str, rank: str, start: str, ident: str) -> DataFrame:
    """Add ``stay_id``: the id of the row with the highest rank, then earliest start, then least id."""
    w = Window.partitionBy(key, "episode")
    return df.withColumn("stay_id", F.min_by(F.col(ident), F.struct(-F.col(rank), F.col(start), F.col(ident))).over(w))


def group_episodes(df: DataFrame, key: str, start: str, stop: str, ident: str, rank: str, hours: int = 12, running_max: bool = False) -> DataFrame:
    """All rows with episode, stay_id, stay_rank, stay_start, stay_stop and stay_days (1 at least).

    One shuffle on ``key`` serves the gap, the number, the representative and the span. Rows with
    a null start come first in their key. One key's rows are sorted in one task, as in any window.
    """
    out = running_number(gap_flag(df, key, start, stop, ident, hours, running_max), key, start, ident)
    out = representative(out, key, rank, start, ident)
    w = Window.partitionBy(key, "episode")
    out = out.withColumns({"stay_rank": F.max(rank).over(w), "stay_start": F.min(start).over(w), "stay_stop": F.max(stop).over(w)})
    return out.withColumn("stay_days", F.greatest(elapsed("DAY", F.col("stay_start"), F.col("stay_stop")), F.lit(1)))


def episode_table(members: DataFrame, key: str, *more: Column) -> DataFrame:
    """One row for each episode of :func:`group_episodes`, with ``more`` aggregates of its members."""
    return members.groupBy(key, "episode").agg(
        F.first("stay_id").alias("stay_id"), F.max("stay_rank").alias("stay_rank"), F.min("stay_start").alias("stay_start"),
        F.max("stay_stop").alias("stay_stop"), F.max("stay_days").alias("stay_days"), F.count("*").alias("members"), *more,
    )


def touched(history: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """All rows of ``history`` whose key occurs in ``delta``."""
    return history.join(delta.select(key).distinct(), key, "left_semi")

