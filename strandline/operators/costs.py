"""Simulation of interventions on scored stays."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.metrics import at_thresholds


def days_needed(p: float, d: float) -> int:
    """Days of an intervention of ``p`` a day to lower a risk by ``d``."""
    return math.ceil(math.log(1 - d) / math.log(1 - p))


def intervention(days: int) -> Column:
    """Cost of an intervention: its days at the daily cost or the mean earlier one, whichever is more; nulls are passed over."""
    return days * F.coalesce(F.greatest("cost_per_day", "prev_cost"), F.lit(0.0))


def with_costs(df: DataFrame, i: Column) -> DataFrame:
    """``df`` with stand-in costs by a number of each row."""
    return df.withColumns({"cost_per_day": ((i * 7) % 50).cast("double"), "prev_cost": F.when(i % 4 != 0, (i * 3) % 60).cast("double"), "readmission_cost": F.when(i % 5 != 0, i % 1000).cast("double")})


def gains(df: DataFrame, p: float = 0.1, d: float = 0.2) -> DataFrame:
    """Rows (prob, hit, cost_per_day, prev_cost, readmission_cost) with intervention and gain."""
    days = days_needed(p, d)
    real = 1 - (1 - p) ** days
    out = df.withColumn("intervention", intervention(days))
    return out.withColumn("gain", F.when(F.col("hit"), real * F.col("prob") * F.coalesce("readmission_cost", F.lit(0.0)) - F.col("intervention")).otherwise(0.0))


def saved(df: DataFrame, by: list[str]) -> DataFrame:
    """Total gain, cost of true positives' readmissions, and the share saved (0 if there are none)."""
    out = df.groupBy(*by).agg(F.sum("gain").alias("gain"), F.sum(F.when(F.col("hit") & (F.col("y") == 1), F.coalesce("readmission_cost", F.lit(0.0))).otherwise(0.0)).alias("at_stake"))
    return out.withColumn("pct_saved", F.when(F.col("at_stake") > 0, 100 * F.col("gain") / F.col("at_stake")).otherwise(0.0))


#: Shares of rows that may be treated, for the scorer of a search.
FRACTIONS = [round(0.05 * i, 2) for i in range(1, 11)]


def cost_score(df: DataFrame) -> DataFrame:
    """(model, cost_score): the most that any cut-off 1 - share saves, in per cent of the costs at stake."""
    cut = at_thresholds(df, [round(1 - f, 2) for f in FRACTIONS])
    return saved(gains(cut), ["model", "t"]).groupBy("model").agg(F.max("pct_saved").alias("cost_score"))


def grid(step: float = 0.05, top: float = 0.5) -> list[tuple[float, float, int, float]]:
    """All (p, d, days, real reduction) with p <= d."""
    values = [round(step * i, 2) for i in range(1, int(top / step + 0.5) + 1)]
    return [(p, d, days_needed(p, d), 1 - (1 - p) ** days_needed(p, d)) for p in values for d in values if p <= d]
