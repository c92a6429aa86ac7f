"""Metrics of scored rows (model, p, y), drift, and threshold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_score(df: DataFrame, ranges: int = 4096) -> DataFrame:
    """Positives and negatives at each distinct score of a model, with those at or above it.

    Rows are counted for each score first. The running sums are taken within each of
    ``ranges`` equal ranges of the score, to which the sums of the ranges above are added: no
    task has to sort all scores of a model.
    """
    n = df.groupBy("model", "p").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    n = n.withColumn("_range", F.least(F.greatest(F.floor(F.col("p") * ranges), F.lit(0)), F.lit(ranges - 1)))
    parts = n.groupBy("model", "_range").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    before = Window.partitionBy("model").orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    above = parts.select("model", "_range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_pos", "_neg")])
    w = Window.partitionBy("model", "_range").orderBy(F.col("p").desc()).rowsBetween(Window.unboundedPreceding, 0)
    within = n.withColumns({"tp": F.sum("pos").over(w), "fp": F.sum("neg").over(w)}).join(above, ["model", "_range"])
    return within.withColumns({"tp": F.col("tp") + F.col("_pos"), "fp": F.col("fp") + F.col("_neg")}).drop("_range", "_pos", "_neg")


def roc_auc(df: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties half; null with a single class."""
    s = by_score(df)
    # negatives below a score: all of them less those at or above it
    total = s.groupBy("model").agg(F.sum("pos").alias("np"), F.sum("neg").alias("nn"))
    area = s.join(total, "model").groupBy("model").agg(F.try_divide(F.sum(F.col("pos") * (F.col("nn") - F.col("fp") + F.col("neg") / 2)), F.max(F.col("np") * F.col("nn"))).alias("roc_auc"))
    return area


def average_precision(df: DataFrame) -> DataFrame:
    """Sum over distinct scores of the step in recall times the precision there."""
    s = by_score(df)
    total = s.groupBy("model").agg(F.sum("pos").alias("np"))
    return s.join(total, "model").groupBy("model").agg(F.try_divide(F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))), F.max("np")).alias("avg_precision"))


def brier(df: DataFrame) -> DataFrame:
    """Mean squared error of the probability."""
    return df.groupBy("model").agg(F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier"))


def confusion(df: DataFrame, by: list[str], hit: Column) -> DataFrame:
    """tp, fp, fn, tn, precision, recall and f1 (0 where undefined)."""
    y = F.col("y") == 1
    out = df.groupBy(*by).agg(F.count_if(hit & y).alias("tp"), F.count_if(hit & ~y).alias("fp"), F.count_if(~hit & y).alias("fn"), F.count_if(~hit & ~y).alias("tn"))
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = out.withColumns({"precision": safe(F.col("tp"), F.col("tp") + F.col("fp")), "recall": safe(F.col("tp"), F.col("tp") + F.col("fn"))})
    return out.withColumn("f1", safe(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))


def at_thresholds(df: DataFrame, thresholds: list[float]) -> DataFrame:
    """Each row once for each threshold ``t``, with ``hit``."""
    return df.withColumn("t", F.explode(F.array(*[F.lit(t) for t in thresholds]))).withColumn("hit", F.col("p") >= F.col("t"))


def histogram(df: DataFrame, p: str = "p", bins: int = 10) -> DataFrame:
    """Rows in each of ``bins`` equal bins of [0, 1], outer ones open, empty ones included."""
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    counts = df.groupBy(F.least(F.greatest(F.floor(F.col(p) * bins), F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return F.broadcast(spine).join(counts, "bin", "left").fillna(0, ["n"])


def score_bins(df: DataFrame, *by: str, p: str = "p", bins: int = 10) -> DataFrame:
    """(by, bin, n): rows of each group in each equal bin of [0, 1] that has any; outer bins are open."""
    bin_ = F.least(F.greatest(F.floor(F.col(p) * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    return df.groupBy(*by, bin_.alias("bin")).agg(F.count("*").alias("n"))


def summed_bins(counts: DataFrame, *by: str, bins: int = 10) -> DataFrame:
    """Counts of several periods as one histogram of each group, empty bins included."""
    every = counts.select(*by).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(counts.groupBy(*by, "bin").agg(F.sum("n").alias("n")), [*by, "bin"], "left").fillna(0, ["n"])


def psi_by(base: DataFrame, current: DataFrame, by: str, eps: float = 1e-8) -> DataFrame:
    """Population stability index of two sets of histograms (by, bin, n), one row for each of ``by`` in both."""
    x = base.select(by, "bin", (F.col("n") + eps).alias("b")).join(current.select(by, "bin", (F.col("n") + eps).alias("c")), [by, "bin"])
    total = x.groupBy(by).agg(F.sum("b").alias("tb"), F.sum("c").alias("tc"))
    x = x.join(total, by).select(by, (F.col("b") / F.col("tb")).alias("b"), (F.col("c") / F.col("tc")).alias("c"))
    return x.groupBy(by).agg(F.sum((F.col("c") - F.col("b")) * F.ln(F.col("c") / F.col("b"))).alias("psi"))


def psi(base: DataFrame, current: DataFrame, eps: float = 1e-8) -> DataFrame:
    """Population stability index of two histograms (bin, n)."""
    b, c = base.select("bin", F.col("n").alias("b")), current.select("bin", F.col("n").alias("c"))
    total = b.agg(F.sum(F.col("b") + eps).alias("tb")), c.agg(F.sum(F.col("c") + eps).alias("tc"))
    x = b.join(c, "bin").join(F.broadcast(total[0])).join(F.broadcast(total[1]))
    pb, pc = (F.col("b") + eps) / F.col("tb"), (F.col("c") + eps) / F.col("tc")
    return x.agg(F.sum((pc - pb) * F.ln(pc / pb)).alias("psi"))


def retune(periods: DataFrame, drift: DataFrame, every: int = 6, most: float = 0.2) -> DataFrame:
    """One row ``retune``: whether some periods (period) have gone by, a multiple of ``every``, or any ``psi`` of ``drift`` is above ``most``."""
    n = periods.agg(F.countDistinct("period").alias("elapsed"))
    x = n.crossJoin(drift.agg(F.max("psi").alias("psi")))  # one row each
    return x.select("elapsed", (((F.col("elapsed") > 0) & (F.col("elapsed") % every == 0)) | F.coalesce(F.col("psi") > most, F.lit(False))).alias("retune"))


def folds(df: DataFrame, key: str, label: str, k: int) -> DataFrame:
    """A stratified fold 0..k-1 for each row, in the order of a hash of the key within a label.

    Labels have few values, so each is ranked in 256 parts by hash whose sizes are summed first.
    """
    h = df.withColumn("_h", F.md5(F.col(key).cast("string"))).withColumn("_part", F.substring("_h", 1, 2))
    sizes = h.groupBy(label, "_part").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(label).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(label, "_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy(label, "_part").orderBy("_h", key)) - 1
    return h.withColumn("_rank", rank).join(F.broadcast(base), [label, "_part"]).withColumn("fold", ((F.col("_rank") + F.col("_base")) % k).cast("int")).drop("_h", "_part", "_rank", "_base")
