"""Costs in rounded currency, evaluation of periods, reports and search scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import scalars as S
from strandline.operators import costs as K
from strandline.operators import metrics as M
from strandline.plans.base import SCORES, STAYS, query, scores, stays
from strandline.plans.tables import CONF, COST, FEATS, GAIN, THRESHOLDS, TS, costed, feats
from strandline.sources import io
from strandline.sources.io import table

# ---- costs --------------------------------------------------------------------------
_money = lambda c: f"({c} / CAST(100 AS DOUBLE))"


@query("SELECT o_orderkey AS stay_id, coalesce(procedures, 0) AS procedures, coalesce(medications, 0) AS medications FROM orders LEFT JOIN (SELECT l_orderkey, round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS procedures, round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END), 2) AS medications FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def agg_sum_round(s, d):
    """Rounded sums of the child rows of each encounter; encounters without any have 0."""
    part = lambda f: F.round(F.sum(F.when(F.col("l_returnflag") == f, F.col("l_extendedprice"))), 2)
    sums = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("stay_id")).agg(part("R").alias("procedures"), part("A").alias("medications"))
    return table(s, d, "orders").select(F.col("o_orderkey").alias("stay_id")).join(sums, "stay_id", "left").fillna(0.0, ["procedures", "medications"])


def _priced(s: SparkSession, d: str) -> DataFrame:
    return stays(s, d).withColumns({c: F.col(c) / 100 for c in ("claim", "base", "procedures", "medications")})


@query(f"WITH {STAYS} SELECT stay_id, round(greatest({_money('claim')}, {_money('base')} + {_money('procedures')} + {_money('medications')}), 2) AS total FROM stays")
def cost_total(s, d):
    return _priced(s, d).select("stay_id", S.total_cost(F.col("claim"), F.col("base"), F.col("procedures"), F.col("medications")).alias("total"))


@query(f"WITH {STAYS} SELECT stay_id, CAST(round(CAST(greatest({_money('claim')} - {_money('base')}, {_money('procedures')} + {_money('medications')}) / greatest(date_sub('day', start, stop), 1) AS DECIMAL(30,10)), 2) AS DOUBLE) AS per_day FROM stays")
def cost_per_day(s, d):
    return _priced(s, d).select("stay_id", S.daily_cost(F.col("claim"), F.col("base"), F.col("start"), F.col("stop"), F.col("procedures"), F.col("medications")).alias("per_day"))


@query(f"WITH {SCORES}, {COST} SELECT doc_id, model, p, total, per_day FROM scores JOIN cost ON stay_id = doc_id")
def join_costs_scores(s, d):
    """Cost columns beside scores, by the stay's id."""
    return scores(s, d).select("doc_id", "model", "p").join(costed(stays(s, d)).select(F.col("stay_id").alias("doc_id"), "total", "per_day"), "doc_id")


def _costly(s: SparkSession, d: str) -> DataFrame:
    """Scores with the stand-in costs of their rows."""
    return K.with_costs(scores(s, d), F.col("doc_id")).withColumn("prob", F.col("p"))


@query(f"{GAIN} SELECT DISTINCT doc_id, 3 * coalesce(greatest(cost_per_day, prev_cost), 0) AS cost FROM k")
def intervention_cost(s, d):
    return _costly(s, d).select("doc_id", K.intervention(K.days_needed(0.1, 0.2)).alias("cost")).distinct()


#: Cut-offs of the search score.
_CUTS = "(VALUES " + ", ".join(f"(CAST({round(1 - f, 2)} AS DOUBLE))" for f in K.FRACTIONS) + ") ts(t)"


@query(GAIN.replace(TS, _CUTS) + " SELECT model, round(max(CASE WHEN at_stake > 0 THEN 100 * gain / at_stake ELSE 0 END), 3) AS cost_score FROM tot GROUP BY model")
def cost_score(s, d):
    """The most that any cut-off saves, for each model."""
    return K.cost_score(_costly(s, d)).withColumn("cost_score", F.round("cost_score", 3))


# ---- predictions --------------------------------------------------------------------
@query(f"WITH {SCORES} SELECT doc_id, 'a' AS model, p FROM scores WHERE model = 'a' UNION ALL SELECT doc_id, 'b', p FROM scores WHERE model = 'b' ORDER BY doc_id, model")
def merge_predictions(s, d):
    """The prediction tables of two models, stacked and in order."""
    x = scores(s, d).select("doc_id", "model", "p")
    tables = [io.stored(x.where(F.col("model") == m), f"predictions-{m}") for m in "ab"]
    return tables[0].unionByName(tables[1]).orderBy("doc_id", "model")


@query(f"WITH {SCORES} SELECT model, period, round(avg((p - y) * (p - y)), 9) AS brier, count(*) AS n FROM (SELECT *, '2024-01-31' AS period FROM scores UNION ALL SELECT *, '2024-02-29' FROM scores WHERE doc_id % 2 = 0) GROUP BY 1, 2")
def append_results(s, d):
    """Metric rows of each period, appended under the period; a period written twice stands once."""
    path, x = io.scratch(s, "results"), scores(s, d)
    for period, rows in (("2024-01-31", x), ("2024-02-29", x.where("doc_id % 2 = 0")), ("2024-02-29", x.where("doc_id % 2 = 0"))):
        row = rows.groupBy("model").agg(F.round(F.avg(F.pow(F.col("p") - F.col("y"), 2)), 9).alias("brier"), F.count("*").alias("n"))
        io.write_snapshot(row.withColumn("period", F.lit(period)), path, "period")
    return s.read.parquet(path).withColumn("period", F.col("period").cast("string"))


# ---- drift --------------------------------------------------------------------------
#: A history of scores: fourteen months; the last three have scores of their own, as if the rows had changed.
HISTORY_FROM, HISTORY_MONTHS = "2023-01-31", 14
_HISTORY = f"""{SCORES}, months AS (SELECT m, last_day(DATE '{HISTORY_FROM}' + to_months(CAST(m AS INTEGER)) - INTERVAL 15 DAY) AS period FROM range({HISTORY_MONTHS}) r(m)),
 hist AS (SELECT model, doc_id, period, m, CASE WHEN m >= 11 AND model = 'a' THEN p * p ELSE p END AS p FROM scores, months WHERE doc_id % {HISTORY_MONTHS} = m),
 h AS (SELECT model, period, least(greatest(CAST(floor(p * 10) AS INTEGER), 0), 9) AS bin, count(*) AS n FROM hist GROUP BY 1, 2, 3)"""
_SPANS = "f AS (SELECT q.model, r.bin, coalesce(sum(n) FILTER (period <= DATE '2023-06-30'), 0) + 1e-8 AS b, coalesce(sum(n) FILTER (period > DATE '2023-11-30'), 0) + 1e-8 AS c FROM (SELECT DISTINCT model FROM h) q CROSS JOIN range(10) r(bin) LEFT JOIN h ON h.model = q.model AND h.bin = r.bin GROUP BY 1, 2)"
_PSIS = f"{_HISTORY}, {_SPANS}, w AS (SELECT model, b / sum(b) OVER (PARTITION BY model) AS b, c / sum(c) OVER (PARTITION BY model) AS c FROM f), psis AS (SELECT model, round(sum((c - b) * ln(c / b)), 6) AS psi FROM w GROUP BY model)"


def score_history(s: SparkSession, d: str) -> DataFrame:
    """Bin counts (model, period, bin, n) of scores, appended month by month; counts of any span of months add up."""
    path = io.scratch(s, "score-bins")
    x = scores(s, d).withColumn("m", (F.col("doc_id") % HISTORY_MONTHS).cast("int"))
    x = x.withColumns({"p": F.when((F.col("m") >= 11) & (F.col("model") == "a"), F.col("p") * F.col("p")).otherwise(F.col("p")), "period": F.last_day(F.add_months(F.date_sub(F.lit(HISTORY_FROM).cast("date"), 15), F.col("m")))})
    x = io.stored(x, "scored")
    M.score_bins(x.where("m < 12"), "model", "period").write.mode("append").parquet(path)
    for m in (12, 13):  # each month adds its own counts and reads no score again
        M.score_bins(x.where(F.col("m") == m), "model", "period").write.mode("append").parquet(path)
    return s.read.parquet(path)


def _drift(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The history, and the PSI of each model's last months against its first ones."""
    history = score_history(s, d)
    base, late = (M.summed_bins(history.where(c), "model") for c in (F.col("period") <= F.lit("2023-06-30").cast("date"), F.col("period") > F.lit("2023-11-30").cast("date")))
    return history, M.psi_by(base, late, "model").withColumn("psi", F.round("psi", 6))


@query(f"WITH {_PSIS} SELECT * FROM psis")
def psi_baseline(s, d):
    """Drift of scores by the sums of monthly bin counts."""
    return _drift(s, d)[1]


@query(f"WITH {_PSIS}, n AS (SELECT count(DISTINCT period) AS elapsed FROM h) SELECT elapsed, (elapsed > 0 AND elapsed % 6 = 0) OR (SELECT max(psi) FROM psis) > 0.2 AS retune FROM n")
def retune_rule(s, d):
    """Whether it is time: every sixth month of the score history, or any score has drifted."""
    history, drift = _drift(s, d)
    return M.retune(history.select("period"), drift)


# ---- evaluation ---------------------------------------------------------------------
_BEST = f"""best AS (SELECT model, arg_max(t, (pct_saved, -t)) AS t FROM pct GROUP BY model), conf AS (SELECT model, t, {CONF} FROM g GROUP BY 1, 2)"""
_RATIO = "round(CASE WHEN {b} > 0 THEN {a} / CAST({b} AS DOUBLE) ELSE 0 END, 9)"
_PRF = f"{_RATIO.format(a='tp', b='(tp + fp)')} AS precision, {_RATIO.format(a='tp', b='(tp + fn)')} AS recall, {_RATIO.format(a='2 * tp', b='(2 * tp + fp + fn)')} AS f1"


def _best(x: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Gains of all thresholds, and the best threshold of each model (the lowest of equal ones)."""
    g = io.stored(K.gains(M.at_thresholds(x, THRESHOLDS)), "gains")
    pct = K.saved(g, ["model", "t"]).withColumn("gain", F.round("gain", 4))
    pct = pct.withColumn("pct_saved", F.when(F.col("at_stake") > 0, F.round(100 * F.col("gain") / F.col("at_stake"), 4)).otherwise(0.0))
    best = pct.groupBy("model").agg(F.max_by(F.struct("t", "pct_saved", "gain"), F.struct("pct_saved", -F.col("t"))).alias("b"))
    return g, best.select("model", "b.*")


def _report(x: DataFrame, end: str) -> DataFrame:
    """One row for each model: its best threshold, what it saves, and the confusion counts there."""
    g, best = _best(x)
    conf = M.confusion(g, ["model", "t"], F.col("hit")).withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})
    return best.join(conf, ["model", "t"]).withColumn("dataset_end", F.lit(end).cast("date"))


def _report_sql(end: str, rows: str = "TRUE") -> str:
    gain = GAIN.replace("FROM k, ", f"FROM (SELECT * FROM k WHERE {rows}) k, ")
    return f"{gain}, {_BEST} SELECT b.model, b.t, pct_saved, gain, tp, fp, fn, tn, {_PRF}, DATE '{end}' AS dataset_end FROM best b JOIN conf USING (model, t) JOIN pct USING (model, t)"


@query(_report_sql("2024-01-31"))
def performance_report(s, d):
    return _report(_costly(s, d), "2024-01-31")


@query(f"SELECT * FROM ({_report_sql('2024-01-31')}) UNION ALL SELECT * FROM ({_report_sql('2024-02-29', 'doc_id % 2 = 0')}) ORDER BY model, dataset_end")
def sort_report(s, d):
    """A new report below the stored one, in the order of models."""
    old = io.stored(_report(_costly(s, d), "2024-01-31"), "report")
    return old.unionByName(_report(_costly(s, d).where("doc_id % 2 = 0"), "2024-02-29")).orderBy("model", "dataset_end")


_AUC = "a AS (SELECT model, p, sum(y) AS pos, sum(1 - y) AS neg FROM k WHERE doc_id % 3 <> 1 GROUP BY 1, 2), c AS (SELECT *, sum(pos) OVER w AS ctp, sum(neg) OVER w AS cfp, sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn FROM a WINDOW w AS (PARTITION BY model ORDER BY p DESC ROWS UNBOUNDED PRECEDING))"
_PERIOD = GAIN.replace("FROM k, ", "FROM (SELECT * FROM k WHERE doc_id % 3 <> 1) k, ")


@query(f"""{_PERIOD}, {_BEST}, {_AUC}, auc AS (SELECT model, round(sum(pos * (nn - cfp + neg / 2.0)) / max(np * nn), 9) AS roc_auc, round(sum(pos * ctp / CAST(ctp + cfp AS DOUBLE)) / max(np), 9) AS avg_precision FROM c GROUP BY model),
 half AS (SELECT model, tp, fp, fn, tn FROM conf WHERE t = 0.5), at_best AS (SELECT model, b.t AS best_threshold, round(sum(CASE WHEN hit THEN {1 - 0.9**3!r} * p * coalesce(readmission_cost, 0) ELSE 0 END), 4) AS saved_cost, round(sum(CASE WHEN hit THEN 3 * greatest(coalesce(cost_per_day, 0), coalesce(prev_cost, 0)) ELSE 0 END), 4) AS intervention_cost, round(sum(gain), 4) AS net_cost, count(*) AS n_predictions, CAST(sum(y) AS BIGINT) AS n_readmitted FROM g JOIN best b USING (model) WHERE g.t = b.t GROUP BY 1, 2)
 SELECT DATE '2024-02-29' AS end_date, model, roc_auc, avg_precision, {_PRF}, best_threshold, saved_cost, intervention_cost, net_cost, n_predictions, n_readmitted FROM auc JOIN half USING (model) JOIN at_best USING (model)""")
def evaluate_period(s, d):
    """Scores of earlier periods against what has happened since: metrics, best threshold and costs of each model."""
    path = io.scratch(s, "scores")
    history = scores(s, d).select("doc_id", "model", "p")
    io.write_snapshot(history.where("doc_id % 3 <> 1").withColumn("period", F.lit("2024-01-31")), path, "period")
    io.write_snapshot(history.where("doc_id % 3 = 1").withColumn("period", F.lit("2024-02-29")), path, "period")
    earlier = s.read.parquet(path).where(F.col("period").cast("string") < "2024-02-29")
    actuals = table(s, d, "labels").select("doc_id", F.col("toxic").alias("y"))
    x = io.stored(K.with_costs(earlier.join(actuals, "doc_id"), F.col("doc_id")).withColumn("prob", F.col("p")), "evaluated")
    g, best = _best(x)
    real = 1 - 0.9**3
    hit = lambda v: F.round(F.sum(F.when(F.col("hit"), v).otherwise(0.0)), 4)
    at_best = g.join(best.select("model", "t"), ["model", "t"]).groupBy("model", F.col("t").alias("best_threshold")).agg(
        hit(real * F.col("p") * F.coalesce("readmission_cost", F.lit(0.0))).alias("saved_cost"), hit(F.col("intervention")).alias("intervention_cost"),
        F.round(F.sum("gain"), 4).alias("net_cost"), F.count("*").alias("n_predictions"), F.sum("y").cast("bigint").alias("n_readmitted"),
    )
    half = M.confusion(x, ["model"], F.col("p") >= 0.5).select("model", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])
    auc = M.roc_auc(x).withColumn("roc_auc", F.round("roc_auc", 9)).join(M.average_precision(x).withColumn("avg_precision", F.round("avg_precision", 9)), "model")
    return auc.join(half, "model").join(at_best, "model").withColumn("end_date", F.lit("2024-02-29").cast("date"))


@query(f"""WITH {SCORES}, k AS (SELECT s.model, s.p, s.y, f.fold FROM scores s JOIN (SELECT doc_id, CAST((row_number() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1) % 3 AS INTEGER) AS fold FROM labels) f USING (doc_id)),
 a AS (SELECT model, fold, p, sum(y) AS pos, sum(1 - y) AS neg FROM k GROUP BY 1, 2, 3), c AS (SELECT *, sum(pos) OVER w AS ctp, sum(neg) OVER w AS cfp, sum(pos) OVER (PARTITION BY model, fold) AS np, sum(neg) OVER (PARTITION BY model, fold) AS nn FROM a WINDOW w AS (PARTITION BY model, fold ORDER BY p DESC ROWS UNBOUNDED PRECEDING))
 SELECT model, fold, round(sum(pos * (nn - cfp + neg / 2.0)) / max(np * nn), 9) AS roc_auc, round(sum(pos * ctp / CAST(ctp + cfp AS DOUBLE)) / max(np), 9) AS avg_precision, CAST(sum(pos + neg) AS BIGINT) AS n FROM c GROUP BY 1, 2""")
def cv_stratified(s, d):
    """ROC AUC and average precision of scored rows in each stratified fold."""
    x = M.folds(scores(s, d).where("model = 'a'").select("doc_id", "y"), "doc_id", "y", 3).select("doc_id", "fold").join(scores(s, d), "doc_id")
    x = io.stored(x.withColumn("model", F.concat_ws("/", "model", "fold")), "folds")
    out = M.roc_auc(x).join(M.average_precision(x), "model").join(x.groupBy("model").agg(F.count("*").alias("n")), "model")
    name = F.split("model", "/")
    return out.select(name[0].alias("model"), name[1].cast("int").alias("fold"), F.round("roc_auc", 9).alias("roc_auc"), F.round("avg_precision", 9).alias("avg_precision"), "n")
