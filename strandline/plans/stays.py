"""Queries on encounters and episodes: filters, windows, joins, aggregates, composites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.functions import scalars as S
from strandline.operators import episodes as E
from strandline.operators import temporal as T
from strandline.plans.base import BACK, ENC, EPS, LATER, MEM, RANK, SOON, UTIL, enc, eps, mem, query
from strandline.sources.io import stored, table

CUT = "TIMESTAMP '2024-01-20 00:00:00'"


def cuts():
    """The cut as a column; columns need a session, so not at import."""
    return F.lit("2024-01-20 00:00:00").cast("timestamp")


def utilization(s: SparkSession, d: str, stays: DataFrame | None = None, earlier: DataFrame | None = None, back: int = BACK, soon: int = SOON, later: int = LATER) -> DataFrame:
    """Look-back and look-ahead of clinical episodes over inpatient ones, on one stream of both.

    ``earlier`` are inpatient episodes that are looked back at and get no row themselves.
    """
    stays = stored(eps(s, d) if stays is None else stays, "episodes")
    pure, inp = stays.where("stay_rank in (4, 5, 6)").drop("episode", "members"), stays.where("stay_rank = 6")
    inp = inp if earlier is None else inp.select(*earlier.columns).unionByName(earlier)
    out = T.around(pure, "stay_start", "stay_stop", inp, "patient", back, ["stay_id"], "admissions", {"total_days": "stay_days", "prev_cents": "cents"})
    at = F.timestamp_micros(F.col("next.at"))
    out = out.withColumns({
        "total_days": F.coalesce("total_days", F.lit(0)), "prev_stay_id": F.col("prev.stay_id"), "prev_stay_date": F.timestamp_micros(F.col("prev.at")),
        "following_stay_id": F.col("next.stay_id"), "following_stay_date": at, "days_to_readmit": S.elapsed("DAY", F.col("stay_stop"), at),
    })
    return out.withColumns({"readmit_soon": S.flag(F.col("days_to_readmit") <= soon), "readmit_later": S.flag(F.col("days_to_readmit") <= later)}).drop("prev", "next")


@query(f"WITH {EPS} SELECT * FROM eps")
def group_episodes(s, d):
    return eps(s, d)


@query("SELECT c_custkey, c_name, c_nationkey FROM customer", "project_patients")
def project_patients(s, d):
    return table(s, d, "customer").select("c_custkey", "c_name", "c_nationkey")


@query(f"WITH {ENC} SELECT id, patient, start, stop, class, cents FROM enc")
def project_encounters(s, d):
    return enc(s, d).drop("event_type")


@query("SELECT l_partkey AS code, l_orderkey AS encounter, l_shipdate AS at FROM lineitem")
def project_rename(s, d):
    return table(s, d, "lineitem").select(F.col("l_partkey").alias("code"), F.col("l_orderkey").alias("encounter"), F.col("l_shipdate").alias("at"))


@query(f"WITH {ENC} SELECT id, class FROM enc WHERE class IN ('wellness','ambulatory','outpatient','virtual','urgentcare')")
def filter_in_list(s, d):
    return enc(s, d).where(F.col("class").isin(*S.CLASSES[:5])).select("id", "class")


@query(f"WITH {EPS} SELECT stay_id, stay_rank FROM pure")
def filter_clinical(s, d):
    return eps(s, d).where(S.rank_class(F.col("stay_rank")).isin(*S.CLINICAL)).select("stay_id", "stay_rank")


@query(f"WITH {ENC} SELECT id, stop FROM enc WHERE stop <= (SELECT max(stop) FROM enc) - INTERVAL 2 DAY")
def filter_right_censor(s, d):
    return censored(enc(s, d)).select("id", "stop")


def bounded(e, name: str = "last"):
    """Each row beside the one row of the latest stop."""
    return e.crossJoin(F.broadcast(e.agg(F.max("stop").alias(name))))


def censored(e):
    """Rows that end two days before the latest stop at least."""
    return bounded(e).where(F.col("stop") <= F.col("last") - F.expr("interval 2 days")).drop("last")


@query(f"WITH {ENC} SELECT id, date_sub('day', stop, last) AS days_left FROM enc, (SELECT max(stop) AS last FROM enc) b")
def join_cross_scalar(s, d):
    return bounded(enc(s, d)).select("id", S.elapsed("DAY", F.col("stop"), F.col("last")).alias("days_left"))


@query(f"WITH {ENC} SELECT e.id, c_custkey FROM enc e LEFT JOIN customer ON c_custkey = patient WHERE stop < coalesce(CASE WHEN c_acctbal < 0 THEN {CUT} END, TIMESTAMP '9999-12-31 00:00:00')")
def filter_alive(s, d):
    death = table(s, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, cuts()).alias("death"))
    e = enc(s, d)
    return e.join(death, e["patient"] == death["c_custkey"], "left").where(F.col("stop") < F.coalesce("death", F.lit("9999-12-31").cast("timestamp"))).select("id", "c_custkey")


DESC = "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 3 = 1 THEN p_name || ' (situation)' ELSE p_name || ' (' || lower(p_type) || ') (x)' END AS t FROM part"


def _described(s, d):
    z = F.col("p_size") % 3
    t = F.when(z == 0, F.col("p_name")).when(z == 1, F.concat("p_name", F.lit(" (situation)"))).otherwise(F.concat("p_name", F.lit(" ("), F.lower("p_type"), F.lit(") (x)")))
    name, kind = S.described(t)
    return table(s, d, "part").select("p_partkey", name.alias("name"), kind.alias("type"))


PARSED = f"SELECT p_partkey, trim(split_part(t, '(', 1)) AS name, CASE WHEN contains(t, '(') THEN replace(trim(split_part(t, '(', 2)), ')', '') END AS type FROM ({DESC})"


@query(PARSED)
def parse_description(s, d):
    return _described(s, d)


@query(f"SELECT * FROM ({PARSED}) WHERE type <> 'situation'")
def filter_type_not(s, d):
    return _described(s, d).where("type <> 'situation'")


@query(f"WITH {ENC} SELECT id FROM enc WHERE CAST(stop AS DATE) <= DATE '2024-01-20'")
def filter_asof_date(s, d):
    return enc(s, d).where(F.to_date("stop") <= F.lit("2024-01-20").cast("date")).select("id")


@query(f"WITH {ENC} SELECT id FROM enc WHERE start > TIMESTAMP '2024-01-05 00:00:00' AND stop <= {CUT}")
def filter_window(s, d):
    return enc(s, d).where((F.col("start") > F.lit("2024-01-05").cast("timestamp")) & (F.col("stop") <= cuts())).select("id")


@query(f"WITH {ENC} SELECT id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 4 WHEN 'error' THEN 5 WHEN 'purchase' THEN 6 ELSE 99 END AS rnk FROM enc")
def map_class_rank(s, d):
    return enc(s, d).select("id", S.class_rank(F.col("class")).alias("rnk"))


@query(f"WITH {ENC} SELECT id, CASE WHEN {RANK} = 99 THEN 'unknown' ELSE class END AS back FROM enc")
def map_rank_class(s, d):
    return enc(s, d).select("id", S.rank_class(S.class_rank(F.col("class"))).alias("back"))


@query(f"WITH {MEM} SELECT id, changed FROM mem")
def win_gap_flag(s, d):
    return E.gap_flag(enc(s, d), "patient", "start", "stop", "id").select("id", "changed")


@query(f"WITH {MEM} SELECT id, episode FROM mem")
def win_running_sum(s, d):
    return mem(s, d).select("id", "episode")


@query(f"WITH {MEM} SELECT id, stay_id FROM mem", "win_rank_first", "join_self_group")
def win_rank_first(s, d):
    return mem(s, d).select("id", "stay_id")


@query(f"WITH {MEM} SELECT patient, episode, min(start) AS a, max(stop) AS b, greatest(date_sub('day', min(start), max(stop)), 1) AS days FROM mem GROUP BY 1, 2")
def agg_group_span(s, d):
    return mem(s, d).groupBy("patient", "episode").agg(F.min("stay_start").alias("a"), F.max("stay_stop").alias("b"), F.max("stay_days").alias("days"))


@query(f"WITH {UTIL} SELECT stay_id, admissions, total_days, prev_cents FROM util", "join_lookback")
def join_lookback(s, d):
    """Count and sums of the inpatient stays before each clinical one, by the look-back operator alone."""
    stays = stored(eps(s, d), "episodes")
    pure, inp = stays.where("stay_rank in (4, 5, 6)").select("patient", "stay_id", "stay_start"), stays.where("stay_rank = 6")
    out = T.look_back(pure, "stay_start", inp, "stay_stop", "patient", BACK, "admissions", {"total_days": "stay_days", "prev_cents": "cents"})
    return out.select("stay_id", "admissions", F.coalesce("total_days", F.lit(0)).alias("total_days"), "prev_cents")


@query(f"WITH {UTIL} SELECT stay_id, admissions, total_days, CASE WHEN admissions > 0 THEN prev_cents / CAST(admissions AS DOUBLE) END AS avg_prev FROM util")
def agg_lookback_365(s, d):
    u = utilization(s, d)
    return u.select("stay_id", "admissions", "total_days", F.try_divide(F.col("prev_cents").cast("double"), F.col("admissions")).alias("avg_prev"))


@query(f"WITH {UTIL} SELECT stay_id, prev_stay_id, prev_stay_date FROM util")
def asof_prev(s, d):
    return utilization(s, d).select("stay_id", "prev_stay_id", "prev_stay_date")


RANKED = f"""{EPS}, x AS (SELECT p.stay_id, i.stay_id AS other, row_number() OVER (PARTITION BY p.stay_id ORDER BY i.stay_stop DESC, i.stay_id DESC) AS back, NULL AS ahead FROM pure p JOIN inp i ON i.patient = p.patient AND i.stay_stop < p.stay_start),
 y AS (SELECT p.stay_id, i.stay_id AS other, row_number() OVER (PARTITION BY p.stay_id ORDER BY i.stay_start, i.stay_id) AS ahead FROM pure p JOIN inp i ON i.patient = p.patient AND i.stay_start > p.stay_stop)"""


def _ranked(s, d, ahead: bool, most: int = 3):
    """The ``most`` nearest inpatient stays of each clinical one, ranked.

    The nearest one is found as of its time; the others follow by their number within the
    patient, so that stays are joined by equality and pairs are only those of the result.
    """
    stays = stored(eps(s, d), "episodes")
    pure = stays.where("stay_rank in (4, 5, 6)").select("patient", "stay_id", "stay_start", "stay_stop")
    at = "stay_start" if ahead else "stay_stop"
    inp = stays.where("stay_rank = 6").select("patient", F.col("stay_id").alias("other"), at)
    inp = stored(inp.withColumn("number", F.row_number().over(Window.partitionBy("patient").orderBy(at, "other"))), "numbered")
    near = T.asof_next(pure, "stay_stop", inp, at, "patient", ["number"]) if ahead else T.asof_previous(pure, "stay_start", inp, at, "patient", ["number"])
    first = F.col("next.number" if ahead else "prev.number")
    ranks = near.where(first.isNotNull()).withColumn("rank", F.explode(F.sequence(F.lit(1), F.lit(most))))
    step = F.col("rank") - 1
    return ranks.withColumn("number", first + (step if ahead else -step)).join(inp.drop(at), ["patient", "number"]).select("stay_id", "other", "rank")


@query(f"WITH {RANKED} SELECT stay_id, other, back AS rank FROM x WHERE back <= 3")
def win_prev_rank(s, d):
    return _ranked(s, d, ahead=False)


@query(f"WITH {RANKED} SELECT stay_id, other, ahead AS rank FROM y WHERE ahead <= 3")
def win_next_rank(s, d):
    return _ranked(s, d, ahead=True)


@query(f"WITH {UTIL} SELECT stay_id, following_stay_id, following_stay_date, days_to_readmit FROM util", "join_lookahead", "agg_pick_first")
def join_lookahead(s, d):
    return utilization(s, d).select("stay_id", "following_stay_id", "following_stay_date", "days_to_readmit")


@query(f"WITH {UTIL} SELECT stay_id, following_stay_id, following_stay_date FROM util")
def asof_next(s, d):
    """The next inpatient stay by the as-of operator alone."""
    stays = stored(eps(s, d), "episodes")
    pure, inp = stays.where("stay_rank in (4, 5, 6)").select("patient", "stay_id", "stay_stop"), stays.where("stay_rank = 6").select("patient", "stay_id", "stay_start")
    out = T.asof_next(pure, "stay_stop", inp, "stay_start", "patient", ["stay_id"])
    return out.select("stay_id", F.col("next.stay_id").alias("following_stay_id"), F.timestamp_micros("next.at").alias("following_stay_date"))


@query(f"WITH {UTIL} SELECT readmit_soon, readmit_later, count(*) AS n FROM util GROUP BY 1, 2")
def agg_readmit_flags(s, d):
    return utilization(s, d).groupBy("readmit_soon", "readmit_later").agg(F.count("*").alias("n"))


PLANNED = f"""{UTIL}, planned AS (SELECT stay_id, CAST(max(CAST(cents % 3 = 0 AS INTEGER)) AS INTEGER) AS is_planned FROM mem GROUP BY stay_id),
 sup AS (SELECT u.stay_id, u.following_stay_id, CASE WHEN is_planned = 1 THEN 0 ELSE readmit_soon END AS soon, CASE WHEN is_planned = 1 THEN 0 ELSE readmit_later END AS later FROM util u LEFT JOIN planned p ON p.stay_id = u.following_stay_id)"""


@query(f"WITH {PLANNED} SELECT stay_id, soon, later, CASE WHEN later = 0 THEN 0 ELSE 1 END AS unplanned FROM sup")
def suppress_planned(s, d):
    planned = mem(s, d).groupBy(F.col("stay_id").alias("following_stay_id")).agg(F.max((F.col("cents") % 3 == 0).cast("int")).alias("is_planned"))
    u = utilization(s, d).join(planned, "following_stay_id", "left")
    u = u.withColumns({"soon": S.suppressed(F.col("readmit_soon"), F.col("is_planned")), "later": S.suppressed(F.col("readmit_later"), F.col("is_planned"))})
    return u.select("stay_id", "soon", "later", S.flag(F.col("later") != 0).alias("unplanned"))


GROUPED = f"{MEM} SELECT stay_id, CAST(sum(cents) AS BIGINT) AS cents, max(rnk) AS rnk, CAST(max(CAST(cents % 3 = 0 AS INTEGER)) AS INTEGER) AS is_planned, count(*) AS n FROM mem WHERE stay_rank >= 4 AND stay_rank <= 6 GROUP BY stay_id"


@query(f"WITH {GROUPED}", "agg_group_flags")
def agg_group_flags(s, d):
    m = mem(s, d).where("stay_rank between 4 and 6")
    return m.groupBy("stay_id").agg(F.sum("cents").alias("cents"), F.max("rnk").alias("rnk"), F.max((F.col("cents") % 3 == 0).cast("int")).alias("is_planned"), F.count("*").alias("n"))


@query(f"WITH {MEM} SELECT stay_id, max(cents) AS admission, CAST(sum(cents) AS BIGINT) AS total, CAST(sum(cents) AS DOUBLE) / greatest(date_sub('day', min(start), max(stop)), 1) AS daily FROM mem GROUP BY stay_id", "agg_group_cost")
def agg_group_cost(s, d):
    return mem(s, d).groupBy("stay_id").agg(F.max("cents").alias("admission"), F.sum("cents").alias("total"), (F.sum("cents").cast("double") / F.max("stay_days")).alias("daily"))


@query(f"WITH {ENC} SELECT max(stop) AS last FROM enc")
def agg_global_max(s, d):
    return enc(s, d).agg(F.max("stop").alias("last"))


@query(f"WITH {ENC} SELECT DISTINCT patient, class FROM enc")
def distinct_rows(s, d):
    return enc(s, d).select("patient", "class").distinct()


@query(f"WITH {MEM} SELECT count(DISTINCT stay_id) AS n FROM mem")
def count_distinct(s, d):
    return mem(s, d).agg(F.countDistinct("stay_id").alias("n"))


ANCHOR = f"""{ENC}, old AS (SELECT patient, max(stop) AS last, arg_max(id, (stop, id)) AS last_id FROM enc WHERE start < {CUT} GROUP BY patient), new AS (SELECT * FROM enc WHERE start >= {CUT})"""


@query(f"WITH {ANCHOR} SELECT o.* FROM old o WHERE patient IN (SELECT patient FROM new)")
def join_prior_anchor(s, d):
    e = enc(s, d)
    old = E.touched(e.where(F.col("start") < cuts()), e.where(F.col("start") >= cuts()), "patient")
    return old.groupBy("patient").agg(F.max("stop").alias("last"), F.max_by("id", F.struct("stop", "id")).alias("last_id"))


@query(f"WITH {ANCHOR} SELECT id, CASE WHEN date_sub('hour', coalesce(lag(stop) OVER (PARTITION BY n.patient ORDER BY start, id), last), start) < 12 THEN 0 ELSE 1 END AS changed FROM new n LEFT JOIN old USING (patient)")
def win_lag_or_anchor(s, d):
    e = enc(s, d)
    last = e.where(F.col("start") < cuts()).groupBy("patient").agg(F.max("stop").alias("last"))
    return E.gap_flag(e.where(F.col("start") >= cuts()).join(last, "patient", "left"), "patient", "start", "stop", "id", anchor=F.col("last")).select("id", "changed")


@query(f"WITH {ENC} SELECT patient, id, start FROM enc QUALIFY row_number() OVER (PARTITION BY patient ORDER BY start, id) = 1")
def qualify_top1(s, d):
    return enc(s, d).withColumn("rn", F.row_number().over(Window.partitionBy("patient").orderBy("start", "id"))).where("rn = 1").select("patient", "id", "start")


@query(f"WITH {ENC} SELECT a.patient, min(b.id) AS dummy, count(*) AS n FROM enc a JOIN (SELECT DISTINCT patient, patient AS id FROM enc WHERE class = 'inpatient') b ON a.patient = b.patient GROUP BY a.patient", "semi_in")
def semi_in(s, d):
    e = enc(s, d)
    hit = e.join(e.where("class = 'inpatient'").select("patient").distinct(), "patient", "left_semi")
    return hit.groupBy("patient").agg(F.min("patient").alias("dummy"), F.count("*").alias("n"))


@query(f"WITH {ENC} SELECT id FROM enc e WHERE NOT EXISTS (SELECT 1 FROM enc x WHERE x.patient = e.patient AND x.class = 'inpatient' AND x.stop < {CUT})", "anti_not_in", "anti_left_null")
def anti_not_in(s, d):
    e = enc(s, d)
    return e.join(e.where((F.col("class") == "inpatient") & (F.col("stop") < cuts())).select("patient").distinct(), "patient", "left_anti").select("id")


@query(f"WITH {ENC} SELECT e.id, count(x.id) AS n FROM enc e LEFT JOIN enc x ON x.patient = e.patient AND x.class = 'emergency' AND x.start <= e.start GROUP BY e.id")
def subquery_count_asof(s, d):
    e = enc(s, d)
    return T.count_until(e.select("id", "patient", "start"), "start", e.where("class = 'emergency'"), "start", "patient", "n").select("id", "n")


@query(f"WITH {ENC} SELECT e.id, max(x.start) AS last_surgery, CASE WHEN date_sub('day', max(x.start), e.start) < 5 THEN 1 ELSE 0 END AS recent FROM enc e LEFT JOIN enc x ON x.patient = e.patient AND x.class = 'urgentcare' AND x.start < e.start GROUP BY e.id, e.start", "join_prior_events", "surgery_recent_flag", "agg_cond_max_flag")
def join_prior_events(s, d):
    e = enc(s, d)
    out = T.latest_before(e.select("id", "patient", "start"), "start", e.where("class = 'urgentcare'"), "start", "patient", "last_surgery")
    return out.select("id", "last_surgery", S.flag(S.elapsed("DAY", F.col("last_surgery"), F.col("start")) < 5).alias("recent"))


@query(f"WITH {ENC} SELECT patient, min(id) AS first_planned FROM (SELECT e.patient, e.id FROM enc e WHERE EXISTS (SELECT 1 FROM enc x WHERE x.patient = e.patient AND x.class = 'urgentcare' AND x.start < e.start) QUALIFY row_number() OVER (PARTITION BY e.patient ORDER BY e.start, e.id) = 1) GROUP BY patient")
def win_first_after_plan(s, d):
    e = enc(s, d)
    first = e.where("class = 'urgentcare'").groupBy("patient").agg(F.min("start").alias("p"))
    after = e.join(first, "patient").where("start > p")
    return after.groupBy("patient").agg(F.min_by("id", F.struct("start", "id")).alias("first_planned"))


@query(f"WITH {ENC} SELECT id FROM enc ORDER BY id")
def order_by(s, d):
    return enc(s, d).select("id").orderBy("id")
