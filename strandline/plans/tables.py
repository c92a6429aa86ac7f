"""Queries on codes, costs, hierarchy, increments, sources, metrics, checks, models and streams."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import scalars as S
from strandline.operators import codes as C
from strandline.operators import costs as K
from strandline.operators import incremental as I
from strandline.operators import metrics as M
from strandline.operators import models as ML
from strandline.operators import quality_checks as Q
from strandline.operators import temporal as T
from strandline.plans.base import (
    CLAIMS, DICT, DISEASES, EDGES, ENC, EPS, LONG, MEM, PLANS, SCORES, STAYS, SYSTEMS, TREE, UP, WIDE, claims, code_rows, coded, dictionary, edges, enc, eps, long, mem, plans, query, scores, stays, tree,
)
from strandline.plans.stays import censored, cuts, utilization
from strandline.sources import io
from strandline.sources.io import table
from strandline.streaming import sessions as ST

# ---- codes ----------------------------------------------------------------


@query(f"WITH {LONG} SELECT * FROM long")
def unpivot_codes(s, d):
    return long(s, d)


@query(f"WITH {LONG}, {DICT} SELECT code, min(name) AS name FROM (SELECT code FROM long UNION SELECT CAST(s_suppkey AS BIGINT) + 5000000 FROM supplier) LEFT JOIN dict USING (code) GROUP BY code")
def union_distinct_codes(s, d):
    return C.code_set(claims(s, d), WIDE, table(s, d, "supplier").select((F.col("s_suppkey") + 5_000_000).alias("code")), dictionary(s, d))


@query("SELECT DISTINCT l_partkey AS code, p_name AS name FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R'")
def unique_procedures(s, d):
    p = table(s, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("code")).distinct()
    return p.join(dictionary(s, d).select("code", "name"), "code")


@query(f"WITH {LONG}, {DICT} SELECT patient, code, min(seen) AS first_seen FROM long JOIN dict USING (code) WHERE is_chronic = 1 GROUP BY 1, 2", "agg_min_onset", "build_known_codes", "join_inner_dict")
def agg_min_onset(s, d):
    return C.first_seen(long(s, d).join(dictionary(s, d).where("is_chronic = 1").select("code"), "code"), "patient", "code", "seen")


ONSET = f"{LONG}, {DICT}, onset AS (SELECT patient, " + ", ".join(f"min(CASE WHEN {x} = 1 THEN seen END) AS {x}_start" for x in DISEASES) + " FROM long JOIN dict USING (code) GROUP BY patient)"


def _onset(s, d):
    return C.onsets(long(s, d).join(dictionary(s, d), "code"), "patient", "seen", DISEASES)


@query(f"WITH {ONSET} SELECT * FROM onset")
def agg_cond_min_pivot(s, d):
    return _onset(s, d)


@query(f"WITH {ONSET} SELECT encounter, " + ", ".join(f"CAST(coalesce(seen >= {x}_start, false) AS INTEGER) AS {x}" for x in DISEASES) + " FROM claims LEFT JOIN onset USING (patient)")
def onset_flag(s, d):
    c = claims(s, d).select("encounter", "patient", "seen").join(_onset(s, d), "patient", "left")
    return c.select("encounter", *[S.flag(F.col("seen") >= F.col(f"{x}_start")).alias(x) for x in DISEASES])


CLIN = f"""{ONSET}, first_chronic AS (SELECT patient, code, min(seen) AS f FROM long JOIN dict USING (code) WHERE is_chronic = 1 GROUP BY 1, 2),
 chronic AS (SELECT c.encounter, count(f) AS num_chronic FROM claims c LEFT JOIN first_chronic fc ON fc.patient = c.patient AND f <= seen GROUP BY c.encounter),
 ev AS (SELECT o_custkey AS patient, l_shipdate AS ts, is_planning, is_surgery FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN dict ON code = l_partkey WHERE l_returnflag = 'R'),
 surg AS (SELECT c.encounter, max(CASE WHEN date_sub('day', ts, seen) < 730 THEN ts END) AS last_surgery FROM claims c LEFT JOIN ev ON ev.patient = c.patient AND is_surgery = 1 AND ts < seen GROUP BY c.encounter),
 plan1 AS (SELECT c.encounter FROM claims c JOIN (SELECT patient, min(ts) AS t FROM ev WHERE is_planning = 1 GROUP BY patient) p ON p.patient = c.patient AND c.seen > t QUALIFY row_number() OVER (PARTITION BY c.patient ORDER BY seen, encounter) = 1),
 nproc AS (SELECT l_orderkey AS encounter, count(*) AS num_procedures FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)"""


def main_codes(s: SparkSession, d: str, groups: DataFrame, up: DataFrame | None = None, desc: DataFrame | None = None) -> DataFrame:
    """Main code of each group (grp, code) with its dictionary row, and how many disorders and findings the group has.

    ``up`` is the closure of the codes' tree, made here where it is not given, and ``desc``
    (code, n_desc) how many codes lie under each one, counted in ``up`` where it is not given.

    A group with disorders elects among these, else among all its codes: favoured codes first,
    no ancestor of another, fewest descendants, least code. A code without descendants is no
    ancestor, so the least favoured one of these wins, or the least one where no favoured code has
    descendants. Only the groups that this leaves open are looked up in the closure.
    """
    dic, up = dictionary(s, d), C.closure(tree(s, d)) if up is None else up
    desc = C.descendants(up) if desc is None else desc
    liked, leaf = F.col("code") % 50 == 0, F.coalesce("n_desc", F.lit(0)) == 0
    facts = dic.select("code", "is_disorder", "is_symptom").join(desc, "code", "left").select("code", "is_disorder", "is_symptom", liked.alias("liked"), leaf.alias("leaf"))
    known = groups.join(facts, "code")
    of = lambda k, c, what: F.when((F.col("is_disorder") == k) & c, F.col(what))
    best = {}
    for k in (0, 1):
        best |= {f"_liked{k}": F.min(of(k, F.col("liked") & F.col("leaf"), "code")), f"_leaf{k}": F.min(of(k, F.col("leaf"), "code")), f"_inner{k}": F.max(of(k, F.col("liked") & ~F.col("leaf"), "code"))}
    totals = known.groupBy("grp").agg(F.sum("is_disorder").alias("num_disorders"), F.sum("is_symptom").alias("num_findings"), F.max("is_disorder").alias("_top"), *[c.alias(n) for n, c in best.items()])
    found = [F.when(F.col("_top") == k, F.coalesce(f"_liked{k}", F.when(F.col(f"_inner{k}").isNull(), F.col(f"_leaf{k}")))) for k in (0, 1)]
    totals = io.stored(totals.select("grp", "num_disorders", "num_findings", "_top", F.coalesce(*found).alias("_found")), "totals")
    left = totals.where("_found is null and _top is not null").select("grp", "_top")
    electors = io.stored(known.join(left, "grp").where(F.col("is_disorder") == F.col("_top")).select("grp", "code"), "electors")
    main = C.elected(electors, up, desc, dic.where("code % 50 = 0").select("code"))
    main = totals.join(main, "grp", "left").select("grp", "num_disorders", "num_findings", F.coalesce("_found", "main_code").alias("main_code"))
    named = dic.select(F.col("code").alias("main_code"), F.col("name").alias("main_name"), "is_disorder", "is_symptom", *SYSTEMS)
    return main.join(named, "main_code", "left").select("grp", "num_disorders", "num_findings", "main_code", "main_name", "is_disorder", "is_symptom", *SYSTEMS)


def main_sql(groups: str, name: str = "main") -> str:
    """CTEs that end in ``name``, as :func:`main_codes` on the CTE ``groups`` (grp, code)."""
    g = groups
    return f"""{g}_known AS (SELECT grp, code, is_disorder, is_symptom, max(is_disorder) OVER (PARTITION BY grp) AS top FROM {g} JOIN dict USING (code)),
 {g}_e AS (SELECT grp, code FROM {g}_known WHERE is_disorder = top),
 {g}_up AS (SELECT DISTINCT e.grp, a.ancestor AS code FROM {g}_e e JOIN above a ON a.node = e.code),
 {g}_m AS (SELECT e.grp, arg_min(e.code, (CASE WHEN e.code % 50 = 0 THEN 0 ELSE 1 END, coalesce(n_desc, 0), e.code)) AS main_code FROM {g}_e e LEFT JOIN below b ON b.code = e.code LEFT JOIN {g}_up u ON u.grp = e.grp AND u.code = e.code WHERE u.code IS NULL GROUP BY e.grp),
 {name} AS (SELECT t.grp, t.num_disorders, t.num_findings, main_code, dict.name AS main_name, is_disorder, is_symptom, {', '.join(SYSTEMS)}
 FROM (SELECT grp, CAST(sum(is_disorder) AS BIGINT) AS num_disorders, CAST(sum(is_symptom) AS BIGINT) AS num_findings FROM {g}_known GROUP BY grp) t LEFT JOIN {g}_m m ON m.grp = t.grp LEFT JOIN dict ON dict.code = m.main_code)"""


#: Columns that are 0 where a group has no main code.
ZEROED = ["is_disorder", "is_symptom", *SYSTEMS, "num_disorders", "num_findings"]


def clinical(s: SparkSession, d: str, base: DataFrame | None = None, up: DataFrame | None = None) -> DataFrame:
    """One row of 28 columns for each encounter: main code, counts, chronic codes so far, onsets, planning and surgery.

    With ``base`` (claims of some patients) only these patients' procedures are read on.
    """
    own = F.sum(F.when(F.col("l_returnflag") == "R", 1))
    if base is None:
        c = io.stored(coded(s, d, num_procedures=own), "claims")
    else:
        c = base.withColumns({x: S.code_of(F.col(x)) for x in WIDE}).join(table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("encounter")).agg(own.alias("num_procedures")), "encounter", "left")
    rows = c.select("encounter", "patient", "seen", "num_procedures")
    dic = dictionary(s, d)
    codes = code_rows(c, "encounter", "patient", "seen").join(dic.select("code", "is_chronic", *DISEASES), "code")
    codes = io.stored(codes.where("is_chronic = 1 or " + " or ".join(f"{x} = 1" for x in DISEASES)), "codes")
    out = T.count_until(rows, "seen", C.first_seen(codes.where("is_chronic = 1"), "patient", "code", "seen"), "first_seen", "patient", "num_chronic")
    orders = table(s, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("patient"))
    if base is not None:
        orders = orders.join(rows.select("patient").distinct(), "patient", "left_semi")
    kinds = dic.where("is_planning = 1 or is_surgery = 1").select(F.col("code").alias("l_partkey"), "is_planning", "is_surgery")
    ev = table(s, d, "lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_partkey", F.col("l_shipdate").cast("timestamp").alias("ts")).join(kinds, "l_partkey")
    ev = io.stored(ev.join(orders, "l_orderkey").select("patient", "ts", "is_planning", "is_surgery"), "events")
    out = T.latest_before(out, "seen", ev.where("is_surgery = 1").select("patient", "ts"), "ts", "patient", "last")
    first = ev.where("is_planning = 1").groupBy("patient").agg(F.min("ts").alias("t"))
    plan = rows.join(first, "patient").where("seen > t").groupBy("patient").agg(F.min_by("encounter", F.struct("seen", "encounter")).alias("encounter")).select("encounter", F.lit(1).alias("planned"))
    on = C.onsets(codes, "patient", "seen", DISEASES)
    main = main_codes(s, d, code_rows(c.withColumnRenamed("encounter", "grp"), "grp"), up).withColumnRenamed("grp", "encounter")
    out = out.join(on, "patient", "left").join(plan, "encounter", "left").join(main, "encounter", "left")
    recent = S.elapsed("DAY", F.col("last"), F.col("seen")) < 730
    return out.select(
        "encounter", "patient", "main_code", "main_name", *[F.coalesce(x, F.lit(0)).alias(x) for x in ZEROED], F.coalesce("num_procedures", F.lit(0)).alias("num_procedures"), "num_chronic",
        *[S.flag(F.col("seen") >= F.col(f"{x}_start")).alias(x) for x in DISEASES],
        F.coalesce("planned", F.lit(0)).alias("is_planned"), S.flag(recent).alias("had_surgery"), F.when(recent, F.col("last")).alias("last_surgery"),
    )


CLIN_ROWS = f"""SELECT c.encounter, c.patient, main_code, main_name, {', '.join(f'coalesce({x}, 0) AS {x}' for x in ZEROED)}, coalesce(num_procedures, 0) AS num_procedures, num_chronic, {', '.join(f'CAST(coalesce(seen >= {x}_start, false) AS INTEGER) AS {x}' for x in DISEASES)},
 CASE WHEN plan1.encounter IS NULL THEN 0 ELSE 1 END AS is_planned, CASE WHEN last_surgery IS NULL THEN 0 ELSE 1 END AS had_surgery, last_surgery
 FROM claims c LEFT JOIN onset USING (patient) LEFT JOIN chronic USING (encounter) LEFT JOIN surg USING (encounter) LEFT JOIN plan1 USING (encounter) LEFT JOIN nproc USING (encounter) LEFT JOIN cmain ON cmain.grp = c.encounter"""
CLIN_ALL = f"{TREE}, {CLIN}, cgrp AS (SELECT DISTINCT encounter AS grp, code FROM long), {main_sql('cgrp', 'cmain')}"
CLIN_SQL = f"WITH {CLIN_ALL} {CLIN_ROWS}"


@query(CLIN_SQL)
def build_helper_clinical(s, d):
    return clinical(s, d)


@query(f"WITH {LONG}, {DICT} SELECT encounter, CAST(sum(is_disorder) AS BIGINT) AS disorders, CAST(sum(is_symptom) AS BIGINT) AS symptoms, CAST(max(is_chronic) AS INTEGER) AS chronic FROM long JOIN dict USING (code) GROUP BY encounter")
def codes_split(s, d):
    return long(s, d).join(dictionary(s, d), "code").groupBy("encounter").agg(F.sum("is_disorder").alias("disorders"), F.sum("is_symptom").alias("symptoms"), F.max("is_chronic").alias("chronic"))


@query(f"WITH {LONG} SELECT DISTINCT patient, code FROM long")
def codes_flatten(s, d):
    """The distinct codes of each patient over all wide columns of all its claims."""
    return C.unpivot_codes(claims(s, d), ["patient"], WIDE)


@query(f"WITH {CLAIMS} SELECT encounter, slot, code FROM (UNPIVOT claims ON d1, d2, d3, d4, d5, d6, d7, d8 INTO NAME slot VALUE code)")
def filter_not_null(s, d):
    """The filled wide columns, each with its place; nulls go before anything is parsed."""
    return claims(s, d).unpivot(["encounter"], WIDE, "slot", "code").where("code is not null")


@query("SELECT l_orderkey, l_linenumber, l_partkey, p_name, p_type FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 40) ON p_partkey = l_partkey")
def join_left_dim(s, d):
    names = table(s, d, "part").where("p_size < 40").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(names, "l_partkey", "left")


@query(f"WITH {LONG}, {DICT} SELECT DISTINCT code, name FROM (SELECT code FROM long WHERE seen <= TIMESTAMP '1998-06-30 00:00:00' UNION SELECT CAST(s_suppkey AS BIGINT) + 5000000 FROM supplier) LEFT JOIN dict USING (code) ORDER BY code")
def unique_codes(s, d):
    """Codes in use up to an end date, with names, in order."""
    seen = claims(s, d).where(F.col("seen") <= F.lit("1998-06-30").cast("timestamp"))
    return C.code_set(seen, WIDE, table(s, d, "supplier").select((F.col("s_suppkey") + 5_000_000).alias("code")), dictionary(s, d)).orderBy("code")


@query(f"WITH {CLIN_ALL}, rows AS ({CLIN_ROWS}) SELECT patient, max(is_planned) AS is_planned, " + ", ".join(f"max({x}) AS {x}" for x in DISEASES) + " FROM rows GROUP BY patient")
def agg_baseline_max(s, d):
    """The flags a patient has had so far: the greatest of the stored ones."""
    return clinical(s, d).groupBy("patient").agg(*[F.max(x).alias(x) for x in ("is_planned", *DISEASES)])


# ---- costs ----------------------------------------------------------------
COST = f"""{STAYS}, cost AS (SELECT stay_id, patient, claim, base, procedures, medications, greatest(claim, base + procedures + medications) AS total, CAST(greatest(claim - base, procedures + medications) AS DOUBLE) / greatest(date_sub('day', start, stop), 1) AS per_day FROM stays)"""


def costed(x: DataFrame) -> DataFrame:
    """Total and daily cost of each stay, in cents."""
    day = F.greatest(S.elapsed("DAY", F.col("start"), F.col("stop")), F.lit(1))
    total = S.greatest_or_null(F.col("claim"), F.col("base") + F.col("procedures") + F.col("medications"))
    return x.select("stay_id", "patient", "claim", "base", "procedures", "medications", total.alias("total"), (S.greatest_or_null(F.col("claim") - F.col("base"), F.col("procedures") + F.col("medications")).cast("double") / day).alias("per_day"))


@query(f"WITH {COST} SELECT * FROM cost")
def build_helper_cost(s, d):
    return costed(stays(s, d))


@query(f"WITH {COST} SELECT * FROM cost", "cost_update", "upsert_union")
def cost_update(s, d):
    old = costed(stays(s, d, F.col("o_orderkey") % 7 != 2)).withColumn("total", F.col("total") + F.when(F.col("stay_id") % 7 == 3, 1).otherwise(0))
    return I.upsert(old, costed(stays(s, d, (F.col("o_orderkey") % 7).isin(2, 3))), "stay_id")


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING max(l_shipdate) <= TIMESTAMP '1998-01-01 00:00:00'")
def agg_count_having(s, d):
    g = table(s, d, "lineitem").where("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.max("l_shipdate").alias("last"))
    return g.where(F.col("last") <= F.lit("1998-01-01").cast("timestamp")).select("l_orderkey", "n")


@query(f"WITH {DICT} SELECT l_orderkey, count(*) AS n FROM lineitem JOIN dict ON code = l_partkey WHERE is_surgery = 1 GROUP BY 1")
def agg_count_dict(s, d):
    dic = dictionary(s, d).where("is_surgery = 1").select("code")
    return table(s, d, "lineitem").join(dic, F.col("l_partkey") == F.col("code")).groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 49)")
def join_semi_dedup(s, d):
    return table(s, d, "supplier").join(table(s, d, "lineitem").where("l_quantity >= 49"), F.col("s_suppkey") == F.col("l_suppkey"), "left_semi").select("s_suppkey", "s_name")


@query("SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O') ON o_orderkey = l_orderkey")
def join_inner_scope(s, d):
    """Child rows of valid parents, with a column of the parent; a parent's key is unique."""
    valid = table(s, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber").join(valid, "l_orderkey")


def slim_children(s: SparkSession, d: str, valid: DataFrame) -> dict[str, DataFrame]:
    """The six child tables cut down to valid encounters (id): care plans, claims, conditions, medications, procedures, organizations."""
    o, li = table(s, d, "orders"), table(s, d, "lineitem")
    mine = lambda df, c: df.join(valid.select(F.col("id").alias(c)), c, "left_semi")
    lines = mine(li, "l_orderkey")
    child = lambda df: df.select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("code"), F.col("l_shipdate").cast("timestamp").alias("at"))
    made = {
        "careplans": mine(plans(s, d).select(F.col("plan").alias("id"), F.lit(None).cast("bigint").alias("code"), F.col("start").cast("timestamp").alias("at")), "id"),
        "claims": mine(o, "o_orderkey").select(F.col("o_orderkey").alias("id"), F.lit(None).cast("bigint").alias("code"), F.col("o_orderdate").cast("timestamp").alias("at")),
        "conditions": child(lines.where("l_returnflag = 'N'")),
        "medications": child(lines.where("l_returnflag = 'A'")),
        "procedures": child(lines.where("l_returnflag = 'R'")),
    }
    used = lines.select(F.col("l_suppkey").alias("s_suppkey")).distinct()
    made["organizations"] = table(s, d, "supplier").join(used, "s_suppkey", "left_semi").select(F.col("s_suppkey").cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("code"), F.lit(None).cast("timestamp").alias("at"))
    return made


def _stacked(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        df = df.select(F.lit(name).alias("child"), "id", "code", "at")
        out = df if out is None else out.union(df)
    return out


CHILDREN = f"""valid AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F'), lines AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT id FROM valid)),
 children AS (SELECT 'careplans' AS child, plan AS id, CAST(NULL AS BIGINT) AS code, CAST(start AS TIMESTAMP) AS "at" FROM plans WHERE plan IN (SELECT id FROM valid) UNION ALL SELECT 'claims', o_orderkey, NULL, o_orderdate FROM orders WHERE o_orderkey IN (SELECT id FROM valid)
 UNION ALL SELECT CASE l_returnflag WHEN 'N' THEN 'conditions' WHEN 'A' THEN 'medications' ELSE 'procedures' END, l_orderkey, l_partkey, l_shipdate FROM lines WHERE l_returnflag IN ('N', 'A', 'R') UNION ALL SELECT 'organizations', s_suppkey, NULL, NULL FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lines))"""


@query(f"WITH {PLANS}, {CHILDREN} SELECT * FROM children")
def build_slim_children(s, d):
    return _stacked(slim_children(s, d, table(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))))


@query(f"WITH {PLANS}, {CHILDREN} SELECT child, id, code FROM children WHERE last_day(CAST(\"at\" AS DATE)) = DATE '1997-03-31'")
def scan_month_segment(s, d):
    """The child tables of one month; each must have it."""
    root = io.scratch(s, "months")
    made = slim_children(s, d, table(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")))
    for name in (n for n in made if n != "organizations"):
        io.write_periods(made[name], "at", f"{root}/{name}")
    month = io.read_month(s, root, [n for n in made if n != "organizations"], "1997-03-31")
    return _stacked(month).drop("at")


SLIM = f"WITH {ENC} SELECT id, patient, start, stop, class FROM enc LEFT JOIN customer ON c_custkey = patient WHERE class <> 'wellness' AND stop <= (SELECT max(stop) FROM enc) - INTERVAL 2 DAY AND stop < coalesce(CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-01-20 00:00:00' END, TIMESTAMP '9999-12-31 00:00:00')"


@query(SLIM)
def build_slim_encounters(s, d):
    """Encounters of the wanted classes that end well before the last one, of patients alive."""
    death = table(s, d, "customer").select(F.col("c_custkey").alias("patient"), F.when(F.col("c_acctbal") < 0, cuts()).alias("death"))
    e = censored(enc(s, d)).where("class <> 'wellness'").join(death, "patient", "left")
    return e.where(F.col("stop") < F.coalesce("death", F.lit("9999-12-31").cast("timestamp"))).select("id", "patient", "start", "stop", "class")


ACTIVE = f"{PLANS}, {ENC}, active AS (SELECT DISTINCT e.id, e.patient, p.plan FROM enc e JOIN (SELECT plan, patient, start + INTERVAL 9131 DAY AS start, stop + INTERVAL 9131 DAY AS stop FROM plans) p ON p.patient = e.patient AND CAST(e.start AS DATE) > p.start AND CAST(e.start AS DATE) < coalesce(p.stop, DATE '2030-01-01'))"


@query(f"WITH {ACTIVE} SELECT id, plan FROM active")
def join_interval_active(s, d):
    p = plans(s, d).select("plan", "patient", F.date_add("start", 9131).alias("start"), F.date_add("stop", 9131).alias("stop"))
    e = enc(s, d).select("id", "patient", F.to_date("start").alias("day"))
    return T.active_intervals(e, "day", p, "start", "stop", "patient", F.lit("2030-01-01").cast("date")).select("id", F.col("plan_plan").alias("plan"))


# ---- hierarchy --------------------------------------------------------------
def _concepts(s: SparkSession, d: str, kept: str = "true") -> DataFrame:
    """Nations and regions as concepts of one JSON file each, some relationships inactive or of another type."""
    n, r = table(s, d, "nation"), table(s, d, "region")
    link = lambda active, kind, target: F.struct(active.alias("active"), F.struct(F.lit(kind).alias("conceptId")).alias("type"), F.struct(target.cast("string").alias("conceptId")).alias("target"))
    up = F.array(link(F.col("n_nationkey") % 4 != 3, "116680003", F.col("n_regionkey") + 100), link(F.lit(True), "363698007", F.lit(7)), link(F.lit(True), "116680003", F.lit(1)))
    a = n.select((F.col("n_nationkey") + 1000).cast("string").alias("conceptId"), (F.col("n_nationkey") % 6 != 5).alias("active"), F.array(F.struct(F.col("n_name").alias("term"))).alias("descriptions"), up.alias("relationships"))
    b = r.select((F.col("r_regionkey") + 100).cast("string").alias("conceptId"), F.lit(True).alias("active"), F.array(F.struct(F.col("r_name").alias("term"))).alias("descriptions"), F.array(link(F.lit(True), "116680003", F.lit(1))).alias("relationships"))
    path = io.scratch(s, "concepts")
    a.union(b).where(kept).repartition(30, "conceptId").write.option("maxRecordsPerFile", 1).json(path)
    return io.read_concepts(s, path)


@query("SELECT CAST(1000 + n_nationkey AS BIGINT) AS child, CAST(100 + n_regionkey AS BIGINT) AS parent FROM nation WHERE n_nationkey % 6 <> 5 AND n_nationkey % 4 <> 3 UNION SELECT CAST(1000 + n_nationkey AS BIGINT), 1 FROM nation WHERE n_nationkey % 6 <> 5 UNION SELECT CAST(100 + r_regionkey AS BIGINT), 1 FROM region")
def graph_edges(s, d):
    """Active is-a relationships of the active concepts of a JSON store."""
    return C.is_a_edges(_concepts(s, d))


@query(f"WITH {UP} SELECT node, ancestor, min(depth) AS depth FROM up WHERE ancestor NOT IN (1, 101) GROUP BY 1, 2")
def graph_ancestors(s, d):
    return C.closure(edges(s, d), stop=F.col("ancestor").isin(1, 101))


@query(f"WITH {UP} SELECT DISTINCT node FROM (SELECT node, ancestor FROM up UNION SELECT child, child FROM edges) WHERE ancestor IN (102, 1003)")
def graph_has_ancestor(s, d):
    e = edges(s, d)
    return C.has_ancestor(e.select(F.col("child").alias("node")).distinct(), C.closure(e), s.createDataFrame([(102,), (1003,)], "target bigint"))


@query(f"WITH {DICT} SELECT code, is_disorder, CASE WHEN is_disorder = 1 THEN 0 ELSE is_symptom END AS is_symptom, greatest(is_chronic, {", ".join(DISEASES)}) AS is_chronic FROM dict")
def dict_fix(s, d):
    return C.fixed_flags(dictionary(s, d), DISEASES).select("code", "is_disorder", "is_symptom", "is_chronic")


@query("SELECT CAST(1000 + c_nationkey AS BIGINT) AS code, coalesce(min(CASE WHEN c_nationkey % 2 = 0 THEN 'known ' || c_nationkey END), min(n_name)) AS name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 7 <> 1) ON n_nationkey = c_nationkey GROUP BY 1")
def dict_describe(s, d):
    """Missing names taken from the first description of the concept."""
    n = F.col("c_nationkey")
    codes = table(s, d, "customer").select(n.cast("bigint") + 1000, F.when(n % 2 == 0, F.concat(F.lit("known "), n.cast("string")))).toDF("code", "name").distinct()
    return C.described_codes(codes, _concepts(s, d, "(cast(conceptId as int) - 1000) % 7 <> 1"))


GRP = f"{UP}, grp AS (SELECT c_custkey % 97 AS grp, CAST(1000 + c_nationkey AS BIGINT) AS code FROM customer WHERE c_custkey % 5 = 0 UNION SELECT c_custkey % 97, CAST(100 + n_regionkey AS BIGINT) FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 3 = 0), nd AS (SELECT ancestor AS code, count(DISTINCT node) AS n_desc FROM up GROUP BY 1), main AS (SELECT grp, arg_min(code, (coalesce(n_desc, 0), code)) AS main_code FROM grp g LEFT JOIN nd USING (code) WHERE NOT EXISTS (SELECT 1 FROM grp h JOIN up ON up.node = h.code AND up.ancestor = g.code WHERE h.grp = g.grp) GROUP BY grp)"


def _grp(s, d):
    c = table(s, d, "customer")
    n = table(s, d, "nation")
    a = c.where("c_custkey % 5 = 0").select((F.col("c_custkey") % 97).alias("grp"), (F.col("c_nationkey").cast("bigint") + 1000).alias("code"))
    b = c.where("c_custkey % 3 = 0").join(n, F.col("n_nationkey") == F.col("c_nationkey")).select((F.col("c_custkey") % 97).alias("grp"), (F.col("n_regionkey").cast("bigint") + 100).alias("code"))
    return a.union(b).distinct()


@query("WITH " + GRP.replace("arg_min(code, (coalesce(n_desc, 0), code))", "arg_min(code, (CASE WHEN code % 9 = 4 THEN 0 ELSE 1 END, coalesce(n_desc, 0), code))") + " SELECT * FROM main")
def main_code_elect(s, d):
    up = C.closure(edges(s, d))
    desc = up.groupBy(F.col("ancestor").alias("code")).agg(F.countDistinct("node").alias("n_desc"))
    favoured = up.select(F.col("node").alias("code")).union(up.select("ancestor")).distinct().where("code % 9 = 4")
    return C.elected(_grp(s, d), up, desc, favoured)


@query(f"WITH {GRP} SELECT grp, arg_min(code, (coalesce(n_desc, 0), code)) AS code FROM grp LEFT JOIN nd USING (code) GROUP BY grp")
def argmin_descendants(s, d):
    """The code with fewest descendants in each group, ancestors of others included."""
    desc = C.closure(edges(s, d)).groupBy(F.col("ancestor").alias("code")).agg(F.countDistinct("node").alias("n_desc"))
    x = _grp(s, d).join(desc, "code", "left")
    return x.groupBy("grp").agg(F.min_by("code", F.struct(F.coalesce("n_desc", F.lit(0)), "code")).alias("code"))


_KIND = "CASE WHEN is_disorder = 1 THEN 'disorder' WHEN is_symptom = 1 THEN 'finding' END"


@query(f"WITH {CLIN_ALL} SELECT grp AS encounter, main_code, main_name, {_KIND} AS main_type, num_disorders, num_findings FROM cmain")
def main_diagnoses(s, d):
    """Main code, name and type of each encounter with known codes, disorders before findings, and how many of each it has."""
    x = main_codes(s, d, long(s, d).select(F.col("encounter").alias("grp"), "code"))
    kind = F.when(F.col("is_disorder") == 1, "disorder").when(F.col("is_symptom") == 1, "finding")
    return x.select(F.col("grp").alias("encounter"), "main_code", "main_name", kind.alias("main_type"), "num_disorders", "num_findings")


PAIRS = f"{UP}, pairs AS (SELECT o_orderkey AS pair_id, 1000000 + o_custkey AS code1, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(1000 + o_orderkey % 25 AS BIGINT) END AS code2 FROM orders), anc AS (SELECT node, ancestor FROM up WHERE ancestor <> 1), rel AS (SELECT pair_id, CASE WHEN code1 IS NULL OR code2 IS NULL THEN 0 WHEN EXISTS (SELECT 1 FROM anc x WHERE x.node = code1 AND (x.ancestor = code2 OR x.ancestor IN (SELECT ancestor FROM anc y WHERE y.node = code2))) THEN 1 ELSE -1 END AS is_related FROM pairs)"
PAIRS = PAIRS.replace("CASE WHEN code1 IS NULL OR code2 IS NULL THEN 0 WHEN EXISTS (SELECT 1 FROM anc x WHERE x.node = code1 AND (x.ancestor = code2 OR x.ancestor IN (SELECT ancestor FROM anc y WHERE y.node = code2))) THEN 1 ELSE -1 END AS is_related FROM pairs)", "CASE WHEN code2 IS NULL THEN 0 WHEN hit.p IS NOT NULL THEN 1 ELSE -1 END AS is_related FROM pairs LEFT JOIN (SELECT DISTINCT q.pair_id AS p FROM pairs q JOIN anc x ON x.node = q.code1 JOIN (SELECT node, ancestor FROM anc UNION SELECT child, child FROM edges) y ON y.node = q.code2 AND y.ancestor = x.ancestor) hit ON hit.p = pair_id)")


def _related(s, d):
    o = table(s, d, "orders")
    pairs = o.select(F.col("o_orderkey").alias("pair_id"), (F.col("o_custkey") + 1_000_000).alias("code1"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey") % 25 + 1000).alias("code2"))
    return C.related(pairs, C.closure(edges(s, d), stop=F.col("ancestor") == 1))


@query(f"WITH {PAIRS} SELECT pair_id, is_related FROM rel", "code_related")
def code_related(s, d):
    return _related(s, d).select("pair_id", "is_related")


@query(f"WITH {PAIRS} SELECT o_custkey, max(is_related) AS is_related, max(greatest(0, CAST(pair_id % 2 AS INTEGER) * is_related)) AS rel_readmit FROM rel JOIN orders ON o_orderkey = pair_id GROUP BY 1", "related_readmit", "agg_max_relation")
def related_readmit(s, d):
    r = _related(s, d).join(table(s, d, "orders"), F.col("o_orderkey") == F.col("pair_id"))
    return r.groupBy("o_custkey").agg(F.max("is_related").alias("is_related"), F.max(F.greatest(F.lit(0), (F.col("pair_id") % 2).cast("int") * F.col("is_related"))).alias("rel_readmit"))


# ---- scalars and flags --------------------------------------------------------
@query(f"WITH {DICT} SELECT l_orderkey, l_linenumber, l_partkey, coalesce(is_surgery, 0) AS is_surgery, greatest(coalesce(is_planning, 0), coalesce(is_surgery, 0)) AS planned FROM lineitem LEFT JOIN (SELECT * FROM dict WHERE code % 2 = 0) ON code = l_partkey", "coalesce_flags", "combine_planned")
def coalesce_flags(s, d):
    dic = dictionary(s, d).where("code % 2 = 0").select("code", "is_surgery", "is_planning")
    x = table(s, d, "lineitem").join(dic, F.col("code") == F.col("l_partkey"), "left")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", F.coalesce("is_surgery", F.lit(0)).alias("is_surgery"), S.either(F.col("is_planning"), F.col("is_surgery")).alias("planned"))


@query(f"WITH {PLANS} SELECT plan, greatest(start, stop) AS latest FROM plans")
def surgery_combine(s, d):
    return plans(s, d).select("plan", F.greatest("start", "stop").alias("latest"))


# ---- periods ----------------------------------------------------------------------
@query(f"WITH {ENC} SELECT DISTINCT id FROM enc WHERE CAST(start AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' OR CAST(stop AS DATE) = DATE '2024-01-21'")
def union_distinct_ids(s, d):
    e = enc(s, d)
    a = e.where(F.to_date("start").between("2024-01-10", "2024-01-20")).select("id")
    return a.union(e.where(F.to_date("stop") == F.lit("2024-01-21").cast("date")).select("id")).distinct()


@query("SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) - INTERVAL 2 MONTH AS first_day, last_day(max(o_orderdate)) AS last_day FROM orders")
def window_bounds(s, d):
    last = table(s, d, "orders").agg(F.max("o_orderdate").alias("m"))
    return last.select(F.add_months(F.trunc("m", "MM"), -2).cast("timestamp").alias("first_day"), F.last_day("m").alias("last_day"))


# ---- sources ----------------------------------------------------------------------
@query("SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) - INTERVAL 11 MONTH AS sim_start, CAST(date_trunc('month', max(o_orderdate)) AS DATE) - INTERVAL 11 MONTH - INTERVAL 1 DAY AS cutoff FROM orders")
def derive_window(s, d):
    return io.window_of(table(s, d, "orders"), "o_orderdate", 12).select(F.col("sim_start").cast("timestamp").alias("sim_start"), F.col("cutoff").cast("timestamp").alias("cutoff"))


@query("SELECT DISTINCT last_day(CAST(o_orderdate AS DATE)) AS period_end FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1998-01-01'")
def month_spine(s, d):
    spine = io.month_spine(s, "1996-01-01", "1997-12-31")
    return table(s, d, "orders").select(F.last_day("o_orderdate").alias("period_end")).join(F.broadcast(spine), "period_end").distinct()


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'")
def month_slice(s, d):
    return table(s, d, "orders").where(F.to_date("o_orderdate").between("1997-03-01", "1997-03-31")).select("o_orderkey")


@query("SELECT last_day(CAST(o_orderdate AS DATE)) AS period_end, count(*) AS n FROM orders GROUP BY 1", "segment_by_month")
def segment_by_month(s, d):
    path = io.scratch(s, "segments")
    io.write_periods(table(s, d, "orders"), "o_orderdate", path)
    return s.read.parquet(path).groupBy("period_end").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey FROM orders WHERE last_day(CAST(o_orderdate AS DATE)) IN (DATE '1997-04-30', DATE '1997-03-31')")
def retain_two_periods(s, d):
    path = io.scratch(s, "segments")
    io.write_periods(table(s, d, "orders"), "o_orderdate", path)
    return io.read_periods(s, path, F.col("period_end").isin(*[F.lit(x).cast("date") for x in ("1997-04-30", "1997-03-31")])).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE last_day(CAST(o_orderdate AS DATE)) <= DATE '1996-06-30'")
def scan_base_segment(s, d):
    path = io.scratch(s, "segments")
    io.write_periods(table(s, d, "orders"), "o_orderdate", path)
    return io.read_periods(s, path, F.col("period_end") <= F.lit("1996-06-30").cast("date")).select("o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'")
def param_query(s, d):
    table(s, d, "orders").createOrReplaceTempView("orders_by_date")
    return s.sql("SELECT o_orderkey, o_totalprice FROM orders_by_date WHERE o_orderdate >= to_timestamp(:first)", args={"first": "1997-01-01 00:00:00"})


@query("SELECT * FROM orders", "scan_csv", "append_table")
def scan_csv(s, d):
    o = table(s, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    path = io.scratch(s, "csv")
    io.write_csv(o.where("o_orderkey % 2 = 0"), path)
    io.write_csv(o.where("o_orderkey % 2 = 1"), path, "append")
    return io.read_csv(s, path, o.schema)


@query("SELECT n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey")
def scan_csv_dir(s, d):
    folder = io.scratch(s, "csv")
    given = {n: table(s, d, n) for n in ("nation", "region")}
    for n, df in given.items():
        io.write_csv(df, f"{folder}/{n}")
    got = io.read_csv_folder(s, folder, {n: df.schema for n, df in given.items()})
    return got["nation"].join(got["region"], F.col("r_regionkey") == F.col("n_regionkey")).select("n_name", "r_name")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def ctas(s, d):
    return io.stored(table(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")), "ctas")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def cached_fetch(s, d):
    """A saved result serves the second request; its build would fail."""
    path = io.scratch(s, "fetched")
    io.fetched(s, path, lambda: table(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")))

    def never():
        raise AssertionError("built again")

    return io.fetched(s, path, never)


@query("SELECT c_custkey, c_name, count(o_orderkey) AS n FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2")
def cluster_layout(s, d):
    """Two tables saved in buckets by one key; their join and the grouping after it shuffle nothing."""
    tag = uuid.uuid4().hex
    o = io.save_clustered(table(s, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), f"orders_{tag}", "c_custkey")
    c = io.save_clustered(table(s, d, "customer").select("c_custkey", "c_name"), f"customer_{tag}", "c_custkey")
    return c.join(o, "c_custkey").groupBy("c_custkey", "c_name").agg(F.count("o_orderkey").alias("n"))


@query(f"WITH {DICT} SELECT l_orderkey, l_linenumber, l_partkey, name, is_chronic FROM lineitem JOIN dict ON code = l_partkey")
def load_lookup(s, d):
    """A dictionary loaded from CSV and joined; broadcast while it is small."""
    folder = io.scratch(s, "lookup")
    dic = dictionary(s, d)
    io.write_csv(dic, f"{folder}/dictionary")
    got = io.read_csv_folder(s, folder, {"dictionary": dic.schema})["dictionary"].select(F.col("code").alias("l_partkey"), "name", "is_chronic")
    small = F.broadcast(got) if got.count() <= 1_000_000 else got
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(small, "l_partkey")


@query("SELECT o_orderkey FROM orders WHERE last_day(CAST(o_orderdate AS DATE)) IN (DATE '1997-04-30', DATE '1997-03-31')")
def union_all_periods(s, d):
    """The rows of the current and the previous period, stacked."""
    path = io.scratch(s, "segments")
    io.write_periods(table(s, d, "orders"), "o_orderdate", path)
    one = lambda x: io.read_periods(s, path, F.col("period_end") == F.lit(x).cast("date"))
    return one("1997-04-30").unionByName(one("1997-03-31")).select("o_orderkey")


@query("SELECT p_partkey, p_name FROM part", "csv_merge_append")
def csv_merge_append(s, d):
    p = table(s, d, "part").select("p_partkey", "p_name")
    return io.append_new(p.where("p_partkey % 3 <> 0"), p.where("p_partkey % 3 <> 1"), ["p_partkey"])


@query(f"WITH {SCORES} SELECT doc_id, model, p, CAST(DATE '2024-01-31' AS VARCHAR) AS period FROM scores UNION ALL SELECT doc_id, model, p, CAST(DATE '2024-02-29' AS VARCHAR) FROM scores WHERE y = 1")
def append_scores(s, d):
    path = io.scratch(s, "scores")
    x = scores(s, d).select("doc_id", "model", "p", "y")
    for _ in range(2):  # a rerun adds nothing
        io.write_snapshot(x.drop("y").withColumn("period", F.lit("2024-01-31")), path, "period")
        io.write_snapshot(x.where("y = 1").drop("y").withColumn("period", F.lit("2024-02-29")), path, "period")
    return s.read.parquet(path).withColumn("period", F.col("period").cast("string"))


@query("SELECT event_id, json_extract_string(props, '$.session') IS NULL AS missing, length(props) AS size FROM events")
def json_fields(s, d):
    return table(s, d, "events").select("event_id", F.get_json_object("props", "$.session").isNull().alias("missing"), F.char_length("props").alias("size"))


@query("SELECT CAST(1000 + n_nationkey AS VARCHAR) AS conceptId, CAST(100 + n_regionkey AS VARCHAR) AS parent FROM nation", "scan_json_concepts")
def scan_json_concepts(s, d):
    n = table(s, d, "nation")
    rel = F.array(F.struct(F.lit(True).alias("active"), F.struct(F.lit("116680003").alias("conceptId")).alias("type"), F.struct((F.col("n_regionkey") + 100).cast("string").alias("conceptId")).alias("target")))
    path = io.scratch(s, "concepts")
    n.select((F.col("n_nationkey") + 1000).cast("string").alias("conceptId"), F.lit(True).alias("active"), rel.alias("relationships")).repartition(25, "conceptId").write.option("maxRecordsPerFile", 1).json(path)
    c = io.read_concepts(s, path)
    return c.select("conceptId", F.explode("relationships").alias("r")).where("r.active and r.type.conceptId = '116680003'").select("conceptId", F.col("r.target.conceptId").alias("parent"))


# ---- metrics --------------------------------------------------------------------
AUC = f"WITH {SCORES}, g AS (SELECT model, p, sum(y) AS pos, sum(1 - y) AS neg FROM scores GROUP BY 1, 2), c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn FROM g WINDOW w AS (PARTITION BY model ORDER BY p DESC ROWS UNBOUNDED PRECEDING))"


@query(f"{AUC} SELECT model, round(sum(pos * (nn - fp + neg / 2.0)) / max(np * nn), 9) AS roc_auc FROM c GROUP BY model")
def metric_roc_auc(s, d):
    return M.roc_auc(scores(s, d)).withColumn("roc_auc", F.round("roc_auc", 9))


@query(f"{AUC} SELECT model, round(sum(pos * tp / CAST(tp + fp AS DOUBLE)) / max(np), 9) AS avg_precision FROM c GROUP BY model")
def metric_avg_precision(s, d):
    return M.average_precision(scores(s, d)).withColumn("avg_precision", F.round("avg_precision", 9))


@query(f"WITH {SCORES} SELECT model, round(avg((p - y) * (p - y)), 9) AS brier FROM scores GROUP BY model")
def metric_brier(s, d):
    return M.brier(scores(s, d)).withColumn("brier", F.round("brier", 9))


CONF = "count(*) FILTER (p >= t AND y = 1) AS tp, count(*) FILTER (p >= t AND y = 0) AS fp, count(*) FILTER (p < t AND y = 1) AS fn, count(*) FILTER (p < t AND y = 0) AS tn"
THRESHOLDS = [round(0.5 + 0.05 * i, 2) for i in range(10)]
TS = "(VALUES " + ", ".join(f"(CAST({t} AS DOUBLE))" for t in THRESHOLDS) + ") ts(t)"
PRF = f"WITH {SCORES}, x AS (SELECT model, t, {CONF} FROM scores, {TS} GROUP BY 1, 2) SELECT *, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0 END AS f1 FROM x"


@query(PRF, "threshold_confusion", "metric_prf")
def threshold_confusion(s, d):
    return M.confusion(M.at_thresholds(scores(s, d), THRESHOLDS), ["model", "t"], F.col("hit"))


@query(f"WITH {SCORES} SELECT model, t, count(*) FILTER (p >= t) AS flagged FROM scores, {TS} GROUP BY 1, 2")
def threshold_sweep(s, d):
    return M.at_thresholds(scores(s, d), THRESHOLDS).groupBy("model", "t").agg(F.count_if("hit").alias("flagged"))


PSI = f"WITH {SCORES}, h AS (SELECT model, least(greatest(CAST(floor(p * 10) AS INTEGER), 0), 9) AS bin, count(*) AS n FROM scores GROUP BY 1, 2), f AS (SELECT bin, coalesce(max(n) FILTER (model = 'a'), 0) + 1e-8 AS b, coalesce(max(n) FILTER (model = 'b'), 0) + 1e-8 AS c FROM range(10) r(bin) LEFT JOIN h USING (bin) GROUP BY bin), q AS (SELECT b / sum(b) OVER () AS b, c / sum(c) OVER () AS c FROM f) SELECT round(sum((c - b) * ln(c / b)), 6) AS psi FROM q"


@query(PSI)
def psi(s, d):
    x = scores(s, d)
    return M.psi(M.histogram(x.where("model = 'a'")), M.histogram(x.where("model = 'b'"))).withColumn("psi", F.round("psi", 6))


GAIN = f"""WITH {SCORES}, k AS (SELECT *, CAST((doc_id * 7) % 50 AS DOUBLE) AS cost_per_day, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST((doc_id * 3) % 60 AS DOUBLE) END AS prev_cost, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE CAST(doc_id % 1000 AS DOUBLE) END AS readmission_cost FROM scores),
 g AS (SELECT k.*, t, p >= t AS hit, CASE WHEN p >= t THEN CAST({1 - 0.9 ** 3!r} AS DOUBLE) * p * coalesce(readmission_cost, 0) - 3 * greatest(coalesce(cost_per_day, 0), coalesce(prev_cost, 0)) ELSE 0 END AS gain FROM k, {TS}),
 tot AS (SELECT model, t, round(sum(gain), 4) AS gain, sum(CASE WHEN hit AND y = 1 THEN coalesce(readmission_cost, 0) ELSE 0 END) AS at_stake FROM g GROUP BY 1, 2), pct AS (SELECT *, CASE WHEN at_stake > 0 THEN round(100 * gain / at_stake, 4) ELSE 0 END AS pct_saved FROM tot)"""


def _gain(s, d):
    i = F.col("doc_id")
    x = M.at_thresholds(scores(s, d), THRESHOLDS).withColumns(
        {"cost_per_day": ((i * 7) % 50).cast("double"), "prev_cost": F.when(i % 4 != 0, (i * 3) % 60).cast("double"), "readmission_cost": F.when(i % 5 != 0, i % 1000).cast("double"), "prob": F.col("p")}
    )
    return K.gains(x)


def _saved(s, d):
    x = K.saved(_gain(s, d), ["model", "t"]).withColumn("gain", F.round("gain", 4))
    return x.withColumn("pct_saved", F.when(F.col("at_stake") > 0, F.round(100 * F.col("gain") / F.col("at_stake"), 4)).otherwise(0.0))


@query(f"{GAIN} SELECT model, t, gain, at_stake, pct_saved FROM pct", "gain_totals", "pct_saved")
def gain_totals(s, d):
    return _saved(s, d)


@query(f"{GAIN} SELECT doc_id, model, t, round(gain, 6) AS gain FROM g")
def gain(s, d):
    return _gain(s, d).select("doc_id", "model", "t", F.round("gain", 6).alias("gain"))


@query(f"{GAIN} SELECT model, arg_max(t, (pct_saved, -t)) AS t, max(pct_saved) AS pct_saved FROM pct GROUP BY model")
def argmax_threshold(s, d):
    return _saved(s, d).groupBy("model").agg(F.max_by("t", F.struct("pct_saved", -F.col("t"))).alias("t"), F.max("pct_saved").alias("pct_saved")).orderBy("model")


_P, _D = "(CAST(1 + doc_id % 9 AS DOUBLE) / 20)", "(CAST(1 + doc_id % 9 AS DOUBLE) / 20 + CAST(doc_id % 3 AS DOUBLE) * 0.07)"


@query(f"SELECT doc_id, CAST(ceil(ln(1 - {_D}) / ln(1 - {_P})) AS BIGINT) AS days, round(1 - pow(1 - {_P}, ceil(ln(1 - {_D}) / ln(1 - {_P}))), 6) AS reached FROM labels")
def intervention_days(s, d):
    """Days that each row's own wish needs at its own daily effect, and what they really reach."""
    i = F.col("doc_id")
    p = (1 + i % 9).cast("double") / 20
    x = table(s, d, "labels").select("doc_id", p.alias("p"), (p + (i % 3).cast("double") * 0.07).alias("d"))
    days = S.intervention_days(F.col("p"), F.col("d")).cast("bigint")
    return x.select("doc_id", days.alias("days"), F.round(S.reached(F.col("p"), days), 6).alias("reached"))


GRID = "(VALUES " + ", ".join(f"({p}, {dd}, {n}, CAST({r!r} AS DOUBLE))" for p, dd, n, r in K.grid()) + ") grid(pp, dd, days, reached)"


@query(f"WITH {SCORES} SELECT CAST(pp AS DOUBLE) AS pp, CAST(dd AS DOUBLE) AS dd, round(sum(reached * p * 100 - days * (doc_id % 50)), 1) AS gain FROM scores, {GRID} WHERE p >= 0.8 GROUP BY 1, 2")
def cost_grid(s, d):
    g = s.createDataFrame(K.grid(), "pp double, dd double, days int, reached double")
    x = scores(s, d).where("p >= 0.8").crossJoin(F.broadcast(g))  # the grid is a parameter of 55 rows
    return x.groupBy("pp", "dd").agg(F.round(F.sum(F.col("reached") * F.col("p") * 100 - F.col("days") * (F.col("doc_id") % 50)), 1).alias("gain"))


@query(f"WITH {SCORES} SELECT doc_id, model, least(doc_id % 50, doc_id % 37) * CASE WHEN p >= 0.9 THEN 3 WHEN p >= 0.7 THEN 2 WHEN p >= 0.5 THEN 1 ELSE 0 END AS cost FROM scores")
def tiered_intervention(s, d):
    days = F.when(F.col("p") >= 0.9, 3).when(F.col("p") >= 0.7, 2).when(F.col("p") >= 0.5, 1).otherwise(0)
    return scores(s, d).select("doc_id", "model", (F.least(F.col("doc_id") % 50, F.col("doc_id") % 37) * days).alias("cost"))


@query(f"WITH {SCORES} SELECT doc_id, model, p, quality FROM scores JOIN labels USING (doc_id)")
def join_scores_actuals(s, d):
    return scores(s, d).drop("y").join(table(s, d, "labels").select("doc_id", "quality"), "doc_id")


# ---- checks -----------------------------------------------------------------------
@query(f"WITH {MEM}, a AS (SELECT stay_id, count(*) AS na FROM mem GROUP BY 1), b AS (SELECT id AS stay_id, count(*) AS nb FROM enc WHERE class IN ('inpatient','emergency') GROUP BY 1) SELECT CAST(coalesce(sum(na), 0) AS BIGINT) AS rows_a, CAST(coalesce(sum(nb), 0) AS BIGINT) AS rows_b, count(*) FILTER (na IS NULL) AS missing, count(*) FILTER (nb IS NULL) AS extra, count(*) FILTER (na > 1) AS repeated FROM a FULL JOIN b USING (stay_id)", "check_counts", "check_keyset")
def check_counts(s, d):
    return Q.key_sets(mem(s, d).select("stay_id"), enc(s, d).where("class in ('inpatient', 'emergency')").select(F.col("id").alias("stay_id")), "stay_id")


@query("SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys, count(*) - count(DISTINCT l_orderkey) AS repeated FROM lineitem")
def check_unique(s, d):
    return Q.unique(table(s, d, "lineitem"), "l_orderkey")


@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def group_having_dupes(s, d):
    return Q.repeated(table(s, d, "lineitem"), "l_orderkey")


@query(f"WITH {DICT} SELECT count(*) FILTER (is_chronic IS NULL OR is_chronic NOT IN (0, 1)) AS bad_is_chronic, count(*) FILTER (has_a IS NULL OR has_a NOT IN (0, 1)) AS bad_has_a, CAST(max(is_chronic) = 0 AS INTEGER) AS zero_is_chronic, CAST(max(has_a) = 0 AS INTEGER) AS zero_has_a FROM dict")
def check_flags(s, d):
    return Q.flags(dictionary(s, d), "is_chronic", "has_a")


@query(f"WITH {COST} SELECT count(*) FILTER (total IS NULL) AS no_total, count(*) FILTER (total < 0) AS negative, count(*) FILTER (total < base + procedures + medications - 1) AS too_small, count(*) FILTER (procedures = 0) AS without FROM cost", "check_costs", "count_if_many")
def check_costs(s, d):
    c = costed(stays(s, d))
    report = Q.violations(c, no_total=F.col("total").isNull(), negative=F.col("total") < 0, too_small=F.col("total") < F.col("base") + F.col("procedures") + F.col("medications") - 1, without=F.col("procedures") == 0)
    return Q.demand(report, "no_total", "negative", "too_small")


@query(f"WITH {EPS} SELECT count(*) FILTER (stay_days <= 0) AS no_days, count(*) FILTER (cents < 0) AS negative FROM eps")
def check_costs_grouped(s, d):
    return Q.violations(eps(s, d), no_days=F.col("stay_days") <= 0, negative=F.col("cents") < 0)


# ---- features and models --------------------------------------------------------
FEATS = "feats AS (SELECT o_orderkey AS id, coalesce(o_totalprice, 0) AS price, CAST(o_custkey % 17 AS DOUBLE) AS visits, o_orderpriority AS priority, o_orderdate AS seen, CAST(o_totalprice > 150000 AND o_custkey % 17 > 4 AS INTEGER) AS label FROM orders)"
LEVELS = {"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}
DUMMY = ", ".join(f"CAST(priority = '{v}' AS INTEGER) AS \"priority_{v}\"" for v in LEVELS["priority"])


def feats(s, d):
    o = table(s, d, "orders").withColumn("o_totalprice", F.coalesce("o_totalprice", F.lit(0.0)))
    label = ((F.col("o_totalprice") > 150000) & (F.col("o_custkey") % 17 > 4)).cast("int")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), (F.col("o_custkey") % 17).cast("double").alias("visits"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").cast("timestamp").alias("seen"), label.alias("label"))


@query(f"WITH {FEATS} SELECT id, price, visits FROM feats")
def feat_select_fill(s, d):
    return feats(s, d).select("id", "price", "visits").fillna(0)


@query(f"WITH {FEATS} SELECT id, 'x' AS side, 'price' AS name, price AS value FROM feats UNION ALL SELECT id, 'x', 'visits', visits FROM feats UNION ALL SELECT id, 'y', 'label', CAST(label AS DOUBLE) FROM feats")
def feat_split_xy(s, d):
    """Features and labels as two tables, shown in long form."""
    x, y = ML.split_xy(feats(s, d).select("id", "price", "visits", "label"), "id", ["label"])
    long_form = lambda df, side: df.unpivot("id", [F.col(c).cast("double").alias(c) for c in df.columns if c != "id"], "name", "value").select("id", F.lit(side).alias("side"), "name", "value")
    return long_form(x, "x").union(long_form(y, "y"))


@query(f"WITH {FEATS} SELECT id, {DUMMY} FROM feats", "feat_dummies")
def feat_dummies(s, d):
    return ML.dummies(feats(s, d).select("id", "priority"), LEVELS)


@query(f"WITH {FEATS} SELECT id, round(ln(1 + price), 9) AS log_price, round(ln(1 + visits), 9) AS log_visits FROM feats")
def feat_log1p(s, d):
    x = ML.log1p(feats(s, d).select("id", "price", "visits"), ["price", "visits"])
    return x.select("id", F.round("log_price", 9).alias("log_price"), F.round("log_visits", 9).alias("log_visits"))


@query(f"WITH {FEATS} SELECT CASE WHEN seen < TIMESTAMP '1997-06-01 00:00:00' THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM feats WHERE seen < TIMESTAMP '1997-07-01 00:00:00' GROUP BY 1")
def split_by_time(s, d):
    x = feats(s, d).where(F.col("seen") < F.lit("1997-07-01").cast("timestamp"))
    return x.groupBy(F.when(F.col("seen") < F.lit("1997-06-01").cast("timestamp"), "train").otherwise("test").alias("part")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, CASE WHEN quality = 0 THEN 0 ELSE toxic END AS toxic FROM labels")
def label_consistency(s, d):
    return table(s, d, "labels").select("doc_id", F.when(F.col("quality") == 0, 0).otherwise(F.col("toxic")).alias("toxic"))


@query(f"WITH {FEATS} SELECT id, CAST(priority = '1-URGENT' AS INTEGER) AS \"priority_1-URGENT\", 0 AS \"priority_2-HIGH\", 0 AS \"priority_3-MEDIUM\" FROM feats WHERE seen >= TIMESTAMP '1998-01-01 00:00:00'")
def align_columns(s, d):
    """Later rows with levels of their own, brought to the columns of the training rows."""
    later = feats(s, d).where(F.col("seen") >= F.lit("1998-01-01").cast("timestamp")).select("id", "priority")
    train = ML.dummies(feats(s, d).select("id", "priority"), LEVELS).columns
    return ML.aligned(ML.dummies(later, {"priority": ["1-URGENT", "9-NEW"]}), train)


@query(f"WITH {FEATS} SELECT id, round((price - avg(price) OVER ()) / stddev_samp(price) OVER (), 6) AS price, round((visits - avg(visits) OVER ()) / stddev_samp(visits) OVER (), 6) AS visits FROM feats")
def scale(s, d):
    """Standardised columns, fitted on all rows."""
    return ML.standardised(feats(s, d).select("id", "price", "visits"), "id", ["price", "visits"]).select("id", F.round("price", 6).alias("price"), F.round("visits", 6).alias("visits"))


@query("SELECT o_orderkey AS id, CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 5 = 0 THEN 'test' ELSE 'train' END AS part FROM orders")
def split_random(s, d):
    """A fifth of the rows by a hash of their key: the same rows in every run and on every cluster."""
    h = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("bigint")
    return feats(s, d).select("id", F.when(h % 5 == 0, "test").otherwise("train").alias("part"))


FEATURES = ["log_price", "visits"]


def model_rows(s: SparkSession, d: str) -> DataFrame:
    """Features, the two labels ``label`` and ``label_late``, and weights."""
    x = ML.log1p(feats(s, d).drop("priority"), ["price"]).withColumn("label_late", F.greatest("label", (F.col("visits") > 12).cast("int")))
    return io.stored(ML.balanced(x, "label"), "model-rows")


def fitted(x: DataFrame, kind: str, label: str = "label", **params) -> PipelineModel:
    """A model of rows before the test month."""
    return ML.classifier(kind, label, FEATURES, **params).fit(x.where(F.col("seen") < F.lit("1997-06-01").cast("timestamp")))


def _fit(kind: str):
    def run(s, d):
        x = model_rows(s, d)
        return ML.scored(fitted(x, kind), x, "id", kind)

    return run


for _kind in ("logreg", "rf", "gbt"):
    query(None, f"fit_{_kind}")(_fit(_kind))


@query(None)
def save_load_model(s, d):
    """A saved model is loaded, and not fitted again where it is there."""
    x, path = model_rows(s, d), io.scratch(s, "model")
    ML.saved_or_fitted(path, lambda: fitted(x, "logreg"))
    return ML.scored(ML.saved_or_fitted(path, None), x, "id", "logreg")


@query(None)
def score(s, d):
    """Probabilities of a month, appended to the score history under the month's end."""
    x, out = model_rows(s, d), io.scratch(s, "scores")
    month = x.where(F.last_day("seen") == F.lit("1997-06-30").cast("date"))
    io.write_snapshot(ML.scored(fitted(x, "logreg"), month, "id", "logreg").withColumn("end_date", F.lit("1997-06-30")), out, "end_date")
    return s.read.parquet(out)


@query(None)
def coefs(s, d):
    return s.createDataFrame(ML.coefficients(fitted(model_rows(s, d), "logreg"), FEATURES), "feature string, value double, share double")


@query(None)
def evaluate_models(s, d):
    """Metrics of the three models for both labels on rows that they have not learned from, with the feature that weighs most."""
    x, all_scores, heaviest = model_rows(s, d), None, []
    later = x.where(F.col("seen") >= F.lit("1997-06-01").cast("timestamp"))
    for kind in ("logreg", "rf", "gbt"):
        for label in ("label", "label_late"):
            model = fitted(x, kind, label)
            top = max(ML.coefficients(model, FEATURES), key=lambda r: abs(r[1]))
            heaviest.append((f"{kind}/{label}", top[0], top[2]))
            p = ML.scored(model, later, "id", f"{kind}/{label}").join(later.select("id", F.col(label).alias("y")), "id").withColumnRenamed("prob", "p")
            all_scores = p if all_scores is None else all_scores.union(p)
    p = io.stored(all_scores, "scored")
    top = s.createDataFrame(heaviest, "model string, feature string, share double")
    return M.roc_auc(p).join(M.average_precision(p), "model").join(M.brier(p), "model").join(F.broadcast(top), "model")  # six rows


@query(None)
def cv_fit(s, d):
    """A model fitted for each stratified fold, in parallel on the fold column: metrics on the rows that it has not seen."""
    x = io.stored(M.folds(model_rows(s, d), "id", "label", 3), "folds")
    models = ML.by_fold("logreg", "label", FEATURES, x, "fold", 3)
    parts = None
    for fold, model in enumerate(models):
        held = x.where(F.col("fold") == fold)
        p = ML.scored(model, held, "id", f"fold {fold}").join(held.select("id", F.col("label").alias("y")), "id").withColumnRenamed("prob", "p")
        parts = p if parts is None else parts.union(p)
    parts = io.stored(parts, "held-out")
    return M.roc_auc(parts).join(M.average_precision(parts), "model").join(parts.groupBy("model").agg(F.count("*").alias("n")), "model")


@query(None)
def tune_random(s, d):
    """Random draws of a grid, each scored by the share of costs saved over stratified folds; the best is marked."""
    x = M.folds(model_rows(s, d), "id", "label", 2)
    x = io.stored(K.with_costs(x.withColumnRenamed("label", "y"), F.col("id")).withColumn("label", F.col("y")), "tuning")
    rows = []
    for draw in ML.draws({"regParam": [0.0001, 0.001, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]}, 3, seed=5):
        parts = None
        for fold in range(2):
            model = ML.classifier("logreg", "label", FEATURES, **draw).fit(x.where(F.col("fold") != fold))
            p = ML.scored(model, x.where(F.col("fold") == fold), "id", f"fold {fold}").withColumnRenamed("prob", "p")
            parts = p if parts is None else parts.union(p)
        scored = parts.join(x.drop("label", "weight", *FEATURES), "id").withColumn("prob", F.col("p"))
        rows.append((str(draw), K.cost_score(scored).agg(F.avg("cost_score")).first()[0]))
    best = max(r for _, r in rows)
    return s.createDataFrame([(name, value, value == best) for name, value in rows], "params string, cost_score double, best boolean")


# ---- streams ----------------------------------------------------------------------
RUNS = f"""WITH {ENC}, r AS (SELECT *, CASE WHEN start - max(stop) OVER (PARTITION BY patient ORDER BY start, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS c FROM enc), n AS (SELECT *, sum(c) OVER (PARTITION BY patient ORDER BY start, id ROWS UNBOUNDED PRECEDING) AS g FROM r)
 SELECT patient, min(start) AS stay_start, max(stop) AS stay_stop, count(*) AS members FROM n GROUP BY patient, g"""


@query(RUNS)
def episodes_running_max(s, d):
    return ST.sessions(enc(s, d), "patient", "start", "stop")


@query(RUNS)
def stream_sessions(s, d):
    """Streaming twin of the running-maximum episodes; at the end, open sessions are closed by a last mark of time."""
    schema = table(s, d, "events").schema
    marks = io.scratch(s, "marks")
    s.createDataFrame([], schema).write.parquet(marks)
    read = lambda path: s.readStream.schema(schema).parquet(path)
    raw = read(f"{d}/events.parq*t").union(read(f"{marks}/*.parq*t"))
    ev = raw.withColumn("start", F.col("ts").cast("timestamp")).select(F.col("user_id").alias("patient"), "start", F.timestamp_micros(F.unix_micros("start") + F.floor("value") * 60_000_000).alias("stop"))
    out, state = io.scratch(s, "sessions"), io.scratch(s, "sessions-state")
    made = ST.sessions(ev, "patient", "start", "stop")
    ST.run_available(made, out, state, "sessions")
    last = table(s, d, "events").agg((F.max("ts") + F.expr("interval 365 days")).alias("ts"))
    last.select(*[F.col("ts").cast(f.dataType) if f.name == "ts" else F.lit(0.0 if f.name == "value" else None).cast(f.dataType).alias(f.name) for f in schema]).write.mode("append").parquet(marks)
    return ST.run_available(made, out, state, "sessions").where("patient is not null")


@query("SELECT user_id, max(ts) AS ts, arg_max(event_id, ts) AS event_id FROM events GROUP BY user_id")
def stream_upsert(s, d):
    schema = table(s, d, "events").schema
    raw = s.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(f"{d}/events.parq*t")
    return ST.upsert_stream(raw.select("user_id", "ts", "event_id"), "user_id", "ts", io.scratch(s, "latest"), io.scratch(s, "latest-state"))
