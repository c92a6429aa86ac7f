"""Helpers by episode, the index table, and their monthly increments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import scalars as S
from strandline.operators import codes as C
from strandline.operators import episodes as E
from strandline.operators import incremental as I
from strandline.operators import quality_checks as Q
from strandline.operators import temporal as T
from strandline.plans.base import DISEASES, ENC, LATER, LONG, DICT, PLANS, SOON, SYSTEMS, UTIL, WIDE, claims, code_rows, coded, dictionary, enc, eps, long, mem, plans, query, stays, tree
from strandline.plans.stays import ANCHOR, cuts, utilization
from strandline.plans.tables import CLIN_ALL, CLIN_ROWS, COST, ZEROED, clinical, costed, main_codes, main_sql
from strandline.sources import io
from strandline.sources.io import table

#: Where the window of the index begins and ends.
FIRST, LAST = "2024-01-05", "2024-01-28"

# ---- helpers by episode -------------------------------------------------------------
_SUMMED = ["num_procedures"]
_MOST = ["num_chronic", *DISEASES, "is_planned", "had_surgery", "last_surgery"]
HELPERS = f"""{CLIN_ALL}, clin AS ({CLIN_ROWS}), {UTIL}, {COST}, sm AS (SELECT *, greatest(date_sub('day', stay_start, stay_stop), 1) AS stay_days FROM mem WHERE stay_rank BETWEEN 4 AND 6),
 sgrp AS (SELECT DISTINCT m.stay_id AS grp, l.code FROM sm m JOIN long l ON l.encounter = m.id), {main_sql('sgrp', 'smain')},
 flags AS (SELECT m.stay_id, any_value(m.patient) AS patient, CAST(sum(num_procedures) AS BIGINT) AS num_procedures, {', '.join(f'max({c}) AS {c}' for c in _MOST)} FROM sm m LEFT JOIN clin ON clin.encounter = m.id GROUP BY m.stay_id),
 cg AS (SELECT f.*, main_code, main_name, {', '.join(f'coalesce({c}, 0) AS {c}' for c in ZEROED)} FROM flags f LEFT JOIN smain ON grp = stay_id),
 kg AS (SELECT m.stay_id, any_value(m.patient) AS patient, max(m.stay_days) AS stay_days, max(k.base) AS admission, CAST(sum(k.procedures) AS BIGINT) AS procedures, CAST(sum(k.medications) AS BIGINT) AS medications, CAST(sum(k.total) AS BIGINT) AS total,
 CAST(sum(k.procedures) + sum(k.medications) AS DOUBLE) / max(m.stay_days) AS per_day FROM sm m LEFT JOIN cost k ON k.stay_id = m.id GROUP BY m.stay_id),
 stayplan AS (SELECT m.stay_id, 1 AS planned FROM sm m JOIN plan1 ON plan1.encounter = m.id GROUP BY 1),
 used AS (SELECT u.stay_id, u.patient, u.stay_rank, u.stay_start, u.stay_stop, admissions, total_days, CASE WHEN admissions > 0 THEN prev_cents / CAST(admissions AS DOUBLE) END AS avg_prev, prev_stay_id, prev_stay_date, following_stay_id, following_stay_date, days_to_readmit,
 CASE WHEN planned = 1 THEN 0 ELSE readmit_soon END AS readmit_soon, CASE WHEN planned = 1 THEN 0 ELSE readmit_later END AS readmit_later, kg.total AS following_cost, CASE WHEN planned = 1 OR readmit_later = 0 THEN 0 ELSE 1 END AS unplanned
 FROM util u LEFT JOIN stayplan p ON p.stay_id = u.following_stay_id LEFT JOIN kg ON kg.stay_id = u.following_stay_id)"""


def members(s: SparkSession, d: str, rows: DataFrame | None = None) -> DataFrame:
    """The encounters of clinical episodes."""
    return mem(s, d, rows).where("stay_rank between 4 and 6")


def clinical_grouped(s: SparkSession, d: str, rows: DataFrame, clin: DataFrame, up: DataFrame | None = None, m: DataFrame | None = None, codes: DataFrame | None = None) -> DataFrame:
    """One row for each clinical episode of ``rows`` (encounters): flags of its members, and its main code.

    ``codes`` (encounter, code) are those of claims, read from the tables where they are not given.
    """
    m = io.stored(members(s, d, rows).select("id", "patient", "stay_id"), "members") if m is None else m
    flags = m.join(clin.select(F.col("encounter").alias("id"), *_SUMMED, *_MOST), "id", "left").groupBy("stay_id").agg(
        F.max("patient").alias("patient"), *[F.sum(c).alias(c) for c in _SUMMED], *[F.max(c).alias(c) for c in _MOST]
    )
    main = grouped_main(s, d, m, up, codes)
    out = flags.join(main, "stay_id", "left")
    return out.select("stay_id", "patient", *_SUMMED, *_MOST, "main_code", "main_name", *[F.coalesce(c, F.lit(0)).alias(c) for c in ZEROED])


def grouped_main(s: SparkSession, d: str, m: DataFrame, up: DataFrame | None = None, codes: DataFrame | None = None) -> DataFrame:
    """The main code of each episode of ``m`` (id, stay_id) with its dictionary row, by :func:`main_codes`; ``codes`` as in :func:`clinical_grouped`."""
    own = m.select(F.col("id").alias("encounter"), F.col("stay_id").alias("grp"))
    codes = long(s, d).select("encounter", "code") if codes is None else codes
    groups = io.stored(codes.join(own, "encounter").select("grp", "code").distinct(), "groups")
    return main_codes(s, d, groups, up).withColumnRenamed("grp", "stay_id")


def cost_grouped(s: SparkSession, d: str, rows: DataFrame, costs: DataFrame, m: DataFrame | None = None) -> DataFrame:
    """One row for each clinical episode of ``rows`` with the costs of its members."""
    m = members(s, d, rows) if m is None else m
    m = m.select("id", "patient", "stay_id", "stay_days").join(costs.drop("patient").withColumnRenamed("stay_id", "id"), "id", "left")
    out = m.groupBy("stay_id").agg(
        F.max("patient").alias("patient"), F.max("stay_days").alias("stay_days"), F.max("base").alias("admission"),
        F.sum("procedures").alias("procedures"), F.sum("medications").alias("medications"), F.sum("total").alias("total"),
    )
    return out.withColumn("per_day", (F.col("procedures") + F.col("medications")).cast("double") / F.col("stay_days"))


def planned_encounters(s: SparkSession, d: str) -> DataFrame:
    """The first encounter of each patient after a planning procedure."""
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("encounter"), F.col("o_custkey").alias("patient"), F.col("o_orderdate").cast("timestamp").alias("seen"))
    planning = dictionary(s, d).where("is_planning = 1").select(F.col("code").alias("l_partkey"))
    ev = table(s, d, "lineitem").where("l_returnflag = 'R'").join(planning, "l_partkey", "left_semi").select(F.col("l_orderkey").alias("encounter"), F.col("l_shipdate").cast("timestamp").alias("ts"))
    first = ev.join(o.drop("seen"), "encounter").groupBy("patient").agg(F.min("ts").alias("t"))
    return o.join(first, "patient").where("seen > t").groupBy("patient").agg(F.min_by("encounter", F.struct("seen", "encounter")).alias("id")).select("id")


def used(u: DataFrame, planned: DataFrame, costs: DataFrame) -> DataFrame:
    """Utilization (:func:`utilization`) with the plan and the cost of the following stay: ``planned`` (stay_id, is_planned), ``costs`` (stay_id, total)."""
    after = planned.select(F.col("stay_id").alias("following_stay_id"), F.col("is_planned").alias("planned"))
    cost = costs.select(F.col("stay_id").alias("following_stay_id"), F.col("total").alias("following_cost"))
    x = C.spread_join(u, after.join(cost, "following_stay_id", "full"), "following_stay_id", "stay_id")
    x = x.withColumns({c: S.suppressed(F.col(c), F.col("planned")) for c in ("readmit_soon", "readmit_later")})
    return x.select(
        "stay_id", "patient", "stay_rank", "stay_start", "stay_stop", "admissions", "total_days", F.try_divide(F.col("prev_cents").cast("double"), F.col("admissions")).alias("avg_prev"), "prev_stay_id", "prev_stay_date",
        "following_stay_id", "following_stay_date", "days_to_readmit", "readmit_soon", "readmit_later", "following_cost", S.flag(F.col("readmit_later") != 0).alias("unplanned"),
    )


def grouped_use(s: SparkSession, d: str, rows: DataFrame, costs: DataFrame | None = None, m: DataFrame | None = None) -> DataFrame:
    """Utilization of the episodes of ``rows`` in full: only the plan and the cost of following stays are computed for it."""
    m = io.stored(mem(s, d, rows), "members") if m is None else m
    episodes = io.stored(E.episode_table(m, "patient", F.sum("cents").alias("cents")), "episodes")
    own = m.where("stay_rank between 4 and 6").select("id", "stay_id")
    plan = own.join(planned_encounters(s, d), "id", "left_semi").select("stay_id").distinct().withColumn("is_planned", F.lit(1))
    cost = own.join((costed(stays(s, d)) if costs is None else costs).select(F.col("stay_id").alias("id"), "total"), "id").groupBy("stay_id").agg(F.sum("total").alias("total"))
    return used(utilization(s, d, episodes), plan, cost)


@query(f"WITH {HELPERS} SELECT * FROM cg")
def build_helper_clinical_grouped(s, d):
    return clinical_grouped(s, d, enc(s, d), clinical(s, d))


@query(f"WITH {HELPERS} SELECT * FROM kg")
def build_helper_cost_grouped(s, d):
    return cost_grouped(s, d, enc(s, d), costed(stays(s, d)))


@query(f"WITH {HELPERS} SELECT * FROM used")
def build_helper_utilization(s, d):
    return grouped_use(s, d, enc(s, d))


# ---- feeds --------------------------------------------------------------------------
RELATED = f"""{HELPERS}, pairs AS (SELECT u.stay_id, u.patient, a.main_code AS code, u.following_stay_id AS fol_id, b.main_code AS sec_code, u.readmit_soon, u.readmit_later FROM used u LEFT JOIN cg a ON a.stay_id = u.stay_id LEFT JOIN cg b ON b.stay_id = u.following_stay_id),
 anc AS (SELECT node, ancestor FROM above WHERE ancestor >= 10), own AS (SELECT node, ancestor FROM anc UNION SELECT p_partkey, p_partkey FROM part),
 hits AS (SELECT DISTINCT q.stay_id FROM pairs q JOIN anc x ON x.node = q.code JOIN own y ON y.node = q.sec_code AND y.ancestor = x.ancestor),
 marked AS (SELECT q.*, CASE WHEN code IS NULL OR sec_code IS NULL THEN 0 WHEN h.stay_id IS NOT NULL THEN 1 ELSE -1 END AS is_related FROM pairs q LEFT JOIN hits h ON h.stay_id = q.stay_id),
 rel AS (SELECT stay_id, any_value(patient) AS patient, max(is_related) AS is_related, max(greatest(0, readmit_soon * is_related)) AS rel_soon, max(greatest(0, readmit_later * is_related)) AS rel_later FROM marked GROUP BY stay_id)"""


def related_pairs(use: DataFrame, grouped: DataFrame) -> DataFrame:
    """Each index stay with its own main code, and the id and main code of the stay that follows."""
    main = grouped.select("stay_id", F.col("main_code").alias("code"))
    after = grouped.select(F.col("stay_id").alias("following_stay_id"), F.col("main_code").alias("sec_code"))
    x = C.spread_join(use.select("stay_id", "patient", "following_stay_id", "readmit_soon", "readmit_later").join(main, "stay_id", "left"), after, "following_stay_id", "stay_id")
    return x.select("stay_id", "patient", "code", F.col("following_stay_id").alias("fol_id"), "sec_code", "readmit_soon", "readmit_later")


def _marked(pairs: DataFrame, up: DataFrame) -> DataFrame:
    return C.related(pairs.withColumnsRenamed({"stay_id": "pair_id", "code": "code1", "sec_code": "code2"}), up).withColumnsRenamed({"pair_id": "stay_id", "code1": "code", "code2": "sec_code"})


def related_stays(s: SparkSession, d: str, pairs: DataFrame, up: DataFrame | None = None) -> DataFrame:
    """For each stay whether its readmission is related to it, and the readmission flags that are.

    Ancestors below 10 relate nothing. In a tree of codes what lies above them is below 10, too, so the
    closure ``up`` may be one that has followed them.
    """
    up = C.closure(tree(s, d), stop=F.col("ancestor") < 10) if up is None else up.where("ancestor >= 10")
    x = _marked(pairs, up)
    clip = lambda c: F.max(F.greatest(F.lit(0), F.col(c) * F.col("is_related")))
    return x.groupBy("stay_id").agg(F.max("patient").alias("patient"), F.max("is_related").alias("is_related"), clip("readmit_soon").alias("rel_soon"), clip("readmit_later").alias("rel_later"))


def _built(s: SparkSession, d: str, rows: DataFrame, clin: DataFrame, costs: DataFrame, up: DataFrame | None = None, codes: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every table by episode of ``rows``, on one closure and one pass over the episodes."""
    up = C.closure(tree(s, d)) if up is None else up
    m = io.stored(mem(s, d, rows), "members")
    clinic = m.where("stay_rank between 4 and 6")
    cg = io.stored(clinical_grouped(s, d, rows, clin, up, clinic.select("id", "patient", "stay_id"), codes), "clinical-grouped")
    kg = io.stored(cost_grouped(s, d, rows, costs, clinic), "cost-grouped")
    episodes = E.episode_table(m, "patient", F.sum("cents").alias("cents"))
    u = io.stored(used(utilization(s, d, episodes), cg, kg), "utilization")
    rel = io.stored(related_stays(s, d, related_pairs(u, cg), up), "related")
    return {"clinical_grouped": cg, "cost_grouped": kg, "utilization": u, "related": rel}


@query(f"WITH {RELATED} SELECT stay_id, code, fol_id, sec_code, readmit_soon, readmit_later FROM pairs")
def related_feed(s, d):
    m = io.stored(mem(s, d), "members")
    main = grouped_main(s, d, m.where("stay_rank between 4 and 6").select("id", "stay_id"))
    return related_pairs(grouped_use(s, d, enc(s, d), m=m), io.stored(main.select("stay_id", "main_code"), "main")).drop("patient")


FEED = f"WITH {UTIL}, {LONG} SELECT m.id, m.stay_id, {', '.join(WIDE)} FROM mem m LEFT JOIN claims c ON c.encounter = m.id"


@query(FEED)
def main_diag_feed(s, d):
    """Each encounter with its episode and its wide code columns."""
    c = claims(s, d).select(F.col("encounter").alias("id"), *WIDE)
    return mem(s, d).select("id", "stay_id").join(c, "id", "left")


#: Care plans stand 9131 days before the encounters; their code is the least of their order.
CARE = f"""{CLIN_ALL}, {ENC}, {PLANS}, care AS (SELECT plan, patient, start + INTERVAL 9131 DAY AS start, stop + INTERVAL 9131 DAY AS stop, code FROM plans LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS code FROM lineitem GROUP BY 1) ON l_orderkey = plan),
 feed AS (SELECT DISTINCT e.id, main_code AS code, care.code AS sec_code FROM enc e JOIN cmain ON cmain.grp = e.id JOIN care ON care.patient = e.patient AND CAST(e.start AS DATE) > care.start AND CAST(e.start AS DATE) < coalesce(care.stop, DATE '2030-01-01'))"""


def care_feed(s: SparkSession, d: str, rows: DataFrame, up: DataFrame | None = None) -> DataFrame:
    """Main code of each encounter of ``rows`` beside the codes of the care plans active at its start."""
    least = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("plan")).agg(F.min("l_partkey").alias("sec_code"))
    span = rows.agg(F.min(F.to_date("start")), F.max(F.to_date("start"))).first()
    span = None if span[0] is None else tuple(span)
    p = plans(s, d).select("plan", "patient", F.date_add("start", 9131).alias("start"), F.date_add("stop", 9131).alias("stop")).join(least, "plan", "left").drop("plan")
    ids = rows.select(F.col("id").alias("encounter"))
    orders, lines = (table(s, d, t).join(ids.withColumnRenamed("encounter", c), c, "left_semi") for t, c in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")))
    groups = io.stored(code_rows(coded(s, d, orders, lines).withColumnRenamed("encounter", "grp"), "grp"), "groups")
    main = main_codes(s, d, groups.distinct(), up).select(F.col("grp").alias("id"), F.col("main_code").alias("code"))
    e = rows.select("id", "patient", F.to_date("start").alias("day")).join(main, "id")
    return T.active_intervals(e, "day", p, "start", "stop", "patient", F.lit("2030-01-01").cast("date"), span=span).select("id", "code", F.col("plan_sec_code").alias("sec_code")).distinct()


@query(f"WITH {CARE} SELECT * FROM feed")
def careplan_feed(s, d):
    return care_feed(s, d, enc(s, d))


RELATED_CARE = CARE + """, anc AS (SELECT node, ancestor FROM above WHERE ancestor >= 10), own AS (SELECT node, ancestor FROM anc UNION SELECT p_partkey, p_partkey FROM part),
 hits AS (SELECT DISTINCT q.id, q.code, q.sec_code FROM feed q JOIN anc x ON x.node = q.code JOIN own y ON y.node = q.sec_code AND y.ancestor = x.ancestor)"""


@query(f"WITH {RELATED_CARE} SELECT q.id, max(CASE WHEN q.code IS NULL OR q.sec_code IS NULL THEN 0 WHEN h.id IS NOT NULL THEN 1 ELSE -1 END) AS is_related FROM feed q LEFT JOIN hits h ON h.id = q.id AND h.code = q.code AND h.sec_code = q.sec_code GROUP BY q.id")
def careplan_related(s, d):
    """Whether an encounter's main code is related to one of its active plans."""
    pairs = io.stored(care_feed(s, d, enc(s, d)), "feed").withColumn("pair_id", F.monotonically_increasing_id())
    x = C.related(pairs.withColumnsRenamed({"code": "code1", "sec_code": "code2"}), C.closure(tree(s, d), stop=F.col("ancestor") < 10))
    return x.groupBy("id").agg(F.max("is_related").alias("is_related"))


# ---- index --------------------------------------------------------------------------
_STAY = {4: "urgentcare", 5: "emergency", 6: "inpatient"}
_KIND = "CASE u.stay_rank " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _STAY.items()) + " END"
INDEX = f"""{RELATED}, idx AS (SELECT u.patient AS patient_id, year(u.stay_start) - year(DATE '1940-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER)) AS patient_age, c_mktsegment AS segment, u.stay_id, u.stay_id % 97 AS hospital_id, u.stay_start AS admission_datetime, u.stay_stop AS discharge_datetime, CAST(u.stay_stop AS DATE) AS discharge_date,
 CAST(year(u.stay_stop) AS INTEGER) AS discharge_year, CAST(month(u.stay_stop) AS INTEGER) AS discharge_month, kg.stay_days AS length_of_stay, {_KIND} AS stay_type, cg.main_code, cg.main_name, {', '.join(f'cg.{c}' for c in (*ZEROED, 'num_chronic', 'num_procedures', *DISEASES, 'had_surgery', 'is_planned'))},
 kg.admission AS admission_cost, kg.procedures AS total_procedure_costs, kg.medications AS total_medication_costs, kg.total AS total_stay_cost, kg.per_day AS cost_per_day_stay, admissions, total_days, avg_prev, u.readmit_soon, u.readmit_later, is_related, rel_soon, rel_later, days_to_readmit, following_stay_id, following_cost AS total_readmission_cost, unplanned
 FROM used u LEFT JOIN customer ON c_custkey = u.patient LEFT JOIN cg USING (stay_id) LEFT JOIN kg USING (stay_id) LEFT JOIN rel USING (stay_id) WHERE u.stay_start > TIMESTAMP '{FIRST} 00:00:00' AND u.stay_stop <= TIMESTAMP '{LAST} 00:00:00')"""


def assemble(s: SparkSession, d: str, t: dict[str, DataFrame], first: str = FIRST, last: str = LAST, more: tuple[str, ...] = ()) -> DataFrame:
    """One row of 54 columns, and ``more``, for each clinical episode that starts after ``first`` and ends by ``last``.

    ``grouped`` in ``t`` may stand for both of the tables by episode.
    """
    c = F.col("c_custkey")
    people = table(s, d, "customer").select(c.alias("patient"), F.col("c_mktsegment").alias("segment"), F.date_add(F.lit("1940-01-01").cast("date"), (c * 37 % 20000).cast("int")).alias("birth"))
    u = t["utilization"].where((F.col("stay_start") > F.lit(first).cast("timestamp")) & (F.col("stay_stop") <= F.lit(last).cast("timestamp")))
    kinds = F.element_at(F.create_map(*[F.lit(x) for kv in _STAY.items() for x in kv]), F.col("stay_rank"))
    names = {"stay_days": "length_of_stay", "admission": "admission_cost", "procedures": "total_procedure_costs", "medications": "total_medication_costs", "total": "total_stay_cost", "per_day": "cost_per_day_stay"}
    x = u.join(people, "patient", "left")
    for one in [t["grouped"]] if "grouped" in t else [t["clinical_grouped"], t["cost_grouped"]]:
        x = x.join(one.drop("patient").withColumnsRenamed(names), "stay_id", "left")
    x = x.join(t["related"].drop("patient"), "stay_id", "left")
    return x.select(
        F.col("patient").alias("patient_id"), S.age(F.col("birth"), F.col("stay_start")).alias("patient_age"), "segment", "stay_id", (F.col("stay_id") % 97).alias("hospital_id"),
        F.col("stay_start").alias("admission_datetime"), F.col("stay_stop").alias("discharge_datetime"), F.to_date("stay_stop").alias("discharge_date"), F.year("stay_stop").alias("discharge_year"), F.month("stay_stop").alias("discharge_month"),
        "length_of_stay", kinds.alias("stay_type"), "main_code", "main_name", *ZEROED, "num_chronic", "num_procedures", *DISEASES, "had_surgery", "is_planned",
        "admission_cost", "total_procedure_costs", "total_medication_costs", "total_stay_cost", "cost_per_day_stay", "admissions", "total_days", "avg_prev", "readmit_soon", "readmit_later",
        "is_related", "rel_soon", "rel_later", "days_to_readmit", "following_stay_id", F.col("following_cost").alias("total_readmission_cost"), "unplanned", *more,
    )


def _bases(s: SparkSession, d: str, up: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The tables by encounter that those by episode are made of."""
    return io.stored(clinical(s, d, up=up), "clinical"), io.stored(costed(stays(s, d)), "costs")


@query(f"WITH {INDEX} SELECT * FROM idx", "build_index_stay", "assemble_index")
def build_index_stay(s, d):
    up = C.closure(tree(s, d))
    return assemble(s, d, _built(s, d, enc(s, d), *_bases(s, d, up), up))


@query(f"WITH {INDEX} SELECT * FROM idx WHERE stay_type = 'inpatient' AND discharge_date > DATE '2024-01-10' ORDER BY stay_id")
def select_index_stay(s, d):
    """A slice of the index as it was saved."""
    saved = io.stored(build_index_stay(s, d), "index")
    return saved.where((F.col("stay_type") == "inpatient") & (F.col("discharge_date") > F.lit("2024-01-10").cast("date"))).orderBy("stay_id")


# ---- increments ---------------------------------------------------------------------
def _split(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Encounters before the cut, and since."""
    e = io.stored(enc(s, d), "encounters")
    return e.where(F.col("start") < cuts()), e.where(F.col("start") >= cuts())


def _updated(s: SparkSession, d: str, build: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """What ``build`` made of the encounters before the cut, written, after those since are added."""
    old, new = _split(s, d)
    return I.update(io.stored(build(old), name), old, new, "patient", build)


@query(f"WITH {HELPERS} SELECT * FROM cg")
def clinical_grouped_update(s, d):
    up = C.closure(tree(s, d))
    clin = io.stored(clinical(s, d, up=up).select("encounter", *_SUMMED, *_MOST), "clinical")
    codes = io.stored(long(s, d).select("encounter", "code"), "codes")
    return _updated(s, d, lambda rows: clinical_grouped(s, d, rows, clin, up, codes=codes), "clinical-grouped")


@query(f"WITH {HELPERS} SELECT * FROM kg")
def cost_grouped_update(s, d):
    costs = io.stored(costed(stays(s, d)), "costs")
    return _updated(s, d, lambda rows: cost_grouped(s, d, rows, costs), "cost-grouped")


DELTA_MAIN = f"{CLIN_ALL}, {UTIL}, egrp AS (SELECT DISTINCT m.stay_id AS grp, l.code FROM mem m JOIN long l ON l.encounter = m.id), {main_sql('egrp', 'emain')}"


@query(f"WITH {DELTA_MAIN} SELECT grp AS stay_id, main_code, main_name, num_disorders, num_findings FROM emain")
def main_diag_delta(s, d):
    """Main codes by episode after new encounters: episodes that go on are those of touched patients, and are elected anew."""
    codes = long(s, d).select(F.col("encounter").alias("id"), "code")

    def build(rows: DataFrame) -> DataFrame:
        m = io.stored(mem(s, d, rows).select("id", "patient", "stay_id"), "members")
        main = main_codes(s, d, m.join(codes, "id").select(F.col("stay_id").alias("grp"), "code").distinct()).withColumnRenamed("grp", "stay_id")
        return main.join(m.groupBy("stay_id").agg(F.max("patient").alias("patient")), "stay_id")

    return _updated(s, d, build, "main").select("stay_id", "main_code", "main_name", "num_disorders", "num_findings")


@query(f"WITH {CARE} SELECT * FROM feed")
def careplan_delta(s, d):
    """Plans of new encounters, appended to those stored; an encounter already there is left."""
    old, new = _split(s, d)
    up = C.closure(tree(s, d))
    kept = io.stored(care_feed(s, d, old, up), "care")
    fresh = io.stored(new.join(kept.select("id").distinct(), "id", "left_anti"), "fresh")
    return kept.unionByName(care_feed(s, d, fresh, up))


@query(f"WITH {LONG}, {DICT} SELECT patient, code, min(seen) AS first_seen FROM long JOIN dict USING (code) WHERE is_chronic = 1 GROUP BY 1, 2")
def known_codes_delta(s, d):
    """Chronic codes of new claims, inserted where patient and code are not known yet."""
    chronic = dictionary(s, d).where("is_chronic = 1").select("code")
    rows = io.stored(long(s, d).join(chronic, "code", "left_semi"), "codes")
    cut = F.lit("1998-01-01").cast("timestamp")
    known = io.stored(C.first_seen(rows.where(F.col("seen") < cut), "patient", "code", "seen"), "known")
    return io.append_new(known, C.first_seen(rows.where(F.col("seen") >= cut), "patient", "code", "seen"), ["patient", "code"])


@query(f"""WITH {ANCHOR}, f AS (SELECT n.*, CASE WHEN date_sub('hour', coalesce(lag(stop) OVER (PARTITION BY n.patient ORDER BY start, id), last), start) < 12 THEN 0 ELSE 1 END AS changed FROM new n LEFT JOIN old USING (patient)),
 g AS (SELECT *, sum(changed) OVER (PARTITION BY patient ORDER BY start, id ROWS UNBOUNDED PRECEDING) AS number FROM f) SELECT patient, min(start) AS stay_start, max(stop) AS stay_stop, count(*) AS members FROM g WHERE number > 0 GROUP BY patient, number""")
def continuation_skip(s, d):
    """New episodes only: the first group of a patient is left out where it goes on from the stored last stop."""
    old, new = _split(s, d)
    last = E.touched(old, new, "patient").groupBy("patient").agg(F.max("stop").alias("last"))
    flagged = E.gap_flag(new.join(last, "patient", "left"), "patient", "start", "stop", "id", anchor=F.col("last"))
    numbered = E.running_number(flagged, "patient", "start", "id").where("episode > 0")
    return numbered.groupBy("patient", "episode").agg(F.min("start").alias("stay_start"), F.max("stop").alias("stay_stop"), F.count("*").alias("members")).drop("episode")


@query(f"WITH {RELATED} SELECT stay_id, is_related, rel_soon, rel_later FROM rel")
def related_update(s, d):
    """Related stays after new encounters: those of touched patients are taken out and made anew."""
    up, costs = C.closure(tree(s, d)), io.stored(costed(stays(s, d)).select("stay_id", "total"), "costs")
    codes = io.stored(long(s, d).select("encounter", "code"), "codes")

    def build(rows: DataFrame) -> DataFrame:
        m = io.stored(mem(s, d, rows), "members")
        main = io.stored(grouped_main(s, d, m.where("stay_rank between 4 and 6").select("id", "stay_id"), up, codes).select("stay_id", "main_code"), "main")
        return related_stays(s, d, related_pairs(grouped_use(s, d, rows, costs, m), main), up)

    return _updated(s, d, build, "related").drop("patient")


@query(f"WITH {INDEX} SELECT * FROM idx")
def index_update(s, d):
    """The index after new encounters: rows of touched patients are replaced."""
    up = C.closure(tree(s, d))
    clin, costs = _bases(s, d, up)
    codes = io.stored(long(s, d).select("encounter", "code"), "codes")
    build = lambda rows: assemble(s, d, _built(s, d, rows, clin, costs, up, codes)).withColumn("patient", F.col("patient_id"))
    return _updated(s, d, build, "index").drop("patient")


# ---- the cursor ----------------------------------------------------------------------
MONTHS = "w AS (SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) - INTERVAL 11 MONTH AS sim_start, last_day(CAST(max(o_orderdate) AS DATE)) AS final_end FROM orders)"


def _opened(s: SparkSession, d: str, path: str) -> None:
    """The first control row: the period that begins the window is next."""
    o = table(s, d, "orders")
    w = io.window_of(o, "o_orderdate", 12).crossJoin(o.agg(F.last_day(F.max("o_orderdate")).alias("final_end")))  # one row each
    io.write_control(w.select(F.col("cutoff").alias("last_processed"), F.last_day("sim_start").alias("next_end"), "final_end"), path, 0)


@query(f"WITH {MONTHS} SELECT CAST(sim_start - INTERVAL 1 DAY AS DATE) AS last_processed, last_day(CAST(sim_start AS DATE)) AS next_end, final_end FROM w")
def cursor_init(s, d):
    control = io.scratch(s, "control")
    _opened(s, d, control)
    return io.read_control(s, control)[0]


# ---- checks -------------------------------------------------------------------------
_FLAGS = [*DISEASES, "is_planned", "had_surgery"]
_bad = lambda c: f"count(*) FILTER ({c} IS NULL OR {c} NOT IN (0, 1)) AS bad_{c}"
_KEYS = "SELECT CAST(coalesce(sum(na), 0) AS BIGINT) AS rows_a, CAST(coalesce(sum(nb), 0) AS BIGINT) AS rows_b, count(*) FILTER (na IS NULL) AS missing, count(*) FILTER (nb IS NULL) AS extra, count(*) FILTER (na > 1) AS repeated FROM (SELECT {k} AS k, count(*) AS na FROM {a} GROUP BY 1) FULL JOIN (SELECT {j} AS k, count(*) AS nb FROM {b} GROUP BY 1) USING (k)"
_zero = lambda c: f"CAST(coalesce(CAST(max({c}) = 0 AS INTEGER), 1) AS BIGINT) AS zero_{c}"
_NEGATIVE = "count(*) FILTER (num_chronic < 0) AS negative_chronic, count(*) FILTER (num_procedures < 0) AS negative_procedures"
#: SQL of each check, by name: one row of counts.
CHECKS = {
    "A1": _KEYS.format(k="encounter", a="clin", j="o_orderkey", b="orders"),
    "A2": "SELECT count(*) AS n_rows, count(DISTINCT stay_id) AS n_keys, count(*) - count(DISTINCT stay_id) AS repeated FROM cg",
    "B": "SELECT count(*) FILTER (encounter IS NULL) AS null_key, count(*) FILTER (main_code IS NULL) AS null_code, count(*) FILTER (main_code IS NOT NULL AND main_name IS NULL) AS nameless FROM clin",
    "C": f"SELECT {', '.join(map(_bad, _FLAGS))}, {', '.join(map(_zero, _FLAGS))}, {_NEGATIVE} FROM clin",
    "D": f"SELECT {', '.join(map(_bad, _FLAGS))}, {', '.join(map(_zero, _FLAGS))}, {_NEGATIVE} FROM cg",
    "E1": _KEYS.format(k="stay_id", a="cost", j="o_orderkey", b="orders"),
    "E2": _KEYS.format(k="stay_id", a="kg", j="stay_id", b="cg"),
    "E3": "SELECT count(*) FILTER (stay_id IS NULL) AS null_key, count(*) FILTER (total IS NULL) AS null_total, count(*) FILTER (per_day IS NULL) AS null_per_day, count(*) FILTER (least(base, procedures, medications, total) < 0 OR per_day < 0) AS negative, count(*) FILTER (total < base + procedures + medications - 1) AS too_small FROM cost",
    "E4": "SELECT count(*) FILTER (stay_days IS NULL OR stay_days <= 0) AS no_days, count(*) FILTER (least(admission, procedures, medications, total) < 0 OR per_day < 0) AS negative FROM kg",
    "U1": _KEYS.format(k="stay_id", a="used", j="stay_id", b="cg"),
    "U2": "SELECT count(*) FILTER (stay_id IS NULL) AS null_stay_id, count(*) FILTER (patient IS NULL) AS null_patient, count(*) FILTER (stay_start IS NULL) AS null_stay_start, count(*) FILTER (stay_stop IS NULL) AS null_stay_stop FROM used",
    "U3": f"SELECT count(*) FILTER (admissions < 0 OR total_days < 0 OR avg_prev < 0) AS negative, count(*) FILTER (days_to_readmit < 0) AS before, count(*) FILTER (readmit_soon NOT IN (0, 1) OR readmit_later NOT IN (0, 1)) AS bad_flag, count(*) FILTER (readmit_later = 1 AND days_to_readmit > {LATER}) AS late, count(*) FILTER (readmit_soon = 1 AND days_to_readmit > {SOON}) AS too_late FROM used",
    "U4": "SELECT count(*) FILTER (readmit_soon = 1 AND readmit_later = 0) AS implied, count(*) FILTER (following_stay_id IS NULL AND days_to_readmit IS NOT NULL) AS loose, count(*) FILTER (following_stay_id IS NULL AND readmit_later = 1) AS unfounded, count(*) FILTER (prev_stay_id IS NULL AND admissions > 0) AS without, count(*) FILTER (unplanned <> readmit_later) AS unequal FROM used",
}


def checked(s: SparkSession, d: str, clin: DataFrame | None, costs: DataFrame | None, t: dict[str, DataFrame], names: tuple[str, ...] = tuple(CHECKS)) -> DataFrame:
    """The reports of the named checks in long form (check, rule, n); raises at the first count that must be 0 and is not."""
    c = F.col
    orders = lambda: table(s, d, "orders").select(c("o_orderkey").alias("k"))
    own = lambda df, k: df.select(c(k).alias("k"))
    negative = {"negative_chronic": c("num_chronic") < 0, "negative_procedures": c("num_procedures") < 0}
    bad = [f"bad_{x}" for x in _FLAGS]
    cg, kg, u = (t.get(n) for n in ("clinical_grouped", "cost_grouped", "utilization"))
    made = {
        "A1": (lambda: Q.key_sets(own(clin, "encounter"), orders(), "k"), ("missing", "extra", "repeated")),
        "A2": (lambda: Q.unique(cg, "stay_id"), ("repeated",)),
        "B": (lambda: Q.violations(clin, null_key=c("encounter").isNull(), null_code=c("main_code").isNull(), nameless=c("main_code").isNotNull() & c("main_name").isNull()), ("null_key", "nameless")),
        "C": (lambda: Q.flags(clin, *_FLAGS, **negative), (*bad, *negative)),
        "D": (lambda: Q.flags(cg, *_FLAGS, **negative), (*bad, *negative)),
        "E1": (lambda: Q.key_sets(own(costs, "stay_id"), orders(), "k"), ("missing", "extra", "repeated")),
        "E2": (lambda: Q.key_sets(own(kg, "stay_id"), own(cg, "stay_id"), "k"), ("missing", "extra", "repeated")),
        "E3": (lambda: Q.violations(costs, null_key=c("stay_id").isNull(), null_total=c("total").isNull(), null_per_day=c("per_day").isNull(), negative=(F.least("base", "procedures", "medications", "total") < 0) | (c("per_day") < 0), too_small=c("total") < c("base") + c("procedures") + c("medications") - 1), ("null_key", "null_total", "null_per_day", "negative", "too_small")),
        "E4": (lambda: Q.violations(kg, no_days=c("stay_days").isNull() | (c("stay_days") <= 0), negative=(F.least("admission", "procedures", "medications", "total") < 0) | (c("per_day") < 0)), ("no_days", "negative")),
        "U1": (lambda: Q.key_sets(own(u, "stay_id"), own(cg, "stay_id"), "k"), ("missing", "extra", "repeated")),
        "U2": (lambda: Q.nulls(u, "stay_id", "patient", "stay_start", "stay_stop"), ("null_stay_id", "null_patient", "null_stay_start", "null_stay_stop")),
        "U3": (lambda: Q.violations(u, negative=(c("admissions") < 0) | (c("total_days") < 0) | (c("avg_prev") < 0), before=c("days_to_readmit") < 0, bad_flag=~c("readmit_soon").isin(0, 1) | ~c("readmit_later").isin(0, 1), late=(c("readmit_later") == 1) & (c("days_to_readmit") > LATER), too_late=(c("readmit_soon") == 1) & (c("days_to_readmit") > SOON)), ("negative", "before", "bad_flag", "late", "too_late")),
        "U4": (lambda: Q.violations(u, implied=(c("readmit_soon") == 1) & (c("readmit_later") == 0), loose=c("following_stay_id").isNull() & c("days_to_readmit").isNotNull(), unfounded=c("following_stay_id").isNull() & (c("readmit_later") == 1), without=c("prev_stay_id").isNull() & (c("admissions") > 0), unequal=c("unplanned") != c("readmit_later")), ("implied", "loose", "unfounded", "unequal")),
    }
    out = None
    for name in names:
        report = io.stored(made[name][0](), f"check-{name}")
        Q.demand(report, *made[name][1], name=name)
        rules = F.array(*[F.struct(F.lit(x).alias("rule"), c(x).cast("bigint").alias("n")) for x in report.columns])
        rows = report.select(F.lit(name).alias("check"), F.inline(rules))
        out = rows if out is None else out.union(rows)
    return out


def _long(name: str) -> str:
    """A check's row as (check, rule, n)."""
    return f"SELECT '{name}' AS \"check\", rule, CAST(n AS BIGINT) AS n FROM (UNPIVOT ({CHECKS[name]}) ON COLUMNS(*) INTO NAME rule VALUE n)"


def _wide(name: str) -> str:
    return f"WITH {HELPERS} {CHECKS[name]}"


@query(f"WITH {HELPERS} " + " UNION ALL ".join(map(_long, CHECKS)))
def run_checks(s, d):
    """All checks over all helpers, in order."""
    up = C.closure(tree(s, d))
    clin, costs = _bases(s, d, up)
    return checked(s, d, clin, costs, _built(s, d, enc(s, d), clin, costs, up))


@query(_wide("B"))
def check_keys_dict(s, d):
    """Null keys and codes without a name in the clinical helper."""
    c = F.col
    return Q.violations(clinical(s, d), null_key=c("encounter").isNull(), null_code=c("main_code").isNull(), nameless=c("main_code").isNotNull() & c("main_name").isNull())


@query(f"WITH {HELPERS} {_long('U2')}")
def check_util_keys(s, d):
    return checked(s, d, None, None, {"utilization": grouped_use(s, d, enc(s, d))}, ("U2",))


@query(f"WITH {HELPERS} {_long('U3')}")
def check_util_values(s, d):
    return checked(s, d, None, None, {"utilization": grouped_use(s, d, enc(s, d))}, ("U3",))


@query(f"WITH {HELPERS} {_long('U4')}")
def check_util_logic(s, d):
    return checked(s, d, None, None, {"utilization": grouped_use(s, d, enc(s, d))}, ("U4",))
