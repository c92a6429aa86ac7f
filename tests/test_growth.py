"""What keeps disk and time down at size, on small tables, each against the plain way."""

import datetime as dt
import glob
import random

from pyspark.sql import functions as F

from strandline.operators import codes as C
from strandline.operators import temporal as T
from strandline.plans import base as B
from strandline.plans import tables as TB
from strandline.sources import io
from tests.conftest import SF


def test_stored_leaves_no_shuffle(spark):
    """Shuffle files go when a table is written, and the session is as before."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own, folder = spark.conf.get(name), spark.conf.get("spark.local.dir")
    files = lambda: set(glob.glob(f"{folder}/**/shuffle_*", recursive=True))
    before = files()
    out = io.stored(spark.range(1000).repartition(3, "id"), "dealt")
    assert not files() - before and spark.conf.get(name) == own
    assert out.count() == 1000
    io.discard(out)
    assert not glob.glob(f"{out._stored_path}*")


def test_main_codes_equal_an_election_of_all(spark):
    """Groups settled by their leaves, and those looked up in the closure, elect what all groups would in the closure."""
    rng = random.Random(4)
    codes = [r.code for r in B.dictionary(spark, SF).select("code").collect()]
    pool = codes + [c for c in codes if c < 20] * 8 + [c for c in codes if c % 50 == 0] * 5  # many inner and favoured ones
    rows = sorted({(g, rng.choice(pool)) for g in range(300) for _ in range(1 + g % 7)})
    groups = io.stored(spark.createDataFrame(rows, "grp long, code long"), "groups")
    up = C.closure(B.tree(spark, SF))
    dic = B.dictionary(spark, SF)
    known = groups.join(dic.select("code", "is_disorder"), "code")
    electors = known.join(known.groupBy("grp").agg(F.max("is_disorder").alias("top")), "grp").where("is_disorder = top")
    want = {r.grp: r.main_code for r in C.elected(electors.select("grp", "code"), up, C.descendants(up), dic.where("code % 50 = 0").select("code")).collect()}
    got = {r.grp: r.main_code for r in TB.main_codes(spark, SF, groups, up).collect()}
    assert got == want and len(want) == 300


def test_a_claim_written_twice_is_one(spark):
    """Equal claims are one claim with its codes, as in the SQL."""
    o = spark.createDataFrame([(1, 7, dt.datetime(2020, 1, 1))] * 2 + [(2, 7, dt.datetime(2020, 1, 2))], "o_orderkey long, o_custkey long, o_orderdate timestamp")
    line = [(1, 30, 1, n, 1.0, 1.0, 0.0, 0.0) for n in (2, 3)] + [(1, 20 + n, 1, 10 + n, 1.0, 1.0, 0.0, 0.0) for n in range(9)] + [(1, None, 1, 1, 1.0, 1.0, 0.0, 0.0)]
    lines = spark.createDataFrame(line, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double")
    got = sorted(B.claims(spark, SF, o, lines).collect(), key=lambda r: r.encounter)
    assert [r.encounter for r in got] == [1, 2]
    assert [got[0][c] for c in B.WIDE] == [None, "30.0", "30.0", "20.0", "21.0", "22.0", "23.0", "24.0"]
    assert sorted(r.code for r in B.code_rows(B.coded(spark, SF, o, lines), "encounter").collect()) == [20, 21, 22, 23, 24, 30]


def test_plans_stand_only_where_events_are(spark):
    """With the events' span the pairs are the same, and an open plan is dealt to the buckets of the span alone."""
    rng = random.Random(6)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    e = spark.createDataFrame([(i, rng.randrange(4), day(rng.randrange(500, 540))) for i in range(60)], "id int, k int, at date")
    p = spark.createDataFrame([(i, rng.randrange(4), day(a := rng.randrange(600)), None if i % 3 else day(a + rng.randrange(300))) for i in range(90)], "plan int, k int, start date, stop date")
    far = F.lit("2100-01-01").cast("date")
    span = tuple(e.agg(F.min("at"), F.max("at")).first())
    made = [sorted(tuple(r) for r in T.active_intervals(e, "at", p, "start", "stop", "k", far, 10, s).select("id", "plan_plan").collect()) for s in (None, span)]
    assert made[0] == made[1] and made[0]


def test_pairs_without_a_code_are_dealt(spark):
    """Pairs with a null code keep their row and lie in many partitions."""
    up = spark.createDataFrame([(1, 10, 1), (2, 10, 1), (3, 11, 1)], "node long, ancestor long, depth int")
    pairs = spark.createDataFrame([(0, 1, 2), (1, 1, 3), (2, 10, 1), (3, 1, 10), (4, 1, 1)] + [(i, 1, None) for i in range(5, 60)], "pair_id long, code1 long, code2 long")
    got = {r.pair_id: r.is_related for r in C.related(pairs, up).collect()}
    assert got == {0: 1, 1: -1, 2: -1, 3: 1, 4: 1} | {i: 0 for i in range(5, 60)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        x = C.spread_join(pairs, up.select(F.col("node").alias("code2"), "ancestor"), "code2", "pair_id")
        lies = [r.at for r in x.select("code2", F.spark_partition_id().alias("at")).collect() if r.code2 is None]
        assert len(lies) == 55 and len(set(lies)) > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
