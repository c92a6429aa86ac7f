"""Edge cases of the operators on small hand-written tables."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strandline.functions import scalars as S
from strandline.operators import codes as C
from strandline.operators import costs as K
from strandline.operators import metrics as M
from strandline.operators import quality_checks as Q
from strandline.operators import temporal as T
from strandline.operators.episodes import group_episodes
from strandline.operators.incremental import upsert
from strandline.sources import io

T0 = dt.datetime(2024, 1, 1)
h = lambda n, **k: T0 + dt.timedelta(hours=n, **k)


def test_episode_gaps(spark):
    rows = [("p", 1, h(0), h(1), 0), ("p", 2, h(12, minutes=59, seconds=59), h(14), 6), ("p", 3, h(26), h(27), 3), ("q", 4, h(0), h(50), 1), ("q", 5, h(1), h(2), 1), ("q", 6, h(20), h(21), 1)]
    df = spark.createDataFrame(rows, "k string, id int, a timestamp, b timestamp, r int")
    got = {r.id: (r.episode, r.stay_id, r.stay_days) for r in group_episodes(df, "k", "a", "b", "id", "r").collect()}
    assert got[1][0] == got[2][0] and got[3][0] != got[2][0]  # 11:59:59 joins, exactly 12 h splits
    assert got[1][1] == 2 and got[3][1] == 3
    assert got[6][0] == 2  # the previous row's stop counts ...
    running = {r.id: r.episode for r in group_episodes(df, "k", "a", "b", "id", "r", running_max=True).collect()}
    assert running[6] == 1  # ... or the latest so far
    assert group_episodes(df.limit(0), "k", "a", "b", "id", "r").count() == 0


def test_code_text(spark):
    df = spark.createDataFrame([("157265008.0",), (None,), ("x",), ("10939881000119105",)], "t string")
    assert [r[0] for r in df.select(S.code_of(F.col("t"))).collect()] == [157265008, None, None, 10939881000119105]


def test_described(spark):
    df = spark.createDataFrame([("plain",), ("a (situation)",), ("b (x) (y)",)], "t string")
    assert [tuple(r) for r in df.select(*S.described(F.col("t"))).collect()] == [("plain", None), ("a", "situation"), ("b", "x")]


def test_readmission_days(spark):
    left = spark.createDataFrame([("p", 0, h(0)), ("q", 1, h(0)), ("r", 2, h(0))], "k string, id int, stop timestamp")
    right = spark.createDataFrame([("p", 7, h(0)), ("p", 8, h(24 * 30 + 23)), ("q", 9, h(24 * 31))], "k string, rid int, start timestamp")
    out = T.asof_next(left, "stop", right, "start", "k", ["rid"])
    got = {r.id: (r.next.rid if r.next else None) for r in out.collect()}
    assert got == {0: 8, 1: 9, 2: None}  # an equal time does not follow


def test_windows_around_equal_brute_force(spark):
    import random

    rng = random.Random(2)
    make = lambda n, first: [(rng.choice("pq"), first + i, h(a := rng.randrange(900)), h(a + rng.randrange(40)), rng.randrange(9)) for i in range(n)]
    left, right = make(60, 0), make(80, 1000)
    schema = "k string, id int, a timestamp, b timestamp, v int"
    day, df = dt.timedelta(days=1), lambda rows: spark.createDataFrame(rows, schema)
    got = {r.id: r for r in T.around(df(left), "a", "b", df(right), "k", 7, ["id"], "n", {"total": "v"}).collect()}
    back = {r.id: r for r in T.look_back(df(left), "a", df(right), "b", "k", 7, "n", {"total": "v"}).collect()}
    after = {r.id: r for r in T.asof_next(df(left), "b", df(right), "a", "k", ["id"]).collect()}
    assert len(got) == len(back) == len(after) == len(left)
    for k, i, a, b, _ in left:
        mine = [x for x in right if x[0] == k]
        inside = [x for x in mine if x[3] < a and (a - x[3]) // day <= 7]
        assert (got[i].n, got[i].total) == (back[i].n, back[i].total) == (len(inside), sum(x[4] for x in inside) if inside else None)
        prev = max(((x[3], x[1]) for x in mine if x[3] < a), default=(None, None))[1]
        nxt = min(((x[2], x[1]) for x in mine if x[2] > b), default=(None, None))[1]
        assert (got[i].prev and got[i].prev.id) == prev
        assert (got[i].next and got[i].next.id) == (after[i].next and after[i].next.id) == nxt


def test_one_key_with_many_events(spark):
    t = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60)
    rows = spark.range(100_000).select(F.lit("p").alias("k"), "id", t.alias("a"), t.alias("b"), F.lit(1).alias("v"))
    out = T.around(rows, "a", "b", rows, "k", 7, ["id"], "n", {"total": "v"})
    assert out.agg(F.max("n")).first()[0] == 8 * 24 * 60 - 1  # a sliding frame would take minutes


def test_intervals_meet_in_their_time(spark):
    e = spark.createDataFrame([("p", i, dt.date(2020, 1, 1) + dt.timedelta(days=97 * i)) for i in range(30)], "k string, id int, day date")
    p = spark.createDataFrame([("p", 1, dt.date(2020, 5, 5), dt.date(2024, 2, 1)), ("p", 2, dt.date(2026, 1, 1), None), ("p", 3, dt.date(2031, 1, 1), None)], "k string, plan int, a date, b date")
    got = {(r.id, r.plan_plan) for r in T.active_intervals(e, "day", p, "a", "b", "k", F.lit("2030-01-01").cast("date"), bucket_days=100).collect()}
    spans = [(1, dt.date(2020, 5, 5), dt.date(2024, 2, 1)), (2, dt.date(2026, 1, 1), dt.date(2030, 1, 1))]
    assert got == {(r.id, n) for r in e.collect() for n, a, b in spans if a < r.day < b}


def test_upserts_survive_a_restart(spark, tmp_path):
    from strandline.streaming import sessions as ST

    source, root, state = (str(tmp_path / x) for x in ("in", "table", "state"))
    write = lambda rows: spark.createDataFrame(rows, "k int, at int, v string").write.mode("append").parquet(source)
    run = lambda: ST.upsert_stream(spark.readStream.schema("k int, at int, v string").parquet(source), "k", "at", root, state)
    write([(1, 1, "a"), (2, 5, "b")])
    assert {tuple(r) for r in run().collect()} == {(1, 1, "a"), (2, 5, "b")}
    write([(1, 3, "c"), (2, 4, "late"), (9, 1, "d")])  # a new query, which knows the folders only
    assert {tuple(r) for r in run().collect()} == {(1, 3, "c"), (2, 5, "b"), (9, 1, "d")}
    assert {tuple(r) for r in run().collect()} == {(1, 3, "c"), (2, 5, "b"), (9, 1, "d")}
    write([(3, 1, "e")])
    run()
    batches = {int(r.batch): r.n for r in spark.read.parquet(root).groupBy("batch").count().withColumnRenamed("count", "n").collect()}
    assert batches[max(batches)] == 1  # a batch writes its own keys
    schema = spark.read.parquet(source).schema
    assert ST.compact(spark, root, schema, "k", max(batches) - 1) == len(batches) - 1
    everything = {(1, 3, "c"), (2, 5, "b"), (9, 1, "d"), (3, 1, "e")}
    assert {tuple(r) for r in ST.current(spark, root, schema, "k").collect()} == everything
    write([(9, 7, "f")])
    assert {tuple(r) for r in run().collect()} == everything - {(9, 1, "d")} | {(9, 7, "f")}


def test_a_failing_check_raises(spark):
    from strandline.plans import period

    rows = spark.createDataFrame([(1, None, h(0), h(1)), (1, "p", h(0), None)], "stay_id int, patient string, stay_start timestamp, stay_stop timestamp")
    with pytest.raises(ValueError, match="U2 failed.*null_patient"):
        period.checked(spark, "", None, None, {"utilization": rows}, ("U2",))


def test_a_missing_month_raises(spark, tmp_path):
    df = spark.createDataFrame([(1, h(0))], "id int, at timestamp")
    io.write_periods(df, "at", f"{tmp_path}/a")
    assert io.read_month(spark, str(tmp_path), ["a"], "2024-01-31")["a"].count() == 1
    with pytest.raises(FileNotFoundError):
        io.read_month(spark, str(tmp_path), ["a"], "2024-02-29")


def test_scores_in_ranges(spark):
    rows = [("m", i / 997, int(i * 7 % 13 > 6)) for i in range(998)]
    df = spark.createDataFrame(rows, "model string, p double, y int")
    pos, neg = [p for _, p, y in rows if y], [p for _, p, y in rows if not y]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    assert M.roc_auc(df).first()["roc_auc"] == pytest.approx(want)


def test_open_interval(spark):
    e = spark.createDataFrame([("p", 1, dt.date(2024, 1, 2)), ("p", 2, dt.date(2024, 1, 1)), ("p", 3, dt.date(2024, 1, 9))], "k string, id int, day date")
    p = spark.createDataFrame([("p", 1, dt.date(2024, 1, 1), None), ("p", 2, dt.date(2024, 1, 1), dt.date(2024, 1, 9))], "k string, plan int, a date, b date")
    got = {(r.id, r.plan_plan) for r in T.active_intervals(e, "day", p, "a", "b", "k", F.lit("2030-01-01").cast("date")).collect()}
    assert got == {(1, 1), (1, 2), (3, 1)}


def test_costs(spark):
    df = spark.createDataFrame([(10.0, 5.0, 0.0, 0.0), (1.0, 5.0, 2.0, 3.0), (None, 5.0, 1.0, 1.0)], "claim double, base double, p double, m double")
    assert [r[0] for r in df.select(S.total_cost(F.col("claim"), F.col("base"), F.col("p"), F.col("m"))).collect()] == [10.0, 10.0, None]
    assert K.days_needed(0.1, 0.2) == 3


def test_hierarchy(spark):
    chain = [(i, i + 1) for i in range(1, 13)]
    e = spark.createDataFrame([*chain, (1, 100), (100, 3)], "child bigint, parent bigint")
    up = C.closure(e)
    got = {(r.node, r.ancestor): r.depth for r in up.collect()}
    assert got[1, 3] == 2 and got[1, 10] == 9 and (1, 13) not in got
    cut = {(r.node, r.ancestor) for r in C.closure(e, stop=F.col("ancestor") == 5).collect()}
    assert (1, 4) in cut and (1, 5) not in cut and (1, 6) not in cut
    groups = spark.createDataFrame([(0, 1), (0, 2), (0, 50), (1, 50), (1, 40)], "grp int, code bigint")
    desc = spark.createDataFrame([(1, 0), (2, 1), (50, 9), (40, 9)], "code bigint, n_desc bigint")
    assert {r.grp: r.main_code for r in C.elected(groups, up, desc).collect()} == {0: 1, 1: 40}


def test_metrics_ties_and_empty(spark):
    df = spark.createDataFrame([("m", 0.5, 1), ("m", 0.5, 0), ("m", 1.0, 1), ("m", 0.0, 0)], "model string, p double, y int")
    assert M.roc_auc(df).first()["roc_auc"] == pytest.approx(0.875)
    assert M.roc_auc(df.where("y = 1")).first()["roc_auc"] is None
    assert M.psi(M.histogram(df), M.histogram(df)).first()["psi"] == pytest.approx(0)
    assert M.confusion(df, ["model"], F.col("p") > 2).first()["precision"] == 0


def test_checks_and_upsert(spark):
    a = spark.createDataFrame([(1, "x"), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "y")], "k int, v string")
    assert {tuple(r) for r in upsert(a, b, "k").collect()} == {(1, "x"), (2, "y"), (3, "y")}
    with pytest.raises(ValueError):
        Q.demand(Q.key_sets(a, b, "k"), "missing")
    with pytest.raises(ValueError):
        io.advance(spark.createDataFrame([(None, None, None)], "last_processed date, next_end date, final_end date"))


def test_concepts_skip_unusable(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"conceptId": "5", "active": true, "descriptions": [{"term": "t"}], "relationships": []}')
    (tmp_path / "2.json").write_text("false")
    assert [r.conceptId for r in io.read_concepts(spark, str(tmp_path)).collect()] == ["5"]


def test_entry_module():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_update_shuffles_what_it_unites(spark):
    """Where history and delta are joined by sorting, a union of both must be dealt by key anew: their partitions merge differently."""
    from strandline.operators.incremental import update

    w = Window.partitionBy("k").orderBy("v", "r")
    build = lambda df: df.withColumn("r", F.col("v") % 7).withColumn("n", F.row_number().over(w)).groupBy("k").agg(F.max("n").alias("n"))
    old, new = (io.stored(spark.range(a, a + n).select((F.col("id") % 50).alias("k"), F.col("id").alias("v")), "rows") for a, n in ((0, 1000), (2000, 30)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = update(io.stored(build(old), "built"), old, new, "k", build)
        assert {r.k: r.n for r in got.collect()} == {k: 21 if k < 30 else 20 for k in range(50)}
        plan = [x.strip(" :+-").lstrip("*") for x in got._jdf.queryExecution().executedPlan().toString().splitlines()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    unions = [i for i, x in enumerate(plan) if x.startswith("Union") and i > 2]
    assert unions and not any("Sort " in plan[i - 1] for i in unions)
