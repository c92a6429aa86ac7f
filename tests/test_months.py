"""Versioned tables, the growing closure, patient states, and the monthly walk with faults."""

import datetime as dt
import glob
import os
import random

import duckdb
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strandline.operators import codes as C
from strandline.operators import patient_state as P
from strandline.plans import months as MO
from strandline.sources.versions import Store
from tests.conftest import SF
from tests.test_queries import rows as shown_rows


def brute_closure(edges, depth=10):
    up = {}
    for child, parent in edges:
        up.setdefault(child, set()).add(parent)
    out = {}
    for node in up:
        at = {node}
        for d in range(1, depth + 1):
            at = {p for x in at for p in up.get(x, ())}
            for p in at:
                out.setdefault((node, p), d)
    return out


def pairs(df):
    return {(r.node, r.ancestor): r.depth for r in df.collect()}


def test_closure_grows_by_new_edges_alone(spark, tmp_path):
    rng = random.Random(1)
    edges = {(i, rng.randrange(i)) for i in range(1, 60) for _ in range(2)} | {(i, i - 1) for i in range(1, 14)}
    new = {(70, 30), (71, 70), (72, 71), (70, 5), (40, 39), (12, 1)}  # new codes in a chain, and edges between old ones
    make = lambda e: spark.createDataFrame(sorted(e), "child long, parent long")
    old = C.closure(make(edges - new))
    assert pairs(old) == brute_closure(edges - new)
    added = C.added_pairs(old, make(new))
    whole = brute_closure(edges | new)
    before = brute_closure(edges - new)
    assert pairs(added) == {k: d for k, d in whole.items() if before.get(k) != d}
    assert pairs(C.extended(old, added)) == whole
    assert C.added_pairs(old, make(new).limit(0)).count() == 0
    stop = F.col("ancestor") < 3
    kept = lambda e: {x for x in e if x[1] >= 3}
    assert pairs(C.closure(make(edges | new), stop=stop)) == brute_closure(kept(edges | new))
    assert pairs(C.extended(C.closure(make(edges - new), stop=stop), C.added_pairs(C.closure(make(edges - new), stop=stop), make(new), stop=stop))) == brute_closure(kept(edges | new))


def test_edges_above(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (4, 3), (5, 6), (3, 9)], "child long, parent long")
    assert {tuple(r) for r in C.edges_above(edges, spark.createDataFrame([(1,), (8,)], "code long")).collect()} == {(1, 2), (2, 3), (3, 9)}
    assert C.edges_above(edges, spark.createDataFrame([(9,)], "code long")).count() == 0


def test_negated_flags(spark):
    up = spark.createDataFrame([(1, 10, 1), (2, 11, 1)], "node long, ancestor long, depth int")
    nodes = spark.createDataFrame([(1,), (2,), (3,), (11,)], "node long")
    targets = spark.createDataFrame([("a", 10), ("a", 3), ("no", 11)], "name string, target bigint")
    got = {r.node: (r.a, r.no) for r in C.dictionary_flags(nodes, up, targets, ["a", "no"], ("no",)).collect()}
    assert got == {1: (1, 1), 2: (0, 0), 3: (1, 1), 11: (0, 0)}


def files(root):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{root}/**/*.parquet", recursive=True)}


def test_store_writes_touched_buckets_only(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=8)
    assert store.version == -1
    table = spark.createDataFrame([(i, i * 10) for i in range(100)] + [(None, -1)], "k long, v long")
    store.keep("t", table, "k")
    store.append("log", table.limit(3))
    assert store.commit(last="a") == 0 and store.control == {"last": "a"}
    first = files(tmp_path)
    keys = spark.createDataFrame([(5,), (7,), (200,)], "k long")
    touched = store.touched(keys)
    store.keep("t", spark.createDataFrame([(5, 1), (200, 2)], "k long, v long"), "k", keys, touched)
    store.append("log", table.limit(2))
    fresh = Store(spark, str(tmp_path), 8)  # nothing is seen before the commit
    assert fresh.read("t").count() == 101 and fresh.read("log").count() == 3
    store.commit(last="b")
    now = {r.k: r.v for r in Store(spark, str(tmp_path), 8).read("t").collect()}
    assert now == {i: i * 10 for i in range(100) if i not in (5, 7)} | {5: 1, 200: 2, None: -1}
    assert Store(spark, str(tmp_path), 8).read("log").count() == 5
    assert all(files(tmp_path)[p] == t for p, t in first.items())
    written = {p.split("/")[-2] for p in set(files(tmp_path)) - set(first) if "/t/" in p}
    assert written == {f"_bucket={b}" for b in touched}
    assert Store(spark, str(tmp_path), 8).sweep() == len(touched)
    assert Store(spark, str(tmp_path), 8).read("t").count() == 101
    store.keep("t", table.limit(0), "k")  # an emptied table
    store.commit()
    assert Store(spark, str(tmp_path), 8).read("t").count() == 0


def test_states_folded_by_month_equal_one_pass(spark):
    rng, day = random.Random(3), lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    claims = [(i, rng.randrange(6), day(rng.randrange(120))) for i in range(80)]
    codes = [(i, p, t, c, int(c % 2 == 0), int(c % 3 == 0), int(c % 5 == 0)) for i, p, t in claims for c in rng.sample(range(12), 2)]
    events = [(rng.randrange(6), day(rng.randrange(120)), int(rng.random() < 0.4), int(rng.random() < 0.2)) for _ in range(40)]
    flags = ["has_x", "has_y"]

    def run(spans):
        out, known, state = {}, None, None
        for lo, hi in spans:
            inside = lambda t: day(lo) <= t < day(hi)  # noqa: B023, E731
            r = spark.createDataFrame([x for x in claims if inside(x[2])], "encounter int, patient int, seen timestamp")
            c = spark.createDataFrame([x for x in codes if inside(x[2])], "encounter int, patient int, seen timestamp, code int, is_chronic int, has_x int, has_y int")
            e = spark.createDataFrame([x for x in events if inside(x[1])], "patient int, ts timestamp, is_surgery int, is_planning int")
            nothing = P.months_state(r, c, e, spark.createDataFrame([], "patient int, code int"), "patient", "seen", flags).limit(0)
            known = spark.createDataFrame([], "patient int, code int, first_seen timestamp") if known is None else known
            state = nothing if state is None else state
            fresh = P.new_codes(c.where("is_chronic = 1"), known, "patient", "seen")
            rows, after = P.fold(r, c, e, fresh, state, "patient", "encounter", "seen", flags)
            out |= {x.encounter: x for x in rows.collect()}
            known = spark.createDataFrame(known.unionByName(fresh).collect(), known.schema)
            after = after.collect()
            mine = {x.patient for x in after}
            state = spark.createDataFrame([x for x in state.collect() if x.patient not in mine] + after, state.schema)
        return out

    got = run([(0, 30), (30, 31), (31, 75), (75, 120)])
    planned = set()
    for p in range(6):
        plans = [t for q, t, _, x in events if q == p and x]
        later = sorted((t, i) for i, q, t in claims if q == p and plans and t > min(plans))
        planned |= {later[0][1]} if later else set()
    for i, p, t in claims:
        first = {}
        for _, q, s, c, chronic, _, _ in codes:
            if q == p and chronic:
                first[c] = min(first.get(c, s), s)
        surgery = [s for q, s, x, _ in events if q == p and x and s < t]
        assert got[i].known == sum(s <= t for s in first.values())
        assert got[i].last_event == (max(surgery) if surgery else None)
        assert got[i].is_planned == (i in planned)
        for name, at in (("has_x", 5), ("has_y", 6)):
            starts = [c[2] for c in codes if c[1] == p and c[at]]
            started = getattr(got[i], f"{name}_start")
            assert (started is not None and started <= t) == (bool(starts) and min(starts) <= t)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def test_walk_goes_on_after_faults(spark, duck, tmp_path):
    """A month that fails leaves nothing to be seen and is run again; what earlier months have written stays as it is; the end equals a full build."""
    root = str(tmp_path)
    store = MO.open_store(spark, SF, root, "2001-07-31", buckets=8)
    base = files(f"{root}/store")
    size = sum(os.stat(p).st_size for p in base)
    fail = iter(["helpers", "models"])
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            MO.run_until(spark, SF, root, store, "2001-12-31", None, lambda end: next(fail))
        assert store.refresh().control["last"] == "2001-06-30" and store.version == 0
    assert MO.run_until(spark, SF, root, store, "2001-12-31") == ["2001-07-31", "2001-08-31"]
    assert MO.run_until(spark, SF, root, store, "2001-12-31") == []
    assert store.refresh().version == 2
    assert MO.run_month(spark, SF, store, MO.Month.read(spark, f"{root}/raw", "2001-07-31")) == 2  # there already
    now = files(f"{root}/store")
    assert all(now[p] == t for p, t in base.items())
    new = {p for p in now if "version=1/" in p and "/commits/" not in p}
    patients = spark.read.parquet(f"{root}/raw/orders").where("period = date'2001-07-31'").select("o_custkey")
    buckets = {f"_bucket={b}" for b in store.touched(patients)}
    assert {p.split("/")[-2] for p in new if "/open_stays/" in p} <= buckets
    assert sum(os.stat(p).st_size for p in new if "/stays/" in p or "/clinical/" in p or "/cost/" in p) < size / 5
    got = MO.index_of(MO.all_stays(store)).toPandas()
    assert shown_rows(got) == shown_rows(duck.execute(f"WITH {MO.INDEX} SELECT * FROM idx").fetchdf())


def test_states_hold_what_open_stays_need(spark, tmp_path):
    """Closed stays leave the members; inpatient episodes stay as long as an open stay can look back at them."""
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    rows = [(1, 1, 1, 6), (1, 2, 2, 5), (1, 3, 3, 6), (1, 4, 4, 0), (2, 1, 9, 6)]  # patient, episode, stay, rank
    members = spark.createDataFrame([(p, e, i, r, day(10 * e)) for p, e, i, r in rows], "patient long, episode long, stay_id long, stay_rank int, stay_start timestamp")
    later = spark.createDataFrame([(1, 3), (2, 3), (3, None), (9, None)], "stay_id long, following_stay_id long")
    assert {r.stay_id for r in MO.open_stays(members, later).collect()} == {3, 4, 9}  # 4 and 9 are the last, 3 has none after it
    inpatient = spark.createDataFrame([(1, 100, day(-900), day(-890)), (1, 101, day(-800), day(-790)), (1, 102, day(-100), day(-90)), (2, 103, day(-999), day(-990))], "patient long, stay_id long, stay_start timestamp, stay_stop timestamp")
    kept = MO.inpatient_kept(inpatient, members.where("patient = 1"))
    assert {r.stay_id for r in kept.collect()} == {102}
    kept = MO.inpatient_kept(inpatient.where("stay_id <> 102"), members)
    assert {r.stay_id for r in kept.collect()} == {101, 103}
