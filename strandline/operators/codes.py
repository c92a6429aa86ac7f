"""Wide and long codes, dictionaries, and the is-a hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.scalars import code_of
from strandline.sources.io import stored


def unpivot_codes(df: DataFrame, ids: list[str], wide: list[str], distinct: bool = True) -> DataFrame:
    """ids and ``code`` for each filled wide column, parsed exactly; one scan."""
    out = df.unpivot(ids, wide, "slot", "text").select(*ids, code_of(F.col("text")).alias("code")).where("code is not null")
    return out.distinct() if distinct else out


def code_set(df: DataFrame, wide: list[str], others: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Distinct codes of wide columns and of ``others`` (code), with the least name of each."""
    codes = unpivot_codes(df, [], wide).union(others.select("code")).distinct()
    names = dictionary.groupBy("code").agg(F.min("name").alias("name"))
    return codes.join(names, "code", "left")


def first_seen(df: DataFrame, key: str, code: str, at: str) -> DataFrame:
    """The first time of each key and code."""
    return df.groupBy(key, code).agg(F.min(at).alias("first_seen"))


def onsets(df: DataFrame, key: str, at: str, flags: list[str]) -> DataFrame:
    """For each flag the first time it is 1, side by side."""
    return df.groupBy(key).agg(*[F.min(F.when(F.col(f) == 1, F.col(at))).alias(f"{f}_start") for f in flags])


def is_a_edges(concepts: DataFrame, is_a: str = "116680003") -> DataFrame:
    """(child, parent) of the active is-a relationships of active concepts (conceptId, active, relationships)."""
    r = concepts.where("active").select(F.col("conceptId").cast("bigint").alias("child"), F.explode("relationships").alias("r"))
    return r.where(F.col("r.active") & (F.col("r.type.conceptId") == is_a)).select("child", F.col("r.target.conceptId").cast("bigint").alias("parent")).distinct()


def described_codes(codes: DataFrame, concepts: DataFrame) -> DataFrame:
    """``codes`` (code, name) with a missing name taken from the concept's first description."""
    terms = concepts.select(F.col("conceptId").cast("bigint").alias("code"), F.get("descriptions", F.lit(0))["term"].alias("term"))
    return codes.join(terms, "code", "left").withColumn("name", F.coalesce("name", "term")).drop("term")


def nearest(pairs: DataFrame) -> DataFrame:
    """Each (node, ancestor) once, at its least depth."""
    return pairs.groupBy("node", "ancestor").agg(F.min("depth").cast("int").alias("depth"))


def _through(first: DataFrame, second: DataFrame, depth: int) -> DataFrame:
    """Pairs by way of an ancestor of ``first`` that is a node of ``second``, up to ``depth`` together."""
    left = first.select("node", F.col("ancestor").alias("at"), F.col("depth").alias("_d"))
    right = second.select(F.col("node").alias("at"), "ancestor", "depth")
    return left.join(right, "at").where(F.col("_d") + F.col("depth") <= depth).select("node", "ancestor", (F.col("_d") + F.col("depth")).alias("depth"))


def _allowed(edges: DataFrame, stop: Column | None) -> DataFrame:
    """Edges (child, parent) as pairs of depth 1, without those into a stop node."""
    pairs = edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor")).distinct()
    return (pairs if stop is None else pairs.where(~stop)).withColumn("depth", F.lit(1))


def closure(edges: DataFrame, depth: int = 10, stop: Column | None = None) -> DataFrame:
    """(node, ancestor, depth) of an acyclic graph (child, parent), at the least depth, up to ``depth``.

    Ancestors for which ``stop`` (on column ``ancestor``) holds are neither kept nor followed.
    Paths are doubled: after a round that knows all pairs up to k links, those of k + 1 to 2 k
    links go by way of a pair of exactly k, so ten links take four rounds. A round is written to the
    shared folder, so lineage stays short; it reads a pair once for each way through it.
    """
    known = stored(_allowed(edges, stop), "closure")
    reach = 1
    while reach < depth:
        found = _through(known.where(F.col("depth") == reach), known, depth)
        more = stored(nearest(found).join(known, ["node", "ancestor"], "left_anti"), "closure")
        if more.isEmpty():
            break
        known, reach = known.unionByName(more), 2 * reach
    return known


def added_pairs(up: DataFrame, edges: DataFrame, depth: int = 10, stop: Column | None = None) -> DataFrame:
    """Pairs that new ``edges`` add to the closure ``up``, or bring nearer.

    Every such pair has a path through a new edge: from what lies below its child, as ``up``
    knows it, to what lies above its parent. These one-edge paths are joined with each other
    until paths through several new edges change nothing, which four rounds reach for ten links.
    Pairs of ``up`` that no new edge touches are only looked up, never made again; the result,
    added to ``up`` and taken at the least depth, equals a closure of all edges.
    """
    fresh = _allowed(edges, stop).join(up.where("depth = 1"), ["node", "ancestor"], "left_anti")
    fresh = stored(fresh, "edges")
    if fresh.isEmpty():
        return fresh
    below = fresh.unionByName(_through(up, fresh, depth))
    made = stored(nearest(below.unionByName(_through(below, up, depth))), "paths")
    size = lambda df: tuple(df.agg(F.count("*"), F.sum("depth")).first())
    before = size(made)
    for _ in range(depth):
        made = stored(nearest(made.unionByName(_through(made, made, depth))), "paths")
        now = size(made)
        if now == before:
            break
        before = now
    old = up.select("node", "ancestor", F.col("depth").alias("_old"))
    return made.join(old, ["node", "ancestor"], "left").where("_old is null or depth < _old").drop("_old")


def extended(up: DataFrame, added: DataFrame) -> DataFrame:
    """The closure ``up`` with the pairs of :func:`added_pairs`."""
    return nearest(up.unionByName(added))


def edges_above(edges: DataFrame, codes: DataFrame, depth: int = 10) -> DataFrame:
    """The edges (child, parent) that lie on a way up from ``codes`` (code), up to ``depth`` links."""
    at, out = codes.select(F.col("code").alias("child")).distinct(), None
    for _ in range(depth):
        step = stored(edges.join(at, "child", "left_semi").distinct(), "edges")
        if step.isEmpty():
            break
        at = step.select(F.col("parent").alias("child")).distinct()
        out = step if out is None else out.union(step)
    return edges.limit(0) if out is None else out.distinct()


def descendants(up: DataFrame) -> DataFrame:
    """code, n_desc: how many nodes lie under each ancestor."""
    return up.groupBy(F.col("ancestor").alias("code")).agg(F.count("*").alias("n_desc"))


def has_ancestor(nodes: DataFrame, up: DataFrame, targets: DataFrame) -> DataFrame:
    """Nodes that are targets or have one among their ancestors."""
    own = nodes.select("node", F.col("node").alias("ancestor"))
    return own.union(up.select("node", "ancestor")).join(targets.select(F.col("target").alias("ancestor")), "ancestor", "left_semi").select("node").distinct()


def dictionary_flags(nodes: DataFrame, up: DataFrame, targets: DataFrame, names: list[str], negated: tuple[str, ...] = (), limit: int = 100_000) -> DataFrame:
    """A 0/1 column for each name in ``targets`` (name, target): whether the node or an ancestor is one.

    A name in ``negated`` is 1 where neither the node nor an ancestor is in its set. All sets are
    looked up in one join of the closure with the targets, which are broadcast up to ``limit``.
    """
    own = nodes.select("node", F.col("node").alias("ancestor")).union(up.select("node", "ancestor"))
    met = own.join(F.broadcast(targets) if targets.count() <= limit else targets, F.col("ancestor") == F.col("target"))
    flags = met.groupBy("node").agg(*[F.max(F.when(F.col("name") == n, 1).otherwise(0)).alias(n) for n in names])
    out = nodes.select("node").join(flags, "node", "left").fillna(0, names)
    return out.withColumns({n: 1 - F.col(n) for n in negated}) if negated else out


def fixed_flags(df: DataFrame, diseases: list[str]) -> DataFrame:
    """A disorder is no symptom; any disease is chronic."""
    chronic = F.greatest(F.col("is_chronic"), *[F.col(d) for d in diseases])
    return df.withColumns({"is_symptom": F.when(F.col("is_disorder") == 1, 0).otherwise(F.col("is_symptom")), "is_chronic": chronic})


def elected(groups: DataFrame, up: DataFrame, descendants: DataFrame, favoured: DataFrame | None = None) -> DataFrame:
    """One code for each group (grp, code): favoured ones first, none that is an ancestor of another, fewest descendants, least code.

    The ancestors of a group's codes are looked up first, and its codes among them left out, so
    that codes of a group do not meet each other.
    """
    above = groups.select("grp", F.col("code").alias("node")).join(up.select("node", F.col("ancestor").alias("code")), "node").select("grp", "code").distinct()
    left = groups.join(above, ["grp", "code"], "left_anti").join(descendants, "code", "left")
    liked = favoured.select("code", F.lit(1).alias("liked")) if favoured is not None else None
    left = left.join(liked, "code", "left") if liked is not None else left.withColumn("liked", F.lit(None).cast("int"))
    order = F.struct(-F.coalesce("liked", F.lit(0)), F.coalesce("n_desc", F.lit(0)), F.col("code"))
    return left.groupBy("grp").agg(F.min_by("code", order).alias("main_code"))


def related(pairs: DataFrame, up: DataFrame, strict: bool = False) -> DataFrame:
    """pairs (pair_id, code1, code2) with is_related: 0 if a code is null, 1 if code2 or one of its
    ancestors is an ancestor of code1 (``strict``: code2 lies under code1), else -1."""
    lists = up.groupBy("node").agg(F.collect_set("ancestor").alias("above"))
    second = spread_join(pairs, lists.select(F.col("node").alias("code2"), F.col("above").alias("_above2")), "code2", "pair_id")
    if strict:
        hit = (F.col("code1") == F.col("code2")) | F.coalesce(F.array_contains("_above2", F.col("code1")), F.lit(False))
    else:
        second = spread_join(second, lists.select(F.col("node").alias("code1"), F.col("above").alias("_above1")), "code1", "pair_id")
        hit = F.coalesce(F.arrays_overlap("_above1", "_above2"), F.lit(False)) | F.coalesce(F.array_contains("_above1", F.col("code2")), F.lit(False))
    made = F.when(F.col("code1").isNull() | F.col("code2").isNull(), 0).when(hit, 1).otherwise(-1)
    return second.withColumn("is_related", made).select(*pairs.columns, "is_related")


def spread_join(df: DataFrame, other: DataFrame, key: str, ident: str) -> DataFrame:
    """Left join on ``key``; rows without one are dealt by ``ident``, so that they do not meet in one task.

    The other side's part of the join key is always 0, but no constant: one would be folded away, and the dealing with it.
    """
    salt = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(ident), F.lit(4096)) + 1).otherwise(0)
    return df.withColumn("_salt", salt).join(other.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(1))), [key, "_salt"], "left").drop("_salt")
