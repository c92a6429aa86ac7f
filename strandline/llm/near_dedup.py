"""Operator 7: near-duplicates by a chosen-path set similarity join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm import shingling
from strandline.llm.common import discard, freed_shuffles, in_batches, read, stored
from strandline.llm.components import components

TREES, LEVELS, NODE = 16, 4, 64
#: Words of eight bytes in a set's sketch; each byte is of the least token in one part of the hash range.
SKETCH, COARSE = 32, 6
#: Standard deviations by which a sketch's estimate may fall short of the similarity asked for.
SLACK = 4.0
#: Bits of the cell that a token is counted in, words of a set's parities, sets of a token in a block of pairs.
CELL_BITS, PARITIES, BLOCK = 20, 32, 512
#: Rows of a list of large nodes or of documents up to which it is broadcast.
BROADCAST_ROWS = 1_000_000

_rng = np.random.default_rng(7)
_TREE = _rng.integers(0, 2**63, (TREES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROOT = _rng.integers(0, 2**64, (TREES, 1), dtype=np.uint64)
_SUM, _XOR = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def paths(tokens: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Node names of a set in every tree, one row for each level.

    At a node, the set follows the token that is least under a hash of the node's name, so
    sets that stand in one node choose by the same hash and part where their tokens differ.
    """
    name, out = _ROOT, np.empty((levels, TREES), np.uint64)
    for level in range(levels):
        least = ((tokens ^ name) * _TREE).min(axis=1, keepdims=True)
        name = shingling.mix(least ^ name) + _TREE
        out[level] = name[:, 0]
    return out


_PARTS = np.arange(8 * SKETCH, dtype=np.uint64) << np.uint64(64 - (8 * SKETCH - 1).bit_length())


def sketch(tokens: np.ndarray) -> np.ndarray:
    """One byte of the least token in each of 256 equal parts of the hash range; 0: no token there."""
    out = np.zeros(8 * SKETCH, np.uint8)
    first = np.searchsorted(tokens, _PARTS)
    past = np.r_[first[1:], len(tokens)]
    some = first < past
    out[some] = (shingling.mix(tokens[first[some]]) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    return out.view(np.int64)


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, two hashes of the whole set, its sketch, and the node names."""
    kind = docs.schema[key].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row = 0
            for many, data, ends in shingling.text_bytes(b.column(1)):
                sets = shingling.shingle_sets(*shingling.word_hashes(data, ends))
                sums = np.zeros((many, 2), np.uint64)
                sketches = np.zeros((many, SKETCH), np.int64)
                names = np.zeros((many, LEVELS * TREES), np.uint64)
                for i, s in enumerate(sets):
                    if len(s):
                        names[i] = paths(s).ravel()
                        sketches[i] = sketch(s)
                        sums[i] = shingling.mix(s ^ _SUM).sum(), np.bitwise_xor.reduce(shingling.mix(s + _XOR))
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel())) for x in (sketches, names.view(np.int64))]
                columns = [b.column(0).slice(row, many), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(c.copy()) for c in sums.view(np.int64).T), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "ha", "hb", "sketch", "names"])
                row += many

    return in_batches(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), sign, f"doc_id {kind}, n_shingles long, ha long, hb long, sketch array<long>, names array<long>")


def _small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, to be broadcast if it has ``rows`` rows at most."""
    return F.broadcast(df) if df.count() <= rows else df


def nodes(classes: DataFrame, most: int = NODE) -> DataFrame:
    """(node, cid, size), stored: each set in the node where its path ends in each tree.

    A path ends at the first node with ``most`` sets or fewer, or at the deepest level. Nodes
    with one set are left out. Only names move; every row learns its node's size in one join a
    level, and the rows of large nodes go on.
    """
    at = lambda level: F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.get("names", t + level * TREES))
    rows = classes.select("cid", F.inline(F.arrays_zip(*[at(i).alias(f"p{i}") for i in range(LEVELS)])))
    out, levels = None, []
    for level in range(LEVELS):
        rows = rows.withColumn("node", F.col(f"p{level}")).drop(f"p{level}")
        sizes = rows.groupBy("node").agg(F.count("*").alias("size"))
        rows = stored(rows.join(sizes, "node"), "level")
        levels.append(rows)
        end = rows.where(F.col("size") > 1) if level == LEVELS - 1 else rows.where(F.col("size").between(2, most))
        end = end.select("node", "cid", "size")
        out = end if out is None else out.union(end)
        rows = rows.where(F.col("size") > most).drop("node", "size")
        if level < LEVELS - 1 and rows.isEmpty():
            break
    out = stored(out, "nodes")
    for df in levels:
        discard(df)
    return out


def _zero_bytes(x: Column) -> Column:
    """How many bytes of a long are 0."""
    for shift in (4, 2, 1):
        x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
    return 8 - F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))


def _enough(equal: Column, empty: Column, slots: int, n: Column, likeness: float) -> Column:
    """Whether so many equal bytes of a sketch allow a similarity of ``likeness`` of sets with ``n`` tokens together."""
    used = slots - empty
    # the used parts are a draw from the union of the sets without putting back
    rest = F.greatest(1 - used * (1 + likeness) / n, F.lit(0.0))
    return equal - empty >= used * likeness - SLACK * F.sqrt(used * rest * (likeness * (1 - likeness))) - 1


def _alike(a: str, b: str, likeness: float = 0.75) -> Column:
    """Whether sizes and sketches allow a similarity of ``likeness``; a few words of the sketches are compared first."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    pairs = [(F.get(f"{a}.sketch", F.lit(i)), F.get(f"{b}.sketch", F.lit(i))) for i in range(COARSE)]
    equal = sum((_zero_bytes(x.bitwiseXOR(y)) for x, y in pairs), F.lit(0))
    empty = sum((_zero_bytes(x.bitwiseOR(y)) for x, y in pairs), F.lit(0))
    each = F.zip_with(f"{a}.sketch", f"{b}.sketch", lambda x, y: _zero_bytes(x.bitwiseXOR(y)) * 1024 + _zero_bytes(x.bitwiseOR(y)))
    whole = F.aggregate(each, F.lit(0), lambda total, x: total + x, lambda t: _enough(F.floor(t / 1024), t % 1024, 8 * SKETCH, n + m, likeness))
    return (F.least(n, m) >= F.greatest(n, m) * likeness) & _enough(equal, empty, 8 * COARSE, n + m, likeness) & whole


def shingle_tables(docs: DataFrame, ids: DataFrame, key: str, text: str) -> DataFrame:
    """(k, s): the whole shingle set, as sorted 64-bit hashes, of each document whose key is in ``ids`` (k)."""
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(_small(ids), "k", "left_semi")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row = 0
            for many, data, ends in shingling.text_bytes(b.column(1)):
                sets = shingling.shingle_sets(*shingling.word_hashes(data, ends))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, many), pa.array([s.tobytes() for s in sets], pa.binary())], names=["k", "s"])
                row += many

    return in_batches(texts, collect, f"k {kind}, s binary")


def confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, percent: int = 75, partners: int = 200) -> DataFrame:
    """The pairs (u, v) of documents whose whole sets are similar enough.

    Pairs move with the set of v. The set of u goes once to each share of about ``partners``
    pairs of u, and by the order within a task just ahead of them, so that no document's set is
    copied for each of its partners and none of its pairs must meet in one task.
    """
    kind = docs.schema[key].dataType.simpleString()
    ids = pairs.select(F.col("u").alias("k")).union(pairs.select("v")).distinct()
    sets = stored(shingle_tables(docs, ids, key, text), "sets")
    shares = pairs.groupBy("u").agg(F.ceil(F.count("*") / partners).alias("shares"))
    dealt = pairs.join(shares, "u").select("u", F.pmod(F.xxhash64("v"), F.col("shares")).alias("share"), "v")
    ahead = dealt.select("u", "share").distinct().join(sets.withColumnRenamed("k", "u"), "u").select("u", "share", F.lit(None).cast(kind).alias("v"), "s")
    rows = ahead.union(dealt.join(sets.withColumnRenamed("k", "v"), "v").select("u", "share", "v", "s"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.empty(0, np.uint64)
        for b in batches:
            keep = []
            for v, s in zip(b.column(2), b.column(3)):
                other = np.frombuffer(s.as_buffer(), np.uint64)
                if not v.is_valid:
                    mine = other
                    keep.append(False)
                    continue
                both = len(mine) + len(other) - len(np.union1d(mine, other))
                keep.append(100 * both >= percent * (len(mine) + len(other) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    rows = rows.repartition("u", "share").sortWithinPartitions("u", "share", F.col("v").asc_nulls_first())
    return in_batches(rows, compare, f"u {kind}, v {kind}").distinct()


def _alike_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The distinct pairs (u, v) of classes whose sizes and sketches allow the similarity."""
    side = classes.select("cid", "n", "sketch")
    both = pairs.distinct().join(side.withColumnRenamed("cid", "v"), "v").alias("b").join(side.withColumnRenamed("cid", "u").alias("a"), "u")
    return both.where(_alike("a", "b")).select("u", "v")


def _within(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (u, v) of sets of one node in different components (node, cid, component) that may be similar.

    Sets that meet in several nodes make one pair, in the least of them.
    """
    own_nodes = rows.groupBy("cid").agg(F.collect_set("node").alias("nodes"))  # two a tree at most
    full = stored(rows.join(own_nodes, "cid").join(classes.select("cid", "n", "sketch"), "cid"), "apart")
    a, b = full.alias("a"), full.alias("b")
    met_first = F.array_min(F.array_intersect("a.nodes", "b.nodes")) == F.col("node")
    pairs = a.join(b, "node").where((F.col("a.cid") < F.col("b.cid")) & (F.col("a.component") != F.col("b.component")) & _alike("a", "b") & met_first)
    return pairs.select(F.col("a.cid").alias("u"), F.col("b.cid").alias("v"))


def rare_tokens(crowd: DataFrame, docs: DataFrame, key: str, text: str, most: int = NODE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What tells the sets of a crowd (cid) apart: (cid, node) by rare tokens, (core, cid, n) by common ones, and (cid, share) of rare ones.

    A token is rare if ``most`` sets of the crowd have it, or fewer. Each set stands in the
    node of its least rare token in each tree; no node has more than ``most`` sets. Sets with
    three quarters of common tokens could be similar by these alone; ``core`` is a hash of them.
    """
    kind = docs.schema[key].dataType.simpleString()

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(0, len(b), 500):
                some = b.slice(row, 500)
                sets = [np.frombuffer(s.as_buffer(), np.int64) for s in some.column(1)]
                owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(owner)), pa.array(np.concatenate(sets))], names=["cid", "token"])

    tokens = stored(shingle_tables(docs, crowd.select(F.col("cid").alias("k")), key, text).mapInArrow(spell, f"cid {kind}, token long"), "tokens")
    common = stored(tokens.groupBy("token").count().where(F.col("count") > most).select("token"), "common")
    mark = F.bit_xor(F.xxhash64("token", F.lit("core")))
    every = tokens.groupBy("cid").agg(F.count("*").alias("n"), mark.alias("all_mark"))
    least = [F.min(F.xxhash64("token", F.lit(t))).alias(f"l{t}") for t in range(TREES)]
    rare = tokens.join(_small(common), "token", "left_anti").groupBy("cid").agg(*least, mark.alias("rare_mark"), F.count("*").alias("n_rare"))
    sets = stored(every.join(rare, "cid", "left").fillna(0, ["n_rare", "rare_mark"]), "rare")
    trees = F.array(*[F.struct(F.lit(t).alias("tree"), F.col(f"l{t}").alias("least")) for t in range(TREES)])
    by_rare = sets.select("cid", F.inline(trees)).where("least is not null").select("cid", F.xxhash64("tree", "least").alias("node"))
    # what all tokens leave when the rare ones are taken out
    core = F.col("all_mark").bitwiseXOR(F.col("rare_mark")).alias("core")
    return by_rare, sets.where(F.col("n_rare") * 4 <= F.col("n")).select(core, "cid", "n"), sets.select("cid", (F.col("n_rare") / F.col("n")).alias("share"))


def token_cells(texts: DataFrame) -> np.ndarray:
    """How many sets have a token in each cell (its first bits), over all texts (t); added up in Spark."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for b in batches:
            for _, data, ends in shingling.text_bytes(b.column(0)):
                tokens = np.concatenate(shingling.shingle_sets(*shingling.word_hashes(data, ends)))
                cells += np.bincount((tokens >> np.uint64(64 - CELL_BITS)).view(np.int64), minlength=len(cells))
        yield pa.RecordBatch.from_arrays([pa.array([np.minimum(cells, 2**31 - 1).astype("<i4").tobytes()], pa.binary())], names=["cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for b in batches:
            for x in b.column(0):
                cells += np.frombuffer(x.as_buffer(), "<i4")
        yield pa.RecordBatch.from_arrays([pa.array([np.minimum(cells, 2**31 - 1).astype("<i4").tobytes()], pa.binary())], names=["cells"])

    parts = stored(in_batches(texts.select("t"), tally, "cells binary"), "cells")
    some = max(1, int(parts.count() ** 0.5))
    rows = parts.repartition(some).mapInArrow(add, "cells binary").repartition(1).mapInArrow(add, "cells binary").collect()
    return np.frombuffer(rows[0][0], "<i4") if rows else np.zeros(1 << CELL_BITS, np.int32)


def _differ_little(percent: int) -> Column:
    """Whether sizes and parities of a and b allow the similarity; exact, as no similar pair is ruled out.

    Each differing parity stands for a token at least that only one of the sets has, and similar
    sets have at most (100 - percent) / (100 + percent) of their tokens together as such.
    """
    n, m = F.col("a.n"), F.col("b.n")
    bits = sum((F.bit_count(F.get("a.parity", F.lit(i)).bitwiseXOR(F.get("b.parity", F.lit(i)))) for i in range(PARITIES)), F.lit(0))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (bits * (100 + percent) <= (n + m) * (100 - percent))


def _enough_follows(percent: int) -> Column:
    """Whether sizes and the places of a token that a and b share allow the similarity; exact for the first token they share.

    What they have in common then starts there, in the order of both.
    """
    n, m = F.col("a.n"), F.col("b.n")
    follow = F.least(n - F.col("a.at"), m - F.col("b.at"))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (follow * (100 + percent) >= (n + m) * percent)


def pairs_left(own: DataFrame, docs: DataFrame, key: str, text: str, percent: int = 75) -> DataFrame:
    """All pairs (u, v) in different components (own: cid, component) that sizes and tokens allow to be similar.

    Tokens are ordered from rare to frequent by the counts of their cells, then by their hash.
    Similar sets have one of the first n - ceil(percent n / 100) + 1 tokens of each in common
    (prefix filter), whatever the order, so nothing is lost. The sets of a frequent token are
    dealt to blocks, and a task takes two blocks of them. Only numbers move with the tokens;
    parities join the distinct pairs that sizes and places leave.
    """
    kind, group = own.schema["cid"].dataType.simpleString(), own.schema["component"].dataType.simpleString()
    texts = docs.select(F.col(key).alias("cid"), F.col(text).alias("t")).join(_small(own), "cid").select("t", "cid", "component")
    cells = docs.sparkSession.sparkContext.broadcast(token_cells(texts))

    def first_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, low = np.uint64(64 - CELL_BITS), np.uint64(64 * PARITIES - 1)
        for b in batches:
            row = 0
            for many, data, ends in shingling.text_bytes(b.column(0)):
                sets = shingling.shingle_sets(*shingling.word_hashes(data, ends))
                parity, chosen = np.zeros((many, PARITIES), np.int64), []
                for i, s in enumerate(sets):
                    odd = np.bincount((s & low).view(np.int64), minlength=64 * PARITIES) & 1
                    parity[i] = np.packbits(odd.astype(np.uint8)).view(np.int64)
                    order = np.argsort(cells.value[(s >> shift).view(np.int64)], kind="stable")
                    chosen.append(s[order[: len(s) + 1 + -percent * len(s) // 100]])
                ends_of = lambda sizes: pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends_of([PARITIES] * many), pa.array(parity.ravel())), pa.ListArray.from_arrays(ends_of([len(c) for c in chosen]), pa.array(np.concatenate(chosen).view(np.int64)))]
                columns = [b.column(1).slice(row, many), b.column(2).slice(row, many), pa.array([len(s) for s in sets], pa.int64()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["cid", "component", "n", "parity", "tokens"])
                row += many

    made = stored(in_batches(texts, first_tokens, f"cid {kind}, component {group}, n long, parity array<long>, tokens array<long>"), "prefixes")
    cells.destroy()
    rows = made.select("cid", "component", "n", F.posexplode("tokens").alias("at", "token"))
    same = Window.partitionBy("token")
    rows = rows.withColumns({"size": F.count("*").over(same), "x": F.min("component").over(same), "y": F.max("component").over(same)})
    shared = stored(rows.where("x <> y").drop("x", "y"), "shared")
    blocks = F.ceil(F.col("size") / BLOCK)
    rows = shared.select("token", "cid", "component", "n", "at", blocks.alias("blocks"), F.pmod(F.xxhash64("cid"), blocks).alias("mine"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    rows = rows.select("token", "cid", "component", "n", "at", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))
    pairs = rows.alias("a").join(rows.alias("b"), ["token", "lo", "hi"])
    pairs = pairs.where((F.col("a.mine") == F.col("lo")) & (F.col("b.mine") == F.col("hi")) & ((F.col("lo") < F.col("hi")) | (F.col("a.cid") < F.col("b.cid"))))
    pairs = pairs.where((F.col("a.component") != F.col("b.component")) & _enough_follows(percent))
    met = stored(pairs.select(F.least("a.cid", "b.cid").alias("u"), F.greatest("a.cid", "b.cid").alias("v")).distinct(), "met")
    discard(shared)
    side = made.select("cid", "n", "parity")
    both = met.join(side.withColumnRenamed("cid", "u").alias("a"), "u").join(side.withColumnRenamed("cid", "v").alias("b"), "v")
    return both.where(_differ_little(percent)).select("u", "v")


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; see :func:`near_dedup`.

    All steps end in tables, so that what a step has shuffled is deleted when it ends.
    """
    with freed_shuffles(docs.sparkSession):
        sig, home = _located(docs, key, text)
    out = sig.select("doc_id", "n_shingles", "ha", "hb").join(home, ["ha", "hb"], "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(False)).alias("kept"))


def _located(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Every row's doc_id, n_shingles, ha and hb, and the component_id of each pair of ha and hb, both stored."""
    sig = stored(signatures(docs, key, text), "signatures")
    whole = sig.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = whole.groupBy("ha", "hb").agg(
        F.min("doc_id").alias("cid"), F.max("n_shingles").alias("n"), F.any_value("sketch").alias("sketch"), F.any_value("names").alias("names")
    )
    classes = stored(classes, "classes")
    wide, sig = sig, stored(sig.select("doc_id", "n_shingles", "ha", "hb"), "sets")
    discard(wide)
    met = nodes(classes)

    # First every member of a node with the set that has most company in its nodes.
    company = met.groupBy("cid").agg(F.sum("size").alias("company"))
    heads = met.join(company, "cid").groupBy("node").agg(F.max(F.struct("company", "cid")).alias("head"))
    stars = met.join(heads, "node").select(F.col("head.cid").alias("u"), F.col("cid").alias("v")).where("u <> v")
    first = stored(confirmed(stored(_alike_pairs(stars, classes), "pairs"), docs, key, text), "confirmed")
    part = stored(components(first), "parts").withColumnRenamed("node", "cid")

    # Then what still lies apart: in small nodes each set with each, in crowds by what is rare in them.
    located = met.join(part, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    spread = located.groupBy("node").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("node")
    apart = stored(located.join(spread, "node", "left_semi"), "apart")
    small = apart.where(F.col("size") <= NODE).select("node", "cid", "component")
    crowd = stored(apart.where(F.col("size") > NODE).select("cid").distinct(), "crowd")
    cores = None
    if not crowd.isEmpty():
        by_rare, cores, shares = rare_tokens(crowd, docs, key, text)
        by_rare = by_rare.join(part, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        small = small.union(by_rare.select("node", "cid", "component"))
    rest = _within(small, classes)
    if cores is not None:
        centre = cores.groupBy("core").agg(F.min(F.struct("n", "cid")).alias("centre"))
        around = cores.join(centre, "core").select(F.col("centre.cid").alias("u"), F.col("cid").alias("v")).where("u <> v")
        # and every set of a large node with the one that has least beside the common tokens
        crowded = apart.where(F.col("size") > NODE).join(shares, "cid")
        lightest = crowded.groupBy("node").agg(F.min(F.struct("share", "cid", "component")).alias("light"))
        beside = crowded.join(lightest, "node").where(F.col("light.component") != F.col("component")).select(F.col("light.cid").alias("u"), F.col("cid").alias("v"))
        rest = rest.union(_alike_pairs(around.union(beside), classes))
    second = confirmed(stored(rest.distinct(), "pairs"), docs, key, text)
    own_part = lambda c: part.select(F.col("cid").alias(c), F.col("component").alias(f"of_{c}"))
    joining = second.join(own_part("u"), "u", "left").join(own_part("v"), "v", "left").select(F.coalesce("of_u", "u").alias("u"), F.coalesce("of_v", "v").alias("v"))
    merged = stored(components(joining), "parts").select(F.col("node").alias("first_id"), F.col("component").alias("last_id"))

    own = classes.select("cid").distinct().join(part, "cid", "left").withColumn("first_id", F.coalesce("component", "cid"))
    own = stored(own.join(merged, "first_id", "left").select("cid", F.coalesce("last_id", "first_id").alias("component")), "own")

    # Last, exactly, whatever nodes, crowds and sketches have missed.
    third = confirmed(stored(pairs_left(own, docs, key, text), "pairs"), docs, key, text)
    of = lambda c: own.select(F.col("cid").alias(c), F.col("component").alias(f"of_{c}"))
    joining = third.join(of("u"), "u").join(of("v"), "v").select(F.col("of_u").alias("u"), F.col("of_v").alias("v"))
    last = stored(components(joining), "parts").select(F.col("node").alias("component"), F.col("component").alias("last_id"))
    home = classes.select("ha", "hb", "cid").join(own, "cid").join(last, "component", "left").select("ha", "hb", F.coalesce("last_id", "component").alias("component_id"))
    return sig, stored(home, "home")


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Link documents whose sets of five-word shingles have a similarity of 0.75 or more.

    Every set walks down 16 independent trees (chosen paths): in a node it follows its least
    token under that node's hash. A node with 64 sets or fewer ends the path; a larger one is
    divided again, up to four levels. Equal sets are one class and walk once. In each node all
    sets are compared with the one that has most company. Sets that then still lie in different
    components are compared with each other in nodes of 64 sets or fewer. Larger nodes (a
    passage that many documents share) are divided once more, by tokens that few of the crowd
    have (:func:`rare_tokens`); for what is similar by the crowd's common tokens alone, sets are
    compared with the smallest set of the same common tokens, and all of the node with the one
    that has the least share of rare ones. Sketches and sizes rule pairs out
    that cannot be similar enough; links are confirmed on the full sets. What these ways may miss
    is found exactly: all pairs that still lie in different components and share one of their
    rarest tokens are looked at (:func:`pairs_left`), so no link is lost.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable), kept. Documents
    without words or text are linked with nothing; a null key is linked with nothing, its
    component is null and it is not kept; repeated rows are each returned, as one component;
    an empty table gives an empty result; other columns are ignored; the key may be of any type
    that can be ordered. A very long text is one set of all its shingles.
    """
    return linked(docs, key, text)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_dedup(read(spark, sf_dir, "documents"))


QUERIES = {"op7_near_dedup": op7_near_dedup}
ORACLE: dict[str, str] = {}
