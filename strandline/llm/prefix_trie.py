"""Operator 11: the trie of all conversations' beginnings, by ternary search trees over ranges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm import search_tree as T
from strandline.llm.common import SPACES, in_batches, read, stored

#: Turns of distinct conversations in a range, and ranges whose spines one task merges.
TURNS, FAN = 100_000, 64
#: Open nodes up to which they are broadcast to what hangs below them.
BROADCAST_ROWS = 200_000

SPINE = "shard long, ids array<long>, words array<long>, own array<long>, first array<long>, kids array<long>, leaves array<long>, saved array<long>, ends array<string>"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, name string, above string"
_LONGS = pa.list_(pa.int64())
_NODE = pa.struct([*((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", pa.string()), ("name", pa.string()), ("above", pa.string())])
_SPINE = pa.struct([("shard", pa.int64()), *((c, _LONGS) for c in ("ids", "words", "own", "first", "kids", "leaves", "saved")), ("ends", pa.list_(pa.string()))])


def encoded(conversations: DataFrame, rows_per_bucket: int = 100_000) -> DataFrame:
    """conv_id, turn, digest, id, words: turns by the number of their (role, text) in a dictionary.

    Digests of 256 bits stand for role and text, so that only they move. Numbers are dealt out
    within buckets of digests, which keeps them from passing one task. Rows of a frequent turn
    meet one dictionary row in a join that adaptive execution splits.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    words = F.size(F.array_remove(F.split(text, SPACES), "")).cast("long")
    rows = stored(conversations.select("conv_id", "turn", digest.alias("digest"), words.alias("words")), "turns")
    turns = rows.select("digest").distinct()
    buckets = max(1, turns.count() // rows_per_bucket)
    bucket = F.pmod(F.xxhash64("digest"), F.lit(buckets))
    within = Window.partitionBy("bucket").orderBy("digest")
    dictionary = turns.withColumn("bucket", bucket).select("digest", (F.col("bucket") * (1 << 32) + F.row_number().over(within)).alias("id"))
    return rows.join(dictionary, "digest")


def rebuilt(rows: DataFrame) -> DataFrame:
    """conv_id, ids, words of every conversation after the contract's exchange of first turns."""
    turn = F.struct("turn", "digest", "id", "words")
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns")).select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))
    own = stored(own, "conversations")
    c = F.col("conv_id")
    heads = own.where(c % 20 == 0).select(c.alias("base"), F.slice("turns", 1, 3).alias("head"))
    both = own.withColumns({"base": c - c % 20, "h": (F.crc32(c.cast("string")) % 4).cast("int")}).join(heads, "base", "left")
    empty = F.array().cast("array<struct<id: bigint, words: bigint>>")
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    made = both.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), empty), tail).alias("turns"))
    return made.select("conv_id", F.transform("turns", lambda t: t["id"]).alias("ids"), F.transform("turns", lambda t: t["words"]).alias("words"))


def distinct_sequences(sequences: DataFrame) -> DataFrame:
    """ids, words, first, members, ends: each distinct sequence with the least conv_id, how many there are, and the digest of all.

    conv_ids arrive in order and are hashed as they come: a task holds one sequence and no list
    of members, however many there are.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, words, first, many, sha = None, None, None, 0, None
        kinds = [_LONGS, _LONGS, pa.int64(), pa.int64(), pa.string()]
        names = ["ids", "words", "first", "members", "ends"]
        out: list[tuple] = []

        def rows() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
            out.clear()
            return made

        for b in batches:
            for conv, ids, w in zip(*(c.to_pylist() for c in b.columns)):
                if ids != now:
                    if now is not None:
                        out.append((now, words, first, many, sha.hexdigest()))
                    now, words, first, many, sha = ids, w, conv, 0, hashlib.sha256()
                sha.update((b"," if many else b"") + str(conv).encode())
                many += 1
            if len(out) >= 2000:
                yield rows()
        if now is not None:
            out.append((now, words, first, many, sha.hexdigest()))
        if out:
            yield rows()

    sorted_ = sequences.repartition("ids").sortWithinPartitions("ids", "conv_id").select("conv_id", "ids", "words")
    return in_batches(sorted_, hashed, "ids array<long>, words array<long>, first long, members long, ends string", 10_000)


def _rows(nodes: list[T.Node], spines: list[T.Spine], shard: int, many: int = 10_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(nodes), many):
        part = [{"conv_id": n.conv, "depth": n.depth, "parent_conv_id": n.parent, "n_convs": n.members, "n_children": n.children, "n_leaves": n.leaves, "saved_tokens": n.saved, "ends_sha256": n.ends, "name": n.name, "above": n.above} for n in nodes[at : at + many]]
        yield pa.RecordBatch.from_arrays([pa.array(part, _NODE), pa.nulls(len(part), _SPINE)], names=["node", "spine"])
    if spines:
        part = [{"shard": shard, "ids": s.ids, "words": s.words, "own": s.own, "first": s.first, "kids": s.kids, "leaves": s.leaves, "saved": s.saved, "ends": s.ends} for s in spines]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(part), _NODE), pa.array(part, _SPINE)], names=["node", "spine"])


_MADE = f"node struct<{NODE.replace(' ', ': ').replace(',: ', ', ')}>, spine struct<{SPINE.replace(' ', ': ').replace(',: ', ', ')}>"


def _ranges(distinct: DataFrame, shards: int) -> DataFrame:
    """Finished nodes and open spines of each range of distinct sequences."""
    last = shards == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spines = [T.sequence(*row) for b in batches for row in zip(*(c.to_pylist() for c in b.columns))]
        shard = TaskContext.get().partitionId()
        yield from _rows(*T.grown(spines, last), shard)

    dealt = distinct.repartition(1) if last else distinct.repartitionByRange(shards, "ids")
    return dealt.sortWithinPartitions("ids").select("ids", "words", "first", "members", "ends").mapInArrow(run, _MADE)


def _merged(spines: DataFrame, last: bool) -> DataFrame:
    """Finished nodes and open spines of each ``FAN`` neighbouring ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for group, _, s in zip(*(c.to_pylist() for c in b.columns)):
                if held and group != now:
                    yield from _rows(*T.grown(held, last, True), now)
                    held = []
                now = group
                held.append(T.Spine(s["ids"], s["words"], s["own"], s["first"], s["kids"], s["leaves"], s["saved"], s["ends"]))
        if held:
            yield from _rows(*T.grown(held, last, True), now)

    rows = spines.select(F.floor(F.col("spine.shard") / FAN).cast("long").alias("group"), F.col("spine.ids").alias("ids"), "spine")
    return rows.repartition("group").sortWithinPartitions("group", "ids").mapInArrow(run, _MADE)


def trie(sequences: DataFrame, turns_per_range: int = TURNS) -> DataFrame:
    """All nodes of the trie of ``sequences`` (conv_id, ids, words).

    Distinct sequences are dealt out by range, so that a first turn that many share is split like
    any other. Each range makes a balanced ternary search tree and sums up members, leaves and
    savings from below. Nodes that a range may share with its neighbours lie on the paths of its
    first and last sequences; these two spines are merged in rounds of ``FAN`` ranges, until one
    is left. Every round is written to the shared folder. At last children of such nodes take
    their parents' ids by a join.
    """
    distinct = stored(distinct_sequences(sequences), "sequences")
    turns = distinct.agg(F.sum(F.size("ids") + 1)).first()[0]
    if turns is None:
        return distinct.sparkSession.createDataFrame([], NODE).drop("name", "above")
    shards = -(-turns // turns_per_range)
    made = stored(_ranges(distinct, shards), "trie")
    done = [made.where("node is not null").select("node.*")]
    spines = made.where("spine is not null")
    while (most := spines.agg(F.max("spine.shard")).first()[0]) is not None:
        made = stored(_merged(spines, most < FAN), "trie")
        done.append(made.where("node is not null").select("node.*"))
        spines = made.where("spine is not null")
    nodes = done[0]
    if len(done) == 1:
        return nodes.drop("name", "above")
    for more in done[1:]:
        nodes = nodes.unionByName(more)
    named = nodes.where("name is not null").select(F.col("name").alias("above"), F.col("conv_id").alias("_parent"))
    parents = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    hung = nodes.where("above is not null").join(parents, "above").withColumn("parent_conv_id", F.col("_parent")).select(*nodes.columns)
    return nodes.where("above is null").unionByName(hung).drop("name", "above")


def prefix_trie(conversations: DataFrame, turns_per_range: int = TURNS) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations, with the least conv_id of each as its name.

    Returns conv_id, depth, parent_conv_id (root: null), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Null roles and texts are empty; a null turn comes first; rows of one
    turn are ordered by a digest of role and text, and repeated rows are turns each; rows without
    a conv_id belong to no conversation and are left out; a very long text is one turn; an empty
    table gives no node; other columns are ignored, whatever their names. The numbers of a
    conversation's turns, eight bytes each, must fit a task.
    """
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    return trie(rebuilt(encoded(rows)), turns_per_range)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations."""
    return prefix_trie(read(spark, sf_dir, "conversations"))


QUERIES = {"op11_prefix_trie": op11_prefix_trie}
ORACLE: dict[str, str] = {}
