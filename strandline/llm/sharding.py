"""Operator 12: documents on a consistent-hash ring whose shards have bounded loads."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import read, stored

#: The ring is cut into 2 ** BITS equal cells; a virtual node stands where a cell begins.
BITS = 16
VIRTUAL = 256
#: Copies of one row from which on its copies are listed by several tasks.
CHUNK = 65_536


def ring(shards: int, virtual: int = VIRTUAL, bits: int = BITS) -> list[int]:
    """Owner of each cell: the shard whose virtual node stands next clockwise.

    A virtual node's cell depends on its own shard and number only, so that one more shard
    takes cells and gives none. Where two stand in one cell, the lower shard has it.
    """
    cells = 1 << bits
    at: dict[int, int] = {}
    for shard in range(shards):
        for v in range(virtual):
            cell = int.from_bytes(hashlib.sha256(f"{shard}:{v}".encode()).digest()[:8], "big") % cells
            at.setdefault(cell, shard)
    owner, last = [0] * cells, at[min(at)]
    for cell in range(cells - 1, -1, -1):
        last = at.get(cell, last)
        owner[cell] = last
    return owner


@dataclass(frozen=True)
class Share:
    """Keys ``first`` to ``past`` - 1 of a cell stand in a shard from ``slot`` on."""

    cell: int
    first: int
    past: int
    shard: int
    slot: int


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Most keys of each shard: their mean, rounded up for the first ones only, and ``slack`` times the mean more."""
    more = int(slack * total / shards)
    return [total // shards + (k < total % shards) + more for k in range(shards)]


def deal(counts: dict[int, int], owner: list[int], most: list[int]) -> list[Share]:
    """Deal the keys of all cells out in ring order.

    A cell's keys enter its owner while that has room; those that overflow go on clockwise to
    the next virtual node of a shard that is not full. ``most`` must hold all keys.
    """
    held, out, cells = [0] * len(most), [], len(owner)
    for cell in sorted(counts):
        first, left, at, tried = 0, counts[cell], cell, set()
        while left:
            shard = owner[at]
            if shard not in tried:
                tried.add(shard)
                some = min(left, most[shard] - held[shard])
                if some:
                    out.append(Share(cell, first, first + some, shard, held[shard]))
                    held[shard] += some
                    first, left = first + some, left - some
            at = (at + 1) % cells
            if len(tried) == len(most) and left:
                raise ValueError("the shards cannot hold all keys")
    return out


def sharding(docs: DataFrame, shards: int = 8, slack: float = 0.0, virtual: int = VIRTUAL, key: str = "doc_id", text: str = "text", rows_per_part: int = 50_000) -> DataFrame:
    """Put every document into one of ``shards`` shards: doc_id, size, text_crc32, shard, slot.

    A document's place on the ring is a hash of its text, so that equal texts lie side by side
    and share a shard unless it fills up between them. A shard takes at most its mean number of
    documents and ``slack`` times the mean more; what overflows goes on clockwise. With no slack
    the counts are at most one apart. ``slot`` numbers the documents of a shard without gaps.

    Only the counts of the 65,536 cells reach the driver, where they are dealt out; the shares, a
    few for each cell, are broadcast. Texts are read once and reduced to fixed-size rows; equal
    rows are counted before they move, and a crowded cell is ranked in parts by doc_id. The parts'
    table is written to the shared folder, so a lost executor costs no second read of texts.

    A null or empty text has size 1 and the hash of the empty text; null keys and repeated rows
    get a slot each; a very long text counts as one; an empty table gives an empty result; other
    columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    cell = F.shiftrightunsigned(F.xxhash64(body), 64 - BITS).cast("int")
    rows = docs.select(F.col(key).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("place"), cell.alias("cell"))
    rows = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("copies")), "places")
    sizes = rows.groupBy("cell").agg(F.sum("copies").alias("n"), F.count("*").alias("many"))
    cells = sizes.collect()  # 65,536 rows at most
    counts = {r["cell"]: r["n"] for r in cells}
    total = sum(counts.values())
    shares = deal(counts, ring(shards, virtual), capacities(total, shards, slack))
    plan = spark.createDataFrame([(s.cell, s.first, s.past, s.shard, s.slot) for s in shares], "cell int, first long, past long, shard int, base long")
    # a crowded cell is ranked in parts, and the parts' sizes are summed first
    crowded = spark.createDataFrame([(r["cell"], -(-r["many"] // rows_per_part)) for r in cells if r["many"] > rows_per_part], "cell int, parts long")
    parted = rows.join(F.broadcast(crowded), "cell", "left").withColumn("part", F.pmod(F.xxhash64("doc_id", "place"), F.coalesce("parts", F.lit(1)))).drop("parts")
    order = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parted.groupBy("cell", "part").agg(F.sum("copies").alias("n")).select("cell", "part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    within = Window.partitionBy("cell", "part").orderBy("place", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    ranked = parted.withColumn("rank", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    ranked = ranked.join(bases, ["cell", "part"]) if len(crowded.head(1)) else ranked.withColumn("before", F.lit(0).cast("long"))
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    placed = _listed(ranked).join(F.broadcast(plan), "cell").where("rank >= first and rank < past")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot"))


def _listed(ranked: DataFrame) -> DataFrame:
    """One row for each copy, with its own rank; a row of very many copies is listed by several tasks."""
    many = F.col("copies")
    if ranked.where(many > CHUNK).isEmpty():
        return ranked.withColumn("rank", F.explode(F.sequence(F.col("rank"), F.col("rank") + many - 1)))
    chunk = ranked.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((many - 1) / CHUNK)))).repartition("cell", "place", "doc_id", "chunk")
    first = F.col("rank") + F.col("chunk") * CHUNK
    return chunk.withColumn("rank", F.explode(F.sequence(first, F.least(first + CHUNK, F.col("rank") + many) - 1)))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards whose counts are at most one apart."""
    out = sharding(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op12_sharding": op12_sharding}
ORACLE: dict[str, str] = {}
