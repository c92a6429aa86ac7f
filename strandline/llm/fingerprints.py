"""Operator 4: SimHash document fingerprints and search within a Hamming radius."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import read, stored, words

BITS = 128
LOW_HALVES = 0x0000000100000001
#: Rows beyond which the heads of blocks are joined by a shuffle and not broadcast.
BROADCAST_ROWS = 1_000_000


def following(ids: DataFrame, width: int = 512, alone: int = 10_000) -> DataFrame:
    """(id, next_id) for distinct ids in descending order; after the last comes the first.

    Ids are cut into blocks of ``width`` consecutive values, each sorted by itself; the heads
    of the blocks are linked by the same function with wider blocks, until ``alone`` ids or
    fewer are left. Sparse ids only make more heads.
    """
    if ids.count() <= alone:
        w = Window.orderBy(F.col("id").desc_nulls_last())
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return ids.select("id", F.coalesce(F.lead("id").over(w), F.first("id").over(whole)).alias("next_id"))
    blocks = ids.withColumn("block", F.floor(F.col("id") / width))
    heads = blocks.groupBy("block").agg(F.max("id").alias("head"))
    links = following(heads.select(F.col("head").alias("id")), width * 512, alone)
    after = heads.join(links, heads["head"] == links["id"]).select("block", F.col("next_id").alias("next_head"))
    w = Window.partitionBy("block").orderBy(F.col("id").desc())
    return blocks.withColumn("within", F.lead("id").over(w)).join(after, "block").select("id", F.coalesce("within", "next_head").alias("next_id"))


def with_next(docs: DataFrame, key: str, text: str, width: int = 512) -> DataFrame:
    """Each row beside the next one in descending key order, the first after the last.

    Returns block, place, doc_id, text, next_block, next_place, next_text. The texts move once,
    to blocks of ``width`` consecutive keys; only the rows that head a block are joined to the
    last row of the block before. Null keys come last; rows with equal keys follow each other by text.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("doc_id") / width), F.lit(-(2**62))))
    heads = rows.groupBy("block").agg(F.max("doc_id").alias("head_id"))
    links = following(heads.select(F.col("block").alias("id")))
    ids = heads.select(F.col("block").alias("next_block"), "head_id")
    head_ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    texts = rows.select("doc_id", "text").join(head_ids, F.col("doc_id").eqNullSafe(F.col("head_id"))).groupBy("next_block").agg(F.min("text").alias("head_text"))
    after = links.join(texts, links["next_id"] == texts["next_block"]).select(F.col("id").alias("block"), "next_block", "head_text")
    w = Window.partitionBy("block").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    placed = rows.select(
        "block", "doc_id", "text",
        F.row_number().over(w).alias("place"), F.lead("text").over(w).alias("within"),
    ).join(after, "block")
    last = F.col("within").isNull()
    return placed.select(
        "block", "place", "doc_id", "text",
        F.when(last, F.col("next_block")).otherwise(F.col("block")).alias("next_block"),
        F.when(last, F.lit(1)).otherwise(F.col("place") + 1).alias("next_place"),
        F.coalesce("within", "head_text").alias("next_text"),
    )


def shingles(w: str) -> Column:
    """Array of structs of five consecutive words of an array column; fewer words stand as one, padded with nulls."""
    n = F.size(w)
    long = F.arrays_zip(*[F.slice(w, i + 1, F.greatest(n - 4, F.lit(0))).alias(f"w{i}") for i in range(5)])
    short = F.array(F.struct(*[F.get(w, F.lit(i)).alias(f"w{i}") for i in range(5)]))
    return F.when(n >= 5, long).when(n > 0, short)


def _vote(sums: list[str], total: Column) -> Column:
    """64 bits: those whose term hashes had the bit set by more than half of the weight."""
    bit = F.lit(0).cast("long")
    for k, s in enumerate(sums):
        low, high = F.col(s).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(s), 32)
        for ones, place in ((low, k), (high, k + 32)):
            mask = (1 << place) - ((1 << 64) if place == 63 else 0)
            bit = bit.bitwiseOR(F.when(ones * 2 > total, F.lit(mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return bit


def simhash(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """SimHash of ``text`` in each row of ``df``: ``by`` columns, low and high 64 bits.

    Every occurrence of a five-word shingle votes on 128 signed bits by its hash, so a term
    weighs its frequency. Two 32-bit counters share a long. ``by`` must identify rows; if
    ``df`` is partitioned by a subset of it, nothing is shuffled. A text without words gives zeros.
    """
    terms = df.select(*by, words(F.lower(text)).alias("w")).select(*by, F.inline_outer(shingles("w")))
    row = [f"w{i}" for i in range(5)]
    voting = terms.select(
        *by, F.col("w0").isNotNull().cast("long").alias("v"),
        F.xxhash64(*row).alias("h0"), F.xxhash64(F.lit("high"), *row).alias("h1"),
    )
    sums = [F.sum("v").alias("n")]
    for half in (0, 1):
        sums += [F.sum(F.shiftrightunsigned(F.col(f"h{half}"), k).bitwiseAND(F.lit(LOW_HALVES)) * F.col("v")).alias(f"s{half}_{k}") for k in range(32)]
    votes = voting.groupBy(*by).agg(*sums)
    return votes.select(*by, *(_vote([f"s{h}_{k}" for k in range(32)], F.col("n")).alias(name) for h, name in ((0, "low"), (1, "high"))))


def shown(low: str, high: str) -> Column:
    """The 128 bits as 32 lowercase hex digits."""
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def differing(a: str, b: str) -> Column:
    """Bits in which fingerprints ``a`` and ``b`` (prefixes of low/high columns) differ."""
    return F.bit_count(F.col(f"{a}low").bitwiseXOR(F.col(f"{b}low"))) + F.bit_count(F.col(f"{a}high").bitwiseXOR(F.col(f"{b}high")))


def likeness(distance: Column) -> Column:
    """Cosine of the term vectors that a Hamming distance stands for, 0 at the least."""
    return F.greatest(F.lit(0.0), F.cos(distance * F.lit(3.141592653589793 / BITS)))


def _blocks(count: int) -> list[tuple[int, int]]:
    """Masks (low, high) that cut the 128 bits into ``count`` blocks."""
    edges = [round(BITS * i / count) for i in range(count + 1)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [(signed(m & (2**64 - 1)), signed(m >> 64)) for m in masks]


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 8, blocks: int = 10) -> DataFrame:
    """All pairs of distinct fingerprints (low, high) at most ``radius`` bits apart.

    Fingerprints within the radius agree in ``blocks - radius`` whole blocks at least. There is
    a table for each choice of so many blocks, keyed by their bits; a query meets the
    fingerprints of its key in each table. A pair that several tables would find is taken from
    the first one only. Returns q_low, q_high, low, high, distance, a fingerprint's own row included.
    """
    masks = _blocks(blocks)
    chosen = list(combinations(range(blocks), blocks - radius))

    def table(df: DataFrame, p: str) -> DataFrame:
        keys = []
        for t, c in enumerate(chosen):
            lo, hi = (sum(masks[i][k] & (2**64 - 1) for i in c) for k in (0, 1))
            lo, hi = (x - (1 << 64) if x >> 63 else x for x in (lo, hi))
            keys.append(F.struct(F.lit(t).alias("t"), F.xxhash64(F.col("low").bitwiseAND(F.lit(lo).cast("long")), F.col("high").bitwiseAND(F.lit(hi).cast("long"))).alias("k")))
        return df.select("low", "high", F.inline(F.array(*keys))).withColumnsRenamed({"low": f"{p}low", "high": f"{p}high"})

    pairs = table(queries, "q_").join(table(prints, ""), ["t", "k"])
    xl, xh = F.col("q_low").bitwiseXOR(F.col("low")), F.col("q_high").bitwiseXOR(F.col("high"))
    same = [(xl.bitwiseAND(F.lit(lo).cast("long")) == 0) & (xh.bitwiseAND(F.lit(hi).cast("long")) == 0) for lo, hi in masks]
    first = F.lit(-1)
    for t, c in reversed(list(enumerate(chosen))):
        all_same = same[c[0]]
        for i in c[1:]:
            all_same = all_same & same[i]
        first = F.when(all_same, F.lit(t)).otherwise(first)
    distance = F.bit_count(xl) + F.bit_count(xh)
    return pairs.where((distance <= radius) & (F.col("t") == first)).select("q_low", "q_high", "low", "high", distance.alias("distance"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 8, every: int = 100) -> DataFrame:
    """Fingerprint every whole text and its edited text, and search the near ones.

    The edited text has the last half of the code points replaced by the first as many (or
    all) of the next document in descending key order. Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, and near_docs: for documents whose
    key is divisible by ``every``, how many other rows have a fingerprint within ``radius``
    bits (else null). Null texts count as empty, texts without words have the fingerprint 0;
    null keys sort last and repeated rows each get a row; a lone row is its own next; a very long
    text is fingerprinted whole; an empty table gives an empty result; other columns are ignored.
    ``radius`` bounds bits and not the share of common shingles: see the README for what it finds.
    """
    rows = with_next(docs, key, text)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half)))
    by = ["block", "place", "doc_id", "next_block", "next_place", "n_chars", "edited_sha256"]
    rows = rows.select(*by[:5], n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "text", "edited")
    both = rows.select(*by, F.inline(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("body")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("body")))))
    hashed = simhash(both, "body", [*by, "side"])
    pick = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    prints = stored(hashed.groupBy(*by).agg(pick(0, "low").alias("low"), pick(0, "high").alias("high"), pick(1, "low").alias("e_low"), pick(1, "high").alias("e_high")), "fingerprints")

    after = prints.select(F.col("block").alias("next_block"), F.col("place").alias("next_place"), F.col("low").alias("n_low"), F.col("high").alias("n_high"))
    distinct = prints.groupBy("low", "high").agg(F.count("*").alias("many"))
    asking = prints.where(F.col("doc_id") % every == 0).select("low", "high").distinct()
    found = within_radius(asking, distinct.select("low", "high"), radius)
    near = found.join(distinct, ["low", "high"]).groupBy(F.col("q_low").alias("low"), F.col("q_high").alias("high")).agg((F.sum("many") - 1).alias("near_docs"))
    return (
        prints.join(after, ["next_block", "next_place"])
        .join(near, ["low", "high"], "left")
        .select(
            "doc_id", "n_chars", "edited_sha256",
            shown("low", "high").alias("fingerprint"), shown("e_low", "e_high").alias("edited_fingerprint"),
            likeness(differing("", "e_")).alias("near_edited"), likeness(differing("", "n_")).alias("near_next"),
            F.when(F.col("doc_id") % every == 0, F.col("near_docs")).alias("near_docs"),
        )
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    return fingerprints(read(spark, sf_dir, "documents"))


QUERIES = {"op4_fingerprints": op4_fingerprints}
ORACLE: dict[str, str] = {}
