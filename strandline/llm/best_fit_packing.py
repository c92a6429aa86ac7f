"""Operator 5: sequence packing by length patterns fitted with non-negative least squares."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm import word_bpe
from strandline.llm.common import in_batches, read, stored
from strandline.llm.shingling import text_parts
from strandline.llm.token_counts import vocabulary_path

PIECE = "doc_id {kind}, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, max_tokens: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of every whole text: its ids, then ``end_id``, cut only where longer than a sequence."""
    kind = docs.schema[key].dataType.simpleString()
    tail = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe.load(path)
        for b in batches:
            rows: list[tuple] = []
            keys = b.column(0).to_pylist()
            for first, part in text_parts(b.column(1)):
                for doc, ids in zip(keys[first:], bpe.encode_texts(part)):
                    ids += tail
                    n = len(ids) // 4
                    for i, begin in enumerate(range(0, n, max_tokens)):
                        end = min(n, begin + max_tokens)
                        rows.append((doc, i, begin, end - begin, zlib.crc32(ids[4 * begin : 4 * end])))
            columns = list(zip(*rows)) or [()] * 5
            types = [b.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return in_batches(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), cut, PIECE.format(kind=kind))


def patterns(counts: np.ndarray, partners: int = 4) -> list[tuple[int, ...]]:
    """Length patterns of two to four documents that fill a sequence exactly.

    ``counts[n]`` is the number of pieces of length n. All pairs are listed; for each length the
    ``partners`` triples whose other two lengths are most frequent; and for each length with
    each of its ``partners`` most frequent shorter ones, the best two that fill the rest.
    """
    full = len(counts) - 1
    out = [(full - a, a) for a in range(1, full // 2 + 1) if counts[a] and counts[full - a]]

    def best_pairs(rest: int, least: int, many: int) -> list[tuple[int, int]]:
        b = np.arange(least, rest // 2 + 1)
        support = np.minimum(counts[b], counts[rest - b])
        best = np.flatnonzero(support) if np.count_nonzero(support) <= many else np.argsort(-support, kind="stable")[:many]
        return [(rest - int(b[i]), int(b[i])) for i in best]

    present = np.flatnonzero(counts[: full + 1])
    for a in present[present <= full // 3].tolist():
        out += [(x, y, a) for x, y in best_pairs(full - a, a, partners)]
    small = present[present <= full // 4]
    for at, a in enumerate(small.tolist()):
        step = max(1, at // partners)
        for b in small[at % step : at + 1 : step].tolist()[:partners]:
            out += [(x, y, a, b) for x, y in best_pairs(full - a - b, max(a, b), 1)]
    return list(dict.fromkeys(tuple(sorted(p, reverse=True)) for p in out))


def fit(counts: np.ndarray, listed: list[tuple[int, ...]], sweeps: int = 25) -> np.ndarray:
    """Repeat counts x >= 0 that make the listed patterns come nearest to ``counts``.

    Non-negative least squares by cyclic coordinate descent on the sparse columns.
    """
    columns = [[(n, p.count(n)) for n in set(p)] for p in listed]
    norms = [sum(m * m for _, m in c) for c in columns]
    x, rest = [0.0] * len(listed), counts.astype(float).tolist()
    for _ in range(sweeps):
        moved = 0.0
        for i, c in enumerate(columns):
            step = max(-x[i], sum(m * rest[n] for n, m in c) / norms[i])
            if step:
                x[i] += step
                moved = max(moved, abs(step))
                for n, m in c:
                    rest[n] -= m * step
        if moved < 0.25:
            break
    return np.array(x)


def best_fit(counts: np.ndarray) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best-fit decreasing on a histogram: groups of (((length, times), ...), sequences)."""
    full = len(counts) - 1
    open_: dict[int, list] = {}
    gaps: list[int] = []
    done: list = []

    def put(gap: int, content: tuple, many: int) -> None:
        if not many:
            return
        if gap == 0:
            done.append((content, many))
            return
        if gap not in open_:
            open_[gap] = []
            bisect.insort(gaps, gap)
        open_[gap].append((content, many))

    for n in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[n])
        while left:
            at = bisect.bisect_left(gaps, n)
            if at == len(gaps):
                gap, content, many = full, (), left
            else:
                gap = gaps[at]
                content, many = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap]
                    gaps.pop(at)
            times = gap // n
            whole = min(many, left // times)
            put(gap - times * n, (*content, (n, times)), whole)
            left -= whole * times
            used = whole
            if left and left < times and used < many:
                put(gap - left * n, (*content, (n, left)), 1)
                left, used = 0, used + 1
            if content:
                put(gap, content, many - used)
    return done + [g for groups in open_.values() for g in groups]


Group = tuple[tuple[tuple[int, int], ...], int]


def by_patterns(counts: np.ndarray, share: float, rounds: int = 12) -> tuple[list[Group], np.ndarray]:
    """Groups of equal sequences by fitted patterns, and the histogram of what they leave.

    Each round lists the patterns of what is left, fits their repeat counts, and rounds them up
    as far as pieces last, from the most repeated pattern on. It ends when ``share`` of all
    tokens is placed or no pattern is left.
    """
    rest, groups = counts.copy(), []
    lengths = np.arange(len(counts))
    keep = (1 - share) * float(counts @ lengths)
    for _ in range(rounds):
        listed = patterns(rest)
        if not listed or rest @ lengths <= keep:
            break
        x = fit(rest, listed)
        placed = 0
        for i in np.argsort(-x, kind="stable").tolist():
            if x[i] < 1e-6 or rest @ lengths <= keep:
                break
            content = tuple((n, listed[i].count(n)) for n in sorted(set(listed[i]), reverse=True))
            many = min(int(np.ceil(x[i])), *(int(rest[n]) // m for n, m in content))
            if many:
                groups.append((content, many))
                placed += many
                for n, m in content:
                    rest[n] -= m * many
        if not placed:
            break
    return groups, rest


def plan(counts: np.ndarray, shares: tuple[float, ...] = (1.0, 0.95, 0.9, 0.8, 0.7)) -> list[Group]:
    """Groups of equal sequences for a histogram of lengths.

    Fitted patterns place shares of the tokens; whole sequences of one piece stand by
    themselves; the residual is packed by best fit. The share that needs the fewest sequences is
    taken, of equal ones the largest.
    """
    counts = counts.copy()
    full = len(counts) - 1
    whole = [(((full, 1),), int(counts[full]))] if counts[full] else []
    counts[full] = 0
    best: list | None = None
    least = -(-int(counts @ np.arange(len(counts))) // full)
    for share in shares:
        groups, rest = by_patterns(counts, share)
        groups = groups + best_fit(rest)
        if best is None or sum(m for _, m in groups) < sum(m for _, m in best):
            best = groups
        if sum(m for _, m in best) == least:
            break
    return whole + (best or [])


def plan_rows(groups: list[tuple[tuple[tuple[int, int], ...], int]]) -> list[tuple[int, ...]]:
    """One row for each length of each group: which ranks of that length go where."""
    rows, taken, sequence = [], {}, 0
    for content, many in groups:
        offset = 0
        for n, times in content:
            first = taken.get(n, 0)
            taken[n] = first + times * many
            rows.append((n, first, taken[n], times, sequence, offset))
            offset += n * times
        sequence += many
    return rows


def pack(cut: DataFrame, max_tokens: int = 4096, rows_per_salt: int = 50_000) -> DataFrame:
    """Give every piece (doc_id, piece, start, length, ...) a sequence and an offset.

    Only the histogram of lengths (at most ``max_tokens`` rows) reaches the driver. The plan
    made there has some rows for each length, whatever the number of documents, so it is
    broadcast. Pieces take consecutive ranks within their length; a length that many pieces
    share is ranked in salted parts whose sizes are summed first. Rows that are equal in all
    columns are packed each. An empty table gives an empty result.
    """
    spark = cut.sparkSession
    counts = np.zeros(max_tokens + 1, np.int64)
    for n, many in cut.groupBy("length").count().collect():
        counts[n] = many
    rows = plan_rows(plan(counts))
    layout = spark.createDataFrame(rows, "length long, first long, past long, times long, sequence long, place long")
    if len(rows) <= 40 * max_tokens:
        layout = F.broadcast(layout)
    salts = max(16, int(counts.sum()) // rows_per_salt)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("many"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "salt", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(within) - 1).join(bases, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("base"))
    placed = ranked.join(layout, (ranked["length"] == layout["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past"))).drop(layout["length"])
    j = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(j / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("place") + F.pmod(j, F.col("times")) * F.col("length")).cast("long").alias("offset"),
    )


def best_fit_packing(docs: DataFrame, path: str, max_tokens: int = 4096, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``max_tokens`` tokens.

    A null or empty text is the single id ``end_id``; a null key stays null; repeated rows are
    packed each; other columns are ignored, whatever their names; an empty table gives an empty
    result. The small table of pieces is written to the shared folder, so texts are tokenised
    once and a lost executor costs no second tokenisation.
    """
    cut = stored(pieces(docs, path, max_tokens, end_id, key, text), "pieces")
    return pack(cut, max_tokens)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return best_fit_packing(read(spark, sf_dir, "documents"), vocabulary_path())


QUERIES = {"op5_best_fit_packing": op5_best_fit_packing}
ORACLE: dict[str, str] = {}
