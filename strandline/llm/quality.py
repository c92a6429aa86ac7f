"""Operator 2: quality by an interpolated modified Kneser-Ney trigram model of trusted text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import discard, freed_shuffles, in_batches, read, stored
from strandline.llm.shingling import mix, text_parts
from strandline.llm.word_ids import WordIds

#: Trusted documents that the model is fitted on: no bound, so four in five (a hash of the key chooses); the fifth sets limits.
TRUSTED = 1 << 62
#: Learned words up to which a model is broadcast; a larger one stays in Spark and scores in shards.
ENTRIES = 2_000_000
#: How often the trusted text must have a word for it to stand for itself; rarer ones stand for their shape.
LEAST = 2
#: Words that a worker remembers.
REMEMBERED = 100_000
#: The share of trusted spans that a limit lets pass.
QUANTILE = 0.998
#: Symbols before the words: document edges, a word's second and its further occurrences in a row.
EDGE, AGAIN, ONCE_MORE = 0, 1, 2
_MARKS = ".,;:!?\"'()"
_ODD = regex.compile(r"[^\p{L}\p{M}\p{N}'’\-]")
SHAPES = [f"{k}{n}" for k in ("lower", "title", "upper", "mixed", "number", "odd", "mark") for n in range(5)]


def shape(word: str) -> str:
    """The class of a word without a number: its kind of letters and its length."""
    core = word.strip(_MARKS)
    size = min(4, len(core) // 3)
    if not core:
        return f"mark{min(4, len(word) - 1)}"
    if _ODD.search(core) or len(word) - len(core) > 2:
        return f"odd{size}"
    if any(c.isdigit() for c in core):
        return f"number{size}"
    if core.islower() or not any(c.isupper() for c in core):
        return f"lower{size}"
    if core[0].isupper() and core[1:].islower() or len(core) == 1:
        return f"title{size}"
    return f"{'upper' if core.isupper() else 'mixed'}{size}"


def folded(word: str) -> str:
    """A word as it is looked up: without marks around it; a capital first letter counts as small."""
    core = word.strip(_MARKS)
    if len(word) - len(core) > 2:
        return word
    return core[:1].lower() + core[1:] if core[1:].islower() or len(core) == 1 else core


def word_hash(word: str) -> int:
    """A signed hash of 64 bits that stands for a word."""
    n = xxhash.xxh64_intdigest(word)
    return n - (1 << 64) if n >> 63 else n


@dataclass
class Vocabulary:
    """Numbers of words and shapes; a word's number is the place of its hash among the sorted ``hashes``."""

    hashes: np.ndarray

    def __post_init__(self):
        self.shape = {s: 3 + i for i, s in enumerate(SHAPES)}
        self.size = 3 + len(SHAPES) + len(self.hashes)

    def describe(self, words: list[str]) -> np.ndarray:
        out = np.fromiter((self.shape[shape(w)] for w in words), np.int64, len(words))
        if len(self.hashes):
            mine = np.fromiter((word_hash(folded(w)) for w in words), np.int64, len(words))
            at = np.minimum(np.searchsorted(self.hashes, mine), len(self.hashes) - 1)
            known = self.hashes[at] == mine
            out[known] = 3 + len(SHAPES) + at[known]
        return out

    def tokens(self, ids: WordIds, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the texts, two edges before and one after each, and symbols of each text."""
        ids.tidy()
        numbers, counts = ids.of([t.split() for t in texts])
        symbols = ids.rows[numbers, 0].astype(np.int64)
        begins = np.cumsum(counts) - counts
        again = np.zeros(len(numbers), bool)
        again[1:] = numbers[1:] == numbers[:-1]
        again[begins[counts > 0]] = False
        symbols[again] = AGAIN
        symbols[1:][again[1:] & again[:-1]] = ONCE_MORE
        out = np.full(len(symbols) + 3 * len(counts), EDGE, np.int64)
        out[np.arange(len(symbols)) + 2 + 3 * np.repeat(np.arange(len(counts)), counts)] = symbols
        return out, counts + 3


@dataclass
class KneserNey:
    """Sorted keys and log10 values of the model's tables; b and ab are contexts."""

    vocabulary: Vocabulary
    unigram: np.ndarray
    key2: np.ndarray
    p2: np.ndarray
    back2: np.ndarray
    key3: np.ndarray
    p3: np.ndarray
    key_ab: np.ndarray
    back3: np.ndarray

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def score(self, symbols: np.ndarray) -> np.ndarray:
        """log10 P of symbols 2, 3, ... each after the two before it."""
        v = self.vocabulary.size
        a, b, c = symbols[:-2], symbols[1:-1], symbols[2:]
        ab, bc = a * v + b, b * v + c
        at, found = self._find(self.key3, ab * v + c)
        out = np.empty(len(c), np.float32)
        out[found] = self.p3[at[found]]
        rest = np.flatnonzero(~found)
        at, found = self._find(self.key2, bc[rest])
        low = np.where(found, self.p2[at] if len(self.p2) else 0.0, self.back2[b[rest]] + self.unigram[c[rest]])
        at, found = self._find(self.key_ab, ab[rest])
        out[rest] = low + np.where(found, self.back3[at] if len(self.back3) else 0.0, 0.0)
        return out


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more."""
    n = {r[0]: r[1] for r in counts.where(F.col("n") <= 4).groupBy("n").count().collect()}
    return _clamped([n.get(k, 0) for k in (1, 2, 3, 4)])


def _off(d: tuple[float, float, float]) -> Column:
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


def _contexts(counts: DataFrame, by: list[str], d: tuple[float, float, float]) -> DataFrame:
    """Total count of each context, and the mass it leaves to the lower order."""
    return counts.groupBy(*by).agg(F.sum("n").alias("total"), F.sum(_off(d)).alias("freed")).select(*by, "total", (F.col("freed") / F.col("total")).alias("back"))


def in_sample(key: str, trusted: int, most: int) -> Column:
    """Whether a trusted document is one to fit on: at most four in five, and about ``most``."""
    share = min(0.8, most / max(1, trusted))
    return F.coalesce(F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_000)) < F.lit(int(1_000_000 * share)), F.lit(False))


@dataclass
class Tables:
    """The model in Spark: p3 (ab, c, x) and p2 (b, c, x), log10; contexts ab and b with x, the log10 of what they leave; p1 (c, x)."""

    vocabulary: Vocabulary
    uniform: float
    p1: DataFrame
    after2: DataFrame
    p2: DataFrame
    after3: DataFrame
    p3: DataFrame

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """log10 values of all symbols alone, and of what each leaves as a context."""
        v = self.vocabulary.size
        unigram, back2 = np.full(v, np.log10(self.uniform), np.float32), np.zeros(v, np.float32)
        for out, df in ((unigram, self.p1), (back2, self.after2)):
            t = df.toArrow()
            out[t.column(0).to_numpy()] = t.column(1).to_numpy()
        return unigram, back2

    def collected(self) -> KneserNey:
        """The model as arrays, for one that is small enough to be broadcast."""
        v = self.vocabulary.size
        if v >= 1 << 21:
            raise ValueError("three numbers no longer fit a key of 63 bits: score by shards")

        def table(df: DataFrame, key: Column) -> tuple[np.ndarray, np.ndarray]:
            t = df.select(key.alias("k"), "x").toArrow().sort_by("k")
            return t.column("k").to_numpy().astype(np.int64), t.column("x").to_numpy().astype(np.float32)

        unigram, back2 = self.arrays()
        key2, p2 = table(self.p2, F.col("b") * v + F.col("c"))
        return KneserNey(self.vocabulary, unigram, key2, p2, back2, *table(self.p3, F.col("ab") * v + F.col("c")), *table(self.after3, F.col("ab")))


def fit(trusted: DataFrame, many: int, most: int = TRUSTED, least: int = LEAST, key: str = "doc_id", text: str = "text") -> KneserNey:
    """The model of :func:`fit_tables` as arrays in the driver."""
    return fit_tables(trusted, many, most, least, key, text).collected()


def fit_tables(trusted: DataFrame, many: int, most: int = TRUSTED, least: int = LEAST, key: str = "doc_id", text: str = "text") -> Tables:
    """Fit the model to four in five of ``many`` trusted documents, if ``most`` sets no bound.

    Counts of trigrams and continuation counts of shorter ones are joined with those of their
    contexts, sharded by context, and stay in Spark. Words that the text has ``least`` times
    stand for themselves; only their hashes reach the driver.
    """
    texts = learned(trusted, many, most, key, text)
    return tables_of(texts, learn_words(texts, least)[0])


def learned(trusted: DataFrame, many: int, most: int, key: str, text: str) -> DataFrame:
    """The texts ``t`` of the trusted documents to fit on."""
    return trusted.where(in_sample(key, many, most)).select(F.coalesce(F.col(text), F.lit("")).alias("t"))


def learn_words(texts: DataFrame, least: int) -> tuple[Vocabulary, np.ndarray]:
    """The words that ``texts`` have ``least`` times, and about how often each symbol occurs."""
    place = {s: i for i, s in enumerate(SHAPES)}

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for _, some in text_parts(b.column(0)):
                for t in some:
                    seen.update(t.split())
        merged: Counter = Counter()
        kinds: dict = {}
        others = [0] * len(SHAPES)
        for w, n in seen.items():
            s = shape(w)
            if s[:-1] in ("lower", "title"):
                f = folded(w)
                merged[f] += n
                kinds[f] = place[s]
            else:
                others[place[s]] += n
        w = [*map(word_hash, merged), *range(len(SHAPES))]
        columns = [pa.array(w, pa.int64()), pa.array([*merged.values(), *others], pa.int64()), pa.array([*map(kinds.__getitem__, merged), *range(len(SHAPES))], pa.int32())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.arange(len(w)) < len(merged))], names=["w", "n", "s", "named"])

    counts = in_batches(texts, count_words, "w long, n long, s int, named boolean").groupBy("w", "named").agg(F.sum("n").alias("n"), F.max("s").alias("s"))
    own = F.col("named") & (F.col("n") >= least)
    found = counts.groupBy(F.when(own, F.col("w")).alias("w"), F.when(~own, F.col("s")).alias("s")).agg(F.sum("n").alias("n")).toArrow().sort_by("w")
    own, rest = (found.filter(x) for x in (pc.is_valid(found.column("w")), pc.is_null(found.column("w"))))
    words = Vocabulary(own.column("w").to_numpy())
    often = np.zeros(words.size, np.int64)
    often[3 + len(SHAPES) :] = own.column("n").to_numpy()
    often[3 + rest.column("s").to_numpy()] = rest.column("n").to_numpy()
    return words, often


def tables_of(texts: DataFrame, words: Vocabulary) -> Tables:
    """The model of ``texts`` as tables in Spark."""
    v = words.size

    def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds(words.describe, 1, np.int32, REMEMBERED)
        for b in batches:
            for _, part in text_parts(b.column(0)):
                symbols, sizes = words.tokens(ids, part)
                inside = np.ones(len(symbols), bool)
                ends = np.cumsum(sizes)
                for k in (1, 2):
                    inside[ends - k] = False
                at = np.flatnonzero(inside)
                contexts, which = np.unique(symbols[at] * v + symbols[at + 1], return_inverse=True)
                keys, n = np.unique(which * v + symbols[at + 2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(contexts[keys // v]), pa.array(keys % v), pa.array(n.astype(np.int64))], names=["ab", "c", "n"])

    three = stored(in_batches(texts, count_trigrams, "ab long, c long, n long").groupBy("ab", "c").agg(F.sum("n").alias("n")), "trigrams")
    three = three.withColumn("b", F.col("ab") % v)
    two = stored(three.groupBy("b", "c").agg(F.count("*").alias("n")), "bigrams")
    one = two.groupBy("c").agg(F.count("*").alias("n"))
    d3, d2 = _discounts(three), _discounts(two)
    kinds = one.agg(F.sum("n")).first()[0] or 0
    uniform = 0.005 / v
    p1 = one.select("c", (F.col("n") * (0.995 / max(1, kinds)) + uniform).alias("p1"))
    after2 = stored(_contexts(two, ["b"], d2), "contexts2")
    p2 = two.join(after2, "b").join(p1, "c").select("b", "c", ((F.col("n") - _off(d2)) / F.col("total") + F.col("back") * F.col("p1")).alias("p2"))
    p2 = stored(p2, "p2")
    after3 = stored(_contexts(three, ["ab"], d3), "contexts3")
    p3 = three.join(after3, "ab").join(p2, ["b", "c"]).select("ab", "c", F.log10((F.col("n") - _off(d3)) / F.col("total") + F.col("back") * F.col("p2")).alias("x"))
    log = lambda c: F.log10(c).alias("x")
    return Tables(words, uniform, p1.select("c", log("p1")), after2.select("b", log("back")), p2.select("b", "c", log("p2")), after3.select("ab", log("back")), stored(p3, "p3"))


#: Lengths are compared by powers of two, up to this one.
LONGEST = 9


def _spans(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many spans each text has, and of each span its power of two and its place in the text."""
    many = np.minimum(np.log2(sizes - 2).astype(np.int64), LONGEST) + 1
    k = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    size = np.repeat(sizes, many)
    return many, k, (size * 2654435761 + k * 40503) % (size - 1 - (1 << k))


def perplexity(docs: DataFrame, model: KneserNey, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, ``keep`` columns, n_tokens (words and the end), logp (log10 P) and spans of every whole text.

    ``spans`` holds the mean surprise of one span of 2 ** k symbols for every k that fits. The
    model is broadcast, so it must be small. The same scores by joins with the counts are in
    :func:`scores_by_joins`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(text).alias("_t"), F.col(key), *keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[1:])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds(shared.value.vocabulary.describe, 1, np.int32, REMEMBERED)
        for b in batches:
            for first, texts in text_parts(b.column(0), 1_000_000):
                symbols, sizes = shared.value.vocabulary.tokens(ids, texts)
                begins = np.cumsum(sizes) - sizes
                logp = np.zeros(len(symbols), np.float64)
                logp[2:] = shared.value.score(symbols)
                logp[begins] = logp[begins + 1] = 0
                upto = np.cumsum(logp)  # that of begins + 1 is before a text's first symbol
                many, k, start = _spans(sizes)
                start = start + np.repeat(begins + 1, many)
                means = (upto[start] - upto[start + (1 << k)]) / (1 << k)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)].astype(np.int32)), pa.array(means))
                columns = [c.slice(first, len(texts)) for c in b.columns[1:]]
                names = [f.name for f in b.schema][1:]
                total = upto[begins + sizes - 1] - upto[begins + 1]
                yield pa.RecordBatch.from_arrays([*columns, pa.array((sizes - 2).astype(np.int64)), pa.array(total), lists], names=[*names, "n_tokens", "logp", "spans"])

    return in_batches(source, score, f"{fields}, n_tokens long, logp double, spans array<double>")


def model_tables(spark: SparkSession, model: KneserNey) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The model as tables: trigrams (ab, c, x), bigrams (b, c, x), contexts of two symbols (ab, x)."""
    v = model.vocabulary.size
    make = lambda k, x: spark.createDataFrame(pa.table({**k, "x": x.astype(np.float64)}))
    return make({"ab": model.key3 // v, "c": model.key3 % v}, model.p3), make({"b": model.key2 // v, "c": model.key2 % v}, model.p2), make({"ab": model.key_ab}, model.back3)


def perplexity_by_joins(docs: DataFrame, model: KneserNey, key: str = "doc_id", text: str = "text") -> DataFrame:
    """n_tokens and logp of every whole text as in :func:`perplexity`, by joins with the sharded tables."""
    tables = model_tables(docs.sparkSession, model)
    return scores_by_joins(docs.select(key, text), model.vocabulary, (model.unigram, model.back2), tables, F.lit(False), text)[0].drop("row")


def scores_by_joins(docs: DataFrame, vocabulary: Vocabulary, arrays: tuple[np.ndarray, np.ndarray], tables: tuple[DataFrame, DataFrame, DataFrame], spanned: Column, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The columns of ``docs`` but ``text`` with row, n_tokens and logp, and the spans (row, k, mean) of the rows that are ``spanned``.

    For a model of any size. Each text's trigrams are joined with the trigram, bigram and
    context tables by their keys; the sums meet again by row. A span is scored as a text of its own.
    """
    v = vocabulary.size
    numbered = stored(docs.withColumns({"row": F.monotonically_increasing_id(), "_s": F.coalesce(spanned, F.lit(False))}), "numbered")
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, *arrays))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, unigram, back2 = shared.value
        ids = WordIds(words.describe, 1, np.int32, REMEMBERED)
        for b in batches:
            for first, texts in text_parts(b.column(0), 1_000_000):
                symbols, sizes = words.tokens(ids, texts)
                begins, tokens = np.cumsum(sizes) - sizes, sizes - 2
                mine = np.flatnonzero(b.column(2).slice(first, len(texts)).to_numpy(zero_copy_only=False))
                many, k, start = _spans(sizes[mine])
                # whole texts, then spans: which text, which power of two, where and how long
                owner = np.r_[np.arange(len(texts)), np.repeat(mine, many)]
                kind = np.r_[np.full(len(texts), -1), k].astype(np.int32)
                length = np.r_[tokens, 1 << k]
                at = np.arange(length.sum()) + np.repeat(np.r_[begins, begins[np.repeat(mine, many)] + start] - np.cumsum(length) + length, length)
                x, y, z = symbols[at], symbols[at + 1], symbols[at + 2]
                rows = b.column(1).slice(first, len(texts)).to_numpy()[np.repeat(owner, length)]
                columns = [rows, np.repeat(kind, length), x * v + y, y, z, (back2[y] + unigram[z]).astype(np.float64)]
                for i in range(0, len(rows), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 100_000]) for c in columns], names=["row", "k", "ab", "b", "c", "low"])

    grams = in_batches(numbered.select(F.col(text).alias("_t"), "row", "_s"), spell, "row long, k int, ab long, b long, c long, low double")
    three, two, contexts = (t.withColumnRenamed("x", n) for t, n in zip(tables, ("p3", "p2", "back3")))
    met = grams.join(three, ["ab", "c"], "left").join(two, ["b", "c"], "left").join(contexts, "ab", "left")
    one = F.coalesce("p3", F.coalesce("p2", "low") + F.coalesce("back3", F.lit(0.0)))
    sums = stored(met.groupBy("row", "k").agg(F.count("*").alias("n_tokens"), F.sum(one).alias("logp")), "sums")
    whole = numbered.drop(text, "_s").join(sums.where("k = -1").drop("k"), "row")
    return whole, sums.where("k >= 0").select("row", "k", (-F.col("logp") / F.col("n_tokens")).alias("mean"))


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 32-bit numbers, their bytes by significance, compressed."""
    raw = np.concatenate([np.asarray(c).astype("<i4") for c in columns])
    return pa.compress(raw.view(np.uint8).reshape(-1, 4).T.copy(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int, many: int) -> np.ndarray:
    """The ``many`` columns of ``size`` numbers that :func:`packed` has compressed."""
    raw = np.frombuffer(pa.decompress(data, 4 * size * many, codec="zstd"), np.uint8)
    return raw.reshape(4, -1).T.copy().view("<i4").reshape(many, size)


def _order(b: np.ndarray, a: np.ndarray, c: np.ndarray, v: int) -> np.ndarray:
    """An order of trigrams by middle, first and last symbol."""
    ba = b.astype(np.int64) * v
    ba += a
    if v >= 1 << 21:
        return np.lexsort((c, ba))
    ba *= v
    ba += c
    return np.argsort(ba)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted columns."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for x in columns:
            new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _off_of(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d], np.float32)[np.minimum(n, 3)]


@dataclass
class Shards:
    """Where trigrams are counted: with their middle symbol, whose shards, one for most, are told apart by the first."""

    size: int
    many: int
    home: np.ndarray
    parts: np.ndarray

    @staticmethod
    def by(often: np.ndarray) -> Shards:
        total = max(1, int(often.sum()))
        many = max(LEAST_SHARDS, -(-total // SHARD_WORDS))
        home = mix(np.arange(len(often), dtype=np.uint64)) % np.uint64(many)
        # a middle symbol with more than a quarter of a shard's words is divided
        return Shards(len(often), many, home.astype(np.int32), np.clip(-(-often * 4 * many // total), 1, many).astype(np.int32))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.home[b] + (mix(a.astype(np.uint64) + np.uint64(1)) % self.parts[b].astype(np.uint64)).astype(np.int64)) % self.many

    def dealt(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, more: np.ndarray | None = None) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(shard, [b, a, c, n or more]) of trigrams in their order; without ``more``, equal ones are counted."""
        order = _order(b, a, c, self.size)
        a, b, c = a[order], b[order], c[order]
        if more is None:
            at = _runs(b, a, c)
            more = np.diff(np.r_[at, len(b)])
            a, b, c = a[at], b[at], c[at]
        else:
            more = more[order]
        shard = self.of(a, b).astype(np.int16 if self.many < 1 << 15 else np.int64)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.many + 1))
        for k in np.flatnonzero(np.diff(edges)):
            at = order[edges[k] : edges[k + 1]]
            yield int(k), [b[at], a[at], c[at], more[at]]


def _by_shard(batches: Iterator[pa.RecordBatch], many: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The columns of each shard as a whole, from batches (shard, size, data) in order of shard."""
    now, held = None, []

    def whole() -> np.ndarray:
        out = np.concatenate(held, axis=1)
        held.clear()
        return out

    for b in batches:
        for shard, size, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            if shard != now and held:
                yield now, whole()
            now = shard
            held.append(unpacked(data.as_buffer(), size, many))
    if held:
        yield now, whole()


#: What a row of the sharded model holds: trigrams (b, a, c, n), bigrams (b, c, n), how many counts are 1 to 4, what follows each middle symbol, and a last symbol's bigrams.
THREE, TWO, COUNTS, MIDDLE, LAST = range(5)
_MODEL = "shard int, kind int, size int, data binary, c long, n long"


def _model_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=["shard", "kind", "size", "data", "c", "n"])


def _pieces(shard: int, kind: int, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(columns[0]), 500_000):
        some = [x[i : i + 500_000] for x in columns]
        yield _model_rows([(shard, kind, len(some[0]), packed(*some), None, None)])


def _first_counts(n: np.ndarray) -> bytes:
    return np.bincount(np.minimum(n, 5), minlength=6)[1:5].astype("<i8").tobytes()


def _clamped(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many counts are 1, 2, 3 and 4."""
    n1, n2, n3, n4 = n
    if not (n1 and n2):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d1, d2 = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(min(max(d, 0.1), k - 0.1) for k, d in ((1, d1), (2, d2), (3, d3)))


@dataclass
class Sharded:
    """A model in shards: ``rows`` (shard, kind, size, data) of trigrams and bigrams; by symbol: P alone, words after it and what it leaves."""

    vocabulary: Vocabulary
    shards: Shards
    rows: list[DataFrame]
    p1: np.ndarray
    total2: np.ndarray
    back2: np.ndarray
    d3: tuple[float, float, float]
    d2: tuple[float, float, float]


def fit_sharded(texts: DataFrame, words: Vocabulary, often: np.ndarray) -> Sharded:
    """Count the model of ``texts`` in shards by the middle symbol.

    There a trigram meets its context (a, b) and its bigram (b, c), so that one shuffle of the
    trigrams serves all counts. A frequent middle symbol has several shards; the counts of its
    bigrams are added up over them and given to each.
    """
    v, shards = words.size, Shards.by(often)
    shared = texts.sparkSession.sparkContext.broadcast((words, shards))

    def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shards = shared.value
        ids = WordIds(words.describe, 1, np.int32, REMEMBERED)
        for b in batches:
            for _, part in text_parts(b.column(0), 4_000_000):
                symbols, sizes = words.tokens(ids, part)
                inside = np.ones(len(symbols), bool)
                ends = np.cumsum(sizes)
                for k in (1, 2):
                    inside[ends - k] = False
                at = np.flatnonzero(inside)
                yield _model_rows([(k, THREE, len(x[0]), packed(*x), None, None) for k, x in shards.dealt(symbols[at], symbols[at + 1], symbols[at + 2])])

    def add_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = shared.value[1]
        for shard, (b, a, c, n) in _by_shard(batches, 4):
            order = _order(b, a, c, v)
            b, a, c, n = b[order], a[order], c[order], n[order]
            del order
            at = _runs(b, a, c)
            n = np.add.reduceat(n, at)
            b, a, c = b[at], a[at], c[at]
            del at
            yield from _pieces(shard, THREE, [b, a, c, n])
            yield _model_rows([(shard, COUNTS, 0, _first_counts(n), None, None)])
            bc, n = np.unique(b.astype(np.int64) * v + c, return_counts=True)
            b, c = bc // v, bc % v
            homes = shards.home[b]
            for home in np.unique(homes):
                mine = homes == home
                yield from _pieces(int(home), TWO, [b[mine], c[mine], n[mine]])

    def add_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = shared.value[1]
        for home, (b, c, n) in _by_shard(batches, 3):
            order = np.argsort(b.astype(np.int64) * v + c)
            b, c = b[order], c[order]
            at = _runs(b, c)
            n = np.add.reduceat(n[order], at)
            b, c = b[at], c[at]
            for j in range(int(shards.parts[b].max())):
                mine = shards.parts[b] > j
                yield from _pieces((home + j) % shards.many, TWO, [b[mine], c[mine], n[mine]])
            yield _model_rows([(home, COUNTS, 0, _first_counts(n), None, None)])
            at = _runs(b)
            yield from _pieces(home, MIDDLE, [b[at], *(np.add.reduceat(x, at) for x in (n, n == 1, n == 2, n > 2))])
            last, many = np.unique(c, return_counts=True)
            for i in range(0, len(last), 100_000):
                k = len(last[i : i + 100_000])
                same = lambda x, t: pa.array(np.full(k, x), t)  # noqa: B023, E731
                columns = [same(home, pa.int32()), same(LAST, pa.int32()), same(0, pa.int32()), pa.nulls(k, pa.binary()), pa.array(last[i : i + k].astype(np.int64)), pa.array(many[i : i + k])]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "kind", "size", "data", "c", "n"])

    dealt = lambda df: df.select("shard", "size", "data").repartition(4 * shards.many, "shard").sortWithinPartitions("shard")
    three = stored(in_batches(dealt(in_batches(texts, count_trigrams, _MODEL)), add_trigrams, _MODEL), "trigrams")
    two = stored(in_batches(dealt(three.where(F.col("kind") == TWO)), add_bigrams, _MODEL), "bigrams")

    def discounts(df: DataFrame) -> tuple[float, float, float]:
        rows = df.where(F.col("kind") == COUNTS).select("data").collect()
        return _clamped(sum((np.frombuffer(r.data, "<i8") for r in rows), np.zeros(4, np.int64)).tolist())

    d3, d2 = discounts(three), discounts(two)
    one = two.where(F.col("kind") == LAST).groupBy("c").agg(F.sum("n").alias("n")).toArrow()
    alone = np.zeros(v)
    alone[one.column("c").to_numpy()] = one.column("n").to_numpy()
    p1 = alone * (0.995 / max(1.0, alone.sum())) + 0.005 / v
    total2, back2 = np.ones(v), np.ones(v)
    for r in two.where(F.col("kind") == MIDDLE).select("size", "data").collect():
        b, total, *kinds = unpacked(r.data, r.size, 5)
        total2[b], back2[b] = total, sum(k * d for k, d in zip(kinds, d2)) / total
    return Sharded(words, shards, [three, two], p1.astype(np.float32), total2.astype(np.float32), back2.astype(np.float32), d3, d2)


class Shard:
    """The tables of one shard of the model, ready to be looked up.

    ``three`` and ``two`` are its pieces, in any order; they are used up. A piece of ``three`` is
    a stretch of the sorted trigrams, so that they are taken one after another and never lie
    beside a copy of all.
    """

    def __init__(self, model: tuple, three: list[np.ndarray], two: list[np.ndarray]):
        self.v, self.p1, self.total2, self.back2, d3, d2 = model
        b, c, n = np.concatenate(two, axis=1) if two else np.empty((3, 0), np.int32)
        two.clear()
        bc = b.astype(np.int64) * self.v
        bc += c
        p2 = ((n - _off_of(n, d2)) / self.total2[b] + self.back2[b] * self.p1[c]).astype(np.float32)
        order = np.argsort(bc)
        self.bc, self.p2 = bc[order], p2[order]
        del b, c, n, bc, p2, order
        three.sort(key=lambda x: x[:3, 0].tolist(), reverse=True)  # the last one is taken first
        begins, contexts, totals, freed = [], [], [np.empty(0, np.int64)], [np.empty(0, np.float32)]
        for b, a, c, n in reversed(three):
            ba = b.astype(np.int64) * self.v + a
            at = _runs(ba)
            ba, total, off = ba[at], np.add.reduceat(n, at, dtype=np.int64), np.add.reduceat(_off_of(n, d3), at)
            goes_on = int(bool(contexts) and contexts[-1][-1] == ba[0])  # a context that the piece before has begun
            if goes_on:
                totals[-1][-1] += total[0]
                freed[-1][-1] += off[0]
            begins.append((-goes_on, at))
            if len(ba) > goes_on:
                contexts.append(ba[goes_on:])
                totals.append(total[goes_on:])
                freed.append(off[goes_on:])
        self.ba = np.concatenate(contexts) if contexts else np.empty(0, np.int64)
        total = np.concatenate(totals).astype(np.float32)
        self.back3 = np.concatenate(freed) / total
        size = sum(x.shape[1] for x in three)
        self.bac, self.p3 = np.empty(size, np.int64), np.empty(size, np.float32)
        row = context = 0
        for back, at in begins:
            b, a, c, n = three.pop()
            context += back
            which = np.repeat(np.arange(context, context + len(at)), np.diff(np.r_[at, len(b)]))
            self.bac[row : row + len(b)] = which * self.v + c
            self.p3[row : row + len(b)] = (n - _off_of(n, d3)) / total[which] + self.back3[which] * self._two(b, c)
            row, context = row + len(b), context + len(at)

    def _two(self, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        at, found = KneserNey._find(self.bc, b.astype(np.int64) * self.v + c)
        low = self.back2[b] * self.p1[c]
        low[found] = self.p2[at[found]]
        return low

    def log_probs(self, b: np.ndarray, a: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 P of each c after a, b."""
        out = np.empty(len(b), np.float32)
        ba, known = KneserNey._find(self.ba, b.astype(np.int64) * self.v + a)
        at, found = KneserNey._find(self.bac, ba * self.v + c)
        found &= known
        out[found] = self.p3[at[found]]
        rest = np.flatnonzero(~found)
        low = self._two(b[rest], c[rest])
        seen = known[rest]
        low[seen] *= self.back3[ba[rest[seen]]]
        out[rest] = low
        return np.log10(out)


#: Learned words of a shard, and shards at least; parts of the documents whose trigrams are under way at once, one after another.
SHARD_WORDS, LEAST_SHARDS, PORTIONS = 4_000_000, 16, 4


def scores_by_shards(docs: DataFrame, model: Sharded, spanned: Column, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The columns of ``docs`` but ``text`` with row, n_tokens and logp, and the spans (row, k, mean) of the rows that are ``spanned``.

    For a model of any size. Trigrams go to the shard of their middle symbol, where all their
    counts are, and the sums meet again by row. A span is scored as a text of its own. The
    documents go in ``PORTIONS`` one after another, so that a part of their trigrams is on disk.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != text]
    source = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_t"), F.coalesce(spanned, F.lit(False)).alias("_s"), *others)
    own = source.schema[2:]
    fields = ", ".join(f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(own))
    names = ["shard", "kind", "size", "data", "row", *(f"_{i}" for i in range(len(own)))]
    schema = f"shard int, kind int, size int, data binary, row long, {fields}"
    tables = (model.vocabulary.size, model.p1, model.total2, model.back2, model.d3, model.d2)
    shared = spark.sparkContext.broadcast((model.vocabulary, model.shards, tables))
    tokens_kind, document_kind = LAST + 1, LAST + 2
    counted = [df.where(F.col("kind") == kind).select("shard", "kind", "size", "data") for df, kind in zip(model.rows, (THREE, TWO))]
    sums = []
    for portion in range(PORTIONS):

        def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, shards, _ = shared.value
            ids = WordIds(words.describe, 1, np.int32, REMEMBERED)
            row = (TaskContext.get().partitionId() << 40) + (portion << 36)  # noqa: B023
            for batch in batches:
                for first, texts in text_parts(batch.column(0), 4_000_000):
                    symbols, sizes = words.tokens(ids, texts)
                    begins, tokens = np.cumsum(sizes) - sizes, sizes - 2
                    mine = np.flatnonzero(batch.column(1).slice(first, len(texts)).to_numpy(zero_copy_only=False))
                    many, k, start = _spans(sizes[mine])
                    # whole texts, then spans: which text, which power of two, where and how long
                    owner = np.r_[np.arange(len(texts)), np.repeat(mine, many)] * 16 + np.r_[np.zeros(len(texts), np.int64), k + 1]
                    length = np.r_[tokens, 1 << k]
                    at = np.arange(length.sum()) + np.repeat(np.r_[begins, begins[np.repeat(mine, many)] + start] - np.cumsum(length) + length, length)
                    dealt = [(s, len(x[0]), packed(*x)) for s, x in shards.dealt(symbols[at], symbols[at + 1], symbols[at + 2], np.repeat(owner, length))]
                    for i in range(0, len(dealt), 100):
                        s, size, data = zip(*dealt[i : i + 100])
                        n = len(s)
                        columns = [pa.array(s, pa.int32()), pa.array(np.full(n, tokens_kind, np.int32)), pa.array(size, pa.int32()), pa.array(data, pa.binary()), pa.array(np.full(n, row))]
                        yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(n, c.type) for c in batch.columns[2:])], names=names)
                    n = len(texts)
                    rows = row + np.arange(n)
                    columns = [pa.array((rows % shards.many).astype(np.int32)), pa.array(np.full(n, document_kind, np.int32)), pa.array(tokens.astype(np.int32)), pa.nulls(n, pa.binary()), pa.array(rows)]
                    yield pa.RecordBatch.from_arrays([*columns, *(c.slice(first, n) for c in batch.columns[2:])], names=names)
                    row += n

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, held, shard = None, {}, None
            for batch in batches:
                kinds = batch.column(1).to_numpy()
                for i in np.flatnonzero(kinds < document_kind):
                    at, size, data = batch.column(0)[i].as_py(), batch.column(2)[i].as_py(), batch.column(3)[i].as_buffer()
                    if at != now:
                        now, held, shard = at, {THREE: [], TWO: []}, None
                    if kinds[i] != tokens_kind:
                        held[int(kinds[i])].append(unpacked(data, size, 4 if kinds[i] == THREE else 3))
                        continue
                    if shard is None:
                        shard, held = Shard(shared.value[2], held[THREE], held[TWO]), {}
                    b, a, c, owner = unpacked(data, size, 4)
                    total = np.bincount(owner, weights=shard.log_probs(b, a, c))
                    met = np.flatnonzero(np.bincount(owner))
                    rows = [pa.array((met >> 4) + batch.column(4)[i].as_py()), pa.array(((met & 15) - 1).astype(np.int32)), pa.array(total[met])]
                    yield pa.RecordBatch.from_arrays([*rows, pa.nulls(len(met), pa.int64()), *(pa.nulls(len(met), x.type) for x in batch.columns[5:])], names=["row", "k", "x", "n_tokens", *names[5:]])
                some = batch.filter(pa.array(kinds == document_kind))
                n = some.num_rows
                if n:
                    yield pa.RecordBatch.from_arrays([some.column(4), pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64()), some.column(2).cast(pa.int64()), *some.columns[5:]], names=["row", "k", "x", "n_tokens", *names[5:]])

        mine = source if PORTIONS == 1 else source.where(F.pmod(F.xxhash64("_t", *others), F.lit(PORTIONS)) == portion)
        spelled = in_batches(mine, spell, schema)
        met = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), counted, spelled)
        met = met.repartition(4 * model.shards.many, "shard").sortWithinPartitions("shard", "kind")
        sums.append(stored(in_batches(met, score, f"row long, k int, x double, n_tokens long, {fields}"), "sums"))
    shared.destroy()
    both = reduce(DataFrame.union, sums)
    by_row = stored(both.where("k is not null").groupBy("row", "k").agg(F.sum("x").alias("logp")), "logp")
    whole = both.where("k is null").select("row", "n_tokens", *(F.col(f"_{i}").alias(f.name) for i, f in enumerate(own)))
    whole = whole.join(by_row.where("k = -1").select("row", "logp"), "row")
    return whole, by_row.where("k >= 0").select("row", "k", (-F.col("logp") / F.pow(F.lit(2.0), F.col("k"))).alias("mean"))


def limits(sample: DataFrame, quantile: float, least: int = 200) -> DataFrame:
    """(g, k, limit): the quantile of each language and length of spans (g, k, mean); lengths with fewer than ``least`` spans take that of all languages."""
    q = F.percentile_approx("mean", F.lit(quantile), F.lit(10000))
    own = sample.groupBy("g", "k").agg(q.alias("own"), F.count("*").alias("n"))
    pooled = sample.groupBy("k").agg(q.alias("pooled"))
    lengths = F.explode(F.sequence(F.lit(0), F.lit(LONGEST))).alias("k")
    both = own.select("g").distinct().select("g", lengths).join(pooled, "k").join(own, ["g", "k"], "left")  # languages x lengths
    return both.select("g", "k", F.when(F.col("n") >= least, F.col("own")).otherwise(F.col("pooled")).alias("limit"))


def quality(
    docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, most: int = TRUSTED,
    key: str = "doc_id", text: str = "text", lang: str = "lang", carry: tuple[str, ...] = (),
) -> DataFrame:
    """Judge every whole text by its perplexity under a model of trusted text.

    Trusted are documents labelled with quality 1; four in five of them, all of their text, fit
    the model, which is broadcast if it is small and else looked up in shards. The
    others, all of them, set the limits on text that was not learned: for each language and each power of two, the ``quantile`` of the
    mean surprise of their spans of that length. A text is kept if its own mean is within the
    limit for its language and length, so that a short one is compared with short spans.

    Returns key, ``carry`` columns, lang, n_tokens, perplexity, score (mean surprise), limit and keep, one row for
    each input row. Null and empty texts have the end token alone; a null language is a group of
    its own; a language without trusted documents has no limit and keeps all; null keys and
    repeated rows are judged each; a very long text is scored whole and compared with the
    longest spans; other columns are ignored; an empty table gives an empty result.
    """
    good = labels.where("quality = 1").select(F.col(key)).distinct()
    good = F.broadcast(good) if good.count() <= 1_000_000 else good
    trusted = docs.select(key, text).join(good, key, "left_semi")
    many = trusted.count()
    texts = learned(trusted, many, most, key, text)
    with freed_shuffles(docs.sparkSession):
        words, often = learn_words(texts, LEAST)
    named = docs.select(F.col(key), *carry, F.col(text), F.col(lang).alias("lang"))
    more = {"score": -F.col("logp") / F.col("n_tokens"), "g": F.coalesce("lang", F.lit("\x00"))}
    if often.sum() <= ENTRIES:
        scored = stored(perplexity(named, tables_of(texts, words).collected(), key, text, (*carry, "lang")).withColumns(more), "scored")
        others = scored.where(~in_sample(key, many, most)).join(good, key, "left_semi").select("g", F.posexplode("spans").alias("k", "mean"))
    else:
        with freed_shuffles(docs.sparkSession):
            model = fit_sharded(texts, words, often)
            marked = named.join(good.withColumn("_good", F.lit(True)), key, "left")
            scored, spans = scores_by_shards(marked, model, F.col("_good") & ~in_sample(key, many, most), text)
            for df in model.rows:
                discard(df)
            scored = stored(scored.withColumns(more), "scored")
            others = spans.join(scored.select("row", "g"), "row").select("g", "k", "mean")
    bounds = stored(limits(others, quantile), "limits")
    length = F.least(F.floor(F.log2(F.col("n_tokens"))), F.lit(LONGEST)).cast("int")
    longest = F.broadcast(bounds.groupBy("g").agg(F.max("k").alias("_most")))
    out = scored.drop("spans", "row").join(longest, "g", "left").withColumn("k", F.least(length, F.col("_most")))
    out = out.join(F.broadcast(bounds), ["g", "k"], "left")  # languages x lengths
    return out.select(key, *carry, "lang", "n_tokens", F.pow(F.lit(10.0), F.col("score")).alias("perplexity"), "score", "limit", F.coalesce(F.col("score") <= F.col("limit"), F.lit(True)).alias("keep"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {"op2_quality": op2_quality}
ORACLE: dict[str, str] = {}
