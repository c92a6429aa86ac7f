"""Operator 8: language identification by script ranges and Viterbi over word scores."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import in_batches, read
from strandline.llm.shingling import mix, text_parts
from strandline.llm.word_ids import WordIds

#: Words that a worker remembers.
REMEMBERED = 100_000

#: First and last code point of script blocks.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F), (0x30000, 0x323AF)],
}
BUCKETS = 1 << 16
UNKNOWN = "und"
_PLACES = mix(np.arange(1, 5, dtype=np.uint64)) | np.uint64(1)


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Whether a code point is a letter, and its script (0: none of the listed)."""
    points = 0x110000
    letter = np.fromiter((chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(points)), bool, points)
    script = np.zeros(points, np.int8)
    for i, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            script[a : b + 1] = i
    return letter, script


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all words, each word between two blanks, and the word they belong to."""
    letter, _ = _letters()
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    points = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(words)), sizes)
    keep = letter[points] | (points == 32)
    return points[keep], owner[keep]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, word) of all runs of two to four letters, word ends included, and each word's script (-1: no letter)."""
    letter, scripts = _letters()
    points, owner = _code_points(words)
    buckets, owners = [], []
    for n in (2, 3, 4):
        if len(points) < n:
            continue
        end = len(points) - n + 1
        inside = owner[:end] == owner[n - 1 :]
        h = np.zeros(end, np.uint64)
        for j in range(n):
            h += points[j : j + end].astype(np.uint64) * _PLACES[j]
        buckets.append((mix(h[inside] + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int64))
        owners.append(owner[:end][inside])
    is_letter = letter[points]
    first = np.full(len(words), -1, np.int64)
    first[owner[is_letter][::-1]] = scripts[points[is_letter]][::-1]
    bucket, which = np.concatenate(buckets or [np.empty(0, np.int64)]), np.concatenate(owners or [np.empty(0, np.int64)])
    real = first[which] >= 0
    return bucket[real], which[real], first


@dataclass
class LanguageModel:
    """Languages, log probabilities of buckets (languages x buckets), and which languages use a script."""

    langs: list[str]
    logp: np.ndarray
    scripts: np.ndarray = field(repr=False)

    def describe(self, words: list[str]) -> np.ndarray:
        """Word scores: log posterior of each language under equal priors, 0 without letters.

        Languages that do not use the word's script are ruled out, unless none uses it.
        The last column says whether the word has a letter.
        """
        bucket, owner, script = features(words)
        out = np.zeros((len(words), len(self.langs) + 1), np.float32)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(owner, weights=self.logp[k][bucket], minlength=len(words))
        used = self.scripts[:, np.maximum(script, 0)].T
        used |= ~used.any(axis=1, keepdims=True)
        scores = np.where(used, out[:, :-1], -1e9) if len(self.langs) else out[:, :-1]
        if len(self.langs):
            top = scores.max(axis=1, keepdims=True)
            scores = scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))
        has = script >= 0
        out[:, :-1] = np.where(has[:, None], np.maximum(scores, -12.0), 0.0)
        out[:, -1] = has
        return out


def train(docs: DataFrame, per_language: int = 4000, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from labelled documents, about ``per_language`` of each language at most.

    Which documents are taken depends on a hash of the key, so that the bounded sample spreads
    over the whole table. The counts that reach the driver have languages x 65,536 entries at most.
    """
    spark = docs.sparkSession
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}
    langs = sorted(sizes)
    if not langs:
        return LanguageModel([], np.empty((0, BUCKETS)), np.empty((0, len(SCRIPTS) + 1), bool))
    share = spark.createDataFrame([(l, i, min(1.0, per_language / sizes[l])) for i, l in enumerate(langs)], "lang string, which int, share double")
    sample = known.select(F.col(lang).alias("lang"), F.col(text).alias("t"), F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_000)).alias("h"))
    sample = sample.join(F.broadcast(share), "lang").where(F.col("h") < F.col("share") * 1_000_000).select("which", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(langs), BUCKETS + len(SCRIPTS) + 1), np.int64)
        for b in batches:
            which = b.column(0).to_pylist()
            for first, texts in text_parts(b.column(1), 1_000_000):
                for k, t in zip(which[first:], texts):
                    seen = Counter(t.lower().split())
                    times = np.fromiter(seen.values(), np.int64, len(seen))
                    bucket, owner, script = features(list(seen))
                    np.add.at(table[k], bucket, times[owner])
                    real = script >= 0
                    np.add.at(table[k], BUCKETS + script[real], times[real])
        k, at = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(at, pa.int32()), pa.array(table[k, at])], names=["which", "at", "n"])

    table = np.zeros((len(langs), BUCKETS + len(SCRIPTS) + 1))
    for r in in_batches(sample, count, "which int, at int, n long").groupBy("which", "at").agg(F.sum("n")).collect():
        table[r[0], r[1]] = r[2]
    counts, scripts = table[:, :BUCKETS], table[:, BUCKETS:]
    logp = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    uses = scripts >= 0.01 * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return LanguageModel(langs, logp.astype(np.float32), uses)


def viterbi(scores: np.ndarray, numbers: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word of many texts, which advance by a word together.

    ``scores[numbers]`` are the word scores of the texts one after another, ``counts`` their
    words. A change of language costs ``penalty``.
    """
    langs = scores.shape[1]
    order = np.argsort(-counts, kind="stable")
    begin = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    longest = int(sizes[0]) if len(sizes) else 0
    kind = np.min_scalar_type(langs)
    back = np.empty((len(numbers), langs), kind)
    own = np.arange(langs, dtype=kind)
    value = np.zeros((len(sizes), langs), np.float32)
    active = np.searchsorted(-sizes, -np.arange(longest), "left")
    for t in range(longest):
        n = active[t]
        at = begin[:n] + t
        v = value[:n]
        best = v.argmax(axis=1)
        change = v[np.arange(n), best][:, None] - penalty
        stay = v >= change
        back[at] = np.where(stay, own, best[:, None].astype(kind))
        value[:n] = np.where(stay, v, change) + scores[numbers[at]]
    state = value.argmax(axis=1)
    labels = np.empty(len(numbers), kind)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        labels[at] = state[:n]
        state[:n] = back[at, state[:n]]
    return labels


def spans(labels: np.ndarray) -> list[tuple[int, int, int]]:
    """(first word, past word, language) of each run of equal labels."""
    edges = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1], True]) if len(labels) else np.zeros(1, int)
    return [(int(a), int(b), int(labels[a])) for a, b in zip(edges, edges[1:])]


def language_id(docs: DataFrame, model: LanguageModel, penalty: float = 6.0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Label the language of every whole text and of its spans.

    Returns key, lang_pred, score (share of the words with letters that bear that label, 0 to 1)
    and spans (begin and end word, language). The language with most labelled words wins, of
    equal ones the first by name. Null texts and texts without letters are ``und`` with score 0
    and no spans; a null key stays null; repeated rows are labelled each; a very long text is
    labelled whole, word by word; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.langs, UNKNOWN], dtype=object)
        ids = WordIds(m.describe, len(m.langs) + 1, most=REMEMBERED)
        for b in batches:
            for first, texts in text_parts(b.column(1), 2_000_000 // max(1, len(m.langs) // 4)):
                ids.tidy()
                pieces = [ids.of([t.lower().split() for t in texts[i : i + 300]]) for i in range(0, len(texts), 300)]
                numbers, counts = (np.concatenate(x) for x in zip(*pieces))
                owner = np.repeat(np.arange(len(texts)), counts)
                has = ids.rows[numbers, -1] > 0
                lettered = np.bincount(owner[has], minlength=len(texts))
                pred, score = np.full(len(texts), len(m.langs)), np.zeros(len(texts))
                found: list = [[]] * len(texts)
                if m.langs:
                    labels = viterbi(np.ascontiguousarray(ids.rows[:, :-1]), numbers, counts, penalty)
                    tally = np.bincount(owner[has] * len(m.langs) + labels[has], minlength=len(texts) * len(m.langs)).reshape(len(texts), -1)
                    some = lettered > 0
                    pred[some] = tally.argmax(axis=1)[some]
                    score[some] = tally.max(axis=1)[some] / lettered[some]
                    begins = np.cumsum(counts) - counts
                    found = [[{"begin": x, "end": y, "lang": m.langs[k]} for x, y, k in spans(labels[s : s + n])] if ok else [] for s, n, ok in zip(begins, counts, some)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)), pa.array(names[pred].tolist(), pa.string()), pa.array(score), pa.array(found, pa.list_(span))],
                    names=["k", "lang_pred", "score", "spans"],
                )

    out = in_batches(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), label, f"k {kind}, lang_pred string, score double, spans array<struct<begin:int,end:int,lang:string>>")
    return out.withColumnRenamed("k", key)


def held_out(key: str = "doc_id", fold: int = 4):
    """Whether a document is never learned from; false for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % fold == 2, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from three quarters of the labels."""
    docs = read(spark, sf_dir, "documents")
    model = train(docs.where(~held_out() & F.col("doc_id").isNotNull()))
    found = language_id(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


QUERIES = {"op8_language_id": op8_language_id}
ORACLE: dict[str, str] = {}
