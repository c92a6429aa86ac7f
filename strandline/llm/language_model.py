"""Operator 6: a gated recurrent language model with a class-factored output layer."""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import shingling
from strandline.llm.common import in_batches, read, stored
from strandline.llm.language_id import held_out
from strandline.llm.shingling import text_parts
from strandline.llm.word_ids import WordIds

#: Words with an output of their own, in so many classes; classes of all other words, by their last letters.
HEAD_CLASSES, IN_CLASS, TAIL = 24, 32, 32
HEAD = HEAD_CLASSES * IN_CLASS
HIDDEN, LANES, WINDOW = 24, 256, 64
#: Words whose counts are broadcast; counts of rarer words are joined.
KNOWN = 1 << 17
DISCOUNT = 0.75
#: The weights are fitted on every training document: on one in ``SHARE``, that is on all, of its
#: stretches of about so many bytes, dealt to ``ROUNDS`` rounds of training.
STRETCH, SHARE, ROUNDS = 16_000, 1, 4
#: Symbols that a task learns from, or scores, side by side: enough to fill all lanes beside a long document.
LESSON, SCORED = 640_000, 2_000_000
#: Symbols: head words, tail classes, then the edge of a document.
EDGE = HEAD + TAIL
SYMBOLS, CLASSES = EDGE + 1, HEAD_CLASSES + TAIL + 1


def split(text: str) -> list[bytes]:
    """Words of a text: A-Z folded, separated by the bytes 20 and 09-0D."""
    return text.encode("utf-8", "replace").lower().split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of distinct words."""
    data = np.frombuffer(b" ".join(words), np.uint8)
    return shingling.word_hashes(data, np.array([len(data)]))[0].view(np.int64)


def tail_classes(words: list[bytes]) -> np.ndarray:
    """The class of each word by its last two bytes."""
    last = np.array([(w[-1] << 8) | (w[-2] if len(w) > 1 else 0) for w in words], np.uint64)
    return (shingling.mix(last + np.uint64(1)) % np.uint64(TAIL)).astype(np.int64)


class Network:
    """The weights, and a forward and backward pass through a window of many lanes."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        w = lambda *shape: (rng.standard_normal(shape) * 0.12).astype(np.float32)
        self.p = {
            "x": w(SYMBOLS, 3 * HIDDEN), "u": w(HIDDEN, 3 * HIDDEN), "bn": np.zeros(HIDDEN, np.float32),
            "c": w(HIDDEN, CLASSES), "cb": np.zeros(CLASSES, np.float32),
            "o": w(HEAD_CLASSES, HIDDEN, IN_CLASS), "ob": np.zeros((HEAD_CLASSES, IN_CLASS), np.float32),
        }
        self.p["x"][:, :HIDDEN] += 1.0  # at first, state is kept

    def begin_at(self, counts: np.ndarray) -> None:
        """Let the output biases say how often each symbol occurs, before anything is learned."""
        c = counts.astype(np.float64) + 0.5
        words = c[:HEAD].reshape(HEAD_CLASSES, IN_CLASS)
        kinds = np.r_[words.sum(axis=1), c[HEAD:]]
        self.p["cb"] = np.log(kinds / kinds.sum()).astype(np.float32)
        self.p["ob"] = np.log(words / words.sum(axis=1, keepdims=True)).astype(np.float32)

    def to_bytes(self) -> bytes:
        """All weights as 32-bit floats."""
        return b"".join(x.astype("<f4").tobytes() for x in self.p.values())

    def set_from(self, flat: np.ndarray) -> None:
        """Take the weights that :meth:`to_bytes` has written."""
        at = 0
        for k, x in self.p.items():
            self.p[k] = flat[at : at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size

    def run(self, symbols: np.ndarray, state: np.ndarray, tape: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States after each of (steps x lanes) symbols, from ``state``; an edge symbol starts from nothing.

        Within, lanes come last, so that every gate is one piece of memory. ``tape`` gets, in
        that order, the states before each symbol, the gates, and what the reset gate lets through.
        """
        p, n, (steps, lanes) = self.p, HIDDEN, symbols.shape
        x, u = p["x"].copy(), p["u"].T.copy()
        x[:, : 2 * n] *= -1  # a sigmoid is 1 / (1 + exp(-x))
        u[: 2 * n] *= -1
        fresh = (symbols != EDGE).astype(np.float32)
        cut = ~fresh.all(axis=1)
        bias = p["bn"][:, None]
        out = np.empty((steps, n, lanes), np.float32)
        gates = np.empty((steps if tape is not None else 1, 3 * n, lanes), x.dtype)
        before, inners = (np.empty_like(out), np.empty_like(out)) if tape is not None else (None, None)
        h = state.T
        with np.errstate(over="ignore"):
            for t in range(steps):
                if cut[t]:
                    h = h * fresh[t]
                a, gate = u @ h, gates[t if tape is not None else 0]
                inner = a[2 * n :]
                inner += bias
                if tape is not None:
                    before[t], inners[t] = h, inner
                own = x.take(symbols[t], axis=0).T
                zr, new = gate[: 2 * n], gate[2 * n :]
                np.add(a[: 2 * n], own[: 2 * n], out=zr)
                np.exp(zr, out=zr)
                zr += 1
                np.divide(1, zr, out=zr)
                inner *= zr[n:]
                np.add(inner, own[2 * n :], out=new)
                np.tanh(new, out=new)
                after = out[t]
                np.subtract(h, new, out=after)
                after *= zr[:n]
                after += new
                h = after
        if tape is not None:
            tape += [before, gates, inners]
        return out.transpose(0, 2, 1), h.T

    def log_probs(self, h: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list]:
        """Natural log P(class) + log P(word | class) of each target after a state (rows of ``h``), and what the backward pass needs."""
        p = self.p
        # states lie between -1 and 1: with weights like these, no exponential can overflow, nor all of them vanish
        small = lambda w, b: float(np.abs(w).sum(axis=-2).max() + np.abs(b).max()) < 60
        small_kinds, small_words = small(p["c"], p["cb"]), small(p["o"], p["ob"])
        kind = np.where(target < HEAD, target // IN_CLASS, target - HEAD + HEAD_CLASSES)
        logits = p["c"].T @ h.T
        logits += p["cb"][:, None]
        if not small_kinds:
            logits -= logits.max(axis=0)
        out = logits[kind, np.arange(len(h))]
        e = np.exp(logits, out=logits)
        total = e.sum(axis=0)
        out -= np.log(total)
        inside = []
        head = np.flatnonzero(target < HEAD)
        kinds = kind[head].astype(np.int16)  # short numbers are sorted by their digits
        order = np.argsort(kinds, kind="stable")
        head, edges = head[order], np.searchsorted(kinds[order], np.arange(HEAD_CLASSES + 1))
        for k in range(HEAD_CLASSES):
            at = head[edges[k] : edges[k + 1]]
            if not len(at):
                continue
            mine = h[at]
            x = p["o"][k].T @ mine.T
            x += p["ob"][k][:, None]
            if not small_words:
                x -= x.max(axis=0)
            which = target[at] % IN_CLASS
            own = x[which, np.arange(len(at))]
            ex = np.exp(x, out=x)
            s = ex.sum(axis=0)
            out[at] += own - np.log(s)
            inside.append((k, at, which, ex, s, mine))
        return out, [kind, e, total, inside]

    def gradients(self, symbols: np.ndarray, target: np.ndarray, weight: np.ndarray, state: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the mean loss over a window (truncated backpropagation), and the state after it."""
        p, n, (steps, lanes) = self.p, HIDDEN, symbols.shape
        tape: list = []
        hs, after = self.run(symbols, state, tape)
        before, gates, inners = tape
        rows = lambda x: x.transpose(0, 2, 1).reshape(steps * lanes, -1)
        h = hs.reshape(-1, n)
        w = (weight.ravel() / max(1.0, float(weight.sum()))).astype(np.float32)
        _, (kind, probs, total, inside) = self.log_probs(h, target.ravel())
        g = {k: np.zeros_like(v) for k, v in p.items() if k in ("x", "o", "ob")}
        probs *= w / total
        probs[kind, np.arange(len(h))] -= w
        g["c"], g["cb"] = h.T @ probs.T, probs.sum(axis=1)
        of_words = np.zeros_like(h)
        for k, at, which, q, s, mine in inside:
            q *= w[at] / s
            q[which, np.arange(len(at))] -= w[at]
            g["o"][k], g["ob"][k] = mine.T @ q.T, q.sum(axis=1)
            of_words[at] = q.T @ p["o"][k].T
        dh = (p["c"] @ probs).reshape(n, steps, lanes).transpose(1, 0, 2) + of_words.reshape(steps, lanes, n).transpose(0, 2, 1)
        dh = np.ascontiguousarray(dh)
        z, r, new = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
        to_new, to_z, to_r = (1 - z) * (1 - new * new), (before - new) * z * (1 - z), inners * r * (1 - r)
        fresh = (symbols != EDGE).astype(np.float32)
        cut = ~fresh.all(axis=1)
        back = np.zeros((n, lanes), np.float32)
        da, dnew = np.empty_like(gates), np.empty((steps, n, lanes), gates.dtype)
        for t in range(steps - 1, -1, -1):
            d = dh[t]
            d += back
            np.multiply(d, to_new[t], out=dnew[t])
            np.multiply(d, to_z[t], out=da[t, :n])
            np.multiply(dnew[t], to_r[t], out=da[t, n : 2 * n])
            np.multiply(dnew[t], r[t], out=da[t, 2 * n :])
            back = p["u"] @ da[t]
            d *= z[t]
            back += d
            if cut[t]:
                back *= fresh[t]
        flat = rows(da)
        g["u"], g["bn"] = rows(before).T @ flat, da[:, 2 * n :].sum(axis=(0, 2))
        da[:, 2 * n :] = dnew
        order = np.argsort(symbols.ravel().astype(np.int16), kind="stable")
        met = symbols.ravel()[order]
        begins = np.flatnonzero(np.r_[True, met[1:] != met[:-1]])
        g["x"][met[begins]] = np.add.reduceat(rows(da)[order], begins, axis=0)
        return g, after


class Adam:
    """Steps of a network along its gradients, each of bounded length."""

    def __init__(self, network: Network, rate: float):
        self.network, self.rate, self.t = network, rate, 0
        self.m = {k: np.zeros_like(x) for k, x in network.p.items()}
        self.v = {k: np.zeros_like(x) for k, x in network.p.items()}

    def learn(self, documents: list[np.ndarray], whole: list[tuple[bool, bool]] | None = None, lanes: int = 128, steps: int = 32) -> int:
        """One pass over documents in windows of ``steps`` symbols, states carried from window to window; gives the symbols."""
        symbols, target, owner, _ = lanes_of(documents, lanes, whole)
        state = np.zeros((symbols.shape[1], HIDDEN), np.float32)
        for a in range(0, len(symbols), steps):
            weight = (owner[a : a + steps] >= 0).astype(np.float32)
            g, state = self.network.gradients(symbols[a : a + steps], target[a : a + steps], weight, state)
            size = np.sqrt(sum(float(np.vdot(x, x)) for x in g.values()))
            self.t += 1
            step = self.rate * min(1.0, 1.0 / max(size, 1e-9))
            first, second = step / (1 - 0.9**self.t), 1 / (1 - 0.99**self.t)
            for k, x in g.items():
                m, v = self.m[k], self.v[k]
                m *= 0.9
                m += 0.1 * x
                x *= x
                x *= 0.01
                v *= 0.99
                v += x
                np.multiply(v, second, out=x)
                np.sqrt(x, out=x)
                x += 1e-6
                np.divide(m, x, out=x)
                x *= first
                self.network.p[k] -= x
        return int((owner >= 0).sum())


def lanes_of(documents: list[np.ndarray], lanes: int, whole: list[tuple[bool, bool]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Lay documents one after another into lanes of nearly equal length, long ones first.

    ``whole`` says whether each one has its true beginning and its true end; a first word or an
    end that is none is not to be predicted. There are only so many lanes that a long document
    fills the others' length, so that the arrays are at most about three times the input.

    Returns inputs, targets and document numbers (-1: not to be predicted) as (steps x lanes), and the lanes.
    """
    sizes = [len(d) + 1 for d in documents]
    lanes = max(1, min(lanes, len(documents), sum(sizes) // 64 + 1, sum(sizes) // max(sizes) + 1))
    free = [(0, i) for i in range(lanes)]
    content: list[list[int]] = [[] for _ in range(lanes)]
    for i in sorted(range(len(documents)), key=lambda i: -sizes[i]):
        used, lane = heapq.heappop(free)
        content[lane].append(i)
        heapq.heappush(free, (used + sizes[i], lane))
    length = max(u for u, _ in free)
    symbols = np.full((length, lanes), EDGE, np.int32)
    target = np.full((length, lanes), EDGE, np.int32)
    owner = np.full((length, lanes), -1, np.int32)
    for lane, docs in enumerate(content):
        at = 0
        for i in docs:
            n = len(documents[i])
            symbols[at + 1 : at + n + 1, lane] = documents[i]
            target[at : at + n, lane] = documents[i]
            first, last = whole[i] if whole else (True, True)
            owner[at + (not first) : at + n + last, lane] = i
            at += n + 1
    return symbols, target, owner, lanes


_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def stretches(text: bytes) -> Iterator[tuple[int, bool, bool, bytes]]:
    """The stretches of a folded text to learn from: (round, is its beginning, is its end, words).

    One that is not the beginning starts with the last word before it, which is not to be
    predicted there, so that every word and the end are predicted once.
    """
    many, h = max(1, len(text) // STRETCH), zlib.crc32(text)
    begin = lambda i: 0 if i == 0 else (m.end() if (m := _SPACE.search(text, i * STRETCH)) else len(text))
    for j in range(-(-many // SHARE)):
        i = (h + j * SHARE) % many
        last, past = i + 1 == many, begin(i)
        if i and not last and begin(i + 1) == past:  # within one long word
            yield (h + j) % ROUNDS, False, False, b""
            continue
        while past and _SPACE.match(text, past - 1):
            past -= 1
        while past and not _SPACE.match(text, past - 1):
            past -= 1
        first = not text[past : begin(i)].strip()
        yield (h + j) % ROUNDS, first, last, text[past : len(text) if last else begin(i + 1)]


@dataclass
class Model:
    """Sorted hashes of frequent words with their counts, the head words' symbols, and the network."""

    hashes: np.ndarray
    counts: np.ndarray
    head: np.ndarray
    network: Network

    def describe(self, words: list[bytes]) -> np.ndarray:
        """Symbol, count (-1: not among the frequent), hash and tail class of each word."""
        h = hashes_of(words)
        out = np.empty((len(words), 4), np.int64)
        out[:, 2], out[:, 3] = h, tail_classes(words)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            known = self.hashes[at] == h
            head = np.where(known, self.head[at], -1)
            out[:, 1] = np.where(known, self.counts[at], -1)
        else:
            head = np.full(len(words), -1)
            out[:, 1] = -1
        out[:, 0] = np.where(head >= 0, head, HEAD + out[:, 3])
        return out

    def score(self, documents: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each document's classes and head words, its end included."""
        symbols, target, owner, _ = lanes_of(documents, LANES)
        total = np.zeros(len(documents))
        state = np.zeros((symbols.shape[1], HIDDEN), np.float32)
        for a in range(0, len(symbols), WINDOW):
            hs, state = self.network.run(symbols[a : a + WINDOW], state)
            own = owner[a : a + WINDOW].ravel()
            real = np.flatnonzero(own >= 0)
            logp, _ = self.network.log_probs(hs.reshape(-1, HIDDEN)[real], target[a : a + WINDOW].ravel()[real])
            total += np.bincount(own[real], weights=logp, minlength=len(documents))
        return total / np.log(10)


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """h, c, kind: how often each word occurs, by its hash, and its tail class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            for _, texts in text_parts(b.column(0)):
                for t in texts:
                    seen.update(split(t))
            if seen:
                words = list(seen)
                yield pa.RecordBatch.from_arrays([pa.array(hashes_of(words)), pa.array(list(seen.values()), pa.int64()), pa.array(tail_classes(words), pa.int32())], names=["h", "c", "kind"])

    return in_batches(docs.select(F.col(text).alias("t")), count, "h long, c long, kind int").groupBy("h").agg(F.sum("c").alias("c"), F.first("kind").alias("kind"))


def _binaries(symbols: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The symbols of each document, one after another in ``symbols``, as 16-bit numbers."""
    ends = np.r_[0, 2 * np.cumsum(sizes)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(symbols.astype("<i2"))])


def _documents(column: pa.Array) -> list[np.ndarray]:
    """The symbols of each document, from the column that :func:`_binaries` has made."""
    return [np.frombuffer(x.as_py(), "<i2") for x in column]


def in_lots(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches one after another as one, until their ``symbols`` are ``most`` or more."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += pc.sum(pc.binary_length(b.column("symbols"))).as_py() // 2
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def encoded(docs: DataFrame, learn: Column, model: Model, log_mass: np.ndarray, key: str, text: str) -> DataFrame:
    """Each document's symbols and all of its score that the network does not give, and what is to be learned from.

    A row with ``row`` is a document: its tokens, those known, base and rest of its score, and
    hashes and tail classes of its rare words, whose counts are joined. A row with ``round`` is a
    stretch to learn from in that round; a document of one stretch is both in one row.
    """
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model, log_mass))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, log_mass = shared.value
        ids = WordIds(m.describe, 4, np.int64)
        rid = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for b in batches:
            for first, texts in text_parts(b.column(2), 8_000_000):
                ids.tidy()
                learns = b.column(1).slice(first, len(texts)).to_pylist()
                numbers, sizes, lessons, more = [], [], [], []
                for i in range(0, len(texts), 300):
                    folded = [t.encode("utf-8", "replace").lower() for t in texts[i : i + 300]]
                    for x, out in zip(ids.of([f.split() for f in folded]), (numbers, sizes)):
                        out.append(x)
                    for f, own in zip(folded, learns[i : i + 300]):
                        parts = list(stretches(f)) if own else []
                        lessons.append(parts[0][:3] if len(parts) == 1 else (None, None, None))
                        more += parts if len(parts) > 1 else []
                numbers, sizes = np.concatenate(numbers), np.concatenate(sizes)
                more_numbers, more_sizes = ids.of([x[3].split() for x in more])
                rows = ids.rows
                owner = np.repeat(np.arange(len(texts)), sizes)
                symbol, count = rows[numbers, 0], rows[numbers, 1]
                tail = symbol >= HEAD
                known = count > 0
                add = lambda mask, x: np.bincount(owner[mask], weights=x, minlength=len(texts)).astype(float)  # noqa: B023, E731
                seen_tail = tail & known
                score = add(seen_tail, np.log10(count[seen_tail] - DISCOUNT)) - add(tail, log_mass[rows[numbers[tail], 3]])
                base = add(known, np.log10(count[known] + 1.0))
                n_known = np.bincount(owner[known], minlength=len(texts))
                rest = np.flatnonzero(~known)  # their counts are joined
                many = np.bincount(owner[rest], minlength=len(texts))
                lists = [pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many)].astype(np.int32)), pa.array(x)) for x in (rows[numbers[rest], 2], rows[numbers[rest], 3].astype(np.int32))]
                lesson = lambda x: [pa.array(c, t) for c, t in zip(zip(*x), (pa.int32(), pa.bool_(), pa.bool_()))]
                document = [pa.array(np.arange(len(texts), dtype=np.int64) + rid), b.column(0).slice(first, len(texts)), pa.array(sizes + 1), pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(score), *lists]
                names = ["row", "k", "n_tokens", "n_known", "base", "rest", "hs", "kinds", "symbols", "round", "first", "last"]
                yield pa.RecordBatch.from_arrays([*document, _binaries(symbol, sizes), *lesson(lessons)], names=names)
                if more:
                    none = [pa.nulls(len(more), x.type) for x in document]
                    yield pa.RecordBatch.from_arrays([*none, _binaries(rows[more_numbers, 0], more_sizes), *lesson([x[:3] for x in more])], names=names)
                rid += len(texts)

    own = F.coalesce(learn & F.col(key).isNotNull(), F.lit(False))
    schema = f"row long, k {kind}, n_tokens long, n_known long, base double, rest double, hs array<long>, kinds array<int>, symbols binary, round int, first boolean, last boolean"
    return stored(in_batches(docs.select(F.col(key).alias("k"), own.alias("l"), F.col(text).alias("t")), encode, schema), "encoded")


def fit(network: Network, lessons: DataFrame) -> None:
    """Fit the network to all ``lessons`` (round, first, last, symbols): all words and ends to learn from.

    In each round, every task learns from the round's stretches of its part (truncated
    backpropagation from the same weights), and the weights are averaged by the symbols they
    have seen: first in Spark, in about the square root of the number of tasks, so that only so
    many copies reach the driver.
    """
    for number in range(ROUNDS):
        now, rate = lessons.sparkSession.sparkContext.broadcast(network.to_bytes()), 0.01 * 0.6**number

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            net = Network()
            net.set_from(np.frombuffer(now.value, "<f4"))  # noqa: B023
            adam, seen = Adam(net, rate), 0  # noqa: B023
            for b in in_lots(batches, LESSON):
                seen += adam.learn(_documents(b.column("symbols")), list(zip(b.column("first").to_pylist(), b.column("last").to_pylist())))
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([net.to_bytes()], pa.binary())], names=["n", "w"])

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = None, 0
            for b in batches:
                for x, w in zip(b.column(0).to_pylist(), b.column(1)):
                    part = np.frombuffer(w.as_buffer(), "<f4").astype(np.float64) * x
                    total, n = part if total is None else total + part, n + x
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([(total / n).astype("<f4").tobytes()], pa.binary())], names=["n", "w"])

        mine = lessons.where(F.col("round") == number).select("first", "last", "symbols")
        learned = stored(in_batches(mine, learn, "n long, w binary"), "weights")
        many = learned.count()
        if many:
            rows = learned.repartition(max(1, int(many**0.5))).mapInArrow(average, "n long, w binary").collect()
            flat = sum(np.frombuffer(r.w, "<f4").astype(np.float64) * r.n for r in rows) / sum(r.n for r in rows)
            network.set_from(flat)
        now.destroy()


def language_model(docs: DataFrame, learn, key: str = "doc_id", text: str = "text", seed: int = 1) -> DataFrame:
    """Score every whole text by its log10 probability.

    ``learn`` is the condition on a document to learn from. Word counts cover all such
    documents and stay in Spark. The network predicts the class of the next word from all words
    before it; frequent words have a softmax within their class, the others share a tail class
    by their last letters and are chosen within it by their discounted counts, unseen words
    together taking what the discount freed. Documents run side by side in lanes, and the state is
    carried over windows to a document's end, however long it is. The weights are fitted by
    tasks on the whole of every document to learn from (:func:`fit`). Texts are read twice, for
    their counts and for their symbols (:func:`encoded`); all rounds and the scores take the symbols.

    Returns key, n_tokens, n_known, train_tokens, base_score and score. Tokens are words and one
    end; a null or empty text is its end alone; a null key is never learned from; repeated rows
    are scored each; other columns are ignored; an empty table gives an empty result, and
    without documents to learn from all words are unseen.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    train = docs.where(learn & F.col(key).isNotNull())
    counts = stored(word_counts(train, text), "counts")
    ends = train.count()
    size = counts.agg(F.sum("c"), F.count("*")).first()
    tokens, types = (size[0] or 0) + ends, size[1] + (1 if ends else 0)

    top = counts.orderBy(F.col("c").desc(), "h").limit(KNOWN).select("h", "c").toArrow().sort_by([("c", "descending"), ("h", "ascending")])
    h, c = top.column("h").to_numpy(), top.column("c").to_numpy()
    order = np.argsort(h)
    head = np.full(len(h), -1, np.int64)
    head[: min(HEAD, len(h))] = np.arange(min(HEAD, len(h)))
    model = Model(h[order], c[order], head[order], Network(seed))
    heads = spark.createDataFrame([(int(x),) for x in h[:HEAD]], "h long")
    tails = counts.join(F.broadcast(heads), "h", "left_anti").groupBy("kind").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    mass = np.zeros(TAIL), np.zeros(TAIL)
    for r in tails:
        mass[0][r[0]], mass[1][r[0]] = r[1], r[2]
    heads_seen = np.zeros(HEAD)
    heads_seen[: min(HEAD, len(h))] = c[:HEAD]
    model.network.begin_at(np.r_[heads_seen, mass[0], ends])
    ready = encoded(docs, learn, model, np.log10(mass[0] + 1), key, text)
    fit(model.network, ready)
    shared = spark.sparkContext.broadcast(model.network)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        m = Model(none, none, none, shared.value)
        for b in in_lots(batches, SCORED):
            gru = b.column("rest").to_numpy() + m.score(_documents(b.column("symbols")))
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(gru)], names=["row", "k", "n_tokens", "n_known", "base", "gru"])

    whole = ready.where("row is not null")
    made = in_batches(whole.select("row", "k", "n_tokens", "n_known", "base", "rest", "symbols"), score, f"row long, k {kind}, n_tokens long, n_known long, base double, gru double")
    made = stored(made, "scored")
    unseen = spark.createDataFrame([(i, float(np.log10(DISCOUNT * mass[1][i] + 1))) for i in range(TAIL)], "kind int, unseen double")
    rare = whole.select("row", F.inline(F.arrays_zip(F.col("hs").alias("h"), F.col("kinds").alias("kind"))))
    joined = rare.join(counts.select("h", "c"), "h", "left").join(F.broadcast(unseen), "kind")
    sums = joined.groupBy("row").agg(
        F.count("c").alias("more_known"),
        F.sum(F.coalesce(F.log10(F.col("c") + 1.0), F.lit(0.0))).alias("more_base"),
        F.sum(F.coalesce(F.log10(F.col("c") - DISCOUNT), F.col("unseen"))).alias("more_score"),
    )
    zero = lambda c, x: F.coalesce(F.col(c), F.lit(x))
    return made.join(sums, "row", "left").select(
        F.col("k").alias(key), "n_tokens",
        (F.col("n_known") + zero("more_known", 0) + (1 if ends else 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base", 0.0) + float(np.log10(ends + 1)) - F.col("n_tokens") * float(np.log10(tokens + types + 1))).alias("base_score"),
        (F.col("gru") + zero("more_score", 0.0)).alias("score"),
    )


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all documents."""
    docs = read(spark, sf_dir, "documents")
    scored = language_model(docs, ~held_out(fold=7))
    return scored.select("doc_id", held_out(fold=7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op6_language_model": op6_language_model}
ORACLE: dict[str, str] = {}
