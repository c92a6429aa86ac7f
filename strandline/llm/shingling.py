"""Word and shingle hashes of whole texts, by numpy over the bytes of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20240229)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_PLACE = _rng.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = np.cumprod(np.full(n - 1, _BASE))
    return out


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of concatenated UTF-8 texts, A-Z folded, and words of each text.

    ``ends`` holds where each text ends. Words are the runs between the bytes 20 and 09-0D.
    """
    inside = ~_SPACE[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    begins = np.r_[0, ends[:-1]]
    begins = begins[begins < len(data)]
    start[begins] = inside[begins]
    first = np.flatnonzero(start)
    if not len(first):
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64)
    at = np.flatnonzero(inside)
    offset = np.searchsorted(at, first)
    size = np.diff(np.r_[offset, len(at)])
    place = np.arange(len(at)) - np.repeat(offset, size)
    hashes = mix(np.add.reduceat(_BYTE[_FOLD[data[at]]] * _powers(int(size.max()))[place], offset) + size.astype(np.uint64))
    upto = np.searchsorted(first, ends)
    return hashes, np.diff(np.r_[0, upto])


def shingle_sets(words: np.ndarray, counts: np.ndarray, n: int = 5) -> list[np.ndarray]:
    """The distinct hashes of ``n`` consecutive words of each text, sorted.

    A text with fewer words has its whole sequence as one shingle; one without words has none.
    """
    total = len(words)
    rolled = np.zeros(total, np.uint64)
    for j in range(min(n, total)):
        rolled[: total - j] += words[j:] * _PLACE[j]
    rolled = mix(rolled)
    out, begin = [], 0
    for many in counts.tolist():
        if many >= n:
            s = np.sort(rolled[begin : begin + many - n + 1])
            if len(s) > 1:
                s = s[np.r_[True, s[1:] != s[:-1]]]
        elif many:
            s = mix(np.sum(words[begin : begin + many] * _PLACE[:many], keepdims=True) + np.uint64(many))
        else:
            s = np.empty(0, np.uint64)
        out.append(s)
        begin += many
    return out


def _cuts(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Rows (first, past) that hold about ``size`` bytes together, one at least."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        past = min(rows, max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1))
        yield row, past
        row = past


def _offsets(column: pa.Array) -> np.ndarray:
    wide = column.type == pa.large_string()
    return np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def text_bytes(column: pa.Array, size: int = 2_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string column (null: empty) into (rows, bytes, ends) of about ``size`` bytes."""
    if not len(column):
        return
    column = column.fill_null("")
    offsets = _offsets(column)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    for row, past in _cuts(offsets, size):
        yield past - row, data[offsets[row] : offsets[past]], offsets[row + 1 : past + 1] - offsets[row]


def text_parts(column: pa.Array, size: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """Cut a string column (null: empty) into (first row, texts) of about ``size`` bytes.

    A batch is cut before its texts become Python strings, so that a worker holds one part's
    strings at a time, whatever the length of the batch.
    """
    if not len(column):
        return
    for row, past in _cuts(_offsets(column), size):
        yield row, [t or "" for t in column.slice(row, past - row).to_pylist()]
