"""Byte-pair encoding by rank-synchronous merging of ragged numpy arrays."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import regex

NO_RANK = np.int64(1) << 40
#: Before the text of a special token, where pieces are kept by their text.
SPECIAL = " "
#: Entries after which a worker's memo of words is emptied, so that its memory is bounded.
MEMO_ENTRIES = 600_000


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordBpe:
    """A byte-level BPE vocabulary with a word-end suffix, lower case, white space dropped.

    ``ids_of(words)`` encodes a batch of pre-tokens at once: their symbols stand in one flat
    array with a start for each sequence. Every round finds the lowest-ranked pair of each
    sequence, merges all its occurrences in all sequences together, and retires sequences
    without a known pair.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pre_tokens = regex.compile(pattern)
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + end] for s in symbols], np.int64)
        self.base = np.int64(max(vocab.values()) + 1)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * int(self.base) + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.counts: dict[str, int] = {}
        self.ids: dict[str, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def ids_of(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat surviving symbols of all non-empty pre-tokens, and how many each has."""
        raw = [w.encode("utf-8") for w in batch]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[data[last]]
        owner = np.repeat(np.arange(len(raw)), sizes)
        rank = np.full(len(symbols), NO_RANK)
        inside = np.flatnonzero(owner[:-1] == owner[1:]) if len(owner) else np.empty(0, np.int64)
        rank[inside] = self._rank(symbols[inside], symbols[inside + 1])
        out_symbols, out_owner = [], []
        while len(symbols):
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[start, len(owner)])
            best = np.repeat(np.minimum.reduceat(rank, start), lengths)
            alive = best < NO_RANK
            if not alive.all():
                out_symbols.append(symbols[~alive])
                out_owner.append(owner[~alive])
                symbols, owner, rank, best = symbols[alive], owner[alive], rank[alive], best[alive]
                if not len(symbols):
                    break
            hit = rank == best
            run = np.flatnonzero(hit[1:] & hit[:-1]) + 1
            for i in run:  # overlapping occurrences such as "aaa": the left one wins
                if hit[i - 1]:
                    hit[i] = False
            at = np.flatnonzero(hit)
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            at = place[at]
            rank[at] = NO_RANK
            for left in (at, at[at > 0] - 1):
                inside = left[left + 1 < len(owner)]
                same = owner[inside] == owner[inside + 1]
                rank[inside[~same]] = NO_RANK
                inside = inside[same]
                rank[inside] = self._rank(symbols[inside], symbols[inside + 1])
        if not out_symbols:
            return np.empty(0, np.int64), np.zeros(len(raw), np.int64)
        symbols, owner = np.concatenate(out_symbols), np.concatenate(out_owner)
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.bincount(owner, minlength=len(raw))

    def chunks(self, text: str) -> list[str]:
        """Folded white-space-free pieces of ``text``; a special token is the mark and its text.

        Special tokens are found before folding. A mark of its own keeps them apart from pieces
        that only become equal to one by folding; a blank cannot begin any other piece.
        """
        if self.special_split is not None and "<|" in text:
            out = []
            for i, part in enumerate(self.special_split.split(text)):
                out += [f"{SPECIAL}{part}"] if i % 2 else self._plain(part)
            return out
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # split() takes these for white space
            return [w for w in regex.split(r"[\x09-\x0d\x20\x85\xa0  -     　]+", text) if w]
        return text.split()

    def _encode_new(self, new: set[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Ids of all ``new`` chunks in one flat array, and how many each has."""
        chunks = list(new)
        pieces = [[c] if c[0] == SPECIAL else self.pre_tokens.findall(c) for c in chunks]
        plain = list({p for c, ps in zip(chunks, pieces) if c[0] != SPECIAL for p in ps})
        special = [c for c in chunks if c[0] == SPECIAL]
        distinct = {p: i for i, p in enumerate([*plain, *special])}
        flat, sizes = self.ids_of(plain) if plain else (np.empty(0, np.int64), np.empty(0, np.int64))
        flat = np.r_[flat, np.array([self.specials[c[1:]] for c in special], np.int64)]
        sizes = np.r_[sizes, np.ones(len(special), np.int64)]
        starts = np.cumsum(sizes) - sizes
        which = np.fromiter((distinct[p] for ps in pieces for p in ps), np.int64)
        many = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = sizes[which]
        at = np.repeat(starts[which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner = np.repeat(np.arange(len(chunks)), many)
        return chunks, flat[at], np.bincount(owner, weights=n, minlength=len(chunks)).astype(np.int64)

    def count_texts(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text."""
        split = [self.chunks(t) for t in texts]
        if len(self.counts) > MEMO_ENTRIES:
            self.counts.clear()
        known = self.counts
        new = {w for ws in split for w in ws if w not in known}
        if new:
            chunks, _, sizes = self._encode_new(new)
            known.update(zip(chunks, sizes.tolist()))
        return [sum(map(known.__getitem__, ws)) for ws in split]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit numbers."""
        split = [self.chunks(t) for t in texts]
        if len(self.ids) > MEMO_ENTRIES:
            self.ids.clear()
        known = self.ids
        new = {w for ws in split for w in ws if w not in known}
        if new:
            chunks, flat, sizes = self._encode_new(new)
            data, ends = flat.astype("<u4").tobytes(), np.cumsum(sizes) * 4
            begin = 0
            for c, end in zip(chunks, ends.tolist()):
                known[c] = data[begin:end]
                begin = end
        return [b"".join(map(known.__getitem__, ws)) for ws in split]


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """The vocabulary at ``path``, read once in each Python worker."""
    return WordBpe(path)

