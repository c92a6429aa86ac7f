"""Numbers for words within a Python worker, with a bounded memory."""

from __future__ import annotations

from itertools import chain, islice

import numpy as np

#: Words after which a worker forgets all numbers before its next batch, if it is not told otherwise.
WORDS = 400_000


class _Numbers(dict):
    """A word's number; a new word gets the next one, so that each word is looked up once."""

    def __missing__(self, word) -> int:
        self[word] = number = len(self)
        return number


class WordIds:
    """Numbers words in order of appearance; ``describe(words)`` gives a row for each new one."""

    def __init__(self, describe, width: int, dtype=np.float32, most: int = WORDS):
        self.describe, self.width, self.dtype, self.most = describe, width, dtype, most
        self.forget()

    def forget(self) -> None:
        self.ids = _Numbers()
        self.rows = np.empty((0, self.width), self.dtype)

    def tidy(self) -> None:
        """Forget all numbers if there are many; not between calls whose numbers are used together."""
        if len(self.ids) > self.most:
            self.forget()

    def of(self, texts: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all ``texts`` in one array, and how many each text has.

        ``rows[numbers]`` then holds what ``describe`` says of each word.
        """
        ids, known = self.ids, len(self.ids)
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        numbers = np.fromiter(map(ids.__getitem__, chain.from_iterable(texts)), np.int32, int(counts.sum()))
        if len(ids) > known:
            new = list(islice(reversed(ids), len(ids) - known))[::-1]
            self.rows = np.concatenate([self.rows, np.asarray(self.describe(new), self.dtype).reshape(len(new), self.width)])
        return numbers, counts

