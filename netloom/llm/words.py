"""Encoding of whole texts through a table of the distinct segments seen so far.

Where no token of a tokenizer crosses the border between two segments, the
ids of a text are the ids of its segments in order.  A text repeats most of
its segments, so each is encoded once and texts are put together by array
look-ups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np

#: Segments, and characters of them, held before a table starts anew; this bounds a worker's memory.
TABLE_SEGMENTS, TABLE_CHARS = 400_000, 16_000_000
#: Characters of text put together at a time.
BLOCK_CHARS = 1_000_000


class IdLists:
    """Numbered strings, each with a list of ids, in flat arrays."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.at = _Numbers(self.new)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def numbers(self, lists: list[list[str]]) -> np.ndarray:
        """The number of each string of all lists; unknown ones get the next numbers and are noted in ``new``."""
        return np.fromiter(map(self.at.__getitem__, chain.from_iterable(lists)), np.int64, sum(map(len, lists)))

    def learn(self, flat: np.ndarray, length: np.ndarray) -> None:
        """The ids of all strings in ``new``, in their order."""
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, flat.astype(np.int32)])
        self.new.clear()

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings numbered ``which`` one after the other, and the number of ids of each."""
        length = self.length[which]
        end = np.cumsum(length)
        take = np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[which] - (end - length), length)
        return self.ids[take], length


class _Numbers(dict):
    def __init__(self, new: list[str]):
        super().__init__()
        self.new, self.chars = new, 0

    def __missing__(self, string: str) -> int:
        number = self[string] = len(self)
        self.new.append(string)
        self.chars += len(string)
        return number


class SegmentTable:
    """ids of texts from ``split`` (text to segments) and ``encode`` (segments to flat ids and lengths).

    With ``limit`` 0 nothing is held from one block of texts to the next.
    """

    def __init__(self, split: Callable[[str], list[str]], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = TABLE_SEGMENTS, block_chars: int = BLOCK_CHARS):
        self.split, self.encode, self.limit, self.block_chars, self.lists = split, encode, limit, block_chars, IdLists()

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self.split(t) for t in texts]
        if len(self.lists.at) > self.limit or self.lists.at.chars > TABLE_CHARS:
            self.lists = IdLists()
        which = self.lists.numbers(split)
        if self.lists.new:
            self.lists.learn(*self.encode(self.lists.new))
        ids, length = self.lists.gather(which)
        bounds = np.concatenate([[0], np.cumsum(length)])[np.cumsum([0, *map(len, split)])]
        return ids, bounds

    def blocks(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(index of the first text, ids of a block of texts, bounds of each text in them); null is empty."""
        first, chars = 0, 0
        for k, t in enumerate(texts):
            chars += len(t or "") + 1
            if chars >= self.block_chars or k + 1 == len(texts):
                yield first, *self._block([t or "" for t in texts[first : k + 1]])
                first, chars = k + 1, 0
