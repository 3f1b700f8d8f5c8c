"""A task's dictionary of text pieces, so that equal pieces are encoded once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np


class Dictionary:
    """Pieces met so far by number, with their ids laid end to end.

    ``number[piece]`` numbers a piece at its first use. ``encode`` gives for a list of pieces all ids end to
    end, and how many each piece has.
    """

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.number: defaultdict = defaultdict(count().__next__)
        self.ids = np.zeros(0, np.int32)
        self.start = np.zeros(1, np.int64)

    def learn(self) -> None:
        """Encode the pieces that are new."""
        ids, sizes = self.encode(list(self.number)[len(self.start) - 1 :])
        self.start = np.r_[self.start, self.start[-1] + np.cumsum(sizes)]
        self.ids = np.r_[self.ids, ids]

    def encoded(self, pieces: np.ndarray) -> np.ndarray:
        at = self.start[pieces]
        return self.ids[spread(at, self.start[pieces + 1] - at)]


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every run, run after run."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


def sliced(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items that together are no larger than ``most``, or one item."""
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)
