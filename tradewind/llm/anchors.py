"""Sampled positions that equal windows have in common.

A window of ``size`` items names one of its ``grams``-long stretches, the one with the smallest hash (the
first of them). Equal windows name the same stretch, wherever they stand, so that windows with
equal neighbours can be found by comparing the few named positions, the anchors, instead of all.

Each anchor stands for the windows that name it, which begin at neighbouring places. ``key`` is the
hash of its stretch; ``context`` is that of all items of its windows and of their places around it. Windows
of anchors with different keys differ; anchors with equal key and context have equal windows.
"""

from __future__ import annotations

import numpy as np

from tradewind.llm.textscan import BASE, mix, powers

#: Positions within a slice of a scan are kept in this many bits while the smallest hash is looked for.
PLACE_BITS = 26


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    n = len(x) - width + 1
    filler = np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)
    blocks = np.concatenate([x, filler]).reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


class Anchors:
    """The anchors of a row of items that texts divide at ``bounds``.

    ``hashes(begins, ends)`` gives a 64-bit hash of any stretch.
    """

    def __init__(self, n: int, bounds: np.ndarray, hashes, size: int, grams: int):
        empty = np.empty(0, np.int64)
        self.place = self.first = self.last = self.text = empty
        self.key = self.context = np.empty(0, np.uint64)
        if n < size:
            return
        at = np.arange(n - grams + 1)
        gram = mix(hashes(at, at + grams))
        named = self._named(gram, size - grams + 1)
        # Windows that go beyond their text are none.
        ends = np.repeat(bounds[1:], np.diff(bounds))[: len(named)]
        begin = np.flatnonzero(np.arange(len(named)) + size <= ends)
        if not len(begin):
            return
        named = named[begin]
        new = np.ones(len(named), bool)
        new[1:] = (named[1:] != named[:-1]) | (begin[1:] != begin[:-1] + 1)
        starts = np.flatnonzero(new)
        self.place = named[starts]
        self.first = begin[starts]
        self.last = begin[np.append(starts[1:] - 1, len(begin) - 1)]
        self.text = np.searchsorted(bounds, self.first, "right") - 1
        self.key = gram[self.place]
        around = ((self.place - self.first) * (size + 1) + self.last - self.first).astype(np.uint64)
        self.context = mix(hashes(self.first, self.last + size) + mix(around + np.uint64(1)))

    @staticmethod
    def _named(gram: np.ndarray, width: int) -> np.ndarray:
        """Per window of ``width`` stretches, the place of the one that it names.

        Taken in slices, in which a place fits its bits; windows at a slice's end begin the next one.
        """
        low, found = np.uint64((1 << PLACE_BITS) - 1), []
        step = (1 << PLACE_BITS) - width + 1
        for start in range(0, len(gram) - width + 1, step):
            part = gram[start : start + step + width - 1]
            packed = (part & ~low) | np.arange(len(part), dtype=np.uint64)
            found.append((sliding_minimum(packed, width) & low).astype(np.int64) + start)
        return np.concatenate(found)


def stretch_hashes(items: np.ndarray):
    """Hashes of stretches of 64-bit items."""
    from tradewind.llm.textscan import INVERSE

    sums = np.zeros(len(items) + 1, np.uint64)
    np.cumsum(items * powers(BASE, len(items))[: len(items)], out=sums[1:])
    back = powers(INVERSE, len(items) + 1)
    return lambda begins, ends: (sums[ends] - sums[begins]) * back[begins]
