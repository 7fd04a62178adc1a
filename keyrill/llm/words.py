"""Words of UTF-8 texts and their hashes, for whole batches of texts at a time.

A word is a run of bytes other than space and the controls 9 to 13, which is `[^\\x20\\x09-\\x0D]+` over characters.
"""

from __future__ import annotations

import numpy as np
import xxhash

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BLOCK = 1 << 20
_LONG_WORD = 256


def scan(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words as positions in `data`, and for each text the number of its first word."""
    space = _SPACE[data]
    word = ~space
    begins, finishes = word.copy(), word.copy()
    begins[1:] &= space[:-1]
    finishes[:-1] &= space[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = word[edges]
    finishes[edges - 1] = word[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offsets)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class Hasher:
    """64-bit hashes of words and of windows of words; hashers of different seeds are independent."""

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.seed = seed
        self.letters = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base, self.step = (int(x) * 2 + 1 for x in rng.integers(1 << 60, 1 << 62, 2))
        self.powers = self._powers(self.base, _BLOCK + 1)
        self.inverses = self._powers(pow(self.base, -1, 1 << 64), _BLOCK + 1)

    @staticmethod
    def _powers(base: int, count: int) -> np.ndarray:
        powers = np.full(count, base & (2**64 - 1), np.uint64)
        powers[0] = 1
        return np.cumprod(powers, dtype=np.uint64)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each word: a polynomial of its bytes, mixed; XXH64 for long words."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            base = starts[at]
            to = int(np.searchsorted(ends, base + _BLOCK, side="right"))
            if to <= at:  # one word longer than a block
                to = at + 1
            else:
                sums = np.zeros(ends[to - 1] - base + 1, np.uint64)
                terms = self.letters[data[base : ends[to - 1]]]
                terms *= self.powers[: len(terms)]
                np.cumsum(terms, out=sums[1:])
                s, e = starts[at:to] - base, ends[at:to] - base
                out[at:to] = (sums[e] - sums[s]) * self.inverses[s]
            at = to
        for i in np.flatnonzero(ends - starts > _LONG_WORD):
            out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed=self.seed)
        return _mixed(out)

    def windows(self, words: np.ndarray, width: int) -> np.ndarray:
        """The hash of each run of `width` words, by doubling; runs over the end of a text are hashed like any other."""
        if len(words) < width:
            return np.zeros(0, np.uint64)
        total, total_width, part, part_width = None, 0, words, 1
        with np.errstate(over="ignore"):
            rest = width
            while rest:
                if rest & 1:
                    if total is None:
                        total, total_width = part, part_width
                    else:
                        shift = np.uint64(pow(self.step, total_width, 1 << 64))
                        moved = part[total_width:]
                        total = total[: len(moved)] + shift * moved
                        total_width += part_width
                rest >>= 1
                if rest:
                    part = part[: len(part) - part_width] + np.uint64(pow(self.step, part_width, 1 << 64)) * part[part_width:]
                    part_width *= 2
        return _mixed(total[: len(words) - width + 1])


def inside(first: np.ndarray, count: int, width: int) -> np.ndarray:
    """Which windows of `width` words starting at each of `count` words lie within one text."""
    ends = np.repeat(first[1:], np.diff(first))
    starts = np.arange(count)
    return starts + width <= ends
