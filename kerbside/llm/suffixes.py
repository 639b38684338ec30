"""Sorting of equally long windows of text by hashed comparison, in numpy.

Prefix polynomial hashes give the hash of any substring in constant time. The longest common
extension of two windows is found by binary search over its length, so one comparison takes a
logarithmic number of hash comparisons and one byte. A bottom-up mergesort makes all
comparisons of a step at once. Neighbours that the hashes call equal are compared byte by
byte; where they differ, their segment is sorted again by its bytes.
"""

from __future__ import annotations

import numpy as np

#: The multiplier of the polynomial, odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(200).integers(0, 1 << 64, 256, dtype=np.uint64)
#: Bytes of windows compared at once.
VERIFIED = 1 << 22


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), np.uint64(base))
    out[0] = 1
    return np.cumprod(out)


def mixed(h: np.ndarray) -> np.ndarray:
    """The hashes with all bits stirred, in place."""
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    return h


class Hashed:
    """A buffer and the prefix hashes of its polynomial."""

    def __init__(self, buffer: np.ndarray, base: int = BASE, values: np.ndarray | None = None):
        self.buffer = buffer
        self.power = powers(base, len(buffer) + 1)
        self.prefix = np.zeros(len(buffer) + 1, np.uint64)
        letters = (_BYTES if values is None else values)[buffer]
        np.cumsum(letters * self.power[:-1], out=self.prefix[1:])
        # The eight bytes from each place on, as one number.
        self.first = np.ndarray(max(0, len(buffer) - 7), ">u8", np.ascontiguousarray(buffer), strides=(1,))

    def grams(self, k: int, base: int = BASE) -> np.ndarray:
        """A mixed hash of every substring of k bytes."""
        n = len(self.buffer) - k + 1
        h = (self.prefix[k:] - self.prefix[:-k]) * powers(pow(base, -1, 1 << 64), n)
        return mixed(h)

    def same(self, a: np.ndarray, b: np.ndarray, n) -> np.ndarray:
        """Whether the n bytes from a and from b have equal hashes."""
        left = (self.prefix[a + n] - self.prefix[a]) * self.power[b]
        return left == (self.prefix[b + n] - self.prefix[b]) * self.power[a]

    def extension(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """The longest common extension of a and b, at most ``most`` bytes, by binary search."""
        low = np.full(len(a), most)
        unlike = np.flatnonzero(~self.same(a, b, most))
        x, y = a[unlike], b[unlike]
        of_x, of_y, by_x, by_y = self.prefix[x], self.prefix[y], self.power[y], self.power[x]
        least, high = np.zeros(len(x), np.int64), np.full(len(x), most - 1)
        for _ in range(most.bit_length()):
            middle = (least + high + 1) // 2
            same = (self.prefix[x + middle] - of_x) * by_x == (self.prefix[y + middle] - of_y) * by_y
            least, high = np.where(same, middle, least), np.where(same, high, middle - 1)
        low[unlike] = least
        return low

    def before(self, a: np.ndarray, b: np.ndarray, size: int, or_same: np.ndarray) -> np.ndarray:
        """Whether window a sorts before window b, or is the same where that counts."""
        out = or_same.copy()
        rest = np.arange(len(a))
        if size >= 8:  # most differ in their first bytes
            x, y = self.first[a].astype(np.uint64), self.first[b].astype(np.uint64)
            out, rest = np.where(x == y, out, x < y), np.flatnonzero(x == y)
        common = self.extension(a[rest], b[rest], size)
        rest, common = rest[common < size], common[common < size]
        out[rest] = self.buffer[a[rest] + common] < self.buffer[b[rest] + common]
        return out


def merge_sort(text: Hashed, at: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """``at`` with each segment sorted by its windows. ``begin`` and ``end``: of each place's segment."""
    at, place = at.copy(), np.arange(len(at))
    width = 1
    while True:
        busy = np.flatnonzero(end - begin > width)
        if not busy.size:
            return at
        b, e, i = begin[busy], end[busy], place[busy] - begin[busy]
        run = i // width
        other = np.minimum(b + (run ^ 1) * width, e)
        low, high = other.copy(), np.minimum(other + width, e)
        right = run % 2 == 1
        open_ = np.flatnonzero(low < high)
        while open_.size:
            middle = (low[open_] + high[open_]) // 2
            less = text.before(at[middle], at[busy[open_]], size, right[open_])
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < high[open_]]
        target = b + (run // 2) * 2 * width + i % width + low - other
        moved = at.copy()
        moved[target] = at[busy]
        at = moved
        width *= 2


def repeated_windows(text: Hashed, at: np.ndarray, segment: np.ndarray, size: int) -> np.ndarray:
    """Whether each window equals another one of its segment. ``segment`` ascends."""
    out = np.zeros(len(at), bool)
    if not len(at):
        return out
    edges = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1], True])
    many = np.flatnonzero(np.repeat(np.diff(edges) > 1, np.diff(edges)))
    begin, end = (np.repeat(edge, np.diff(edges)) for edge in (edges[:-1], edges[1:]))
    rank = np.empty(len(at), np.int64)
    rank[many] = np.arange(len(many))
    if not len(many):
        return out
    first, last = rank[begin[many]], rank[end[many] - 1] + 1
    places = at[many]
    ordered = merge_sort(text, places, first, last, size)
    same = np.r_[(first[1:] == first[:-1]) & text.same(ordered[1:], ordered[:-1], size), False]
    wrong = []
    pairs = np.flatnonzero(same)
    for some in np.array_split(pairs, max(1, len(pairs) * size // VERIFIED)):
        span = np.arange(size)
        equal = (text.buffer[ordered[some][:, None] + span] == text.buffer[ordered[some + 1][:, None] + span]).all(axis=1)
        wrong.append(first[some[~equal]])
    hit = same | np.r_[False, same[:-1]]
    for segment_begin in np.unique(np.concatenate([np.zeros(0, np.int64), *wrong])):
        inside = np.flatnonzero(first == segment_begin)
        by_bytes = sorted((text.buffer[p : p + size].tobytes(), p) for p in ordered[inside])
        ordered[inside] = [p for _, p in by_bytes]
        keys = [k for k, _ in by_bytes]
        hit[inside] = [k in (keys[i - 1 : i] + keys[i + 1 : i + 2]) for i, k in enumerate(keys)]
    # Each segment's windows stand at different places of the buffer, so the place names the window.
    found = np.lexsort((ordered, first))
    asked = np.lexsort((places, first))
    flags = np.empty(len(many), bool)
    flags[asked] = hit[found]
    out[many] = flags
    return out
