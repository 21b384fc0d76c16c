"""Suffix sorting by hash comparison: merge sort whose comparisons binary-search the common extension."""

from __future__ import annotations

import numpy as np

from marketflow.llm.common import PrefixHashes


class Text:
    """Bytes with prefix polynomial hashes; compares slices in logarithmic time, for many pairs at once."""

    def __init__(self, data: np.ndarray):
        self.data, self.hashes = data, PrefixHashes(data)

    def common_right(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length, up to `most`, of the common beginning of the suffixes at a and b."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            same = self.hashes.of(a, a + mid) == self.hashes.of(b, b + mid)
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
        return low

    def common_left(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length, up to `most`, of the common ending of what precedes a and b."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            same = self.hashes.of(a - mid, a) == self.hashes.of(b - mid, b)
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)
        return low

    def before(self, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether the suffix a:a_end sorts before (or as) b:b_end."""
        most = np.minimum(a_end - a, b_end - b)
        n = self.common_right(a, b, most)
        ended = n == most
        last = len(self.data) - 1
        smaller = self.data[np.minimum(a + n, last)] < self.data[np.minimum(b + n, last)]
        sizes = (a_end - a <= b_end - b) if or_equal else (a_end - a < b_end - b)
        return np.where(ended, sizes, smaller)

    def _heads(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first eight bytes of each suffix as one number that sorts like them; ended suffixes are filled with zeros."""
        heads, last = np.zeros(len(start), np.uint64), len(self.data) - 1
        for k in range(8):
            byte = np.where(start + k < end, self.data[np.minimum(start + k, last)], 0)
            heads = (heads << np.uint64(8)) | byte.astype(np.uint64)
        return heads

    def sort(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Order of the suffixes start:end, by merge sort inside groups of equal first bytes.

        All merges of one width are made together: an element's place in a merged run is its own index plus its rank in
        the sibling run, found by binary search.
        """
        heads = self._heads(start, end)
        order = np.argsort(heads, kind="stable")
        if not len(order):
            return order
        new = np.append(True, heads[order[1:]] != heads[order[:-1]])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(order)))
        width = 1
        while (large := size > width).any():
            place = np.flatnonzero(np.repeat(large, size))
            group = np.repeat(first[large], size[large])
            stop = group + np.repeat(size[large], size[large])
            inside = (place - group) % (2 * width)
            left, base = inside < width, place - inside
            # the sibling run of each element, and the element's rank in it
            low = np.where(left, np.minimum(base + width, stop), base)
            high = np.where(left, np.minimum(base + 2 * width, stop), np.minimum(base + width, stop))
            begin = low.copy()
            while len(at := np.flatnonzero(low < high)):
                mid = (low[at] + high[at]) >> 1
                x, y = order[mid], order[place[at]]
                go = np.zeros(len(at), bool)
                for side, or_equal in ((left[at], False), (~left[at], True)):
                    k = np.flatnonzero(side)
                    go[k] = self.before(start[x[k]], end[x[k]], start[y[k]], end[y[k]], or_equal)
                low[at], high[at] = np.where(go, mid + 1, low[at]), np.where(go, high[at], mid)
            merged = order.copy()
            own = np.where(left, inside, inside - width)
            merged[base + own + low - begin] = order[place]
            order, width = merged, 2 * width
        return order
