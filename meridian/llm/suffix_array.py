"""Suffix arrays by induced sorting, and permuted common prefixes, over one shard in numpy.

A suffix is S if it is smaller than the one after it, else L; an S suffix after an L suffix is leftmost-smaller (LMS). The LMS substrings
are sorted by inducing from their first characters and named; where names repeat, the string of names is sorted in turn by the same steps;
from the sorted LMS suffixes all L suffixes, and from these all S suffixes, are induced in one scan each.

Buckets are parts of one array, sized by counts, with a head for each. A scan takes a large bucket by itself, in one step for each repeat of
its own character, and some thousand members of small neighbouring buckets together: strings of names have many of those. Where these
induce one another in long chains, they are scanned one by one.
"""

from __future__ import annotations

from itertools import chain

import numpy as np

#: Members of neighbouring buckets that are scanned together, about, and steps that this may take.
TOGETHER, STEPS = 1 << 12, 12


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is S. A suffix at the end of the string is larger than the empty one, hence L."""
    n = len(s)
    change = s[1:] != s[:-1]
    differs = np.flatnonzero(change)
    if not len(differs):
        return np.zeros(n, bool)
    after = np.concatenate([[0], np.cumsum(change)])
    inside = after < len(differs)
    at = differs[np.minimum(after, len(differs) - 1)]
    return inside & (s[at] < s[np.minimum(at + 1, n - 1)])


class _Scan:
    """One scan through the buckets 0, 1, ..: a suffix whose next one is scanned, and which is ``wanted``, joins the end of its own bucket.

    ``key``: bucket of each suffix; ``fixed``: suffixes that each bucket ends with, by bucket and in the order of the scan.
    """

    def __init__(self, key: np.ndarray, wanted: np.ndarray, fixed: np.ndarray, chars: int):
        self.key, self.fixed, self.chars = key, fixed, chars
        # Bucket of the suffix before each, where it is wanted, else ``chars``: one look-up tells both.
        self.to = np.full(len(key), chars, np.uint16 if chars < 1 << 16 else np.int32)
        self.to[1:] = np.where(wanted[:-1], key[:-1], self.to.dtype.type(chars))
        size = np.bincount(self.to, minlength=chars + 1)[:chars]
        size[key[-1]] += wanted[-1]
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.head, self.out = self.start[:-1].copy(), np.empty(self.start[-1], np.int32)
        self.fixed_start = np.concatenate([[0], np.cumsum(np.bincount(key[fixed], minlength=chars))])
        self.ends = self.start[1:] + self.fixed_start[1:]

    def run(self) -> np.ndarray:
        """The wanted suffixes as the scan finds them."""
        first, chars = 0, len(self.head)
        while first < chars:
            stop = int(np.searchsorted(self.ends, self.start[first] + self.fixed_start[first] + TOGETHER, "right"))
            stop = min(max(stop, first + 1), chars)
            if stop == first + 1:
                self._alone(first)
            elif not self._together(first, stop):
                self._one_by_one(first, stop)
            first = stop
        return self.out

    def put(self, at: np.ndarray, key: np.ndarray) -> None:
        """Add suffixes to the ends of their buckets ``key``."""
        if not len(at):
            return
        order = np.argsort(key, kind="stable")
        key = key[order]
        last = np.append(np.flatnonzero(key[1:] != key[:-1]), len(key) - 1)
        size, of = last.copy(), key[last]
        size[1:] -= last[:-1]
        size[0] += 1
        head = self.head[of]
        self.out[np.arange(len(key)) + np.repeat(head - last + size - 1, size)] = at[order]
        self.head[of] = head + size

    def _put_before(self, at: np.ndarray) -> None:
        to = self.to[at]
        wanted = np.flatnonzero(to < self.chars)
        self.put(at[wanted] - 1, to[wanted])

    def _alone(self, bucket: int) -> None:
        done = self.start[bucket]
        while done < self.head[bucket]:
            wave, done = self.out[done : self.head[bucket]], self.head[bucket]
            self._put_before(wave)
        self._put_before(self.fixed[self.fixed_start[bucket] : self.fixed_start[bucket + 1]])

    def _together(self, first: int, stop: int) -> bool:
        """Scan several buckets at once: what they induce among themselves is put in and ordered anew, until that changes nothing."""
        lo, hi = self.start[first], self.start[stop]
        # Within a bucket: what came before, what is induced here, what is fixed.
        kind = np.uint16 if 3 * (stop - first) < 1 << 16 else np.int32
        bucket = np.arange(0, 3 * (stop - first), 3, dtype=kind)
        there = np.arange(lo, hi) < np.repeat(self.head[first:stop], np.diff(self.start[first : stop + 1]))
        came, fixed = self.out[lo:hi][there], self.fixed[self.fixed_start[first] : self.fixed_start[stop]]
        came_key = np.repeat(bucket, self.head[first:stop] - self.start[first:stop])
        fixed_key = np.repeat(bucket + kind(2), np.diff(self.fixed_start[first : stop + 1]))
        inner, inner_key = came[:0], came_key[:0]
        for _ in range(STEPS):
            key = np.concatenate([came_key, inner_key, fixed_key])
            order = np.argsort(key, kind="stable")
            line = np.concatenate([came, inner, fixed])[order]
            to = self.to[line]
            inside = np.flatnonzero(to < stop)
            again = line[inside] - 1
            if np.array_equal(again, inner):
                self.out[lo:hi] = line[order < len(came) + len(inner)]
                later = np.flatnonzero((to >= stop) & (to < self.chars))
                self.put(line[later] - 1, to[later])
                return True
            inner, inner_key = again, bucket[to[inside] - first] + kind(1)
        return False

    def _one_by_one(self, first: int, stop: int) -> None:
        to, later, chars = memoryview(self.to), [], self.chars
        lines = [self.out[self.start[b] : self.head[b]].tolist() for b in range(first, stop)]
        for b, line in enumerate(lines, first):
            fixed = self.fixed[self.fixed_start[b] : self.fixed_start[b + 1]].tolist()
            for at in chain(line, fixed):  # the line may grow meanwhile
                bucket = to[at]
                if bucket < chars:
                    (lines[bucket - first] if bucket < stop else later).append(at - 1)
        self.out[self.start[first] : self.start[stop]] = [at for line in lines for at in line]
        later = np.array(later, np.int32)
        self.put(later, self.key[later])


def _induce(s: np.ndarray, small: np.ndarray, chars: int, lms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All L and all S suffixes in the order induced by ``lms``, the LMS suffixes by first character and, among those, as given."""
    ascending = _Scan(s, ~small, lms, chars)
    ascending.put(np.array([len(s) - 1], np.int32), s[-1:])  # the end of the string induces the last suffix
    large = ascending.run()
    return large, _Scan(chars - 1 - s, small, large[::-1], chars).run()[::-1]


def _names(s: np.ndarray, order: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether each LMS substring (in sorted order, with its length) differs from the one before it."""
    differs = np.ones(len(order), bool)
    differs[1:] = lengths[1:] != lengths[:-1]
    todo, k = np.flatnonzero(~differs), 0
    while len(todo):
        other = s[order[todo] + k] != s[order[todo - 1] + k]
        differs[todo[other]] = True
        k += 1
        todo = todo[~other]
        todo = todo[lengths[todo] > k]
    return differs


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of a string of non-negative integers; work arrays have as many entries as the string and the largest integer."""
    n = len(s)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    chars = int(s.max()) + 1
    s = s.astype(np.uint8 if chars <= 1 << 8 else np.uint16 if chars <= 1 << 16 else np.int32)  # narrow signs are sorted by counting
    small = _types(s)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms).astype(np.int32)
    if len(lms) > 1:
        by_first = lms[np.argsort(s[lms], kind="stable")]
        _, order = _induce(s, small, chars, by_first)
        order = order[is_lms[order]]
        # An LMS substring goes on to the next LMS suffix, which is in it, or to the end of the string; no other ends there.
        length = np.zeros(n, np.int32)
        length[lms[:-1]] = np.diff(lms) + 1
        length[lms[-1]] = n - lms[-1]
        differs = _names(s, order, length[order])
        differs[np.flatnonzero(order == lms[-1])] = True
        after = np.flatnonzero(order == lms[-1]) + 1
        differs[after[after < len(order)]] = True
        name = np.cumsum(differs) - 1
        if name[-1] + 1 < len(lms):
            place = np.zeros(n, np.int32)
            place[order] = name
            order = lms[suffix_array(place[lms])]
        lms = order[np.argsort(s[order], kind="stable")]
    large, low = _induce(s, small, chars, lms)
    # In a bucket the L suffixes come first.
    smaller = np.concatenate([[0], np.cumsum(np.bincount(s[low], minlength=chars))])[:-1]
    larger = np.cumsum(np.bincount(s[large], minlength=chars))
    out = np.empty(n, np.int32)
    out[np.arange(len(large)) + smaller[s[large]]] = large
    out[np.arange(len(low)) + larger[s[low]]] = low
    return out


def permuted_lcp(s: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each suffix, by its place in the text, with the one before it in the suffix array.

    Where both suffixes have the same character before them, the length is one less than at the place before; only the others are
    compared, up to ``most`` characters, which has to be more than any common prefix that the caller follows along such a run.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] > 0) & (s[:-1] == s[before[1:] - 1])
    lcp = np.zeros(n, np.int32)
    padded = np.concatenate([s.astype(np.int32), np.full(1, -1, np.int32)])
    todo, k = np.flatnonzero(~follows & (before >= 0)), 0
    while len(todo) and k < most:
        a, b = todo + k, before[todo] + k
        same = (a < n) & (b < n)
        same[same] = padded[a[same]] == padded[b[same]]
        todo = todo[same]
        k += 1
        lcp[todo] = k
    at = np.arange(n)
    start = np.maximum.accumulate(np.where(follows, 0, at))
    return np.maximum(lcp[start] - (at - start), 0)
