"""Runs of words shared by an item and a set of anchors, counted without listing them.

Each text is a row of 64-bit word codes.  A run is named by two modular polynomial sums taken from
prefix sums, so the name of any run costs the same.  For a start p of an anchor let ``E(p)`` be
the end of the longest run from p that occurs earlier in the anchor, and ``e(p)`` the end of the
longest run from p that occurs in the item.  Distinct shared phrases are

    sum over p of max(0, e(p) - E(p)).

Both ends never decrease as p grows.  So of neighbouring starts with one E only the last (its shortest
unseen run) need be asked first, and starts inside one long match share its end and are settled by
halving, whatever the texts repeat.  An item's runs of one length are named and sorted once, when first asked for.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Two primes below 2**31 and a base for each.
PRIMES = ((2147483647, 911382323), (2147483629, 972663749))
# Lengths tried one by one before a match counts as long.
SHORT = 8


def _powers(n: int, base: int, prime: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.int64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * pow(base, done, prime) % prime
        done += step
    return out


_known: list[tuple[np.ndarray, np.ndarray]] = []


def _tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse, n at least; each process keeps its own."""
    if not _known or len(_known[0][0]) < n:
        size = 1 << n.bit_length()
        _known[:] = [(_powers(size, b, p), _powers(size, pow(b, -1, p), p)) for p, b in PRIMES]
    return _known


class Runs:
    """Names of the runs of a row of word codes."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        raw = codes.view(np.uint64)
        self.sums = []
        for (prime, _), (power, _), word in zip(PRIMES, _tables(self.n), (raw >> np.uint64(32), raw & np.uint64(0xFFFFFFFF)), strict=True):
            each = (word.astype(np.int64) % prime + 1) * power[: self.n] % prime
            self.sums.append(np.r_[0, np.cumsum(each) % prime])
        self._sorted: dict[int, np.ndarray] = {}

    def names(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        one, two = (
            (s[start + length] - s[start]) % prime * inverse[start] % prime
            for s, (prime, _), (_, inverse) in zip(self.sums, PRIMES, _tables(self.n), strict=True)
        )
        return (one << 31) | two

    def has(self, names: np.ndarray, length: int) -> np.ndarray:
        """Are these names of runs of that length here?"""
        if length > self.n:
            return np.zeros(len(names), bool)
        if length not in self._sorted:
            self._sorted[length] = np.sort(self.names(np.arange(self.n - length + 1), length))
        own = self._sorted[length]
        return own[np.minimum(np.searchsorted(own, names), len(own) - 1)] == names


def seen_ends(codes: list[int]) -> np.ndarray:
    """E(p) of every start, from the lengths of the repeated suffixes (a suffix automaton's links)."""
    onward: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    repeated = np.zeros(len(codes), np.int64)
    for t, code in enumerate(codes):
        new = len(size)
        onward.append({})
        size.append(size[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and code not in onward[at]:
            onward[at][code] = new
            at = link[at]
        if at >= 0:
            to = onward[at][code]
            if size[to] != size[at] + 1:
                copy = len(size)
                onward.append(dict(onward[to]))
                size.append(size[at] + 1)
                link.append(link[to])
                while at >= 0 and onward[at].get(code) == to:
                    onward[at][code] = copy
                    at = link[at]
                link[to] = copy
                to = copy
            link[new] = to
        last = new
        repeated[t] = size[link[new]]
    begins = np.arange(1, len(codes) + 1) - repeated  # never decreases with the end
    p = np.arange(len(codes))
    return np.maximum(np.searchsorted(begins, p, side="right"), p)


@dataclass
class Anchors:
    """Anchors' words end to end, with what does not depend on an item."""

    runs: Runs
    ends: np.ndarray  # end of the anchor that each place is in
    owner: np.ndarray  # its number
    seen: np.ndarray  # E(p)
    first: np.ndarray  # starts with one E: the first and last of each group
    last: np.ndarray
    words: np.ndarray  # distinct codes
    word: np.ndarray  # index of the code at each place
    n: int

    @staticmethod
    def of(texts: list[np.ndarray]) -> Anchors:
        codes = np.concatenate([np.zeros(0, np.int64), *texts])
        sizes = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(texts)), sizes)
        ends = (begin + sizes)[owner]
        parts = [seen_ends(t.tolist()) + b for t, b in zip(texts, begin.tolist(), strict=True)]
        seen = np.concatenate([np.zeros(0, np.int64), *parts])
        new = np.r_[True, (seen[1:] != seen[:-1]) | (owner[1:] != owner[:-1])] if len(seen) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(seen)][: len(first)] - 1
        open_ = seen[last] < ends[last]  # the rest is seen to the anchor's end: nothing new starts here
        words, word = np.unique(codes, return_inverse=True)
        return Anchors(Runs(codes), ends, owner, seen, first[open_], last[open_], words, word, len(texts))


def _ask(a: Anchors, item: Runs, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Does the item have the run of that length from each start?"""
    out = np.zeros(len(start), bool)
    for size in np.unique(length).tolist():
        own = np.flatnonzero(length == size)
        out[own] = item.has(a.runs.names(start[own], size), size)
    return out


def shared(a: Anchors, codes: np.ndarray) -> np.ndarray:
    """Distinct phrases that the item shares with each anchor."""
    item = Runs(codes)
    held = np.isin(a.words, codes)
    end = a.seen.copy()  # e(p), where it lies beyond E(p)
    group = np.flatnonzero(held[a.word[a.last]])
    first, last = a.first[group], a.last[group]
    length = a.seen[last] + 1 - last
    found = _ask(a, item, last, length)

    def one(p: int, e: int) -> bool:
        return bool(item.has(a.runs.names(np.array([p]), e - p), e - p)[0])

    def least(low: int, high: int, true) -> int:
        """First number from low on for which ``true`` holds; it holds for high."""
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if true(middle) else (middle + 1, high)
        return low

    low, p = first[found], last[found]
    starts = [p]
    for _ in range(SHORT):
        more = p > low
        low, p = low[more], p[more] - 1
        more = _ask(a, item, p, a.seen[p] + 1 - p)
        low, p = low[more], p[more]
        if not len(p):
            break
        starts.append(p)
    for f, l in zip(low.tolist(), p.tolist(), strict=True):
        starts.append(np.arange(least(f, l, lambda p, to=int(a.seen[l]) + 1: one(p, to)), l))
    p = np.sort(np.concatenate(starts))
    end[p] += 1
    alive = p
    for _ in range(SHORT):
        alive = alive[end[alive] < a.ends[alive]]
        if not len(alive):
            break
        # A start inside a match that ends at the same place goes with the first one there, below.
        alive = alive[_ask(a, item, alive, end[alive] + 1 - alive)]
        end[alive] += 1
    rest, i = alive[end[alive] < a.ends[alive]].tolist(), 0
    while i < len(rest):
        q, stop = rest[i], int(a.ends[rest[i]])
        e = int(end[q])
        if e < stop and one(q, e + 1):
            step = 1
            while e + step < stop and one(q, e + step + 1):
                step *= 2
            top = min(e + step + 1, stop + 1)
            e = least(e + 1, top, lambda t, q=q, stop=stop: t > stop or not one(q, t)) - 1
        end[q] = max(end[q], e)
        j = i + 1
        while j < len(rest) and a.ends[rest[j]] == stop and rest[j] < e:
            j += 1
        if e < stop and i + 1 < j:  # starts inside the match: those from k on reach further
            k = least(i + 1, j, lambda k, e=e, j=j: k == j or one(rest[k], e + 1))
        else:
            k = j
        for m in range(i + 1, k):
            end[rest[m]] = max(end[rest[m]], e)
        if k < j:
            end[rest[k]] = max(end[rest[k]], e + 1)
        i = k
    return np.bincount(a.owner, weights=end - a.seen, minlength=a.n).astype(np.int64)
