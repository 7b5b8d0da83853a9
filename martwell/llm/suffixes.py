"""Suffix arrays by induced sorting, and permuted common prefixes.

``suffix_array`` follows the usual steps: suffixes are classified as smaller
(S) or larger (L) than the next one; the leftmost S of each run (LMS) start the
LMS substrings; these are sorted by inducing, named, and, where names repeat,
ordered by the suffix array of the names (recursion); the array is induced from
them.  Inducing reads the array in order.  With few symbols a whole bucket is
read at once (suffixes that fall into the bucket that is being read make the
next wave of it); with many, one suffix after another.

``common_prefixes`` gives, for every place of the text, how long its suffix
agrees with the one before it in the array.  Only the irreducible values (the
symbols before both differ) are compared, by words of eight symbols; the others
are one less than their left neighbour's.
"""

from __future__ import annotations

import numpy as np

#: Suffixes per symbol from which whole buckets are worth a numpy call.
MANY = 200


def _types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S); the last is not."""
    n = len(s)
    small = np.zeros(n, bool)
    if n < 2:
        return small
    step = np.sign(s[1:].astype(np.int64) - s[:-1].astype(np.int64))
    # equal neighbours take the type of the run's end
    known = np.flatnonzero(step)
    if known.size:
        following = np.searchsorted(known, np.arange(n - 1))
        inside = following < len(known)
        small[: n - 1][inside] = step[known[following[inside]]] > 0
    return small


def _induced_by_bucket(s: np.ndarray, small: np.ndarray, lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    n, symbols = len(s), len(counts)
    ends = np.cumsum(counts)
    begins = ends - counts
    s_begins = ends - np.bincount(s[small], minlength=symbols)
    sa = np.full(n, -1, np.int64)
    order = np.argsort(s[lms], kind="stable")
    by_symbol = np.append(0, np.cumsum(np.bincount(s[lms], minlength=symbols)))
    seeds = lms[order]
    head = begins.copy()

    def put_up(found: np.ndarray) -> None:
        symbol = s[found]
        o = np.argsort(symbol, kind="stable")
        found, symbol = found[o], symbol[o].astype(np.int64)
        many = np.bincount(symbol, minlength=symbols)
        first = np.cumsum(many) - many
        sa[head[symbol] + np.arange(len(found)) - first[symbol]] = found
        head[:] += many

    put_up(np.array([n - 1]))
    for c in np.flatnonzero(counts):
        told, done = [], begins[c]
        while done < head[c]:
            wave = sa[done : head[c]]
            done = head[c]
            before = wave[wave > 0] - 1
            before = before[~small[before]]
            here = s[before] == c
            same = before[here]
            sa[head[c] : head[c] + len(same)] = same
            head[c] += len(same)
            told.append(before[~here])
        seed = seeds[by_symbol[c] : by_symbol[c + 1]]
        told.append(seed[seed > 0] - 1)
        found = np.concatenate(told)
        if found.size:
            put_up(found)
    tail = ends.copy()

    def put_down(found: np.ndarray) -> None:
        symbol = s[found]
        o = np.argsort(symbol, kind="stable")
        found, symbol = found[o], symbol[o].astype(np.int64)
        many = np.bincount(symbol, minlength=symbols)
        first = np.cumsum(many) - many
        sa[tail[symbol] - 1 - (np.arange(len(found)) - first[symbol])] = found
        tail[:] -= many

    for c in np.flatnonzero(counts)[::-1]:
        told, done = [], ends[c]
        while done > tail[c]:
            wave = sa[tail[c] : done][::-1]
            done = tail[c]
            before = wave[wave > 0] - 1
            before = before[small[before]]
            here = s[before] == c
            same = before[here]
            sa[tail[c] - len(same) : tail[c]] = same[::-1]
            tail[c] -= len(same)
            told.append(before[~here])
        wave = sa[begins[c] : s_begins[c]][::-1]
        before = wave[wave > 0] - 1
        told.append(before[small[before]])
        found = np.concatenate(told)
        if found.size:
            put_down(found)
    return sa


def _induced_one_by_one(s: np.ndarray, small: np.ndarray, lms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    n = len(s)
    ends = np.cumsum(counts)
    # the symbol before each place, where that is larger or smaller; -1: not so, or not filled (the last)
    larger, smaller = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
    larger[1:n][~small[:-1]] = s[:-1][~small[:-1]]
    smaller[1:n][small[:-1]] = s[:-1][small[:-1]]
    up, down = larger.tolist(), smaller.tolist()
    filled = np.full(n, -1, np.int64)
    symbol = s[lms].astype(np.int64)
    order = np.argsort(symbol, kind="stable")
    many = np.bincount(symbol, minlength=len(counts))
    nth = np.arange(len(lms)) - np.repeat(np.cumsum(many) - many, many)
    spot = ends - np.bincount(s[small], minlength=len(counts))
    filled[spot[symbol[order]] + nth] = lms[order]
    sa = filled.tolist()
    head = (ends - counts).tolist()
    last = int(s[n - 1])
    sa[head[last]] = n - 1
    head[last] += 1
    for i in sa:  # grows ahead of the reading
        c = up[i]
        if c >= 0:
            at = head[c]
            sa[at] = i - 1
            head[c] = at + 1
    tail = ends.tolist()
    for i in reversed(sa):
        c = down[i]
        if c >= 0:
            tail[c] = at = tail[c] - 1
            sa[at] = i - 1
    return np.array(sa, np.int64)


def _names(s: np.ndarray, places: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """A number for each LMS substring (by place in ``places``), equal for equal
    ones, in their order, and how many there are."""
    n = len(s)
    number = np.zeros(n, np.int64)
    number[places] = np.arange(len(places))
    following = np.append(places[1:], n)
    length = following[number[ordered]] - ordered  # up to the next LMS, which also counts
    last = following[number[ordered]] == n
    left, right = ordered[:-1], ordered[1:]
    alike = (length[:-1] == length[1:]) & ~last[:-1] & ~last[1:]
    pairs = np.flatnonzero(alike)
    if pairs.size:
        size = length[:-1][pairs] + 1
        first = np.cumsum(size) - size
        ramp = np.arange(int(size.sum())) - np.repeat(first, size)
        differ = s[np.repeat(left[pairs], size) + ramp] != s[np.repeat(right[pairs], size) + ramp]
        alike[pairs] = ~np.logical_or.reduceat(differ, first)
    rank = np.cumsum(np.append(True, ~alike)) - 1
    out = np.empty(len(places), np.int64)
    out[number[ordered]] = rank
    return out, int(rank[-1]) + 1


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``s`` (whole numbers from 0) in order; a suffix
    comes before its own continuations."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    counts = np.bincount(s)
    small = _types(s)
    places = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    induced = _induced_by_bucket if n >= MANY * np.count_nonzero(counts) else _induced_one_by_one
    if len(places) < 2:
        return induced(s, small, places, counts)
    sa = induced(s, small, places, counts)
    is_lms = np.zeros(n, bool)
    is_lms[places] = True
    ordered = sa[is_lms[sa]]
    names, distinct = _names(s, places, ordered)
    if distinct < len(places):
        ordered = places[suffix_array(names)]
    return induced(s, small, ordered, counts)


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every place of the bytes ``s``: the place before it in the array (-1 for
    the first) and the length of the prefix that both share."""
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n)
    reducible = (place > 0) & (before > 0)
    reducible[1:] &= s[:-1] == s[np.maximum(before[1:] - 1, 0)]
    some = np.flatnonzero(~reducible & (before >= 0))
    # eight symbols from every place; what lies behind the end is told apart below
    padded = np.concatenate([s.astype(np.uint8), np.zeros(16, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[: n + 8]
    words = np.ascontiguousarray(words).view(np.uint64).ravel()
    shared = np.zeros(n, np.int64)
    left, right, at = some, before[some], 0
    while left.size:
        room = n - np.maximum(left, right) - at  # symbols of the later suffix that are left
        differ = words[np.minimum(left + at, n)] ^ words[np.minimum(right + at, n)]
        low = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
        step = np.minimum(equal, np.maximum(room, 0))
        shared[left] = at + step
        on = step == 8
        left, right, at = left[on], right[on], at + 8
    # a reducible value follows from the nearest value to its left that is not
    anchor = np.maximum.accumulate(np.where(reducible, 0, place))
    return before, np.where(reducible, shared[anchor] - (place - anchor), shared)
