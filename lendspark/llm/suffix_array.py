"""Suffix arrays by induced sorting, and permuted common prefixes."""

from __future__ import annotations

import numpy as np

SMALL = 1024  # alphabets up to this size are induced a bucket at a time in numpy


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last symbol is a unique least one."""
    n = len(s)
    differs = np.flatnonzero(s[:-1] != s[1:])
    smaller = np.ones(n, bool)
    smaller[:-1] = (s[:-1] < s[1:])[differs[np.searchsorted(differs, np.arange(n - 1))]]
    return smaller


def _scatter(sa: np.ndarray, at: np.ndarray, chars: np.ndarray, rows: np.ndarray, step: int) -> None:
    """Append rows, in order, to the buckets of chars that grow from at by step."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    new = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    size = np.diff(np.append(new, len(c)))
    rank = np.arange(len(c)) - np.repeat(new, size)
    sa[at[c] + step * rank] = rows[order]
    at[c[new]] += step * size


def _induce(s: np.ndarray, smaller: np.ndarray, k: int, lms: np.ndarray) -> np.ndarray:
    """Suffix order from that of the leftmost-smaller suffixes ``lms``.

    The sequential scan reads a bucket's larger-type suffixes, then its
    smaller-type ones, and places each one's predecessor at the end of a later
    bucket or of this one.  A whole bucket is placed at once; predecessors in
    the same bucket make the next wave.
    """
    n, s = len(s), s.astype(np.uint16, copy=False)  # a short type, whose stable sort is by radix
    count = np.bincount(s, minlength=k)
    tail = np.cumsum(count)
    head = tail - count
    larger = np.bincount(s[~smaller], minlength=k)
    sa = np.full(n, -1, np.int32)
    n_lms = np.bincount(s[lms], minlength=k)
    at = tail - n_lms
    _scatter(sa, at.copy(), s[lms], lms, 1)
    present = np.flatnonzero(count)

    fill = head.copy()
    for c in present.tolist():
        low, own_end = head[c], tail[c]
        while True:  # larger-type part, wave by wave, then the leftmost-smaller part
            wave = sa[low:fill[c]] if low < fill[c] else None
            if wave is None:
                break
            low = fill[c]
            prev = wave[wave > 0] - 1
            prev = prev[~smaller[prev]]
            if len(prev):
                _scatter(sa, fill, s[prev], prev, 1)
        wave = sa[own_end - n_lms[c]:own_end]
        prev = wave[wave > 0] - 1
        if len(prev):
            _scatter(sa, fill, s[prev], prev, 1)

    fill = tail - 1
    sa[0] = n - 1
    fill[s[n - 1]] -= 1
    for c in present[::-1].tolist():
        high = tail[c]
        while high > fill[c] + 1:
            wave = sa[fill[c] + 1:high][::-1]
            high = fill[c] + 1
            prev = wave[wave > 0] - 1
            prev = prev[smaller[prev] & (s[prev] <= c)]
            if len(prev):
                _scatter(sa, fill, s[prev], prev, -1)
        wave = sa[head[c]:head[c] + larger[c]][::-1]
        prev = wave[wave > 0] - 1
        prev = prev[smaller[prev]]
        if len(prev):
            _scatter(sa, fill, s[prev], prev, -1)
    return sa


def _induce_large(s: np.ndarray, smaller: np.ndarray, k: int, lms: np.ndarray) -> np.ndarray:
    """The same for large alphabets, whose buckets hold a few suffixes each:
    a scan over lists.  before[i] is the symbol before i if that position is of
    the type the scan places, else -1, as it is for an empty place (-1)."""
    n = len(s)
    ends = np.cumsum(np.bincount(s, minlength=k))
    start = np.full(n, -1, np.int64)
    chars = s[lms]
    _scatter(start, ends - np.bincount(chars, minlength=k), chars, lms.astype(np.int64), 1)
    sa = start.tolist()

    before = np.full(n + 1, -1, np.int64)
    before[1:n][~smaller[:-1]] = s[:-1][~smaller[:-1]]
    before, at = before.tolist(), (ends - np.bincount(s, minlength=k)).tolist()
    for i in sa:  # it grows ahead of the scan
        c = before[i]
        if c >= 0:
            place = at[c]
            sa[place] = i - 1
            at[c] = place + 1

    before = np.full(n + 1, -1, np.int64)
    before[1:n][smaller[:-1]] = s[:-1][smaller[:-1]]
    before, at = before.tolist(), (ends - 1).tolist()
    for i in reversed(sa):
        c = before[i]
        if c >= 0:
            place = at[c]
            sa[place] = i - 1
            at[c] = place - 1
    sa[0] = n - 1
    return np.array(sa, np.int32)


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """Order of the suffixes of s, symbols below k, whose last one is a unique least one.

    Suffixes are classed as smaller or larger than the next.  The substrings
    between leftmost smaller ones are sorted by one induction and named; the
    string of names is sorted recursively; a second induction from that order
    gives all suffixes.
    """
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    smaller = _types(s)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = smaller[1:] & ~smaller[:-1]
    lms = np.flatnonzero(is_lms).astype(np.int32)
    induce = _induce if k <= SMALL else _induce_large
    if len(lms) > 1:
        by_substring = induce(s, smaller, k, lms)
        by_substring = by_substring[is_lms[by_substring]]
        length = np.zeros(n, np.int32)
        length[lms[:-1]] = np.diff(lms) + 1
        length[lms[-1]] = 1
        a, b = by_substring[:-1].astype(np.int64), by_substring[1:].astype(np.int64)
        differ = length[a] != length[b]
        going = np.flatnonzero(~differ)
        step = 0
        while len(going):
            going = going[length[a[going]] > step]
            bad = s[a[going] + step] != s[b[going] + step]
            differ[going[bad]] = True
            going = going[~bad]
            step += 1
        name = np.zeros(n, np.int32)
        name[by_substring[1:]] = np.cumsum(differ)
        reduced = name[lms]
        names = int(reduced.max()) + 1
        if names < len(reduced):
            order = suffix_array(reduced, names)
        else:
            order = np.empty(names, np.int32)
            order[reduced] = np.arange(names)
        lms = lms[order]
    return induce(s, smaller, k, lms)


def common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Permuted common prefixes: for each position, the symbols its suffix
    shares with its neighbour before it in sa.

    Where the symbols before both are equal, the value is one less than the
    position before has; only at the other, irreducible positions are symbols
    compared, four at a time, all positions together.  s: uint16.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    irreducible = (before <= 0) | (i == 0)
    rest = np.flatnonzero(~irreducible)
    irreducible[rest] = s[rest - 1] != s[before[rest] - 1]
    at = np.flatnonzero(irreducible & (before >= 0))
    other = before[at]
    padded = np.zeros(n + 8, np.uint16)
    padded[:n] = s
    padded[n:] = np.arange(65528, 65536)
    four = np.ndarray((n + 4,), "<u8", padded.tobytes(), strides=(2,))
    shared, going = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(going):
        left, right = at[going] + shared[going], other[going] + shared[going]
        over = np.maximum(left, right) >= n
        x = four[np.minimum(left, n)] ^ four[np.minimum(right, n)]
        whole = (x == 0) & ~over
        part = going[~whole & ~over]
        y = x[~whole & ~over]
        shared[part] += ((y & np.uint64(0xFFFF)) == 0).astype(int) * (1 + ((y & np.uint64(0xFFFF0000)) == 0).astype(int) * (
            1 + ((y & np.uint64(0xFFFF00000000)) == 0).astype(int)))
        going = going[whole]
        shared[going] += 4
    top = np.zeros(n, np.int64)
    top[at] = shared + at
    return np.maximum(np.maximum.accumulate(top) - i, 0)
