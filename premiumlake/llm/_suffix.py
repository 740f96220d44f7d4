"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard of text.

Positions are S (their suffix is smaller than the next one) or L; the leftmost S of a run is LMS.
LMS substrings are sorted by inducing from their first characters and named; if names repeat, the
string of names is sorted by the same procedure (less the names that need none); then L and S suffixes are induced from the sorted
LMS ones, each in one scan. With a small alphabet a scan goes bucket by bucket over whole arrays;
the shorter strings of names, whose alphabets are large, are scanned element by element.
"""

from __future__ import annotations

import numpy as np

from premiumlake.llm import _text

SMALL_ALPHABET = 1024


def _types(s: np.ndarray) -> np.ndarray:
    """True for S positions; the end of the string is smaller than anything."""
    n = len(s)
    differs = np.flatnonzero(s[:-1] != s[1:])
    smaller = s[differs] < s[differs + 1]
    at = np.searchsorted(differs, np.arange(n))
    return np.r_[smaller, False][at]


def _induce_buckets(s: np.ndarray, kind: np.ndarray, lms: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All suffixes from LMS positions in order, a bucket of the alphabet at a time."""
    n, k = len(s), len(size)
    end = np.cumsum(size)
    start = end - size
    out = np.empty(n, np.int64)

    def spread(at: np.ndarray, wanted: bool):
        """Predecessors of the given type, by character, with their rank among equals."""
        at = at[at > 0] - 1
        at = at[kind[at] == wanted]
        char = s[at]
        order = np.argsort(char, kind="stable")
        at, char = at[order], char[order]
        count = np.bincount(char, minlength=k)
        return at, char, np.arange(len(at)) - (np.cumsum(count) - count)[char], count

    lms_count = np.bincount(s[lms], minlength=k)
    by_char = lms[np.argsort(s[lms], kind="stable")]
    lms_end = np.cumsum(lms_count)
    head = start.copy()
    out[head[s[n - 1]]] = n - 1
    head[s[n - 1]] += 1
    used = np.flatnonzero(size)
    for c in used:
        done = start[c]
        while done < head[c]:
            part, done = out[done : head[c]], head[c]
            at, char, rank, count = spread(part, False)
            out[head[char] + rank] = at
            head += count
        if lms_count[c]:
            at, char, rank, count = spread(by_char[lms_end[c] - lms_count[c] : lms_end[c]], False)
            out[head[char] + rank] = at
            head += count
    tail = end.copy()
    for c in used[::-1]:
        done = end[c]
        while done > tail[c]:
            part, done = out[tail[c] : done][::-1], tail[c]
            at, char, rank, count = spread(part, True)
            out[tail[char] - 1 - rank] = at
            tail -= count
        if head[c] > start[c]:
            at, char, rank, count = spread(out[start[c] : head[c]][::-1], True)
            out[tail[char] - 1 - rank] = at
            tail -= count
    return out


def _induce_elements(s: np.ndarray, kind: np.ndarray, lms: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The same, an element at a time, for large alphabets."""
    n = len(s)
    # of each position, the character before it if that is of the wanted type, else -1; the
    # entry for position -1 (not yet known) is the last
    before = np.r_[-1, s[:-1].astype(np.int64), -1]
    before_l = np.where(np.r_[False, ~kind[:-1], False], before, -1).tolist()
    before_s = np.where(np.r_[False, kind[:-1], False], before, -1).tolist()
    end = np.cumsum(size)
    order = np.argsort(s[lms], kind="stable")
    char = s[lms][order]
    count = np.bincount(char, minlength=len(size))
    start = np.full(n, -1, np.int64)
    start[end[char] - count[char] + np.arange(len(lms)) - (np.cumsum(count) - count)[char]] = lms[order]
    head = (end - size).tolist()
    out = start.tolist()
    c = int(s[n - 1])
    out[head[c]] = n - 1
    head[c] += 1
    for k in range(n):
        p = out[k]
        c = before_l[p]
        if c >= 0:
            at = head[c]
            out[at] = p - 1
            head[c] = at + 1
    tail = end.tolist()
    for k in range(n - 1, -1, -1):
        p = out[k]
        c = before_s[p]
        if c >= 0:
            at = tail[c] - 1
            out[at] = p - 1
            tail[c] = at
    return np.array(out, np.int64)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of an array of small non-negative integers, in order."""
    s = s.astype(np.int64) if len(s) and s.max() > 0xFFFF else s.astype(np.uint16)
    n = len(s)
    if n < 2:
        return np.arange(n)
    size = np.bincount(s)
    induce = _induce_buckets if len(size) <= SMALL_ALPHABET else _induce_elements
    kind = _types(s)
    lms = np.flatnonzero(kind[1:] & ~kind[:-1]) + 1
    if len(lms) > 1:
        order = induce(s, kind, lms, size)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = order[is_lms[order]]
        # LMS substrings reach to the next LMS position, included
        stop = np.r_[lms[1:] + 1, n]
        code = np.empty(n, np.uint64)
        code[lms] = _symbol_hashes(s, lms, stop)
        new = np.r_[True, code[order[1:]] != code[order[:-1]]]
        name = np.empty(n, np.int64)
        name[order] = np.cumsum(new) - 1
        if not new.all():
            order = lms[_order_of_names(name[lms])]
        lms = order
    return induce(s, kind, lms, size)


def _order_of_names(names: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of a string of names, in order.

    A name that occurs once settles the place of its suffix and ends every comparison that reaches
    it: only the names that recur, and the single one after each run of them, are sorted further.
    """
    count = np.bincount(names)
    single = count[names] == 1
    needed = ~single
    needed[1:] |= ~single[:-1]
    rest = np.flatnonzero(needed)
    used = np.zeros(len(count), np.int64)
    used[names[rest]] = 1
    sorted_rest = rest[suffix_array((np.cumsum(used) - 1)[names[rest]])]
    place = (np.cumsum(count) - count)[names[single]]
    free = np.ones(len(names), bool)
    free[place] = False
    out = np.empty(len(names), np.int64)
    out[place] = np.flatnonzero(single)
    out[free] = sorted_rest[~single[sorted_rest]]
    return out


def _symbol_hashes(s: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of ranges of symbols; the last one, which runs into the end, is unlike others."""
    code = _text.symbol_hashes(s, start, stop)
    code[-1] ^= np.uint64(0x5851F42D4C957F2D)
    return code


def common_prefixes(s: np.ndarray, order: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """For each position, the common prefix of its suffix and the one before it in order, exact up
    to ``most`` less the distance from the last of ``starts``.

    Permuted common prefixes: where the characters before both suffixes agree, the value is one
    less than that of the position before; only elsewhere, and at ``starts``, are suffixes compared.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    anew = np.ones(n, bool)
    anew[1:] = (before[1:] <= 0) | (s[np.arange(n - 1)] != s[before[1:] - 1])
    anew[starts] = True
    at = np.flatnonzero(anew)
    length = np.zeros(n, np.int64)
    active = at[before[at] >= 0]
    for k in range(most):
        inside = np.maximum(active, before[active]) + k < n
        active = active[inside]
        active = active[s[active + k] == s[before[active] + k]]
        if not len(active):
            break
        length[active] = k + 1
    last = np.maximum.accumulate(np.where(anew, np.arange(n), 0))
    return np.maximum(length[last] - (np.arange(n) - last), 0)
