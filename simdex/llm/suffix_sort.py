"""Suffix arrays of integer strings by induced sorting, and permuted common prefixes.

Suffixes are classified (smaller or larger than the next one); the substrings between
leftmost-smaller positions are named in sorted order; the string of names is sorted
recursively; all suffixes follow from the sorted leftmost-smaller ones in linear time.
The steps are array operations, so a shard of some megabytes takes about a second.
"""

from __future__ import annotations

import numpy as np

from .common import concat_ranges


def _dense(keys: np.ndarray) -> np.ndarray:
    """Rank of each key among the distinct ones."""
    return np.unique(keys, return_inverse=True)[1]


def _chain_names(code: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sorted names of the code sequences from each place x to ``last[x]`` (x < last[x]).

    A first key packs as many codes as fit; longer sequences are then doubled.  Where a
    sequence's rest is only its last code, the least name that begins with that code stands
    for it: another rest that begins alike and goes on can't meet it (its place would be
    leftmost-smaller as well)."""
    n = len(last)
    bits = int(code.max() + 1).bit_length()
    fit = max(1, 63 // bits)
    key = np.zeros(n, np.int64)
    padded = np.append(code + 1, np.zeros(fit, np.int64))
    room = last - np.arange(n)
    for j in range(fit):
        key = key << bits | np.where(room >= j, padded[j:j + n], 0)
    name = _dense(key)
    cover = fit
    while True:
        x = np.nonzero(room >= cover)[0]
        if not len(x):
            return name
        y = x + cover
        least = np.full(int(code.max()) + 1, n)
        np.minimum.at(least, code[:n], name + 1)
        least[code[n]] = 0  # the end of the string is the smallest
        second = np.where(y == last[x], least[code[y]], name[np.minimum(y, n - 1)] + 1)
        # every place that shares a name with one of these is one of these
        sub, back = np.unique(name[x] * (n + 2) + second, return_inverse=True)
        old = sub // (n + 2)
        first = np.append(True, old[1:] != old[:-1])
        nth = np.arange(len(old)) - np.maximum.accumulate(np.where(first, np.arange(len(old)), 0))
        more = np.zeros(n + 2, np.int64)  # new names that earlier names have made room for
        np.add.at(more, old[~first] + 1, 1)
        shift = np.cumsum(more)
        new = name + shift[name]
        new[x] = (old + shift[old] + nth)[back]
        name = new
        cover *= 2


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Sorted suffixes of ``s``, whose last symbol is its smallest and occurs once."""
    n = len(s)
    if n < 3:
        return np.arange(n)[::-1].copy()
    # classify: a suffix is smaller than the next one if its first other symbol is larger
    ends = np.append(np.nonzero(s[1:] != s[:-1])[0], n - 1)
    up = np.append(s[ends[:-1]] < s[ends[:-1] + 1], True)
    smaller = np.repeat(up, np.diff(np.append(-1, ends)))
    left = np.append(False, smaller[1:] & ~smaller[:-1])
    lms = np.nonzero(left)[0]                        # the last one is the end of the string
    if not len(lms):
        return np.arange(n)[::-1].copy()
    following = np.cumsum(left)[:-1]                 # place in lms of the next one after x
    code = s * 2 + smaller
    name = _chain_names(code, lms[following])
    # sort the leftmost-smaller suffixes, by their names or recursively
    reduced = np.append(_dense(name[lms[:-1]]) + 1, 0)
    if reduced.max() == len(lms) - 1:
        order = np.argsort(reduced, kind="stable")
    else:
        order = suffix_array(reduced)
    # induce: lay all places out by the order of the next leftmost-smaller suffix, then
    # stable counting passes over their names
    begin = np.append(0, lms[:-1])[order]
    out = concat_ranges(begin, lms[order] - begin)
    for shift in range(0, max(1, int(name.max()).bit_length()), 16):
        out = out[np.argsort((name[out] >> shift & 0xFFFF).astype(np.uint16), kind="stable")]
    return np.append(n - 1, out)


def common_prefixes(text: np.ndarray, order: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every place of ``text`` (bytes) but the last: the place of the suffix sorted before it,
    and the length of their common prefix, at most ``room``.

    Only where the bytes before a place and before its neighbour differ (or the room starts
    anew) are bytes compared; everywhere else the length is one less than a place earlier."""
    n = len(text)
    phi = np.empty(n, np.int64)
    phi[order[1:]] = order[:-1]
    phi[order[0]] = -1
    i = np.arange(n)
    start = np.append(True, room[1:] != room[:-1] - 1)
    before = np.where((i > 0) & (phi > 0), text[phi - 1] != text[i - 1], True)
    at = np.nonzero(start | before)[0]
    raw = np.append(text, np.zeros(16, np.uint8)).tobytes()
    words = np.ndarray(n + 8, "<u8", raw, strides=(1,))
    length = np.zeros(n, np.int64)
    live = at[phi[at] >= 0]
    while len(live):
        a, b = live + length[live], phi[live] + length[live]
        inside = (a < n) & (b < n)
        live, a, b = live[inside], a[inside], b[inside]
        differ = words[a] ^ words[b]
        same = differ == 0
        low = differ & (~differ + np.uint64(1))
        length[live] += np.where(same, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8)
        live = live[same & (length[live] < room[live])]
    length = np.minimum(length, np.maximum(room, 0))
    base = np.maximum.accumulate(np.where(start | before, i, 0))
    return phi, length[base] - (i - base)
