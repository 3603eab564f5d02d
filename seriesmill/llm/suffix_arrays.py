"""Suffix arrays of byte shards, their common prefixes, and merging of sorted runs, in numpy."""

from __future__ import annotations

import numpy as np

# Positions, groups and ranks of a shard share one 64-bit sort key up to this length.
BITS = 21


def words_of(body: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as a big-endian number; zeros beyond the end."""
    padded = np.zeros(len(body) + 8, np.uint64)
    padded[: len(body)] = body
    for size in (1, 2, 4):
        head = padded[:-size] << np.uint64(8 * size) if size else padded
        padded = np.append(head | padded[size:], np.zeros(size, np.uint64))
    return padded[: len(body)]


def suffix_array(body: np.ndarray) -> np.ndarray:
    """Positions in the order of the suffixes that begin there, by Larsson and Sadakane's refinement.

    Suffixes start in groups of equal first bytes. A round sorts the members of every unsorted group by
    the group of the suffix h further on, which doubles the bytes compared; sorted ones are
    left alone.
    """
    n = len(body)
    if n == 0:
        return np.zeros(0, np.int64)
    words = words_of(body)
    small = n < 1 << BITS
    low = np.uint64((1 << BITS) - 1)
    # Zeros stand beyond the end, so how many bytes there are decides between equal words.
    there = np.minimum(np.arange(n, 0, -1), 5 if small else 8).astype(np.uint64)
    if small:  # five bytes, their number and the position in one key
        keys = (words >> np.uint64(24) << np.uint64(24)) | (there << np.uint64(BITS)) | np.arange(n, dtype=np.uint64)
        keys.sort()
        sa, first, h = (keys & low).astype(np.int64), keys >> np.uint64(BITS), 5
    else:
        sa = np.lexsort((there, words))
        first, h = words[sa], 8
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(first[1:], first[:-1], out=new[1:])
    if not small:
        new[1:] |= there[sa][1:] != there[sa][:-1]
    # The rank of a suffix is the slot where its group begins; suffixes that end early rank before all others.
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, n))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.repeat(begins, sizes)
    slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(slots):
        own = sa[slots]
        group, after = rank[own], rank[np.minimum(own + h, n)] + 1
        if small and n < low:
            index = np.arange(len(slots), dtype=np.uint64)
            keys = (group.astype(np.uint64) << np.uint64(2 * BITS)) | (after.astype(np.uint64) << np.uint64(BITS)) | index
            keys.sort()
            order, pairs = (keys & low).astype(np.int64), keys >> np.uint64(BITS)
            differs = pairs[1:] != pairs[:-1]
        else:
            order = np.lexsort((after, group))
            differs = (group[order][1:] != group[order][:-1]) | (after[order][1:] != after[order][:-1])
        own = own[order]
        sa[slots] = own
        new = np.concatenate([[True], differs])
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(slots)))
        rank[own] = np.repeat(slots[begins], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        h *= 2
    return sa


_SIGNIFICANT = (np.uint64(1) << (np.arange(1, 8, dtype=np.uint64) * np.uint64(8))).astype(np.uint64)


def common_prefixes(body: np.ndarray, sa: np.ndarray, most: int, lanes: int = 8192) -> np.ndarray:
    """Bytes that the suffix in each slot shares with the one before, at most `most`, by Kasai's walk.

    Going from a position to the next, at most one shared byte is lost. The text is cut into lanes
    that walk side by side, each from its own start; bytes are compared eight at a time.
    """
    n = len(body)
    if n == 0:
        return np.zeros(0, np.int64)
    before = np.empty(n, np.int64)
    before[sa[0]] = n
    before[sa[1:]] = sa[:-1]
    words = np.append(words_of(body), np.zeros(most + 9, np.uint64))
    shared = np.zeros(n, np.int64)
    steps = -(-n // min(lanes, n))
    starts = np.arange(0, n, steps)
    known = np.zeros(len(starts), np.int64)
    for t in range(steps):
        at = starts + t
        if at[-1] >= n:
            at, starts, known = at[:-1], starts[:-1], known[:-1]
        phi = before[at]
        live = np.flatnonzero((known < most) & (phi < n))
        known[phi >= n] = 0
        while len(live):
            a, b, k = at[live], phi[live], known[live]
            differ = words[a + k] ^ words[b + k]
            same = np.where(differ == 0, 8, 7 - np.searchsorted(_SIGNIFICANT, differ, "right"))
            k = np.minimum(k + same, np.minimum(most, n - np.maximum(a, b)))
            known[live] = k
            live = live[(same == 8) & (k < most) & (k < n - np.maximum(a, b))]
        shared[at] = known
        known = np.maximum(known - 1, 0)
    return shared[sa]


def least_by_prefix(body: np.ndarray, starts: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of equal strings of `size` bytes among `starts`, in order of the strings.

    Returns the group of every start, the smallest of `values` in each group, and one start of each.
    """
    sa = suffix_array(body)
    shared = common_prefixes(body, sa, size)
    slot_of = np.full(len(body), -1, np.int64)
    slot_of[starts] = np.arange(len(starts))
    listed = slot_of[sa]
    wanted = listed >= 0
    group = np.cumsum(shared < size)[wanted]
    listed = listed[wanted]
    if not len(listed):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.minimum.reduceat(values[listed], begins)
    groups = np.empty(len(starts), np.int64)
    groups[listed] = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(listed))))
    return groups, least, starts[listed[begins]]


def merged_least(runs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """For runs of (sorted distinct keys, values): each key's smallest value in any run, run by run.

    Runs are merged two by two: binary search puts the keys of one into the other.
    """
    level = list(runs)
    while len(level) > 1:
        level = [_merge(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    keys, values = level[0]
    return [values[np.searchsorted(keys, own)] for own, _ in runs]


def _merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    (keys, values), (more, new) = (a, b) if len(a[0]) >= len(b[0]) else (b, a)
    at = np.searchsorted(keys, more)
    found = np.zeros(len(more), bool)
    found[at < len(keys)] = keys[at[at < len(keys)]] == more[at < len(keys)]
    values = values.copy()
    values[at[found]] = np.minimum(values[at[found]], new[found])
    return np.insert(keys, at[~found], more[~found]), np.insert(values, at[~found], new[~found])
