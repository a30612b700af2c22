"""Suffix arrays of many strings in numpy: Larsson-Sadakane refinement and Kasai common prefixes.

The strings stand one after the other. A suffix ends with its string; one that is the beginning of
another comes first, and equal suffixes stand in the order of their strings, as if every string had an
end mark of its own.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position, as little-endian numbers; zeros follow the end."""
    padded = np.concatenate((data, np.zeros(WORD, np.uint8)))
    return np.ndarray((len(data),), "<u8", padded, strides=(1,)).copy()


def suffix_array(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of strings of these sizes in the order of their suffixes.

    Groups of suffixes with equal first bytes are split by the rank of what follows, which doubles the
    bytes they are known to share. Suffixes alone in their group are done, as are equal whole ones.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    bits = np.uint64(max(1, n.bit_length()))
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)
    known, keys = _first_keys(data, room, bits)
    at = np.arange(n)
    ranks = np.zeros(n, np.int64)  # where the group begins, from 1; a string's end is 0
    while True:
        keys, at = _sorted(keys, at, bits)
        first = _group_starts(keys)
        ranks[at] += first + 1 if not ranks.any() else first - _group_starts(keys >> bits)
        alone = np.ones(len(at) + 1, bool)
        alone[:-1] = first == np.arange(len(at))
        at = at[~(alone[:-1] & alone[1:])]
        at = at[room[at] >= known]
        if not len(at):
            break
        far = room[at] > known
        after = np.zeros(len(at), np.uint64)
        after[far] = ranks[at[far] + known]
        keys = ranks[at].astype(np.uint64) << bits | after
        known *= 2
    order = ranks.astype(np.uint64) << bits | np.arange(n, dtype=np.uint64)
    order.sort()
    return (order & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _first_keys(data: np.ndarray, room: np.ndarray, bits: np.uint64) -> tuple[int, np.ndarray]:
    """As many symbols as fit beside a position, of the bytes that occur; 0 after the string's end."""
    found = np.bincount(data, minlength=256) > 0
    code = np.cumsum(found).astype(np.uint64)[data]
    width = int(found.sum()).bit_length()
    n_symbols = max(1, (64 - int(bits)) // width)
    keys = np.zeros(len(data), np.uint64)
    for k in range(n_symbols):
        keys <<= np.uint64(width)
        keys[: max(0, len(data) - k)] |= np.where(room[: max(0, len(data) - k)] > k, code[k:], np.uint64(0))
    return n_symbols, keys


def _sorted(keys: np.ndarray, at: np.ndarray, bits: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Both by the keys. A key and its position are sorted as one number where they fit into one."""
    if len(keys) and int(keys.max()).bit_length() + int(bits) <= 64:
        both = keys << bits | at.astype(np.uint64)
        both.sort()
        return both >> bits, (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    return keys[order], at[order]


def _group_starts(keys: np.ndarray) -> np.ndarray:
    """For each of sorted keys, where its equal ones begin."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))


def common_prefixes(data: np.ndarray, sizes: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """How many bytes, at most `most`, each suffix of `order` shares with the one before it; 0 for the first.

    By Kasai's rule: where a suffix shares n bytes with its neighbour, the one a byte further on shares
    at least n - 1 with its own. All strings are gone through at once, from their first byte to their last.
    """
    n = len(data)
    ends = np.cumsum(sizes)
    room = np.repeat(ends, sizes) - np.arange(n)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    eight = words(data)
    at = (ends - sizes)[sizes > 0]
    length = np.zeros(len(at), np.int64)
    while len(at):
        other = before[at]
        upto = np.where(other < 0, 0, np.minimum(np.minimum(room[at], room[other]), most))
        length = np.minimum(np.maximum(length - 1, 0), upto)
        going = np.flatnonzero(length < upto)
        while len(going):
            differ = eight[at[going] + length[going]] ^ eight[other[going] + length[going]]
            same = differ == 0
            part = np.full(len(going), WORD)
            low_bit = differ[~same] & (~differ[~same] + np.uint64(1))
            part[~same] = np.log2(low_bit.astype(np.float64)).astype(np.int64) >> 3
            length[going] = np.minimum(length[going] + part, upto[going])
            going = going[same & (length[going] < upto[going])]
        shared[at] = length
        still = room[at] > 1
        at, length = at[still] + 1, length[still]
    return shared[order]
