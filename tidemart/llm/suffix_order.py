"""Repeated substrings of many byte strings at once, by suffix order (numpy alone)."""

from __future__ import annotations

import numpy as np


def _classes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted order of the keys (equal ones in their own order), and for each place in it whether the key equals
    that of the place before, and a class number."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.concatenate([[False], ordered[1:] == ordered[:-1]]) if len(keys) else np.zeros(0, dtype=bool)
    return order, same, np.cumsum(~same)


def suffix_runs(strings: list[bytes], length: int, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the joined strings in suffix order, cut off after ``length`` bytes, ties by position.

    Only positions whose first ``length`` bytes lie in one string and occur again are given. The second
    array tells for each whether it agrees with the one before it over ``length`` bytes; so a run of True
    after a False is one repeated string, its positions ascending.

    Built by doubling: ranks by 8 bytes, then by pairs of ranks for 16, 32, ... and at last ``length``
    bytes. A position whose rank no other has is out of the later rounds. Strings of symbols of ``width``
    bytes have positions at whole symbols alone.
    """
    if length < 8:
        raise ValueError("repeats of fewer than 8 bytes are not looked for")
    data = np.frombuffer(b"".join(strings) + bytes(8), dtype=np.uint8)
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    alive = np.arange(0, len(ends), width)
    alive = alive[ends[alive] - alive >= 8]
    keys = np.zeros(len(alive), dtype=np.uint64)
    for i in range(8):
        keys = (keys << np.uint64(8)) | data[alive + i]
    reach, order, same = 8, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    while True:
        order, same, number = _classes(keys)
        shared = same | np.concatenate([same[1:], [False]]) if len(same) else same
        positions = alive[order][shared]
        if reach == length or not len(positions):
            return positions, same[shared]
        ranks = np.full(len(ends) + 1, -1, dtype=np.int64)
        ranks[positions] = number[shared]
        target = min(2 * reach, length)
        alive = np.sort(positions)
        alive = alive[ends[alive] - alive >= target]
        after = ranks[alive + target - reach]
        alive, after = alive[after >= 0], after[after >= 0]
        keys = ranks[alive] * (len(ends) + 1) + after
        reach = target


def previous_smaller(order: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it that holds a smaller value, -1 for none. The values differ.

    Between a place and its candidate all values are larger; a candidate that is larger too hands on its own, so
    the way back doubles from round to round.
    """
    before = np.arange(len(order)) - 1
    open_ = np.flatnonzero((before >= 0) & (order[before] > order)) if len(order) else before
    while len(open_):
        before[open_] = before[before[open_]]
        at = before[open_]
        open_ = open_[(at >= 0) & (order[at] > order[open_])]
    return before


def previous_and_next_smaller(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place in suffix order the nearest places before and after it that hold an earlier position; -1 for none."""
    after = len(order) - 1 - previous_smaller(order[::-1])[::-1]
    return previous_smaller(order), np.where(after == len(order), -1, after)


def longest_previous_factors(order: np.ndarray, same: np.ndarray, length: int) -> np.ndarray:
    """For each place in suffix order how far its suffix agrees with one at an earlier position, cut off at ``length``:
    ``length``, or 0 for anything below.

    The longest such agreement is with the previous or the next smaller position (Crochemore and Ilie, 2008). Two places agree
    over ``length`` if they are in one run of ``same``.
    """
    run = np.cumsum(~same)
    out = np.zeros(len(order), dtype=np.int64)
    for near in previous_and_next_smaller(order):
        out[(near >= 0) & (run[near] == run)] = length
    return out


def repeats(strings: list[bytes], length: int, width: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """For every position of the joined strings: whether its ``length`` bytes occur at an earlier position (its
    longest previous factor reaches ``length``), and whether they occur at any other."""
    total = sum(len(s) for s in strings)
    order, same = suffix_runs(strings, length, width)
    earlier, anywhere = np.zeros(total, dtype=bool), np.zeros(total, dtype=bool)
    earlier[order[longest_previous_factors(order, same, length) >= length]] = True
    anywhere[order] = True
    return earlier, anywhere
