"""A hierarchical index over 64-bit codes in Gray order (numpy).

Codes that follow one another in Gray order share most of their bits. A node
keeps the bits on which all codes below it agree, as a mask and a pattern,
less the bits its parent already holds. A search walks down with the
differences counted so far and drops a whole group once they exceed the limit.
"""

from __future__ import annotations

import numpy as np

FAN_OUT = 16


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


class GrayIndex:
    """Index over entries (mask, pattern) given in Gray order; plain codes
    have all mask bits set."""

    def __init__(self, masks: np.ndarray, patterns: np.ndarray, fan_out: int = FAN_OUT):
        self.fan_out = fan_out
        levels = [(masks.astype(np.uint64), patterns.astype(np.uint64) & masks.astype(np.uint64))]
        while len(levels[0][0]) > fan_out:
            mask, pattern = levels[0]
            starts = np.arange(0, len(mask), fan_out)
            ones = np.bitwise_and.reduceat(pattern, starts)
            any_one = np.bitwise_or.reduceat(pattern, starts)
            shared = np.bitwise_and.reduceat(mask, starts) & ~(ones ^ any_one)
            levels.insert(0, (shared, ones & shared))
        # what a level checks: the bits its parents have not checked yet
        self.levels = [levels[0]]
        for (upper, _), (mask, pattern) in zip(levels, levels[1:]):
            held = np.repeat(upper, fan_out)[: len(mask)]
            self.levels.append((mask & ~held, pattern))

    def search(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query position, entry position) of all pairs that differ in at
        most ``limit`` of the entry's masked bits."""
        top = len(self.levels[0][0])
        who = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        spent = np.zeros(len(who), np.uint8)
        for depth, (mask, pattern) in enumerate(self.levels):
            if depth:
                who = np.repeat(who, self.fan_out)
                spent = np.repeat(spent, self.fan_out)
                node = (node[:, None] * self.fan_out + np.arange(self.fan_out)).ravel()
                real = node < len(mask)
                who, spent, node = who[real], spent[real], node[real]
            spent = spent + np.bitwise_count((queries[who] ^ pattern[node]) & mask[node])
            near = spent <= limit
            who, spent, node = who[near], spent[near], node[near]
        return who, node
