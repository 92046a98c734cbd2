"""Balanced parentheses of a forest, for use inside tasks.

A node is an opening parenthesis, its subtree ends at the matching closing
one. Excess (opened minus closed) is kept with its minimum per block of
``BLOCK`` positions, so a match is found by one block's scan, a scan of block
minima, and one more block.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256


class Parens:
    def __init__(self, bits: np.ndarray):
        """``bits``: 1 opens, 0 closes; balanced."""
        self.bits = bits
        self.excess = np.cumsum(bits.astype(np.int32) * 2 - 1, dtype=np.int32)
        self.opens = np.flatnonzero(bits)
        self.block_min = (np.minimum.reduceat(self.excess, np.arange(0, len(bits), BLOCK)) if len(bits)
                          else np.empty(0, np.int32))
        leaf = np.zeros(len(bits), dtype=bool)
        leaf[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        self.leaf = leaf
        self.leaves_before = np.concatenate(([0], np.cumsum(leaf, dtype=np.int64)))   # rank of "()"
        self.opens_before = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))    # rank of "("

    def findclose(self, i: int) -> int:
        """Position of the parenthesis that closes the one opened at ``i``."""
        goal = self.excess[i] - 1
        end = min(len(self.bits), (i // BLOCK + 1) * BLOCK)
        hit = np.flatnonzero(self.excess[i + 1:end] == goal)
        if len(hit):
            return i + 1 + int(hit[0])
        block = i // BLOCK + 1
        block += int(np.argmax(self.block_min[block:] <= goal))
        return block * BLOCK + int(np.argmax(self.excess[block * BLOCK:(block + 1) * BLOCK] == goal))

    def closes(self) -> np.ndarray:
        """The closing position of every node, in preorder."""
        out = self.opens + 1
        inner = np.flatnonzero(~self.leaf[self.opens])
        out[inner] = [self.findclose(i) for i in self.opens[inner].tolist()]
        return out

    def subtrees(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every node in preorder: the end of its subtree in preorder
        numbers, its leaves, and its parent's preorder number (-1: none)."""
        close = self.closes()
        end = self.opens_before[close]
        leaves = self.leaves_before[close] - self.leaves_before[self.opens]
        parent = np.full(len(self.opens), -1, dtype=np.int64)
        depth = self.excess[self.opens]
        last: dict[int, int] = {}
        for at, d in enumerate(depth.tolist()):
            parent[at] = last.get(d - 1, -1) if d > 1 else -1
            last[d] = at
        return end, leaves, parent
