"""Counting in a HAT-trie: burstable hash containers under a shallow trie of word ids.

A phrase is a number, (id of its first words) * width + (id of its last word), with ids in a common
order, so the path from the root is the phrase's begin and a subtree is a range of numbers.  A
subtree with few phrases is one hash container; a container that outgrows BURST phrases bursts
into FANOUT containers below it, by the first words while its range holds several, then by
the last.  When the trie as a whole outgrows its memory, the largest subtree below the root leaves
it as a sorted run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BURST = 1 << 14          # phrases of a container
FANOUT = 16              # containers that a burst makes
MOST = 1 << 21           # phrases of a trie
CHUNK = 1 << 18          # occurrences that are added at a time
FREE = -1
MIX = np.uint64(0x9E3779B97F4A7C15)


class Container:
    """Open addressing; keys of one call are different from each other."""

    def __init__(self):
        self._empty(10)

    def _empty(self, bits: int) -> None:
        self.bits, self.used = bits, 0
        self.keys, self.counts = np.full(1 << bits, FREE, np.int64), np.zeros(1 << bits, np.int64)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        on = self.keys != FREE
        return self.keys[on], self.counts[on]

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        bits = self.bits
        while 2 * (self.used + len(keys)) > 1 << bits:
            bits += 1
        if bits > self.bits:
            old = self.items()
            self._empty(bits)
            self._put(*old)
        self._put(keys, n)

    def _put(self, keys: np.ndarray, n: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            at = (keys.view(np.uint64) * MIX >> np.uint64(64 - self.bits)).view(np.int64)
        while len(keys):
            here = self.keys[at]
            free = here == FREE
            if free.any():
                self.keys[at[free]] = keys[free]     # of several keys one gets the place
                here = self.keys[at]
                self.used += int((here == keys)[free].sum())
            found = here == keys
            self.counts[at[found]] += n[found]
            keys, n, at = keys[~found], n[~found], (at[~found] + 1) & ((1 << self.bits) - 1)


class HatTrie:
    def __init__(self, size: int, width: int, burst: int = BURST, most: int = MOST):
        """``size`` numbers in all; ``width`` of them share their first words."""
        self.width, self.burst, self.most, self.size = max(width, 1), burst, most, max(size, 1)
        self.roots = self._cut(0, self.size)                     # begins of the subtrees below the root
        self.starts = list(self.roots)
        self.leaves = [Container() for _ in self.starts]

    def _cut(self, low: int, high: int) -> list[int]:
        """Begins of up to FANOUT parts of a range, between first words while there are several."""
        step = self.width if high - low > self.width else 1
        parts = -(-(high - low) // step)
        each = -(-parts // FANOUT) * step
        first = low // step * step
        return sorted({low, *(b for b in range(first, high, each) if b > low)})

    def add(self, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Count occurrences; yields the sorted runs (numbers, counts) that memory has no room for."""
        for at in range(0, len(numbers), CHUNK):
            keys, n = np.unique(numbers[at:at + CHUNK], return_counts=True)
            cuts = np.append(np.searchsorted(keys, self.starts), len(keys)).tolist()
            grown = []
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if b > a:
                    self.leaves[i].add(keys[a:b], n[a:b])
                    if self.leaves[i].used > self.burst:
                        grown.append(i)
            for i in reversed(grown):
                self._burst(i)
            while self.entries() > self.most:
                yield self._spill(self._largest())

    def entries(self) -> int:
        return sum(leaf.used for leaf in self.leaves)

    def _end(self, i: int) -> int:
        return self.starts[i + 1] if i + 1 < len(self.starts) else self.size

    def _burst(self, i: int) -> None:
        starts = self._cut(self.starts[i], self._end(i))
        if len(starts) < 2:
            return
        keys, n = self.leaves[i].items()
        part = np.searchsorted(starts, keys, side="right") - 1
        leaves = [Container() for _ in starts]
        for j, leaf in enumerate(leaves):
            leaf.add(keys[part == j], n[part == j])
        self.starts[i:i + 1] = starts
        self.leaves[i:i + 1] = leaves

    def _subtree(self, root: int) -> tuple[int, int]:
        """The leaves of a subtree below the root."""
        low = self.starts.index(self.roots[root])
        high = self.starts.index(self.roots[root + 1]) if root + 1 < len(self.roots) else len(self.starts)
        return low, high

    def _largest(self) -> int:
        sizes = []
        for root in range(len(self.roots)):
            low, high = self._subtree(root)
            sizes.append(sum(leaf.used for leaf in self.leaves[low:high]))
        return int(np.argmax(sizes))

    def _spill(self, root: int) -> tuple[np.ndarray, np.ndarray]:
        """A whole subtree leaves as a sorted run; one empty container stays in its place."""
        low, high = self._subtree(root)
        items = [leaf.items() for leaf in self.leaves[low:high]]
        order = [np.argsort(k) for k, _ in items]
        self.starts[low:high] = [self.roots[root]]
        self.leaves[low:high] = [Container()]
        return (np.concatenate([k[o] for (k, _), o in zip(items, order)]),
                np.concatenate([n[o] for (_, n), o in zip(items, order)]))

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What memory holds, as one sorted run."""
        runs = [self._spill(root) for root in range(len(self.roots))]
        keys, n = np.concatenate([k for k, _ in runs]), np.concatenate([n for _, n in runs])
        if len(keys):
            yield keys, n
