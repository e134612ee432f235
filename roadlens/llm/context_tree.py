"""Context-tree weighting over bytes: Krichevsky-Trofimov estimates of all context depths, mixed.

A byte is eight binary decisions. Each decision has a tree of contexts: the last
0 to DEPTH bytes. A node's weight is half its own estimate and half the product
of its children's, on the training counts; that says how far each depth is
trusted. ``ContextTree`` builds the whole tree in one process and takes counts that
leave grams out: a node's unlisted children count together as one more child.
``partial_weights``, ``Top`` and ``log_chances_below`` build the same tree of all grams in
parts that each hold the contexts of one last CUT bytes or more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH = 5
#: Nodes with fewer context bytes are the top of the tree, at most 256^CUT grams whatever the corpus; a part is below it.
CUT = 3
#: Byte that stands before and after a text; UTF-8 never holds it.
EDGE = b"\xff"
EMPTY = np.uint64(0)


def text_bytes(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(depth + 1)-grams that end at each byte of each text and at one EDGE after it; where each text starts, its size."""
    joined = EDGE * depth + b"".join([t + EDGE * depth for t in texts])
    flat = np.frombuffer(joined, np.uint8)
    total = np.zeros(len(flat) - depth, np.uint64)
    for k in range(depth + 1):
        total = (total << np.uint64(8)) | flat[k : k + len(total)]
    sizes = np.array([len(t) + 1 for t in texts])
    begins = np.cumsum([0, *[len(t) + depth for t in texts[:-1]]])
    starts = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(begins - starts, sizes)
    return total[at], starts, sizes


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, from 8 up."""
    x = x.astype(float)
    less = np.zeros(len(x))
    for _ in range(8):
        low = x < 8
        less[low] -= np.log(x[low])
        x = np.where(low, x + 1, x)
    return less + (x - 0.5) * np.log(x) - x + 0.9189385332046727 + (1 / 12 - (1 / 360 - 1 / (1260 * x * x)) / (x * x)) / x


_SMALL = 1 << 12
_HALVES, _WHOLES = _log_gamma(np.arange(_SMALL) + 0.5), _log_gamma(np.arange(_SMALL) + 1.0)


def _shifted_log_gamma(n: np.ndarray, shift: float, small: np.ndarray) -> np.ndarray:
    """Log of gamma(n + shift) of whole n, from ``small`` where it holds it."""
    out = small[np.minimum(n, _SMALL - 1).astype(np.int64)]
    large = np.flatnonzero(n >= _SMALL)
    out[large] = _log_gamma(n[large] + shift)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones, in any order."""
    half = np.log(np.pi)  # twice the log of gamma(1/2)
    both = _shifted_log_gamma(zeros, 0.5, _HALVES) + _shifted_log_gamma(ones, 0.5, _HALVES)
    return both - half - _shifted_log_gamma(zeros + ones, 1.0, _WHOLES)


class Table:
    """A fixed hash table from 64-bit keys above 0 to floats; looks up arrays of keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        slots = 1 << max(4, int(1.4 * len(keys)).bit_length())
        self.keys, self.values = np.zeros(slots, np.uint64), np.zeros(slots, np.float32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[at[left]] == EMPTY
            self.keys[at[left[free]]] = keys[left[free]]  # of several on one slot, the last stays
            own = self.keys[at[left]] == keys[left]
            self.values[at[left[own]]] = values[left[own]]
            left = left[~own]
            at[left] = (at[left] + 1) & (slots - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - (len(self.keys) - 1).bit_length())).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values; NaN for keys that are not held."""
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], np.float32(np.nan))
        left = np.flatnonzero((held != keys) & (held != EMPTY))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            held = self.keys[at[left]]
            found = held == keys[left]
            out[left[found]] = self.values[at[left[found]]]
            left = left[~found & (held != EMPTY)]
        return out


class ContextTree:
    """Chances from counts of grams: ``counts[d]`` is (grams of d context bytes and the next byte, counts)."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.depth = len(counts) - 1
        nodes = [[self._nodes(g, n, d, i) for i in range(8)] for d, (g, n) in enumerate(counts)]
        keys, chances = [], []
        for i in range(8):
            weighed: list = [None] * (self.depth + 1)
            for d in range(self.depth, -1, -1):  # from the longest contexts up: how much each node is trusted
                key, zeros, ones = nodes[d][i]
                own = log_kt(zeros, ones)
                if d == self.depth or not len(nodes[d + 1][i][0]):
                    weighed[d] = (own, np.ones(len(key)), np.full(len(key), 0.5))
                    continue
                child, child_zeros, child_ones = nodes[d + 1][i]
                up = np.searchsorted(key, child & np.uint64((1 << (8 * d + i)) - 1))
                below, rest0, rest1 = np.zeros(len(key)), zeros.astype(float), ones.astype(float)
                np.add.at(below, up, weighed[d + 1][0])
                np.add.at(rest0, up, -child_zeros.astype(float))
                np.add.at(rest1, up, -child_ones.astype(float))
                rest0, rest1 = np.maximum(rest0, 0), np.maximum(rest1, 0)
                below += log_kt(rest0, rest1)
                total = np.logaddexp(own, below)
                kt = (ones + 0.5) / (zeros + ones + 1)
                rest = np.where(rest0 + rest1 > 0, (rest1 + 0.5) / (rest0 + rest1 + 1), kt)
                weighed[d] = (total + np.log(0.5), np.exp(own - total), rest)
            mixed, left = np.zeros(0), np.ones(0)
            for d in range(self.depth + 1):  # from the shortest contexts down: chances of a 1, mixed over depths
                key, zeros, ones = nodes[d][i]
                if d:
                    up = np.searchsorted(nodes[d - 1][i][0], key & np.uint64((1 << (8 * d - 8 + i)) - 1))
                    mixed, left = mixed[up], left[up]
                else:
                    mixed, left = np.zeros(len(key)), np.ones(len(key))
                _, trust, rest = weighed[d]
                mixed = mixed + left * trust * (ones + 0.5) / (zeros + ones + 1)
                left = left * (1 - trust)
                keys.append(key | np.uint64(1 << (8 * d + i)))
                chances.append(mixed + left * rest)
        self.table = Table(np.concatenate(keys), np.concatenate(chances).astype(np.float32))
        grams = counts[-1][0]
        self.whole = Table(grams + np.uint64(1), self._bits(grams).astype(np.float32))

    @staticmethod
    def _nodes(grams: np.ndarray, n: np.ndarray, d: int, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per context of d bytes and i bits of the next: how often a 0 and a 1 follow."""
        key, at = np.unique(grams >> np.uint64(8 - i), return_inverse=True)
        ones = (grams >> np.uint64(7 - i) & np.uint64(1)).astype(bool)
        return key, np.bincount(at[~ones], n[~ones], len(key)), np.bincount(at[ones], n[ones], len(key))

    def _bits(self, grams: np.ndarray) -> np.ndarray:
        """Natural log of each gram's last byte's chance after the others, bit by bit."""
        total, depth = np.zeros(len(grams)), np.full(len(grams), self.depth)
        for i in range(8):
            chance, left = np.full(len(grams), 0.5), np.arange(len(grams))
            while len(left):  # the longest listed context of each; with more bits known it only gets shorter
                bits = (8 * depth[left] + i).astype(np.uint64)
                one = np.uint64(1) << bits
                got = self.table.get((grams[left] >> np.uint64(8 - i) & (one - np.uint64(1))) | one)
                known = ~np.isnan(got)
                chance[left[known]] = got[known]
                left = left[~known]
                depth[left] -= 1
                left = left[depth[left] >= 0]
            depth = np.maximum(depth, 0)
            bit = (grams >> np.uint64(7 - i) & np.uint64(1)).astype(bool)
            total += np.log(np.where(bit, chance, 1 - chance))
        return total

    def log_chances(self, grams: np.ndarray) -> np.ndarray:
        """Natural log of the chance of each gram's last byte after the others."""
        out = self.whole.get(grams + np.uint64(1)).astype(float)
        rare = np.flatnonzero(np.isnan(out))
        if len(rare):
            found, back = np.unique(grams[rare], return_inverse=True)
            out[rare] = self._bits(found)[back]
        return out


@dataclass
class _Level:
    """Nodes of one depth: keys, what follows them, how far each is trusted, its log weight, its place in the level above."""

    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    trust: np.ndarray
    weight: np.ndarray
    up: np.ndarray

    @property
    def one(self) -> np.ndarray:
        return (self.ones + 0.5) / (self.zeros + self.ones + 1)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _levels(grams: np.ndarray, n: np.ndarray, i: int, high: int, low: int, below=None) -> tuple[list[_Level], np.ndarray]:
    """Levels of depth ``high`` to ``low`` for bit ``i`` of the next byte, and each gram's node in the first.

    ``grams`` are of ``high`` context bytes and the next; ``below`` gives the summed log weights of the children of
    the nodes of depth ``high``, which are leaves without it.
    """
    key, at = np.unique(grams >> np.uint64(8 - i), return_inverse=True)
    one = (grams >> np.uint64(7 - i) & np.uint64(1)).astype(bool)
    zeros, ones = np.bincount(at[~one], n[~one], len(key)), np.bincount(at[one], n[one], len(key))
    under = below(key) if below else None
    out = []
    for d in range(high, low - 1, -1):
        own = log_kt(zeros, ones)
        total = own if under is None else np.logaddexp(own, under)
        weight = own if under is None else total + np.log(0.5)
        parents, up = np.unique(key & _mask(8 * max(d - 1, 0) + i), return_inverse=True)
        out.append(_Level(key, zeros, ones, np.exp(own - total), weight, up))
        under = np.bincount(up, weight, len(parents))
        key, zeros, ones = parents, np.bincount(up, zeros, len(parents)), np.bincount(up, ones, len(parents))
    return out, at


def partial_weights(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of nodes of depth CUT - 1, and log weights summed over those of their children that ``grams`` hold whole."""
    keys, sums = [], []
    for i in range(8):
        last = _levels(grams, n, i, DEPTH, CUT)[0][-1]
        bits = 8 * (CUT - 1) + i
        key, up = np.unique(last.key & _mask(bits), return_inverse=True)
        keys.append(key | np.uint64(1 << bits))
        sums.append(np.bincount(up, last.weight, len(key)))
    return np.concatenate(keys), np.concatenate(sums)


class Top:
    """Nodes of less than CUT context bytes: chances of a 1, and what mixing has come to, by sorted keys."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, keys: np.ndarray, sums: np.ndarray) -> None:
        order = np.argsort(keys)
        keys, sums = keys[order], sums[order]
        found: list[tuple] = []
        for i in range(8):
            marker = np.uint64(1 << (8 * (CUT - 1) + i))
            levels, _ = _levels(
                grams, n, i, CUT - 1, 0, lambda key, m=marker: sums[np.searchsorted(keys, key | m)] if len(keys) else np.zeros(0)
            )
            mixed, left = np.zeros(1), np.ones(1)
            for d, level in enumerate(reversed(levels)):
                up = level.up if d else np.zeros(len(level.key), np.int64)
                mixed, left = mixed[up], left[up]
                chance = mixed + left * level.one
                mixed, left = mixed + left * level.trust * level.one, left * (1 - level.trust)
                found.append((level.key | np.uint64(1 << (8 * d + i)), chance, mixed, left))
        key, *values = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(key)
        self.key, self.chance, self.mixed, self.left = key[order], *(v[order] for v in values)

    def get(self, key: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For nodes of depth CUT - 1: the chance of a 1 at the longest context seen, and mixture and rest where seen."""
        chance, mixed, left = np.full(len(key), 0.5), np.zeros(len(key)), np.zeros(len(key))
        for d in range(CUT):
            marked = key & _mask(8 * d + i) | np.uint64(1 << (8 * d + i))
            at = np.minimum(np.searchsorted(self.key, marked), len(self.key) - 1)
            held = np.flatnonzero(self.key[at] == marked) if len(self.key) else np.zeros(0, np.int64)
            chance[held], mixed[held], left[held] = self.chance[at[held]], self.mixed[at[held]], self.left[at[held]]
        return chance, mixed, left


def log_chances_below(grams: np.ndarray, n: np.ndarray, top: Top) -> np.ndarray:
    """Natural log of the chance of each gram's last byte after the others.

    ``grams`` hold all that was counted after any last CUT bytes that they hold; a count of 0 asks for a gram that was
    not seen. There, bit by bit, the longest context seen decides.
    """
    total = np.zeros(len(grams))
    for i in range(8):
        levels, at = _levels(grams, n, i, DEPTH, CUT)
        first = levels[-1]
        chance, mixed, left = top.get(first.key & _mask(8 * (CUT - 1) + i), i)
        for k, level in enumerate(reversed(levels)):
            if k:
                chance, mixed, left = chance[level.up], mixed[level.up], left[level.up]
            chance = np.where(level.zeros + level.ones > 0, mixed + left * level.one, chance)
            mixed, left = mixed + left * level.trust * level.one, left * (1 - level.trust)
        one = (grams >> np.uint64(7 - i) & np.uint64(1)).astype(bool)
        total += np.log(np.where(one, chance[at], 1 - chance[at]))
    return total
