"""A context-mixing range coder of 16-bit ids: many independent blocks are coded side by side, one id of each a step.

Three predictions of the next id are mixed. Orders 2 and 1 name the id that last
followed the same two ids, or the same one; how often they were right lately, by
how often in a row that entry was, is their chance. The rest goes to order 0: ids
in groups of 16, with a prior that falls with the id, as vocabularies are sorted
by frequency, plus the block's counts; in a group, the id seen last has more than
half. A range coder writes each choice. Every block starts afresh and carries a
checksum, so any block can be read by itself.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids in a block, and blocks coded side by side at most (about 40 KB of state each).
BLOCK = 4096
LANES = 2000
HEAD = struct.Struct("<III")  # ids, words of 32 bits, crc32 of the ids

SLOTS = 1 << 12  # entries of the tables of orders 1 and 2
SCALE = 15  # bits of the choice between the orders
WEIGHT = 48  # what one occurrence adds to an id's prior
TRUST = 9  # entries' states: 0 for none, then by hits in a row

GROUP = 4  # bits of an id that its group leaves open
BITS = 16 - GROUP
UNITS = 2 << GROUP  # shares of a group: 2 for each id, or 1 and the rest for the one seen last
NONE = 255

_groups = np.arange(1 << BITS)
_prior = 1 + (60_000 >> GROUP) // (_groups + 4)
PRIOR = int(_prior.sum())
_sums = np.concatenate([[0], np.cumsum(_prior)])
#: For each node of the binary tree over groups (root 1), the prior of its lower half.
LOWER = np.zeros(1 << BITS, np.int32)
for _k in range(BITS):
    _first = np.arange(1 << _k) << (BITS - _k)
    LOWER[1 << _k : 2 << _k] = _sums[_first + (1 << (BITS - 1 - _k))] - _sums[_first]
LEVELS = np.arange(BITS, dtype=np.int32)
DEEPER = (LEVELS > np.arange(-1, BITS, dtype=np.int32)[:, None]).astype(np.int32)  # by last level: the levels after it
FIRST = np.int32(1) << LEVELS
#: For each group the last level at which its path goes to the lower half, or -1.
LAST_LOWER = np.full(1 << BITS, -1, np.int8)
for _k in range(BITS):
    LAST_LOWER[(_groups >> (BITS - 1 - _k) & 1) == 0] = _k
LOW32 = np.uint64(0xFFFFFFFF)
B32 = np.uint64(32)


class _Model:
    """The predictions of ``lanes`` blocks."""

    def __init__(self, lanes: int) -> None:
        self.lane = np.arange(lanes)
        self.tables = [np.zeros(lanes * SLOTS, np.uint32) for _ in range(2)]  # an entry: its state, then 16 bits of id
        start = np.minimum(4000, 500 + 500 * np.arange(TRUST)).astype(np.int32)
        self.chances = [np.tile(start, lanes) for _ in range(2)]
        self.counts = np.zeros(lanes << BITS, np.int16)  # how often a path went to a node's lower half
        self.last = np.full(lanes << BITS, NONE, np.uint8)  # the id of a group that was seen last
        self.seen = np.zeros(lanes, np.int64)
        self.before = [np.zeros(lanes, np.int64) for _ in range(2)]

    def shares(self, m: int) -> tuple[np.ndarray, ...]:
        """For the first ``m`` lanes: ids that orders 2 and 1 name, and their shares of 2^SCALE."""
        lane, one, two = self.lane[:m], self.before[0][:m], self.before[1][:m]
        self.at = [
            lane * SLOTS + (((two * 0x9E3779B1 + one * 0x85EBCA6B) >> 9) & (SLOTS - 1)),
            lane * SLOTS + (((one * 0x9E3779B1) >> 9) & (SLOTS - 1)),
        ]
        entries = [table.take(at) for table, at in zip(self.tables, self.at, strict=True)]
        self.named = [(e & 0xFFFF).astype(np.int32) for e in entries]
        self.trust = [(e >> 16).astype(np.int32) for e in entries]
        self.cell = [lane * TRUST + t for t in self.trust]
        self.chance = [c.take(cell) for c, cell in zip(self.chances, self.cell, strict=True)]
        share2 = np.where(self.trust[0] > 0, self.chance[0] << (SCALE - 12), 0)
        share1 = np.where(self.trust[1] > 0, ((1 << SCALE) - share2) * self.chance[1] >> 12, 0)
        same = (self.named[0] == self.named[1]) & (self.trust[0] > 0)
        share2 = np.where(same, share2 + share1, share2)
        return self.named[0], self.named[1], share2, np.where(same, 0, share1)

    def learn(self, ids: np.ndarray) -> None:
        """Moves the first lanes on by one id each."""
        m = len(ids)
        for k in range(2):
            hit = (self.named[k] == ids) & (self.trust[k] > 0)
            goal = np.where(hit, 4032, 48)
            self.chances[k][self.cell[k]] += ((goal - self.chance[k]) >> 4).astype(np.int32)
            state = np.where(hit, np.minimum(self.trust[k] + 1, TRUST - 1), 1)
            self.tables[k][self.at[k]] = (state << 16) + ids
        self.before[1][:m] = self.before[0][:m]
        self.before[0][:m] = ids

    def _path(self, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of each group's path, and whether it goes to the upper half there."""
        nodes = groups[:, None] >> (BITS - LEVELS)
        nodes += FIRST
        return nodes, groups[:, None] >> (BITS - 1 - LEVELS) & 1

    def _count(self, lanes: np.ndarray, nodes: np.ndarray, upper: np.ndarray, groups, own_ids: np.ndarray) -> None:
        """Adds one to the lower halves gone to; ``nodes`` are numbered by lane."""
        self.counts[nodes] += (1 - upper).astype(np.int16)
        self.last[(lanes << BITS) + groups] = own_ids
        self.seen[lanes] += 1

    def span(self, lanes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order 0: weight of all smaller ids, and the id's own; counts the ids."""
        ids = ids.astype(np.int32)
        groups, own_ids = ids >> GROUP, ids & ((1 << GROUP) - 1)
        nodes, upper = self._path(groups)
        lower = LOWER.take(nodes)
        nodes += (lanes << BITS).astype(np.int32)[:, None]
        lower += self.counts.take(nodes) * np.int32(WEIGHT)
        last = LAST_LOWER.take(groups)
        whole = np.where(last >= 0, lower[np.arange(len(ids)), last], self.total(lanes))
        own = whole - np.einsum("ij,ij->i", lower, DEEPER.take(last + 1, axis=0))
        below = np.einsum("ij,ij->i", lower, upper)
        before, share = self._share(self.last[(lanes << BITS) + groups].astype(np.int32), own_ids)
        self._count(lanes, nodes, upper, groups, own_ids)
        return below * np.int64(UNITS) + before * own, share * own

    @staticmethod
    def _share(last: np.ndarray, own_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units of a group before an id, and its own."""
        most = UNITS - (1 << GROUP)  # what the last id has beside its one unit
        fresh = last == NONE
        before = np.where(fresh, 2 * own_ids, own_ids + most * (own_ids > last))
        return before, np.where(fresh, 2, 1 + most * (own_ids == last))

    def total(self, lanes: np.ndarray) -> np.ndarray:
        return PRIOR + WEIGHT * self.seen[lanes]

    def find(self, lanes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose spans hold ``at``, with these spans as ``span`` gives them; counts the ids."""
        node, units = np.ones(len(lanes), np.int32), at.astype(np.int32)
        rest, own = units // UNITS, self.total(lanes).astype(np.int32)
        start, base = rest.copy(), (lanes << BITS).astype(np.int32)
        for _ in range(BITS):
            lower = self.counts.take(base + node) * np.int32(WEIGHT)
            lower += LOWER.take(node)
            upper = rest >= lower
            rest -= lower * upper
            own = np.where(upper, own - lower, lower)
            node += node + upper
        groups = node - np.int32(1 << BITS)
        below = (start - rest) * np.int64(UNITS)
        unit = ((units - below) // own).astype(np.int32)
        last, most = self.last[base + groups].astype(np.int32), UNITS - (1 << GROUP)
        own_ids = np.where(unit < last, unit, np.where(unit <= last + most, last, unit - most))
        own_ids = np.where(last == NONE, unit >> 1, own_ids)
        before, share = self._share(last, own_ids)
        nodes, upper = self._path(groups)
        nodes += base[:, None]
        self._count(lanes, nodes, upper, groups, own_ids)
        return (groups << GROUP) + own_ids, below + before * own, share * own


class _Range:
    """Low ends and widths of the lanes' ranges; 32 bits leave a range when it is narrower than that."""

    def __init__(self, lanes: int) -> None:
        self.low = np.zeros(lanes, np.uint64)
        self.width = np.full(lanes, np.uint64(0xFFFFFFFFFFFFFFFF))

    def narrow(self, lanes, step: np.ndarray, below: np.ndarray, own: np.ndarray) -> None:
        self.low[lanes] += step * below.astype(np.uint64)
        self.width[lanes] = step * own.astype(np.uint64)

    def shift(self, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lanes that give up a word, and the words; a range that lies across a word's border is cut there first."""
        out = lanes[self.width[lanes] <= LOW32]
        low, width = self.low[out], self.width[out]
        across = (low ^ (low + width - np.uint64(1))) >> B32 != 0
        self.width[out] = np.where(across, (LOW32 + np.uint64(1)) - (low & LOW32), width) << B32
        self.low[out] = low << B32
        return out, low >> B32


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """``ids`` (below 2^16) as blocks, one after the other."""
    ids = np.asarray(ids).astype("<u2")
    count = -(-len(ids) // block)
    side = _side(count)
    return b"".join(
        _encode_lanes(ids[first * block : (first + side) * block], block) for first in range(0, count, side)
    )


def _side(count: int) -> int:
    """Blocks to code side by side, so that all groups are about as large."""
    return max(1, -(-count // max(1, -(-count // LANES))))


def _encode_lanes(ids: np.ndarray, block: int) -> bytes:
    lanes = -(-len(ids) // block)
    sizes = np.minimum(block, len(ids) - block * np.arange(lanes))
    model, coder = _Model(lanes), _Range(lanes)
    written: list[tuple[np.ndarray, np.ndarray]] = []

    def flush(where: np.ndarray) -> None:
        out, word = coder.shift(where)
        if len(out):
            written.append((out.astype(np.int32), word.astype("<u4")))

    for t in range(int(sizes[0])):
        m = lanes if t < sizes[-1] else lanes - 1  # only the last block is shorter
        now, all_lanes = ids[t : t + (m - 1) * block + 1 : block].astype(np.int64), model.lane[:m]
        two, one, share2, share1 = model.shares(m)
        hit2 = (two == now) & (share2 > 0)
        hit1 = (one == now) & (share1 > 0) & ~hit2
        rest = share2 + share1
        below = np.where(hit2, 0, np.where(hit1, share2, rest))
        own = np.where(hit2, share2, np.where(hit1, share1, (1 << SCALE) - rest))
        coder.narrow(slice(0, m), coder.width[:m] >> np.uint64(SCALE), below, own)
        flush(all_lanes)
        miss = np.flatnonzero(~hit2 & ~hit1)
        if len(miss):
            total = (UNITS * model.total(miss)).astype(np.uint64)
            below, own = model.span(miss, now[miss])
            coder.narrow(miss, coder.width[miss] // total, below, own)
            flush(miss)
        model.learn(now)
    written += [(model.lane.astype(np.int32), half.astype("<u4")) for half in (coder.low >> B32, coder.low & LOW32)]
    of_lane = np.concatenate([lane for lane, _ in written])
    words = np.concatenate([word for _, word in written])[np.argsort(of_lane, kind="stable")]
    ends = np.cumsum(np.bincount(of_lane, minlength=lanes))
    out, first = [], 0
    for i, (n, end) in enumerate(zip(sizes.tolist(), ends.tolist(), strict=True)):
        raw = ids[i * block : i * block + n].tobytes()
        out += [HEAD.pack(n, end - first, zlib.crc32(raw)), words[first:end].tobytes()]
        first = end
    return b"".join(out)


def decode(data: bytes) -> np.ndarray:
    """The ids of all blocks of ``data``; a block that is cut off or fails its checksum raises ValueError."""
    blocks, at = [], 0
    while at < len(data):
        if len(data) - at < HEAD.size:
            raise ValueError("a block is cut off")
        n, used, crc = HEAD.unpack_from(data, at)
        at += HEAD.size
        if n > 1 << 24 or len(data) - at < 4 * used or used < 2:
            raise ValueError("a block is cut off")
        blocks.append((n, crc, np.frombuffer(data, "<u4", used, at)))
        at += 4 * used
    out: list[np.ndarray] = []
    side = _side(len(blocks))
    for first in range(0, len(blocks), side):
        out += _decode_lanes(blocks[first : first + side])
    return np.concatenate(out) if out else np.zeros(0, "<u2")


def _decode_lanes(blocks: list[tuple[int, int, np.ndarray]]) -> list[np.ndarray]:
    order = sorted(range(len(blocks)), key=lambda i: -blocks[i][0])
    sizes = np.array([blocks[i][0] for i in order])
    lanes = len(blocks)
    words = np.zeros((lanes, max(len(w) for _, _, w in blocks) + 1), np.uint64)
    for k, i in enumerate(order):
        words[k, : len(blocks[i][2])] = blocks[i][2]
    model, coder = _Model(lanes), _Range(lanes)
    code = words[:, 0] << B32 | words[:, 1]
    used = np.full(lanes, 2)
    ids = np.zeros((lanes, int(sizes.max(initial=0))), "<u2")

    def fill(where: np.ndarray) -> None:
        out, _ = coder.shift(where)
        code[out] = code[out] << B32 | words[out, np.minimum(used[out], words.shape[1] - 1)]
        used[out] += 1

    for t in range(ids.shape[1]):
        m = int(np.searchsorted(-sizes, -t, "left"))  # blocks with more than t ids
        two, one, share2, share1 = model.shares(m)
        step = coder.width[:m] >> np.uint64(SCALE)
        at = np.minimum((code[:m] - coder.low[:m]) // step, np.uint64((1 << SCALE) - 1)).astype(np.int64)
        rest = share2 + share1
        hit2, hit1 = at < share2, (at >= share2) & (at < rest)
        below = np.where(hit2, 0, np.where(hit1, share2, rest))
        own = np.where(hit2, share2, np.where(hit1, share1, (1 << SCALE) - rest))
        coder.narrow(slice(0, m), step, below, own)
        fill(model.lane[:m])
        now = np.where(hit2, two, one).astype(np.int64)
        miss = np.flatnonzero(~hit2 & ~hit1)
        if len(miss):
            total = UNITS * model.total(miss)
            step = coder.width[miss] // total.astype(np.uint64)
            at = np.minimum((code[miss] - coder.low[miss]) // step, total.astype(np.uint64) - np.uint64(1))
            now[miss], below, own = model.find(miss, at)
            coder.narrow(miss, step, below, own)
            fill(miss)
        model.learn(now)
        ids[:m, t] = now
    out: list = [None] * lanes
    for k, i in enumerate(order):
        out[i] = ids[k, : sizes[k]]
        if zlib.crc32(out[i].tobytes()) != blocks[i][1]:
            raise ValueError("a block fails its checksum")
    return out
