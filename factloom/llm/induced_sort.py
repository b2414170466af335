"""Suffix order and common prefixes of one shard by induced sorting, with queues that go to disk.

The leftmost suffixes of each ascending run (LMS) are sorted first: their substrings are named, and tied names are
refined by the names that follow, each round over twice the distance, as far as `depth` symbols reach. All other suffixes are induced from
them in two passes: one ascending over the symbols for descending suffixes, one descending for ascending ones. A pass takes what is queued
for a symbol in order and queues each suffix's left neighbour under the neighbour's symbol; queues are read symbol by symbol and keep the order of
arrival, so they are the priority queue of external induced sorting, and spill to disk beyond a bound. Each tuple carries the common prefix
with the tuple before it in its queue: one more than the least common prefix met since that one's source.
Prefixes are exact up to depth symbols and count as depth beyond.
"""

from __future__ import annotations

import tempfile

import numpy as np

SYMBOL_BITS, PACKED = 9, 7  # seven symbols of nine bits in a word
END, GAP, FIRST = 0, 1, 2  # the text's end, the end of a segment, byte 0


class SymbolQueues:
    """First-in first-out queues of (position, common prefix) blocks, one per symbol; the blocks needed last are spilled."""

    def __init__(self, symbols: int, most_bytes: int, ascending: bool):
        self.blocks: list[list] = [[] for _ in range(symbols)]
        self.most, self.held, self.ascending = most_bytes, 0, ascending
        self.file = None

    def push(self, symbol: int, positions: np.ndarray, prefixes: np.ndarray) -> None:
        self.blocks[symbol].append((positions, prefixes))
        self.held += positions.nbytes + prefixes.nbytes
        if self.held > self.most:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        symbols = range(len(self.blocks) - 1, -1, -1) if self.ascending else range(len(self.blocks))
        for s in symbols:
            for i, b in enumerate(self.blocks[s]):
                if isinstance(b[0], np.ndarray):
                    self.file.seek(0, 2)
                    at = self.file.tell()
                    for a in b:
                        self.file.write(a.tobytes())
                    self.held -= b[0].nbytes + b[1].nbytes
                    self.blocks[s][i] = (at, len(b[0]))
            if self.held <= self.most // 2:
                return

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All that waits under the symbol, in order of arrival."""
        if not self.blocks[symbol]:
            return None
        got = []
        for a, b in self.blocks[symbol]:
            if isinstance(a, np.ndarray):
                self.held -= a.nbytes + b.nbytes
                got.append((a, b))
            else:
                self.file.seek(a)
                got.append((np.frombuffer(self.file.read(8 * b), np.int64), np.frombuffer(self.file.read(2 * b), np.int16)))
        self.blocks[symbol] = []
        return (np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])) if len(got) > 1 else got[0]


class Shard:
    """Symbols of a text with, for each place, the next seven packed in a word."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.text, self.depth, self.n = symbols, depth, len(symbols)
        packed = np.zeros(self.n + PACKED, dtype=np.int64)
        for k in range(PACKED):
            packed[: max(0, self.n - k)] |= symbols[k:].astype(np.int64) << SYMBOL_BITS * (PACKED - 1 - k)
        self.packed = packed
        up = symbols[:-1] < symbols[1:]
        differs = np.flatnonzero(symbols[:-1] != symbols[1:])
        self.ascending = np.ones(self.n, dtype=bool)
        following = np.searchsorted(differs, np.arange(self.n - 1))
        self.ascending[:-1] = up[differs[following]]  # the end symbol is unique, so each place has a differing one after it
        self.lms = np.flatnonzero(self.ascending[1:] & ~self.ascending[:-1]) + 1

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes at p and q, depth at most."""
        out = np.zeros(len(p), dtype=np.int16)
        live, k = np.arange(len(p)), 0
        while len(live) and k < self.depth:
            a, b = self.packed[np.minimum(p[live] + k, self.n)], self.packed[np.minimum(q[live] + k, self.n)]
            same = a == b
            other = (a ^ b)[~same]
            out[live[~same]] = k + PACKED - 1 - (np.frexp(other.astype(np.float64))[1] - 1) // SYMBOL_BITS
            live, k = live[same], k + PACKED
        out[live] = self.depth
        return np.minimum(out, self.depth).astype(np.int16)

    def sorted_lms(self) -> np.ndarray:
        """LMS places in the order of their suffixes, as far as depth symbols tell."""
        places = self.lms
        ends = np.append(places[1:] + 1, self.n)  # a substring holds the next one's first symbol
        rank = _ranked(np.zeros(len(places), dtype=np.int64), self._part(places, ends, 0), np.arange(len(places)))
        k = PACKED
        while k < self.depth:
            tied = _tied(rank)
            tied = tied[(ends - places)[tied] > k]
            if not len(tied):
                break
            group = np.flatnonzero(np.isin(rank, rank[tied]))
            rank[group] = _ranked(rank[group], self._part(places[group], ends[group], k), rank[group])
            k += PACKED
        step = 1
        while step < self.depth:  # LMS places are two apart at least
            tied = _tied(rank)
            tied = tied[tied + step < len(rank)]
            if not len(tied):
                break
            group = np.flatnonzero(np.isin(rank, rank[tied]))
            after = np.where(group + step < len(rank), rank[np.minimum(group + step, len(rank) - 1)], -1)
            rank[group] = _ranked(rank[group], after, rank[group])
            step *= 2
        return places[np.argsort(rank, kind="stable")]

    def _part(self, places: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
        """Symbols k to k + 6 of the substrings, packed. Beyond its end a substring is larger than any: there it ascends, where a longer one of the same symbols descends."""
        left = np.clip(ends - places - k, 0, PACKED)
        beyond = (np.int64(1) << (SYMBOL_BITS * (PACKED - left))) - 1
        return self.packed[np.minimum(places + k, self.n)] | beyond


def _tied(rank: np.ndarray) -> np.ndarray:
    counts = np.bincount(rank, minlength=len(rank))
    return np.flatnonzero(counts[rank] > 1)


def _ranked(group: np.ndarray, key: np.ndarray, base: np.ndarray) -> np.ndarray:
    """New ranks within each group by key. A rank is the number of smaller suffixes, so a group's first new rank is its old one."""
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    at = np.arange(len(g))
    new_group = np.append(True, g[1:] != g[:-1])
    new_key = new_group | np.append(True, k[1:] != k[:-1])
    start = np.maximum.accumulate(np.where(new_group, at, 0))
    first = np.maximum.accumulate(np.where(new_key, at, 0))
    out = np.empty_like(group)
    out[order] = g + first - start
    return out


def _induce(shard: Shard, ascending: bool, seeds: list[tuple[np.ndarray, np.ndarray] | None], symbols: int, most_bytes: int) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """One pass. seeds: by symbol, in the pass's order, the suffixes of the other kind with the common prefix with the one before.
    Returns the same of the induced kind: descending suffixes when ascending over symbols, and the other way round."""
    queues = SymbolQueues(symbols, most_bytes, ascending)
    none = np.int16(shard.depth)
    carry, begun = np.full(symbols, none), np.zeros(symbols, dtype=bool)
    kind = ~shard.ascending if ascending else shard.ascending
    out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * symbols

    def scan(positions: np.ndarray, prefixes: np.ndarray) -> None:
        before = np.maximum(positions - 1, 0)
        fit = np.flatnonzero((positions > 0) & kind[before])
        to = shard.text[before[fit]]
        low = prefixes.min()
        for s in np.unique(to).tolist():
            mine = fit[to == s]
            cuts = np.append(0, mine + 1)
            tail = cuts[-1] < len(prefixes)
            least = np.minimum.reduceat(prefixes, cuts if tail else cuts[:-1])
            found = np.minimum(least[: len(mine)] + np.int16(1), none)
            found[0] = min(int(carry[s]), int(least[0])) + 1 if begun[s] else 0
            found[0] = min(found[0], none)
            kept = carry[s] = least[-1] if tail else none
            queues.push(s, positions[mine] - 1, found)
            carry[s] = kept
            begun[s] = True
        others = np.ones(symbols, dtype=bool)
        others[to] = False
        carry[others] = np.minimum(carry[others], low)

    order = range(symbols) if ascending else range(symbols - 1, -1, -1)
    for s in order:
        got = []
        while (block := queues.pop(s)) is not None:
            got.append(block)
            scan(*block)
        if got:
            out[s] = (np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got]))
        if (seed := seeds[s]) is not None and len(seed[0]):
            positions, prefixes = seed
            prefixes = prefixes.copy()
            prefixes[0] = shard.common(out[s][0][-1:], positions[:1])[0] if got else 0
            scan(positions, prefixes)
    return out


def suffix_order(symbols: np.ndarray, depth: int, most_bytes: int = 256 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix with the suffix before), exact for the first depth symbols. symbols ends in the only END, whose own suffix is left out."""
    shard = Shard(symbols, depth)
    size = int(symbols.max()) + 1
    lms = shard.sorted_lms()
    by = [None] * size
    if len(lms):
        first = symbols[lms]
        prefix = np.append(np.int16(0), shard.common(lms[:-1], lms[1:])).astype(np.int16)
        edges = np.searchsorted(first, np.arange(size + 1))
        by = [(lms[a:b], prefix[a:b]) if b > a else None for a, b in zip(edges[:-1], edges[1:], strict=True)]
    down = _induce(shard, True, by, size, most_bytes)
    # Backwards, a suffix's common prefix with the one before it is that with the one after it forwards.
    turned = [None if d is None else (d[0][::-1], np.append(np.int16(0), d[1][:0:-1]).astype(np.int16)) for d in down]
    up = _induce(shard, False, turned, size, most_bytes)
    order, prefixes = [], []
    for s in range(size):
        u = None if up[s] is None else (up[s][0][::-1], np.append(np.int16(0), up[s][1][:0:-1]).astype(np.int16))
        for part in (down[s], u):
            if part is not None:
                p = part[1].copy()
                p[0] = shard.common(order[-1][-1:], part[0][:1])[0] if order and part is u and down[s] is not None else 0
                order.append(part[0])
                prefixes.append(p)
    if not order:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int16)
    return np.concatenate(order), np.concatenate(prefixes)
