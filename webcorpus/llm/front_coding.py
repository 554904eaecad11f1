"""Sorted runs of suffixes: sorting, common prefixes, front coding, and merging with loser trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CELLS = 1 << 21   # trees times leaves that are merged in step
FAN_IN = 64       # runs merged at once; more of them take another pass


def as_words(rows: np.ndarray) -> np.ndarray:
    """Byte rows as big-endian 64-bit words, padded with zeros: word order is byte order."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    padded[:, :width] = rows
    return padded.view(">u8").astype(np.uint64)


def as_rows(words: np.ndarray, width: int) -> np.ndarray:
    return words.astype(">u8").view(np.uint8).reshape(len(words), -1)[:, :width]


def sort_order(words: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Order by words, then by `tie`; later words are looked at only where the first ones agree."""
    order = np.argsort(words[:, 0], kind="stable")
    first = words[order, 0]
    same = np.zeros(len(order), dtype=bool)
    same[1:] = first[1:] == first[:-1]
    same[:-1] |= same[1:]
    at = np.flatnonzero(same)
    among = order[at]
    keys = [tie[among], *(words[among, c] for c in range(words.shape[1] - 1, -1, -1))]
    order[at] = among[np.lexsort(keys)]
    return order


def common_prefix(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Bytes that two word rows have in common from their start."""
    differ = a ^ b
    some = differ != 0
    word = np.argmax(some, axis=1)
    x = differ[np.arange(len(a)), word]
    same = sum((x < np.uint64(1 << (64 - 8 * k))).astype(np.int64) for k in range(1, 8))
    return np.where(some.any(axis=1), np.minimum(word * 8 + same, width), width)


def prefixes(words: np.ndarray, width: int) -> np.ndarray:
    """Common prefix of each row with the one before; 0 for the first."""
    out = np.zeros(len(words), dtype=np.int64)
    out[1:] = common_prefix(words[1:], words[:-1], width)
    return out


def encode(words: np.ndarray, shared: np.ndarray, width: int) -> pa.Array:
    """What each row has beyond its common prefix with the one before."""
    rest = as_rows(words, width)[np.arange(width)[None, :] >= shared[:, None]]
    offsets = np.concatenate(([0], np.cumsum(width - shared))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(rest)])


def decode(rest: pa.Array, shared: np.ndarray, width: int) -> np.ndarray:
    """Inverse of `encode`: column by column, the last row that states a byte gives it."""
    n = len(shared)
    offsets = np.frombuffer(rest.buffers()[1], dtype=np.int32)[rest.offset : rest.offset + n + 1].astype(np.int64)
    data = np.frombuffer(rest.buffers()[2], dtype=np.uint8)
    rows = np.empty((n, width), dtype=np.uint8)
    index = np.arange(n)
    for c in range(width):
        source = np.maximum.accumulate(np.where(shared <= c, index, 0))
        rows[:, c] = data[offsets[source] + c - shared[source]]
    return as_words(rows)


class LoserTrees:
    """Merges sorted runs with their common prefixes; many key ranges in step, a loser tree for each.

    A node holds the loser of its match and the prefix it shares with the winner.  Of two
    challengers the one that shares more with the last output is the smaller; only where they share
    equally much are they compared, from the first word that is not known to be equal.
    """

    def __init__(self, words: np.ndarray, shared: np.ndarray, run_starts: np.ndarray, width: int):
        self.words, self.shared, self.width = words, shared, width
        k = len(run_starts) - 1
        self.leaves = 1 << max(1, (k - 1).bit_length())
        trees = max(1, min(CELLS // self.leaves, len(words) // 32))
        # Whole keys part the ranges: a common beginning must not make one of them large.
        keys = np.ascontiguousarray(words.astype(">u8")).view(f"S{8 * words.shape[1]}").ravel()
        sample = np.sort(keys[:: max(1, len(words) // (trees * 16))])
        cuts = np.unique(sample[np.linspace(0, len(sample) - 1, trees + 1).astype(int)[1:-1]])
        begin = np.zeros((len(cuts) + 1, self.leaves), dtype=np.int64)
        end = np.zeros_like(begin)
        for r in range(k):
            a, b = run_starts[r], run_starts[r + 1]
            at = a + np.searchsorted(keys[a:b], cuts, side="left")
            begin[0, r], begin[1:, r] = a, at
            end[:-1, r], end[-1, r] = at, b
        used = (end > begin).any(axis=1)
        self.cursor, self.end = begin[used], end[used]

    def beats(self, a, b, shared):
        """(a comes first, their common prefix), looking from `shared` bytes on."""
        first = np.zeros(len(a), dtype=bool)
        prefix = np.full(len(a), self.width, dtype=np.int64)
        open_ = np.arange(len(a))
        word = shared // 8
        while len(open_):
            x, y = self.words[a[open_], word[open_]], self.words[b[open_], word[open_]]
            differ = x != y
            d = open_[differ]
            first[d] = x[differ] < y[differ]
            z = (x ^ y)[differ]
            same = sum((z < np.uint64(1 << (64 - 8 * k))).astype(np.int64) for k in range(1, 8))
            prefix[d] = np.minimum(word[d] * 8 + same, self.width)
            open_ = open_[~differ]
            word[open_] += 1
            last = word[open_] >= self.words.shape[1]
            first[open_[last]] = True
            open_ = open_[~last]
        return first, prefix

    def match(self, a, a_shared, a_live, b, b_shared, b_live):
        """(a wins, the loser's common prefix with the winner)."""
        wins = np.where(a_live & b_live, a_shared > b_shared, a_live)
        prefix = np.where(wins, b_shared, a_shared)
        tied = np.flatnonzero(a_live & b_live & (a_shared == b_shared))
        if len(tied):
            wins[tied], prefix[tied] = self.beats(a[tied], b[tied], a_shared[tied])
        return wins, prefix

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """The order of all rows, and the common prefix of each with the one before it."""
        trees, leaves = self.cursor.shape
        sizes = (self.end - self.cursor).sum(axis=1)
        place = np.concatenate(([0], np.cumsum(sizes)))
        order = np.empty(place[-1], dtype=np.int64)
        out_shared = np.zeros(place[-1], dtype=np.int64)
        loser = np.zeros((trees, leaves), dtype=np.int64)
        loser_shared = np.zeros((trees, leaves), dtype=np.int64)
        level = np.tile(np.arange(leaves), (trees, 1))
        tree = np.arange(trees)[:, None]
        while level.shape[1] > 1:
            a, b = level[:, ::2], level[:, 1::2]
            half = a.shape[1]
            ca, cb = self.cursor[tree, a], self.cursor[tree, b]
            zero = np.zeros(a.size, dtype=np.int64)
            wins, prefix = self.match(
                ca.ravel(), zero, (ca < self.end[tree, a]).ravel(), cb.ravel(), zero, (cb < self.end[tree, b]).ravel()
            )
            wins = wins.reshape(a.shape)
            loser[:, half : 2 * half] = np.where(wins, b, a)
            loser_shared[:, half : 2 * half] = prefix.reshape(a.shape)
            level = np.where(wins, a, b)
        winner, shared = level[:, 0], np.zeros(trees, dtype=np.int64)
        active = np.arange(trees)
        step = 0
        while len(active):
            out = place[active] + step
            order[out] = self.cursor[active, winner]
            out_shared[out] = shared
            self.cursor[active, winner] += 1
            step += 1
            more = step < sizes[active]
            active, winner = active[more], winner[more]
            at = self.cursor[active, winner]
            live = at < self.end[active, winner]
            shared = self.shared[np.minimum(at, len(self.shared) - 1)].copy()
            node = (winner + leaves) >> 1
            while len(active) and node[0]:
                other = loser[active, node]
                other_at = self.cursor[active, other]
                other_live = other_at < self.end[active, other]
                other_shared = loser_shared[active, node]
                wins, prefix = self.match(at, shared, live, other_at, other_shared, other_live)
                loser[active, node] = np.where(wins, other, winner)
                loser_shared[active, node] = prefix
                winner = np.where(wins, winner, other)
                at = np.where(wins, at, other_at)
                live = np.where(wins, live, other_live)
                shared = np.where(wins, shared, other_shared)
                node >>= 1
        ranges = place[1:-1]
        out_shared[ranges] = common_prefix(self.words[order[ranges]], self.words[order[ranges - 1]], self.width)
        return order, out_shared


def merge_runs(words: np.ndarray, shared: np.ndarray, run_starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Merges any number of runs, FAN_IN at a time; returns the order of the rows and their common prefixes."""
    order = np.arange(len(words))
    while True:
        out, prefix, starts = [], [], [0]
        for r in range(0, len(run_starts) - 1, FAN_IN):
            part = run_starts[r : r + FAN_IN + 1]
            a, b = part[0], part[-1]
            if len(part) > 2:
                inner, inner_shared = LoserTrees(words[a:b], shared[a:b], part - a, width).merge()
            else:
                inner, inner_shared = np.arange(b - a), shared[a:b]
            out.append(a + inner)
            prefix.append(inner_shared)
            starts.append(b)
        moved = np.concatenate(out)
        order, words, shared, run_starts = order[moved], words[moved], np.concatenate(prefix), np.array(starts)
        if len(run_starts) <= 2:
            return order, shared
