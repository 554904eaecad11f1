"""Suffix-array dedup: bytes of repeated strings are found where sorted suffixes share 50 bytes.

Suffixes that can't repeat are left out first (`Repeats`: the least hash of a 24-byte gram anchors a
window).  What is left is a sparse suffix array over all documents, built by a merge sort: each group
of documents sorts the suffixes at open anchors into a run and front-codes it by the common prefixes;
runs are cut at key bounds that every task shares and exchanged; loser trees that carry the common
prefixes merge them.  In the merged order, windows are equal if their anchored suffixes share the
rest of the window and the bytes before the anchors are the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.front_coding import as_words, decode, encode, merge_runs, prefixes, sort_order
from webcorpus.llm.hashing import byte_roll, mix
from webcorpus.llm.packing_io import from_bytes, split, to_bytes
from webcorpus.llm.repeats import RESULTS, Repeats, first_of, group_min

WINDOW = 50
GRAM = 24
LEFT = WINDOW - GRAM   # bytes of a window before its anchor, at most
PLACE = 22   # low bits of a packed hash that hold the place in the slice


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


class Bytes:
    """The bytes of a slice of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.borders = data, offsets
        self.rolls = [byte_roll(data)]

    def __len__(self):
        return len(self.data)

    def name(self, start, end, which):
        return self.rolls[which].of(start, end)

    def compared(self, row, first, last, anchor):
        """Of each run: its place and print, its anchored suffix up to the last window's end, and what is left of the anchor."""
        padded = np.concatenate((np.zeros(LEFT, np.uint8), self.data, np.zeros(WINDOW, np.uint8)))
        view = np.lib.stride_tricks.sliding_window_view
        suffix = view(padded, WINDOW)[anchor + LEFT].copy()
        suffix[np.arange(WINDOW)[None, :] >= (last + WINDOW - anchor)[:, None]] = 0
        left = view(padded, LEFT)[anchor].copy()
        left[np.arange(LEFT)[None, :] < (LEFT - anchor + first)[:, None]] = 0
        base = self.borders[row]
        return anchor - base, first - base, last - base, self.name(first, last + WINDOW, 0), as_words(suffix), left

    def runs(self):
        """(row, anchor name, first and last window start) of each run of windows with one anchor."""
        n = len(self)
        none = np.zeros(0, dtype=np.int64)
        if n < WINDOW:
            return none, none.astype(np.uint64), none, none, none
        at = np.arange(n - GRAM + 1)
        grams = self.name(at, at + GRAM, 0)
        # The high bits of a hash choose, the first place among equals: the same for texts of any length.
        low = np.uint64((1 << PLACE) - 1)
        width = WINDOW - GRAM + 1
        if n >> PLACE:   # one text longer than the places: the place can't stand in the low bits
            least = np.lib.stride_tricks.sliding_window_view(grams & ~low, width)
            anchor = np.concatenate([
                s + np.arange(len(part)) + part.argmin(axis=1)
                for s in range(0, len(least), 1 << 16) for part in [least[s : s + (1 << 16)]]
            ])
        else:
            anchor = (sliding_least((grams & ~low) | at.astype(np.uint64), width) & low).astype(np.int64)
        fits = np.zeros(n + 1, dtype=np.int32)
        long = np.diff(self.borders) >= WINDOW
        np.add.at(fits, self.borders[:-1][long], 1)
        np.add.at(fits, self.borders[1:][long] - WINDOW + 1, -1)
        fits = np.cumsum(fits)[: len(anchor)] > 0
        new = first_of(anchor, fits)
        new[self.borders[:-1][self.borders[:-1] < len(new)]] = True
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new)) - 1
        first, last = first[fits[first]], last[fits[first]]
        row = np.searchsorted(self.borders, first, side="right") - 1
        return row, grams[anchor[first]], first, last, anchor[first]


def pack_suffixes(columns, buckets, group, bounds):
    """The anchored suffixes of a group as front-coded sorted runs, one per range of keys."""
    doc, nth, anchor, first, last, content, words, left = columns
    order = np.lexsort((doc, last - first, anchor - first, content))
    doc, nth, anchor, first, last, content, words, left = (
        c[order] for c in (doc, nth, anchor, first, last, content, words, left)
    )
    settled = doc > group_min(doc, first_of(content, anchor - first, last - first))
    local = doc[settled], nth[settled], first[settled], last[settled] + WINDOW
    doc, nth, anchor, first, last, words, left = (c[~settled] for c in (doc, nth, anchor, first, last, words, left))
    if not len(doc):
        return [], local
    order = sort_order(words, doc)
    doc, nth, anchor, first, last, words, left = (c[order] for c in (doc, nth, anchor, first, last, words, left))
    rows = []
    for b, r in split(np.searchsorted(bounds, words[:, 0], side="right")):
        shared = prefixes(words[r], WINDOW)
        ids, which = np.unique(doc[r], return_inverse=True)
        before = anchor[r] - first[r]
        batch = pa.RecordBatch.from_arrays(
            [encode(words[r], shared, WINDOW), encode_left(left[r], before), pa.array(shared.astype(np.uint8)),
             pa.array(which.astype(np.int32)), pa.array(np.pad(ids, (0, len(r) - len(ids)), mode="edge")),
             pa.array(nth[r].astype(np.int32)), pa.array(anchor[r]), pa.array(before.astype(np.uint8)),
             pa.array((anchor[r] - last[r]).astype(np.int8))],
            ["rest", "left", "shared", "which", "ids", "nth", "anchor", "most", "least"],
        )
        rows.append((b, 0, group, to_bytes(batch)))
    return rows, local


def encode_left(left: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The last `sizes` bytes of each row."""
    data = left[np.arange(LEFT)[None, :] >= (LEFT - sizes)[:, None]]
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def decode_left(column: pa.Array, sizes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sizes), LEFT), dtype=np.uint8)
    buffer = column.buffers()[2]
    if buffer is not None:
        out[np.arange(LEFT)[None, :] >= (LEFT - sizes)[:, None]] = np.frombuffer(buffer, np.uint8)[: sizes.sum()]
    return out


def judge_suffixes(groups, bodies):
    """Windows of a range of anchors that start in a smaller document too, with the home of their documents.

    Windows that start `before` bytes before their anchors are equal if their suffixes are neighbours
    that share the rest of the window, and the bytes before the anchor are equal too.
    """
    parts = {k: [] for k in ("words", "shared", "doc", "nth", "anchor", "most", "least", "left", "home")}
    for group, body in bodies:
        x = from_bytes(body).combine_chunks()
        column = lambda name: x[name].to_numpy().astype(np.int64)  # noqa: B023, E731
        shared, most = column("shared"), column("most")
        parts["words"].append(decode(x["rest"].combine_chunks(), shared, WINDOW))
        parts["left"].append(decode_left(x["left"].combine_chunks(), most))
        parts["shared"].append(shared)
        parts["doc"].append(column("ids")[column("which")])
        parts["most"].append(most)
        parts["home"].append(np.full(len(shared), group))
        for name in ("nth", "anchor", "least"):
            parts[name].append(column(name))
    runs = np.concatenate(([0], np.cumsum([len(s) for s in parts["shared"]])))
    x = {k: np.concatenate(v) for k, v in parts.items()}
    order, shared = merge_runs(x["words"], x["shared"], runs, WINDOW)
    x = {k: v[order] for k, v in x.items() if k != "words"}
    # Only suffixes that share their anchors with a neighbour can have equal windows.
    anchored = np.cumsum(shared < GRAM)
    some = np.bincount(anchored)[anchored] > 1
    found = []
    left = np.zeros(len(order), dtype=np.uint64)
    for before in range(LEFT + 1):
        if before:
            # Print of the bytes before the anchor, one byte longer in each round.
            left = mix(left * np.uint64(0x9E3779B97F4A7C15) + x["left"][:, LEFT - before] + np.uint64(1))
        near = np.flatnonzero(some & (x["least"] <= before) & (before <= x["most"]))
        if not len(near):
            continue
        block = np.cumsum(shared < WINDOW - before)[near]
        doc, text = x["doc"][near], left[near]
        inner = np.lexsort((doc, text, block))
        doc = doc[inner]
        gone = doc > group_min(doc, first_of(block[inner], text[inner]))
        at = near[inner[gone]]
        found.append((x["home"][at], x["doc"][at], x["nth"][at], x["anchor"][at] - before))
    return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 4


def kept_bytes(units: Bytes, gone: np.ndarray) -> list[bytes]:
    stay = units.data[~gone].tobytes()
    borders = np.concatenate(([0], np.cumsum(~gone)))[units.borders]
    return [stay[a:b] for a, b in zip(borders[:-1], borders[1:])]


def key_bounds(docs: DataFrame, text_col: str):
    """Bounds of equal shares of suffixes by their first 8 bytes, estimated from one suffix per document.

    What comes to the driver is a number per bucket.
    """
    def bounds(buckets: int) -> np.ndarray:
        place = F.pmod(F.xxhash64(text_col), F.octet_length(text_col)) + 1
        head = F.rpad(F.hex(F.substr(F.encode(text_col, "UTF-8"), place, F.lit(7))), 14, "0")
        share = [i / buckets for i in range(1, buckets)]
        found = docs.where(F.octet_length(text_col) > 0).agg(
            F.percentile_approx(F.conv(head, 16, 10).cast("long"), share, 10_000)
        ).first()[0]
        return np.unique(np.array(found or [], dtype=np.uint64)) << np.uint64(8)

    return bounds


def suffix_dedup(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Removes each byte covered by a 50-byte string that also starts in a document with a smaller id.

    Adds n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary, what remains) to all
    columns of `docs`.  Null text is empty.  A null id comes after all others.  Rows that share an id
    do not remove each other's bytes.  Strings are judged on the input.  An empty table gives none.
    """
    repeats = Repeats(Bytes, WINDOW, pack_suffixes, judge_suffixes, kept_bytes, id_col, text_col)
    out = repeats.apply(docs, key_bounds(docs, text_col))
    size, removed, spans, kept = RESULTS
    new = {"n_bytes": size, "n_removed": removed, "n_spans": spans, "kept": kept}
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new], *[F.col(c).alias(n) for n, c in new.items()])
