"""Substring dedup by recompression: repeated runs of words are found through shared symbols.

A document is a string of word names.  Rounds of recompression shorten it: odd rounds turn each run
of one symbol into a new symbol, even rounds turn each pair of a "left" and a "right" symbol into a
new symbol; the side of a symbol is a bit of its name.  Whether a border between two symbols
survives a round depends on these two symbols alone, so equal substrings get equal symbols except
near their ends.  The name of a new symbol is a fingerprint of the words below it: it is the same in
every document on every executor, so the naming is global without an exchange per round.

For each window of words the symbols that the window alone determines (its interior) are known after
each round; the interior symbols of the highest round that has enough of them reveal repeats: equal
windows have equal interiors.  Four neighbouring symbols with the least hash are the window's anchor.
`Repeats` settles equal anchors; windows that must be compared one by one are compared by two
64-bit names of their words.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.hashing import BASES, Roll, mix, word_names, words_of
from webcorpus.llm.packing_io import pack, split, unpack
from webcorpus.llm.repeats import RESULTS, Repeats, first_of, group_min

WINDOW = 50
ROUNDS = 6
TUPLE = 4   # neighbouring symbols in an anchor


def least_in(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of the least value in each range [low, high], the first one among equals; a sparse table."""
    table = [np.arange(len(values))]
    width = 1
    while len(high) and width * 2 <= int((high - low).max()) + 1:
        a, b = table[-1][:-width], table[-1][width:]
        table.append(np.where(values[b] < values[a], b, a))
        width *= 2
    best = np.zeros(len(low), dtype=np.int64)
    level = np.frexp(high - low + 1)[1] - 1
    for k, places in enumerate(table):
        m = level == k
        a, b = places[low[m]], places[high[m] - (1 << k) + 1]
        best[m] = np.where(values[b] < values[a], b, a)
    return best


class Words:
    """The words of a slice of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW):
        self.data, self.window = data, window
        self.starts, self.ends, self.borders = words_of(data, offsets)
        names = word_names(data, self.starts, self.ends)
        self.rolls = [Roll(names, BASES[0])]
        self.names = names

    def __len__(self):
        return len(self.starts)

    def name(self, start, end, which):
        if which and len(self.rolls) == 1:
            self.rolls.append(Roll(word_names(self.data, self.starts, self.ends, 1), BASES[1]))
        return self.rolls[which].of(start, end)

    def compared(self, row, first, last, anchor):
        """Place in the row, and two names, of each window of these runs; the run of each."""
        n = last - first + 1
        starts = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = starts - np.repeat(self.borders[row], n)
        return n, place, self.name(starts, starts + self.window, 0), self.name(starts, starts + self.window, 1)

    def runs(self):
        """(row, anchor name, first and last window start) of each run of windows with one anchor."""
        n, w = len(self), self.window
        row = np.searchsorted(self.borders, np.arange(n), side="right") - 1
        s = np.flatnonzero(np.arange(n) + w <= self.borders[row + 1])
        row = row[s]
        if not len(s):
            return row, self.names[:0], s, s, s
        fixed = np.zeros(n + 1, dtype=bool)
        fixed[self.borders] = True
        borders, names = np.arange(n + 1), self.names
        left, right = s.copy(), s + w               # interior of each window, as places in `borders`
        anchor = np.zeros(len(s), dtype=np.int64)   # first word and last word of the anchor
        until = np.zeros(len(s), dtype=np.int64)
        live = np.arange(len(s))

        def choose(which):
            """Fixes the anchor of these windows; neighbours often share their interior."""
            low, high = left[which], right[which] - TUPLE
            new = first_of(low, high)
            tuples = mix(self.name(borders[:-TUPLE], borders[TUPLE:], 0) + np.uint64(1))
            at = least_in(tuples, low[new], high[new])[np.cumsum(new) - 1]
            anchor[live[which]], until[live[which]] = borders[at], borders[at + TUPLE]

        for k in range(ROUNDS):
            if k % 2:
                side = mix(names + np.uint64(k)) >> np.uint64(63)
                lost = (side[:-1] == 0) & (side[1:] == 1)
            else:
                lost = names[:-1] == names[1:]
            keep = np.ones(len(borders), dtype=bool)
            keep[1:-1] = ~lost | fixed[borders[1:-1]]
            rank = np.cumsum(keep)
            inner, outer = rank[left], rank[right - 1] - 1
            enough = outer - inner >= TUPLE
            if not enough.all():
                # Too few symbols after this round: these windows take their anchor before it.
                choose(np.flatnonzero(~enough))
                live, inner, outer = live[enough], inner[enough], outer[enough]
            left, right = inner, outer
            borders = borders[keep]
            names = self.name(borders[:-1], borders[1:], 0)
        if len(live):
            choose(np.arange(len(live)))
        first = first_of(anchor, until, row)
        first[1:] |= s[1:] != s[:-1] + 1
        at = np.flatnonzero(first)
        last = np.append(at[1:], len(s)) - 1
        return row[at], self.name(anchor[at], until[at], 0), s[at], s[last], anchor[at]


def pack_windows(columns, buckets, group, _):
    """Open windows of a group of documents by their names; what a smaller document of the group holds is decided here."""
    doc, nth, n, start, one, two = columns
    doc, nth = np.repeat(doc, n), np.repeat(nth, n)
    order = np.lexsort((doc, two, one))
    doc, nth, start, one, two = (c[order] for c in (doc, nth, start, one, two))
    settled = doc > group_min(doc, first_of(one, two))
    local = doc[settled], nth[settled], start[settled], start[settled] + WINDOW
    doc, nth, start, one, two = (c[~settled] for c in (doc, nth, start, one, two))
    rows = [
        (b, 0, group, pack(doc=doc[r], nth=nth[r].astype(np.int32), start=start[r].astype(np.int64), one=one[r], two=two[r]))
        for b, r in split((one % np.uint64(buckets)).astype(np.int64))
    ]
    return rows, local


def judge_windows(groups, bodies):
    """Windows of a bucket that start in a smaller document too, with the home of their documents."""
    x = unpack(b for _, b in bodies)
    order = np.lexsort((x["doc"], x["two"], x["one"]))
    doc, nth, start, one, two = (x[k][order] for k in ("doc", "nth", "start", "one", "two"))
    gone = doc > group_min(doc, first_of(one, two))
    home = np.concatenate([np.full(len(unpack([b])["doc"]), g) for g, b in bodies])[order]
    return home[gone], doc[gone], nth[gone], start[gone]


def kept_words(units: Words, gone: np.ndarray) -> list[bytes]:
    """The words that stay, joined by one space."""
    stay = np.flatnonzero(~gone)
    starts, ends = units.starts[stay], units.ends[stay]
    sizes = ends - starts + 1
    total = int(sizes.sum())
    place = np.concatenate(([0], np.cumsum(sizes)))
    source = np.arange(total) - np.repeat(place[:-1], sizes) + np.repeat(starts, sizes)
    out = units.data[np.minimum(source, max(len(units.data) - 1, 0))] if total else units.data[:0]
    if total:
        out[place[1:] - 1] = 0x20
    body = out.tobytes()
    border = place[np.searchsorted(stay, units.borders)]
    return [body[a : max(a, b - 1)] for a, b in zip(border[:-1], border[1:])]


def substring_dedup(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Removes each word covered by a window of 50 words that also starts in a document with a smaller id.

    Adds n_words, n_removed and kept_text (the kept words joined by one space) to all columns of
    `docs`.  Null text has no words.  A null id comes after all others.  Rows that share an id do
    not remove each other's words.  Windows are judged on the input.  An empty table gives none.
    """
    repeats = Repeats(Words, WINDOW, pack_windows, judge_windows, kept_words, id_col, text_col)
    out = repeats.apply(docs)
    size, removed, _, kept = RESULTS
    new = {"n_words": F.col(size), "n_removed": F.col(removed), "kept_text": F.decode(kept, "UTF-8")}
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new], *[c.alias(n) for n, c in new.items()])
