"""Token counts of a BPE tokenizer with word ends: a finite-state splitter, then direct merging.

* the splitter walks over character classes and marks where a piece (word, digit, other signs,
  contraction) begins.  Its states are few, so a chunk of text is a map of states to states.  The
  maps of all chunks are computed in step, composed by a parallel prefix scan, and a second walk
  marks the pieces with each chunk's true entry state;
* the tokens of a piece are counted by merging, not by a transducer with token counts on its
  transitions: for all new pieces of a batch at once, in each step the pairs of the least rank in
  every piece go.  Merges go by rank over the whole piece, not from left to right, and pieces are
  short and repeat, so each task remembers the counts of those it has seen.  Long pieces (text without
  white space) are merged one by one with their pairs in a heap.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.hashing import BASES, Roll, mix, text_slices

LIMIT = 2048
CHUNK = 256            # characters of a chunk
KNOWN = 1 << 20        # pieces whose counts a task remembers
SLICE = 1 << 18        # bytes of text that are counted together
LONG = 512             # bytes from which a piece is merged by itself, along a heap
#: White space by Unicode's White_Space property.
SPACES = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

# Character classes.
SPACE, LETTER, DIGIT, OTHER, QUOTE, C_S, C_T, C_M, C_D, C_R, C_V, C_L, C_E = range(13)
# States: nothing open; in letters; in other signs; after an opening quote; after quote and r, v, l.
FREE, IN_LETTERS, IN_OTHER, AT_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(7)
# What a transition says about the character it reads.
NOTHING, BEGIN, INSIDE, BEGIN_BEFORE = range(4)


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, action) by state and class, for 's 't 're 've 'm 'll 'd, letter runs, single digits, runs of other signs.

    BEGIN_BEFORE: the character before was taken into a possible contraction and turns out to begin a
    run of letters, which this character continues or follows.
    """
    after = np.zeros((7, 13), dtype=np.uint8)
    act = np.zeros((7, 13), dtype=np.uint8)
    letters = (LETTER, C_S, C_T, C_M, C_D, C_R, C_V, C_L, C_E)
    for state in range(7):
        for c in range(13):
            if c == SPACE:
                new, action = FREE, NOTHING
            elif c in letters:
                new, action = IN_LETTERS, INSIDE if state == IN_LETTERS else BEGIN
            elif c == DIGIT:
                new, action = FREE, BEGIN
            else:
                run = state in (IN_OTHER, AT_QUOTE)
                new = AT_QUOTE if c == QUOTE and not run else IN_OTHER
                action = INSIDE if run else BEGIN
            if state == AT_QUOTE and c in (C_S, C_T, C_M, C_D):
                new, action = FREE, INSIDE
            if state == AT_QUOTE and c in (C_R, C_V, C_L):
                new, action = {C_R: QUOTE_R, C_V: QUOTE_V, C_L: QUOTE_L}[c], INSIDE
            if state >= QUOTE_R:
                if (state, c) in ((QUOTE_R, C_E), (QUOTE_V, C_E), (QUOTE_L, C_L)):
                    new, action = FREE, INSIDE
                elif c in letters:
                    new, action = IN_LETTERS, BEGIN_BEFORE
                else:
                    action = BEGIN_BEFORE if action == NOTHING else BEGIN_BEFORE | 4
            after[state, c], act[state, c] = new, action
    return after, act


AFTER, ACTION = splitter()


def character_classes() -> np.ndarray:
    table = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    category = unicodedata.category
    for code in range(sys.maxunicode + 1):
        kind = category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = DIGIT
    table[list(SPACES)] = SPACE
    for sign, kind in zip("'stmdrvle", (QUOTE, C_S, C_T, C_M, C_D, C_R, C_V, C_L, C_E)):
        table[ord(sign)] = kind
    return table


def entry_states(classes: np.ndarray) -> np.ndarray:
    """State before each chunk (row of classes), starting free; by maps of chunks and a prefix scan."""
    maps = np.tile(np.arange(7, dtype=np.uint8), (len(classes), 1))
    for step in range(classes.shape[1]):
        maps = AFTER[maps, classes[:, step, None]]
    # maps[k] becomes the map of chunks 0..k: doubling the span that each entry covers.
    span = 1
    while span < len(maps):
        maps[span:] = np.take_along_axis(maps[span:], maps[:-span], axis=1)
        span *= 2
    return np.concatenate(([FREE], maps[:-1, FREE])).astype(np.uint8)


def piece_starts(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces in a string of classes."""
    n = len(classes)
    padded = np.full(-(-(n + 1) // CHUNK) * CHUNK, SPACE, dtype=np.uint8)
    padded[:n] = classes
    grid = padded.reshape(-1, CHUNK)
    state = entry_states(grid)
    actions = np.empty(grid.shape, dtype=np.uint8)
    for step in range(CHUNK):
        actions[:, step] = ACTION[state, grid[:, step]]
        state = AFTER[state, grid[:, step]]
    action = actions.ravel()[: n + 1]
    begin = (action == BEGIN) | (action >= 4)
    begin[np.flatnonzero((action & 3) == BEGIN_BEFORE) - 1] = True
    starts = np.flatnonzero(begin[:n])
    # A piece ends where the next one begins or at white space.
    breaks = np.flatnonzero(begin | (padded[: n + 1] == SPACE))
    return starts, breaks[np.searchsorted(breaks, starts, side="right")]


class Merges:
    """The merges of a vocabulary file, ready to count the tokens of many pieces at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        # Bytes are written as printable characters: printable ones as themselves, the others from U+0100 on.
        shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
        names = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
        end = model["end_of_word_suffix"]
        self.inner = np.array([vocab[names[b]] for b in range(256)])
        self.last = np.array([vocab[names[b] + end] for b in range(256)])
        self.width = 1 + max(vocab.values())
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        code = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(code, kind="stable")
        self.code, self.rank = code[order], order
        self.result = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each piece of bytes; pieces are not empty."""
        size = ends - starts
        if (size > LONG).any():
            out = np.empty(len(size), dtype=np.int64)
            short = np.flatnonzero(size <= LONG)
            out[short] = self.count(data, starts[short], ends[short]) if len(short) else 0
            for i in np.flatnonzero(size > LONG).tolist():
                out[i] = self.count_long(data[starts[i] : ends[i]])
            return out
        piece = np.repeat(np.arange(len(size)), size)
        raw = data[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts, size)]
        symbol = self.inner[raw]
        final = np.cumsum(size) - 1
        symbol[final] = self.last[raw[final]]
        total = np.zeros(len(size), dtype=np.int64)
        none = len(self.code)
        while len(symbol):
            code = symbol[:-1] * self.width + symbol[1:]
            at = np.minimum(np.searchsorted(self.code, code), none - 1)
            rank = np.where((self.code[at] == code) & (piece[:-1] == piece[1:]), self.rank[at], none)
            # In each piece the pairs of the least rank go; of overlapping ones every other, from the left.
            begin = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
            least = np.minimum.reduceat(np.append(rank, none), begin)
            least = np.repeat(least, np.diff(np.append(begin, len(piece))))
            go = (rank < none) & (rank == least[:-1])
            again = np.flatnonzero(go[1:] & go[:-1]) + 1
            for run in np.split(again, np.flatnonzero(np.diff(again) > 1) + 1) if len(again) else []:
                go[run[::2]] = False
            goes = np.flatnonzero(go)
            # Pieces without any merge left are done.
            busy = np.zeros(len(total), dtype=bool)
            busy[piece[:-1][rank < none]] = True
            if len(goes):
                symbol[goes] = self.result[rank[goes]]
                stay = np.ones(len(symbol), dtype=bool)
                stay[goes + 1] = False
                symbol, piece = symbol[stay], piece[stay]
            left = busy[piece]
            total += np.bincount(piece[~left], minlength=len(total))
            symbol, piece = symbol[left], piece[left]
        return total


    @cached_property
    def merge_of(self) -> dict[int, tuple[int, int]]:
        """(rank, result) of each pair of symbols that merges."""
        return dict(zip(self.code.tolist(), zip(self.rank.tolist(), self.result[self.rank].tolist())))

    def count_long(self, raw: np.ndarray) -> int:
        """Tokens of one long piece: its pairs wait in a heap by rank and place, so each merge costs its logarithm."""
        symbol = self.inner[raw].tolist()
        symbol[-1] = int(self.last[raw[-1]])
        n, width, merge_of = len(symbol), self.width, self.merge_of
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        waiting = []

        def wait(i: int, j: int) -> None:
            found = merge_of.get(symbol[i] * width + symbol[j])
            if found:
                heappush(waiting, found[0] * n + i)

        for i in range(n - 1):
            wait(i, i + 1)
        left = n
        while waiting:
            rank, i = divmod(heappop(waiting), n)
            j = after[i]
            found = merge_of.get(symbol[i] * width + symbol[j]) if symbol[i] >= 0 and j < n else None
            if not found or found[0] != rank:
                continue   # one of the two has merged with another since
            symbol[i], symbol[j] = found[1], -1
            left -= 1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                wait(i, after[i])
            if before[i] >= 0:
                wait(before[i], i)
        return left


def normalised(text: str) -> str:
    """Canonical composition and lower case, character by character."""
    if text.isascii():
        return text.lower()
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()   # a final sigma would depend on its neighbours


class Counter:
    """Counts tokens of texts; remembers the pieces it has seen."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.classes = character_classes()
        self.special = re.compile("|".join(re.escape(s) for s in self.merges.special)) if self.merges.special else None
        self.names, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        names = Roll(mix(data.astype(np.uint64) + np.uint64(1)), BASES[1]).of(starts, ends)
        unique, first, which = np.unique(names, return_index=True, return_inverse=True)
        counts = np.zeros(len(unique), dtype=np.int64)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, unique), len(self.names) - 1)
            known = self.names[at] == unique
            counts[known] = self.counts[at[known]]
        else:
            known = np.zeros(len(unique), dtype=bool)
        new = np.flatnonzero(~known)
        if len(new):
            counts[new] = self.merges.count(data, starts[first[new]], ends[first[new]])
            if len(self.names) + len(new) > KNOWN:
                self.names, self.counts = unique, counts
            else:
                names_ = np.concatenate((self.names, unique[new]))
                order = np.argsort(names_)
                self.names, self.counts = names_[order], np.concatenate((self.counts, counts[new]))[order]
        return counts[which]

    def texts(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a slice."""
        segments, owner, extra = [], [], np.zeros(len(offsets) - 1, dtype=np.int64)
        for r, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            text = data[a:b].decode("utf-8", "replace")
            parts = self.special.split(text) if self.special and "<" in text else [text]
            extra[r] = len(parts) - 1
            segments += [normalised(p) for p in parts]
            owner += [r] * len(parts)
        sizes = np.array([len(s) + 1 for s in segments], dtype=np.int64)
        joined = "\n".join(segments) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        starts, ends = piece_starts(self.classes[codes])
        row = np.array(owner)[np.searchsorted(np.cumsum(sizes), starts, side="right")]
        if joined.isascii():
            raw, at, to = codes.astype(np.uint8), starts, ends
        else:
            width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
            place = np.concatenate(([0], np.cumsum(width)))
            raw, at, to = np.frombuffer(joined.encode("utf-8"), dtype=np.uint8), place[starts], place[ends]
        return extra + np.bincount(row, weights=self.pieces(raw, at, to), minlength=len(extra)).astype(np.int64)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def count_tokens(docs: DataFrame, path: str | None = None, text_col="text") -> DataFrame:
    """Adds n_bytes (UTF-8), n_tokens and over_limit (more than LIMIT tokens) to all columns of `docs`.

    `path` is the vocabulary file on the executors; by default that of the installed public tokenizers.
    Null text is empty.  No special tokens are added; special strings inside texts count as one token,
    as the tokenizer's library does by default.  Columns of `docs` with the added names are replaced.
    """
    added = ("n_bytes", "n_tokens", "over_limit")
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(path or default_vocabulary())
            tokens = [counter.texts(data.tobytes(), offsets) for _, data, offsets in text_slices(batch.column(text_col), SLICE)]
            n = pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, n], [*batch.schema.names, "n_tokens"])

    fields = ", ".join(f"`{n}` {t}" for n, t in base.dtypes)
    out = base.mapInArrow(count, f"{fields}, n_tokens long")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    return out.withColumn("n_bytes", size).withColumn("over_limit", F.col("n_tokens") > LIMIT)
