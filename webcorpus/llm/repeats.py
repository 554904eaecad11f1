"""Finding the windows of W units that also start in a document with a smaller id, exactly.

Units are bytes or words.  Four exchanges, each of packed and compressed records:

1. Each window has an anchor that depends on the window's content alone; consecutive windows with
   one anchor form a run.  A run is sent as (name of its anchor, name of all its units, id).
2. Runs whose whole content stands in a smaller document are settled: all their windows repeat.
   Runs whose anchor stands in other surroundings elsewhere are open.  All others are unique.  Both
   verdicts go to the documents, dealt in groups of a few megabytes.  What a batch settles by itself
   takes part in the same exchange, but is dealt by the group of its document.
3. The windows of open runs are compared one by one (by the caller's method: `windows`, `judge`).
4. Spans to remove go to the documents once more.

Hot content: what is decided within a batch (RUNS_AT_ONCE runs) is not sent to be decided again; of a
name that many documents hold a batch sends one record by name, that of the least document, and open
runs are dealt by their surroundings, not by the common anchor.  So no task sees more of a name than
there are batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.hashing import byte_roll, mix, text_slices
from webcorpus.llm.packing_io import NO_ID, from_bytes, gathered, groups_of, ids_of, pack, split, to_bytes, unpack

GROUP_BYTES = 2 << 20     # text of a group of documents
BUCKET_BYTES = 16 << 20   # text behind a bucket of runs or of windows
RUNS_AT_ONCE = 400_000    # runs of a batch that are sorted and sent at once
JUDGED_AT_ONCE = 1 << 17  # runs of a bucket that are sorted at once
PACKED = "bucket long, kind int, grp long, body binary"
#: Columns that the operator adds; callers rename them.
RESULTS = ("repeats__size", "repeats__removed", "repeats__spans", "repeats__kept")
UNIQUE, OPEN, SETTLED, VOICE = 0, 1, 2, 3
CTX_SHIFT = np.uint64(24)  # 40 bits of a run's name are sent, beside those of its anchor


def first_of(*columns: np.ndarray) -> np.ndarray:
    """Marks the first row of each run of equal rows."""
    first = np.zeros(len(columns[0]), dtype=bool)
    first[:1] = True
    for c in columns:
        first[1:] |= c[1:] != c[:-1]
    return first


def group_min(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The least value of each run of rows, at each of its rows."""
    if not len(values):
        return values
    return np.minimum.reduceat(values, np.flatnonzero(first))[np.cumsum(first) - 1]


def judge_runs(key, ctx, doc, voice=None):
    """Verdict per run: settled by a smaller document, open, or unique; rows must be sorted by (key, ctx, doc)."""
    same_key, same_ctx = first_of(key), first_of(key, ctx)
    settled = doc > group_min(doc, same_ctx)
    of_key = np.cumsum(same_key) - 1
    surroundings = np.bincount(of_key[same_ctx], minlength=len(doc) and of_key[-1] + 1)[of_key] if len(doc) else doc
    several = (surroundings > 1) & (group_min(doc, same_key) != -group_min(-doc, same_key))
    if voice is not None:
        several |= np.bincount(of_key, weights=voice)[of_key] > 0 if len(doc) else False
    return np.where(settled, SETTLED, np.where(several, OPEN, UNIQUE)).astype(np.int8)


def judge_bucket(key, ctx, doc, state):
    """Verdict per run of a bucket, in any order.  Only runs of one anchor are compared, so parts of the anchors are sorted one by one."""
    verdict = np.empty(len(doc), dtype=np.int8)
    parts = 1 + len(doc) // JUDGED_AT_ONCE
    part = (key % np.uint32(parts)).astype(np.int32)
    for p in range(parts):
        at = np.flatnonzero(part == p)
        at = at[np.lexsort((doc[at], ctx[at], key[at]))]
        found = judge_runs(key[at], ctx[at], doc[at], voice=state[at] == VOICE)
        verdict[at] = np.where((state[at] == OPEN) & (found != SETTLED), OPEN, found)
    return verdict


def merged(doc, nth, start, end):
    """Unites overlapping or touching spans of a document."""
    order = np.lexsort((start, nth, doc))
    doc, nth, start, end = doc[order], nth[order], start[order], end[order]
    if not len(doc):
        return doc, nth, start, end
    fresh = first_of(doc, nth)
    # The running maximum of ends must not cross documents: lift each document above the one before.
    lift = np.cumsum(fresh) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    fresh[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    return doc[at], nth[at], start[at], np.maximum.reduceat(end, at)


def deltas(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=0)


def spans_row(bucket: int, grp: int, doc, nth, start, end):
    doc, nth, start, end = merged(doc, nth, start, end)
    return bucket, 1, grp, pack(doc=deltas(doc), nth=nth.astype(np.int32), start=start.astype(np.int64), end=end.astype(np.int64))


def told(doc, ctx, verdict) -> bytes:
    return pack(doc=deltas(doc), ctx=ctx, verdict=verdict)


def grouped(home, doc, rows):
    """(group, its rows in order of their documents) of each group among `rows`."""
    rows = rows[np.lexsort((doc[rows], home[rows]))]
    for g, r in split(home[rows]):
        yield g, rows[r]


def rows_batch(rows: list[tuple]) -> pa.RecordBatch:
    bucket, kind, grp, body = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int64()), pa.array(kind, pa.int32()), pa.array(grp, pa.int64()), pa.array(body, pa.binary())],
        ["bucket", "kind", "grp", "body"],
    )


def numbered(table: pa.Table, id_col: str, text_col: str):
    """Ids, and which of the rows with its id each row is: by the print of its text, so any order of rows agrees."""
    ids = ids_of(table[id_col])
    text = table[text_col].combine_chunks()
    prints = np.concatenate([byte_roll(d).of(o[:-1], o[1:]) for _, d, o in text_slices(text)]) if len(ids) else ids
    order = np.lexsort((prints, ids))
    nth = np.zeros(len(ids), dtype=np.int64)
    first = first_of(ids[order])
    starts = np.flatnonzero(first)
    nth[order] = np.arange(len(ids)) - starts[np.cumsum(first) - 1] if len(ids) else 0
    return ids, nth, text


class Repeats:
    """The four exchanges for one kind of units.

    `units(data, offsets)` gives an object with `borders` (of rows, in units), `runs()` (row, anchor
    name, first and last window start) and `name(start, end, which)`.  its
    `compared(...)` gives what is compared of open runs.  `windows(...)` packs that for a group of
    documents into rows, `judge(groups, bodies)` gives the removed (home, doc, nth, start) of a
    bucket, `kept(units, gone)` gives what is left of each row.
    """

    def __init__(self, units, window: int, windows, judge, kept, id_col="doc_id", text_col="text"):
        self.units, self.window, self.windows, self.judge, self.kept = units, window, windows, judge, kept
        self.id_col, self.text_col = id_col, text_col

    # --- 1: runs of windows with one anchor -------------------------------------------------

    def send_runs(self, buckets: int, groups: int):
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, n = [], 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                text = batch.column(self.text_col)
                ids = ids_of(batch.column(self.id_col))
                home = groups_of(ids, text, groups)
                for at, data, offsets in text_slices(text):
                    units = self.units(data, offsets)
                    row, anchor, first, last, _ = units.runs()
                    parts.append((ids[at + row], home[at + row], anchor, units.name(first, last + self.window, 0) >> CTX_SHIFT))
                    n += len(row)
                    del units
                    if n >= RUNS_AT_ONCE:
                        yield rows_batch(self.judged_runs(parts, buckets))
                        n = 0
            if parts:
                yield rows_batch(self.judged_runs(parts, buckets))

        return send

    @staticmethod
    def judged_runs(parts, buckets: int) -> list[tuple]:
        """Runs that a batch settles, to the groups of their documents (kind 1); all others by name (kind 0).  Empties `parts`."""
        doc, home, key, ctx = (np.concatenate(c) for c in zip(*parts))
        parts.clear()
        order = np.lexsort((home, doc, ctx, key))
        doc, home, key, ctx = doc[order], home[order], key[order], ctx[order]
        verdict = judge_runs(key, ctx, doc)
        once = first_of(key, ctx, doc, home)
        known = np.flatnonzero(once & (verdict == SETTLED))
        rows = [(g % buckets, 1, g, told(doc[r], ctx[r], verdict[r])) for g, r in grouped(home, doc, known)]
        # One voice for each anchor that is open here, so that other batches learn of it.
        heard = np.flatnonzero(first_of(key))
        opened = np.maximum.reduceat(verdict == OPEN, heard) if len(heard) else np.zeros(0, bool)
        voices = heard[opened]
        left = np.flatnonzero(once & (verdict != SETTLED))
        pick = np.concatenate((left, voices))
        state = np.concatenate((verdict[left], np.full(len(voices), VOICE, np.int8)))
        by_key = ((key[pick] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        by_ctx = (mix(ctx[pick]) % np.uint64(buckets)).astype(np.int64)
        bucket = np.where(state == OPEN, by_ctx, by_key)
        inner = np.lexsort((doc[pick], bucket))
        pick, state, bucket = pick[inner], state[inner], bucket[inner]
        for b, r in split(bucket):
            p = pick[r]
            rows.append((b, 0, 0, pack(
                doc=deltas(doc[p]), key=key[p].astype(np.uint32), low=ctx[p].astype(np.uint32),
                high=(ctx[p] >> np.uint64(32)).astype(np.uint8), state=state[r],
                # Ids say where their documents are; rows without one need their group beside them.
                home=np.where(doc[p] == NO_ID, home[p], 0),
            )))
        return rows

    # --- 2: verdicts for runs ---------------------------------------------------------------

    def settle_runs(self, groups: int):
        def settle(table: pa.Table) -> pa.Table:
            rows, runs = [], {name: [] for name in ("doc", "home", "key", "ctx", "state")}
            for kind, g, body in zip(table["kind"].to_numpy(), table["grp"].to_pylist(), table["body"]):
                if kind == 1:
                    rows.append((g, 1, g, body.as_py()))
                    continue
                x = unpack([body.as_buffer()])
                runs["doc"].append(np.cumsum(x["doc"]))
                runs["ctx"].append(x["low"].astype(np.uint64) | (x["high"].astype(np.uint64) << np.uint64(32)))
                for name in ("home", "key", "state"):
                    runs[name].append(x[name])
            if runs["doc"]:
                doc, home, key, ctx, state = (np.concatenate(runs.pop(name)) for name in list(runs))
                verdict = judge_bucket(key, ctx, doc, state)
                tell = np.flatnonzero((verdict != UNIQUE) & (state != VOICE))
                doc, home, ctx, verdict = doc[tell], home[tell], ctx[tell], verdict[tell]
                by_id = (mix(doc.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
                home = np.where(doc == NO_ID, home, by_id)
                rows += [(g, 1, g, told(doc[r], ctx[r], verdict[r])) for g, r in grouped(home, doc, np.arange(len(doc)))]
            return pa.Table.from_batches([rows_batch(rows)])

        return settle

    # --- texts, dealt in groups -------------------------------------------------------------

    def send_texts(self, groups: int):
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in gathered(batches):
                group = groups_of(ids_of(batch.column(self.id_col)), batch.column(self.text_col), groups)
                yield rows_batch([(g, 0, g, to_bytes(batch.take(pa.array(r)))) for g, r in split(group)])

        return send

    @staticmethod
    def parts(table: pa.Table):
        """The rows of a group, and what was told about them."""
        kinds = table["kind"].to_numpy()
        bodies = table["body"].to_pylist()
        texts = [from_bytes(b) for b, k in zip(bodies, kinds) if k == 0]
        return (pa.concat_tables(texts) if texts else None), [b for b, k in zip(bodies, kinds) if k == 1]

    # --- 3: windows of open runs ------------------------------------------------------------

    def open_windows(self, buckets: int, extra):
        def expand(table: pa.Table) -> pa.Table:
            texts, told = self.parts(table)
            if texts is None or not told:
                return pa.Table.from_batches([rows_batch([])])
            group = table["grp"][0].as_py()
            codes, verdicts = [], []
            for body in told:
                x = unpack([body])
                codes.append(mix(np.cumsum(x["doc"]).astype(np.uint64)) ^ x["ctx"])
                verdicts.append(x["verdict"])
            codes, verdicts = np.concatenate(codes), np.concatenate(verdicts)
            order = np.argsort(codes)
            codes, verdicts = codes[order], verdicts[order]
            ids, nth, text = numbered(texts, self.id_col, self.text_col)
            done, wins = [], []
            for at, data, offsets in text_slices(text):
                units = self.units(data, offsets)
                row, _, first, last, anchor = units.runs()
                ctx = units.name(first, last + self.window, 0) >> CTX_SHIFT
                code = mix(ids[at + row].astype(np.uint64)) ^ ctx
                found = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                verdict = np.where(codes[found] == code, verdicts[found], UNIQUE)
                s = np.flatnonzero(verdict == SETTLED)
                base = units.borders[row]
                done.append((ids[at + row[s]], nth[at + row[s]], (first - base)[s], (last - base)[s] + self.window))
                o = np.flatnonzero(verdict == OPEN)
                wins.append((ids[at + row[o]], nth[at + row[o]], *units.compared(row[o], first[o], last[o], anchor[o])))
            out, local = self.windows([np.concatenate(c) for c in zip(*wins)], buckets, group, extra)
            done.append(local)
            doc, nths, start, end = (np.concatenate(c) for c in zip(*done))
            if len(doc):
                out.append(spans_row(group % buckets, group, doc, nths, start, end))
            return pa.Table.from_batches([rows_batch(out)])

        return expand

    def settle_windows(self, groups: int):
        def settle(table: pa.Table) -> pa.Table:
            kinds = table["kind"].to_numpy()
            rows = [(g, 1, g, b) for g, b, k in zip(table["grp"].to_pylist(), table["body"].to_pylist(), kinds) if k == 1]
            bodies = [(g, b) for g, b, k in zip(table["grp"].to_pylist(), table["body"].to_pylist(), kinds) if k == 0]
            if bodies:
                home, doc, nth, start = self.judge(groups, bodies)
                for g, r in split(home):
                    rows.append(spans_row(g, g, doc[r], nth[r], start[r], start[r] + self.window))
            return pa.Table.from_batches([rows_batch(rows)])

        return settle

    # --- 4: what is left --------------------------------------------------------------------

    def finish(self, names: list[str]):
        def end_of(table: pa.Table) -> pa.Table:
            texts, told = self.parts(table)
            if texts is None:
                return pa.table({})
            ids, nth, text = numbered(texts, self.id_col, self.text_col)
            spans = {}
            if told:
                parts = [unpack([b]) for b in told]
                doc = np.concatenate([np.cumsum(x["doc"]) for x in parts])
                spans = merged(doc, *(np.concatenate([x[k] for x in parts]).astype(np.int64) for k in ("nth", "start", "end")))
                codes = pair_codes(spans[0], spans[1])
            sizes, removed, runs, kept = [], [], [], []
            for at, data, offsets in text_slices(text):
                units = self.units(data, offsets)
                n_rows = len(offsets) - 1
                mask = np.zeros(len(units) + 1, dtype=np.int32)
                count = np.zeros(n_rows, dtype=np.int64)
                if told:
                    here = pair_codes(ids[at : at + n_rows], nth[at : at + n_rows])
                    rank = np.argsort(here)
                    found = np.minimum(np.searchsorted(here, codes, sorter=rank), n_rows - 1)
                    mine = np.flatnonzero(here[rank[found]] == codes)
                    row = rank[found[mine]]
                    np.add.at(mask, units.borders[row] + spans[2][mine], 1)
                    np.add.at(mask, units.borders[row] + spans[3][mine], -1)
                    count = np.bincount(row, minlength=n_rows)
                gone = np.cumsum(mask[:-1]) > 0
                total = np.concatenate(([0], np.cumsum(gone)))
                sizes.append(np.diff(units.borders))
                removed.append(total[units.borders[1:]] - total[units.borders[:-1]])
                runs.append(count)
                kept += self.kept(units, gone)
            columns = [texts[n] for n in names]
            extra = [pa.array(np.concatenate(c).astype(np.int64)) for c in (sizes, removed, runs)]
            return pa.table([*columns, *extra, pa.array(kept, pa.binary())], names=[*names, *RESULTS])

        return end_of

    # --- the plan ---------------------------------------------------------------------------

    def apply(self, docs: DataFrame, extra=None) -> DataFrame:
        """`docs` with its size and the part removed in units, the number of removed spans, and what is left as bytes."""
        total = docs.agg(F.sum(F.octet_length(self.text_col))).first()[0] or 0
        groups = max(8, -(-total // GROUP_BYTES))
        buckets = max(8, -(-total // BUCKET_BYTES))
        slim = docs.select(F.col(self.id_col).cast("long").alias(self.id_col), self.text_col)
        runs = slim.mapInArrow(self.send_runs(buckets, groups), PACKED)
        verdicts = runs.groupBy("bucket").applyInArrow(self.settle_runs(groups), PACKED)
        texts = slim.mapInArrow(self.send_texts(groups), PACKED)
        windows = texts.union(verdicts).groupBy("bucket").applyInArrow(self.open_windows(buckets, extra and extra(buckets)), PACKED)
        spans = windows.groupBy("bucket").applyInArrow(self.settle_windows(groups), PACKED)
        whole = docs.mapInArrow(self.send_texts(groups), PACKED)
        fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
        return whole.union(spans).groupBy("bucket").applyInArrow(
            self.finish(docs.columns), ", ".join([fields, *(f"{n} {t}" for n, t in zip(RESULTS, ("long", "long", "long", "binary")))])
        )


def pair_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a.astype(np.uint64)) + b.astype(np.uint64))
