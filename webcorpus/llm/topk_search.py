"""Exact top-k search by inner product as a Voronoi join.

1. Pivots, a bounded sample of the vectors, part the space into cells; a vector belongs to its nearest
   pivot.  One pass sums up each cell: its rows by distance to the pivot, its radius, and the distances
   of its nearest rows.
2. From the summaries every query gets a score that its k-th best row reaches at least: a row at
   distance d from pivot p scores between <q, p> - |q| d and <q, p> + |q| d.  Queries of neighbouring
   cells form a group; per group and cell the least distance at which a row can still matter follows.
3. Rows go to the groups that may need them, and only there; groups of many rows or queries are dealt in
   blocks.  Each block is solved locally, and the best of the blocks of a query are merged.

Bounds are worked out in double precision with room for rounding and only ever leave out rows that
cannot be among the best; scores are exact integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm.hashing import mix
from webcorpus.llm.packing_io import from_bytes, to_bytes
from webcorpus.sources.storage import stored

SCALE = 1024
PIVOTS = 1024            # cells at most
GROUPS = 1024            # groups of queries at most, so that the table of bounds stays small
BLOCK_BYTES = 16 << 20   # of queries, and of rows, in double precision, in one block
CHUNK = 4096             # rows that are scored at once
RINGS = 64               # steps of distance in a cell's summary
EXACT = 2.0**53          # doubles hold every integer up to here
LONG = 2**63 - 1
PACKED = "block long, kind int, body binary"


def vectors_of(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their components as floor(SCALE * x)); missing components at the end are 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.list_(pa.float64()))
    flat = column.flatten()
    sizes = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    there = np.asarray(column.is_valid())
    row = np.repeat(np.arange(len(column)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(np.asarray(flat.fill_null(float("nan")), dtype=np.float64) * SCALE)
    there &= np.bincount(row[~np.isfinite(values)], minlength=len(column)) == 0
    out = np.zeros((len(column), width))
    out[row, place] = np.nan_to_num(values, posinf=0, neginf=0)
    at = np.flatnonzero(there)
    return at, out[at]


def norms(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((x * x).sum(axis=1))


class Cells:
    """Pivots, and which of them is nearest to a vector."""

    def __init__(self, pivots: np.ndarray):
        self.pivots, self.size = pivots, norms(pivots)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its pivot); the distance has room for rounding."""
        cell = np.zeros(len(x), dtype=np.int64)
        with np.errstate(over="ignore", invalid="ignore"):
            for r in range(0, len(x), CHUNK):
                cell[r : r + CHUNK] = (x[r : r + CHUNK] @ self.pivots.T - self.size**2 / 2).argmax(axis=1)
            distance = norms(x - self.pivots[cell])
        return cell, np.nan_to_num(distance, nan=np.inf)

    def scores(self, q: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            return q @ self.pivots.T


def ring_of(distance: np.ndarray) -> np.ndarray:
    """Step of a distance: four for each power of two from 1 on, the last one for all beyond."""
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(4 * np.log2(np.maximum(distance, 1))), 0, RINGS - 1).astype(np.int64)


def batches_of(batches: Iterator[pa.RecordBatch], width: int):
    """(ids, vectors) of the rows of each batch that take part."""
    for batch in batches:
        at, x = vectors_of(batch.column(1), width)
        ids = batch.column(0).to_numpy(zero_copy_only=False)[at]
        yield ids, x


def pivots_of(base: DataFrame, n: int, width: int) -> np.ndarray:
    """About the square root of n vectors, PIVOTS at most: those whose ids have the least hashes."""
    k = max(1, min(PIVOTS, math.isqrt(n)))
    luck = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30))
    some = base.where(luck <= math.ceil((2 * k + 20) / max(n, 1) * (1 << 30))).withColumn("luck", luck)
    rows = some.orderBy("luck", "id", "vector").limit(k).select("vector").toArrow()
    _, x = vectors_of(rows["vector"], width)
    return np.unique(x, axis=0) if len(x) else np.zeros((1, width))


# --- 1: summaries ----------------------------------------------------------------------------

SUMMARY = "cell long, rings binary, near binary"


def summaries(vectors: DataFrame, cells: Cells, width: int, k: int) -> list:
    """Of each cell: its rows by ring, and its k + 1 least distances; a row per cell comes to the driver."""

    def row(cell, rings, near):
        return {"cell": int(cell), "rings": rings.astype(np.int64).tobytes(), "near": np.sort(near)[: k + 1].tobytes()}

    def task(batches):
        rings = np.zeros((len(cells.pivots), RINGS), np.int64)
        near: dict[int, np.ndarray] = {}
        for _, x in batches_of(batches, width):
            cell, distance = cells.assign(x)
            np.add.at(rings, (cell, ring_of(distance)), 1)
            order = np.lexsort((distance, cell))
            first = np.flatnonzero(np.diff(cell[order], prepend=-1))
            for a, b in zip(first, [*first[1:], len(order)]):
                c = int(cell[order[a]])
                best = distance[order[a : min(b, a + k + 1)]]
                near[c] = np.sort(np.concatenate((near[c], best)))[: k + 1] if c in near else best
        yield pa.RecordBatch.from_pylist([row(c, rings[c], near[c]) for c in near], schema=schema)

    def merge(table: pa.Table) -> pa.Table:
        rings = sum(np.frombuffer(b, np.int64) for b in table["rings"].to_pylist())
        near = np.concatenate([np.frombuffer(b, np.float64) for b in table["near"].to_pylist()])
        return pa.Table.from_pylist([row(table["cell"][0].as_py(), rings, near)], schema=schema)

    schema = pa.schema([("cell", pa.int64()), ("rings", pa.binary()), ("near", pa.binary())])
    return vectors.mapInArrow(task, SUMMARY).groupBy("cell").applyInArrow(merge, SUMMARY).collect()


class Plan:
    """What the driver knows: a summary per cell, groups of cells, and how many blocks a group has."""

    def __init__(self, cells: Cells, rows: list, queries: list, k: int, width: int):
        n = len(cells.pivots)
        self.cells, self.k = cells, k
        self.queries = np.zeros(n, np.int64)
        self.rings = np.zeros((n, RINGS), np.int64)
        self.near = np.full((n, k + 1), np.inf)
        for r in queries:
            self.queries[r["cell"]] = np.frombuffer(r["rings"], np.int64).sum()
        for r in rows:
            self.rings[r["cell"]] = np.frombuffer(r["rings"], np.int64)
            near = np.frombuffer(r["near"], np.float64)
            self.near[r["cell"], : len(near)] = near
        self.limit = max(1, BLOCK_BYTES // (8 * max(width, 1)))
        self.group = self.grouped(max(self.limit, -(-int(self.queries.sum()) // GROUPS)))
        self.sizes = np.bincount(self.group, weights=self.queries).astype(np.int64)
        self.parts = np.maximum(1, -(-self.sizes // self.limit))

    def grouped(self, limit: int) -> np.ndarray:
        """Group of each cell: a chain from pivot to nearest pivot, cut when a group has enough queries."""
        pivots = self.cells.pivots
        left = np.ones(len(pivots), dtype=bool)
        group = np.zeros(len(pivots), dtype=np.int64)
        at, g, have = int(np.argmax(norms(pivots - pivots.mean(axis=0)))), 0, 0
        for _ in range(len(pivots)):
            if have and have + self.queries[at] > limit:
                g, have = g + 1, 0
            group[at] = g
            have += self.queries[at]
            left[at] = False
            if left.any():
                with np.errstate(over="ignore", invalid="ignore"):
                    away = norms(pivots - pivots[at])
                at = int(np.argmin(np.where(left, np.nan_to_num(away, nan=np.inf), np.inf)))
                at = at if left[at] else int(np.flatnonzero(left)[0])
        return group

    def least_scores(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(what the k-th best row of each query scores at least, scores of the pivots, sizes of the queries).

        One row more than k is counted, as the query's own row is among them.
        """
        at_pivots, size = self.cells.scores(q), norms(q)
        best = np.full((len(q), self.k + 1), -np.inf)
        with np.errstate(over="ignore", invalid="ignore"):
            for m in range(self.k + 1):
                # Row m of every cell; those of a cell come in falling order, so a full round decides.
                found = at_pivots - size[:, None] * self.near[:, m]
                found = np.nan_to_num(found - self.room(size, self.near[:, m]), nan=-np.inf, neginf=-np.inf)
                both = np.concatenate((best, found), axis=1)
                best = -np.partition(-both, self.k, axis=1)[:, : self.k + 1]
        return best.min(axis=1), at_pivots, size

    def room(self, size: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """For rounding."""
        with np.errstate(over="ignore", invalid="ignore"):
            return 1e-9 * size[:, None] * (self.cells.size + distance) + 1e-6

    def needed(self, q: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Per group and cell, the distance from which on a row may be among the best of one of these queries."""
        least, at_pivots, size = self.least_scores(q)
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            far = (least[:, None] - at_pivots - self.room(size, np.zeros(1))) / np.maximum(size, 1e-300)[:, None]
            far = np.where(np.isfinite(far), far * (1 - 1e-9) - 1e-3 * (size[:, None] > 0), -np.inf)
            far = np.where(size[:, None] > 0, far, -np.inf)
        out = np.full((int(group.max()) + 1 if len(group) else 0, far.shape[1]), np.inf)
        np.minimum.at(out, group, far)
        return out

    def block_table(self, need: np.ndarray):
        """First block and number of shares of the rows of each group, by the rows that it needs at most."""
        edge = 2.0 ** (np.arange(RINGS) / 4)
        edge[-1] = np.inf
        upper = np.append(edge[1:], np.inf)
        rows = np.array([(self.rings * (upper[None, :] >= n[:, None])).sum() for n in need])
        shares = np.maximum(1, -(-rows // self.limit))
        first = np.concatenate(([0], np.cumsum(shares * self.parts)))
        return first[:-1], shares


def query_groups(ids: np.ndarray, cell: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Group of each query, and its part of the group's queries."""
    group = plan.group[cell]
    return group, (mix(ids.astype(np.uint64)) % plan.parts[group].astype(np.uint64)).astype(np.int64)


# --- 2: bounds -------------------------------------------------------------------------------


def bounds(queries: DataFrame, plan: Plan, width: int) -> np.ndarray:
    """`Plan.needed` over all queries: GROUPS times PIVOTS numbers at most."""

    def task(batches):
        out: dict[int, np.ndarray] = {}
        for ids, x in batches_of(batches, width):
            for r in range(0, len(x), CHUNK):
                group = plan.group[plan.cells.assign(x[r : r + CHUNK])[0]]
                some, inner = np.unique(group, return_inverse=True)
                for g, need in zip(some.tolist(), plan.needed(x[r : r + CHUNK], inner)):
                    out[g] = np.minimum(out[g], need) if g in out else need
        rows = [{"grp": g, "need": below(need).tobytes()} for g, need in out.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def merge(table: pa.Table) -> pa.Table:
        need = reduce(np.minimum, (np.frombuffer(b, np.float32) for b in table["need"].to_pylist()))
        return pa.Table.from_pylist([{"grp": table["grp"][0].as_py(), "need": need.tobytes()}], schema=schema)

    def below(x: np.ndarray) -> np.ndarray:
        """In single precision, rounded down."""
        with np.errstate(over="ignore"):
            return np.nextafter(x.astype(np.float32), np.float32(-np.inf))

    schema = pa.schema([("grp", pa.int64()), ("need", pa.binary())])
    found = queries.mapInArrow(task, "grp long, need binary").groupBy("grp").applyInArrow(merge, "grp long, need binary")
    need = np.full((len(plan.sizes), len(plan.cells.pivots)), np.inf)
    for r in found.collect():
        need[r["grp"]] = np.frombuffer(r["need"], np.float32)
    return need


# --- 3: blocks -------------------------------------------------------------------------------


def narrow(x: np.ndarray) -> np.ndarray:
    """The narrowest type that holds these whole numbers."""
    most = np.abs(x).max() if x.size else 0
    for kind in (np.int16, np.int32, np.int64):
        if most < np.iinfo(kind).max // 2:
            return x.astype(kind)
    return x


def packed(ids: np.ndarray, x: np.ndarray) -> bytes:
    width = x.shape[1]
    flat = pa.array(narrow(x).ravel())
    columns = [pa.array(ids)] + ([pa.FixedSizeListArray.from_arrays(flat, width)] if width else [])
    return to_bytes(pa.RecordBatch.from_arrays(columns, ["ids", "x"][: len(columns)]))


def unpacked(bodies: list[bytes], width: int):
    """(ids, vectors) of all bodies in order of their ids."""
    ids, x = [np.zeros(0, np.int64)], [np.zeros((0, width))]
    for body in bodies:
        table = from_bytes(body).combine_chunks()
        ids.append(table["ids"].to_numpy())
        flat = table["x"].combine_chunks().flatten().to_numpy() if width else np.zeros(0)
        x.append(flat.astype(np.float64).reshape(len(table), width))
    ids, x = np.concatenate(ids), np.concatenate(x)
    order = np.argsort(ids, kind="stable")
    return ids[order], x[order]


def sent_rows(plan: Plan, need: np.ndarray, first: np.ndarray, shares: np.ndarray, width: int):
    """Rows to the blocks of the groups that may need them."""

    def send(batches):
        for ids, x in batches_of(batches, width):
            cell, distance = plan.cells.assign(x)
            out = []
            for g in range(len(need)):
                at = np.flatnonzero(distance >= need[g][cell]) if plan.sizes[g] else ()
                if not len(at):
                    continue
                share = (mix(ids[at].astype(np.uint64) + np.uint64(g)) % np.uint64(shares[g])).astype(np.int64)
                for s in np.unique(share).tolist():
                    r = at[share == s]
                    body = packed(ids[r], x[r])
                    out += [{"block": int(first[g] + p * shares[g] + s), "kind": 0, "body": body} for p in range(plan.parts[g])]
            yield pa.RecordBatch.from_pylist(out, schema=SENT)

    return send


def sent_queries(plan: Plan, first: np.ndarray, shares: np.ndarray, width: int):
    """Queries to all blocks of their part of their group."""

    def send(batches):
        for ids, x in batches_of(batches, width):
            cell, _ = plan.cells.assign(x)
            group, part = query_groups(ids, cell, plan)
            out = []
            for g, p in np.unique(np.stack((group, part), axis=1), axis=0).tolist():
                r = np.flatnonzero((group == g) & (part == p))
                body = packed(ids[r], x[r])
                out += [{"block": int(first[g] + p * shares[g] + s), "kind": 1, "body": body} for s in range(shares[g])]
            yield pa.RecordBatch.from_pylist(out, schema=SENT)

    return send


SENT = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("body", pa.binary())])
FOUND = pa.schema([("query_id", pa.int64()), ("nth", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def best_of_block(q_ids, q, ids, x, k: int):
    """(query, row, score) of the k best rows of each query in this block, ties to smaller ids; ids must be sorted."""
    exact = float(norms(q).max(initial=0)) * float(norms(x).max(initial=0)) < EXACT / CHUNK
    if not exact:   # too large for doubles: Python's whole numbers
        q, x = (np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape) for m in (q, x))
    kind = np.float64 if exact else object
    best = np.full((len(q), k), -np.inf).astype(kind)
    which = np.full((len(q), k), -1, dtype=np.int64)
    for r in range(0, len(x), CHUNK):
        part, part_ids = x[r : r + CHUNK], ids[r : r + CHUNK]
        for a in range(0, len(q), 256):
            rows = slice(a, a + 256)
            score = q[rows].dot(part.T)
            if not exact:
                score = np.clip(score, -LONG - 1, LONG)
            score[q_ids[rows][:, None] == part_ids[None, :]] = -np.inf
            # Rows come in order of their ids, so one that only equals the k-th best loses.
            hit = np.flatnonzero((score > best[rows][:, -1:]).any(axis=1))
            if not len(hit):
                continue
            score = score[hit]
            n = min(k, len(part))
            if exact:   # score and place in one number
                key = score * CHUNK - np.arange(len(part))
                top = np.argpartition(-key, n - 1, axis=1)[:, :n]
                top = np.take_along_axis(top, np.argsort(-np.take_along_axis(key, top, 1), axis=1), 1)
            else:
                top = np.array([sorted(range(len(part)), key=lambda j, s=s: (-s[j], j))[:n] for s in score])
            both = np.concatenate((best[a + hit], np.take_along_axis(score, top, 1)), axis=1)
            names = np.concatenate((which[a + hit], top + r), axis=1)
            if exact:   # stable, and earlier rows stand first
                order = np.argsort(-both, axis=1, kind="stable")[:, :k]
            else:
                order = np.array([sorted(range(both.shape[1]), key=lambda j, s=s: -s[j])[:k] for s in both])
            best[a + hit] = np.take_along_axis(both, order, 1)
            which[a + hit] = np.take_along_axis(names, order, 1)
    there = best > -np.inf
    query, _ = np.nonzero(there)
    return query, which[there], best[there].astype(np.int64)


def solve(width: int, k: int):
    def block(table: pa.Table) -> pa.Table:
        kinds, bodies = table["kind"].to_numpy(), table["body"].to_pylist()
        q_ids, q = unpacked([b for b, kind in zip(bodies, kinds) if kind], width)
        if not len(q_ids):
            return FOUND.empty_table()
        ids, x = unpacked([b for b, kind in zip(bodies, kinds) if not kind], width)
        # Equal query rows are one query; rows that only share an id are told apart by their vectors.
        place = np.arange(width, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        nth = mix(mix(q.view(np.uint64) + place).sum(axis=1, dtype=np.uint64)).view(np.int64)
        _, one = np.unique(np.stack((q_ids, nth), axis=1), axis=0, return_index=True)
        q_ids, q, nth = q_ids[one], q[one], nth[one]
        query, row, score = best_of_block(q_ids, q, ids, x, k)
        return pa.table([q_ids[query], nth[query], ids[row], score], schema=FOUND)

    return block


def topk_search(vectors: DataFrame, queries: Column, k: int = 10, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """For each row where `queries` holds, the k rows of other ids with the highest inner product of floor(1024 * x).

    Returns query_id, rank (from 1), vec_id and score; ties go to the smaller vec_id, then to any row.
    Fewer rows than k give all.  Rows without an id, and vectors that are null or hold a component that
    is null or not finite (also once it is multiplied by 1024), take no part.  Shorter vectors count
    as if zeros followed; an empty one scores 0.  Rows that share an id are not compared; each is a
    row of its own as a candidate, and as a query with its own ranks unless its vector is the same.
    A score beyond a long counts as the end of its range.  Other columns of
    `vectors` are not looked at, whatever their names.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    vector, key = F.col(f"`{vector_col}`"), F.col(f"`{id_col}`")
    asked = vectors.where(key.isNotNull() & vector.isNotNull()).select(
        key.cast("long").alias("id"), vector.cast("array<double>").alias("vector"), queries.alias("asked")
    )
    base = asked.select("id", "vector")
    n, width = base.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    wanted = stored(asked.where("asked").select("id", "vector"), "queries")
    cells = Cells(pivots_of(base, n, width))
    plan = Plan(cells, summaries(base, cells, width, k), summaries(wanted, cells, width, k), k, width)
    need = bounds(wanted, plan, width)
    first, shares = plan.block_table(need)
    sent = base.mapInArrow(sent_rows(plan, need, first, shares, width), PACKED)
    sent = sent.union(wanted.mapInArrow(sent_queries(plan, first, shares, width), PACKED))
    found = sent.groupBy("block").applyInArrow(solve(width, k), "query_id long, nth long, vec_id long, score long")
    order = Window.partitionBy("query_id", "nth").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
