"""Embedding near-dedup: NN-descent links near vectors, an exact pass finds what lists can't hold.

Lists start from random-projection cells of a label and are improved by local joins: the members of a
list, neighbours and those who list its owner, meet around it.  A list whose entries are all links is
saturated and enlarged in the next round.  After each round the lists are audited: for a sample of vectors all
links are counted by brute force, and the share that the lists hold is taken per vector and averaged per
class of link counts.  Rounds go on until it is RECALL in each class, MOST_ROUNDS at most.

No result rests on that: an exact pass completes the links.  Vectors that many lists name, spread by
farthest-first choice, are the centres of cells; by the triangle inequality a vector is sent only to the
cells that reach within the threshold's angle of it, and only there compared.  So the pass grows with the
vectors that are near each other's cells, not with the square of a label, unless its vectors do not cluster.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm.hashing import mix
from webcorpus.llm.links import components
from webcorpus.sources.storage import stored

THRESHOLD = 0.93
LIST = 8            # neighbours in a list
TREES = 6           # projection trees
CELL = 96           # vectors in a cell, about
BLOCK = 1024        # vectors in one block; of large labels an eighth, up to MOST_IN_BLOCK
MOST_IN_BLOCK = 32 * BLOCK
COMPARED = 1 << 21  # similarities held at a time
ROUNDS = 2          # rounds of local joins, at least
MOST_ROUNDS = 5
WIDEST = 8 * LIST   # entries of a saturated list, at most
RECALL = 0.9        # share of a vector's links that its list holds, on average in each class
AUDITED = 1024      # vectors of the sample
CENTRES = 4096      # centres of cells, at most; they come to the driver
CANDIDATES = 4      # vectors that each centre is chosen from
LISTED_IN_GROUP = 8192   # entries of lists that a task joins at a time
EDGES = "a long, b long, sim double"


def packed(x: np.ndarray) -> bytes:
    """A vector as bytes: a mark, then single precision where that loses nothing, else double."""
    single = x.astype(np.float32)
    return b"f" + single.tobytes() if (single == x).all() else b"d" + x.tobytes()


def unit(body: bytes) -> np.ndarray:
    """The unit vector of packed bytes, in double precision."""
    x = np.frombuffer(body[1:], np.float32 if body[:1] == b"f" else np.float64).astype(np.float64)
    x = x / np.abs(x).max()
    return x / np.linalg.norm(x)


def matrix(column) -> np.ndarray:
    return np.array([unit(v) for v in column.to_pylist()]) if len(column) else np.zeros((0, 1))


def usable_vectors(batches):
    """(vec, label, size, packed vector) of usable rows; null, zero and non-finite vectors are left out."""
    for batch in batches:
        out = []
        for i, label, v in zip(batch.column("vec").to_pylist(), batch.column("label").to_pylist(), batch.column("v").to_pylist()):
            if i is None or label is None or not v or None in v:
                continue
            x = np.array(v, dtype=np.float64)
            if np.isfinite(x).all() and x.any():
                out.append((i, label, len(x), packed(x + 0.0)))
        columns = list(zip(*out)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["vec", "label", "size", "unit"])


def cells_of(first_tree: int, trees: int, seed: int):
    """(tree, cell) of each vector: signs of random projections, as many as the label's size asks for."""
    def deal(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            depth = batch.column("depth").to_numpy()
            size = batch.column("size").to_numpy()
            cell = np.zeros((trees, n), dtype=np.int64)
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                x = matrix(batch.column("unit").take(pa.array(rows)))
                for t in range(trees):
                    planes = np.random.default_rng((seed, first_tree + t, int(d))).standard_normal((int(d), 30))
                    bits = ((x @ planes) > 0).astype(np.int64)
                    bits[np.arange(30)[None, :] >= depth[rows][:, None]] = 0
                    code = (bits << np.arange(30)[None, :]).sum(axis=1)
                    cell[t, rows] = mix((code + (int(d) << 32)).astype(np.uint64)).view(np.int64)
            at = pa.array(np.tile(np.arange(n), trees))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(first_tree, first_tree + trees), n).astype(np.int64)), pa.array(cell.ravel()),
                 *(batch.column(c).take(at) for c in ("vec", "label", "unit"))],
                ["tree", "cell", "vec", "label", "unit"],
            )

    return deal


def top_edges(ids: np.ndarray, x: np.ndarray, keep: int):
    """Each row's `keep` nearest rows (a, b, sim)."""
    n = len(ids)
    if n < 2:
        return ids[:0], ids[:0], np.zeros(0)
    sim = x @ x.T
    np.fill_diagonal(sim, -2)
    k = min(keep, n - 1)
    near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    return np.repeat(ids, k), ids[near.ravel()], np.take_along_axis(sim, near, axis=1).ravel()


def edges_table(a, b, sim) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "sim": pa.array(sim, pa.float64())})


def cell_edges(table: pa.Table) -> pa.Table:
    return edges_table(*top_edges(table["vec"].to_numpy(), matrix(table["unit"]), LIST))


def join_edges(wide: int):
    """Local joins: the members of each list (owner, block) against each other."""
    return lambda table: joined_lists(table, wide)


def joined_lists(table: pa.Table, wide: int) -> pa.Table:
    vec, owner, block = (table[c].to_numpy() for c in ("vec", "owner", "block"))
    ids, at, which = np.unique(vec, return_index=True, return_inverse=True)
    size = table["size"].to_numpy()
    units = table["unit"].combine_chunks()
    order = np.lexsort((block, owner))
    new = np.flatnonzero(np.concatenate(([True], (owner[order][1:] != owner[order][:-1]) | (block[order][1:] != block[order][:-1]))))
    found = []
    for dimension in np.unique(size):
        rows = np.flatnonzero(size[at] == dimension)
        x = np.zeros((len(ids), int(dimension)))
        x[rows] = matrix(units.take(pa.array(at[rows])))
        for start, end in zip(new, [*new[1:], len(order)]):
            members = which[order[start:end]]   # all of one label and size, as their owner
            if end - start > 1 and size[at[members[0]]] == dimension:
                found.append(top_edges(ids[members], x[members], wide))
    return edges_table(*(np.concatenate(c) for c in zip(*found))) if found else edges_table([], [], [])


def lists(edges: DataFrame, wide: int = LIST) -> DataFrame:
    """The LIST nearest neighbours of each vector, and of a saturated list up to `wide` links; formed in part before the exchange."""
    best = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    nth = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    ranked = best.withColumn("nth", nth).where(F.col("nth") <= wide)
    return ranked.where((F.col("nth") <= LIST) | (F.col("sim") >= THRESHOLD)).drop("nth")


def sample_of(vectors: DataFrame) -> tuple[list, dict]:
    """A bounded sample of vectors, chosen by hash, and how many links each of them has, by brute force in the tasks."""
    luck = F.xxhash64("vec", F.lit(5))
    rows = vectors.orderBy(luck, "vec").limit(AUDITED).select("vec", F.concat_ws("/", "label", "size").alias("kind"), "unit").collect()
    by_kind: dict[str, list] = {}
    for r in rows:
        by_kind.setdefault(r["kind"], []).append(r)
    groups = {k: (np.array([r["vec"] for r in g]), np.array([unit(r["unit"]) for r in g])) for k, g in by_kind.items()}

    def count(batches):
        total: dict[int, int] = {}
        for batch in batches:
            kinds, vec = np.array(batch.column("kind").to_pylist(), dtype=object), batch.column("vec").to_numpy()
            for kind, (ids, x) in groups.items():
                at = np.flatnonzero(kinds == kind)
                if len(at):
                    linked = (x @ matrix(batch.column("unit").take(pa.array(at))).T >= THRESHOLD) & (ids[:, None] != vec[at][None, :])
                    for i, n in zip(ids.tolist(), linked.sum(axis=1).tolist()):
                        total[i] = total.get(i, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["vec", "n"])

    slim = vectors.select("vec", F.concat_ws("/", "label", "size").alias("kind"), "unit")
    found = slim.mapInArrow(count, "vec long, n long").groupBy("vec").agg(F.sum("n").alias("n")).collect()
    return [r["vec"] for r in rows], {r["vec"]: r["n"] for r in found if r["n"]}


def audit(edges: DataFrame, sample: list, links: dict) -> dict[str, float]:
    """Average share of a sampled vector's links that the lists hold, by class of link counts; 1 without any.

    Vectors with more links than the widest list holds are left to the exact pass.
    """
    near = edges.where(F.col("sim") >= THRESHOLD)
    both = near.select("a", "b").union(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    held = both.where(F.col("a").isin(sample)).distinct().groupBy("a").agg(F.count(F.lit(1)).alias("n")).collect()
    held = {r["a"]: r["n"] for r in held}
    shares: dict[str, list[float]] = {"single": [], "few": [], "many": []}
    for vec, n in links.items():
        if n <= WIDEST:
            shares["single" if n == 1 else "few" if n <= LIST else "many"].append(min(1.0, held.get(vec, 0) / n))
    return {k: float(np.mean(v)) if v else 1.0 for k, v in shares.items()}


def within_reach(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rows of x that can link with a row of y: no farther from y's centre than its radius and the threshold's angle."""
    centre = y.mean(axis=0)
    length = np.linalg.norm(centre)
    if length < 1e-6:
        return np.arange(len(x))
    centre /= length
    reach = np.arccos(np.clip((y @ centre).min(), -1, 1)) + np.arccos(THRESHOLD) + 1e-6
    return np.flatnonzero(x @ centre >= np.cos(reach)) if reach < np.pi else np.arange(len(x))


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (the least member of each group) after the groups of a and b became one, pair by pair."""
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low < high
        a, b = a[open_], b[open_]
        np.minimum.at(root, high[open_], low[open_])
        while (root[root] != root).any():
            root = root[root]
    return root


def block_pairs(table: pa.Table) -> pa.Table:
    """Links between the members of two blocks, or within one: their number and a link to the least of its group, per member."""
    side, weight = table["side"].to_numpy(), table["copies"].to_numpy()
    vec, x = table["vec"].to_numpy(), matrix(table["unit"])
    ids, at = np.unique(vec, return_inverse=True)
    first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = table["block"][0].as_py() == table["meets"][0].as_py()
    n, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
    if len(first) and len(second):
        i = first[within_reach(x[first], x[second])]
        j = second[within_reach(x[second], x[first])]
        step = max(1, COMPARED // max(1, len(j)))
        for start in range(0, len(i), step):
            rows = i[start : start + step]
            linked = (x[rows] @ x[j].T >= THRESHOLD) & (at[rows][:, None] != at[j][None, :])
            n[at[rows]] += linked @ weight[j]
            if not alone:
                n[at[j]] += weight[rows] @ linked
            some = np.flatnonzero(linked.any(axis=1))
            linked = linked[some]
            root = unite(root, at[rows[some]], at[j[linked.argmax(axis=1)]])
            r, c = np.nonzero(linked & (root[at[rows[some]]][:, None] != root[at[j]][None, :]))
            root = unite(root, at[rows[some[r]]], at[j[c]])
    has = n > 0
    return pa.table({"vec": ids[has], "n": n[has], "root": ids[root[has]]})


def centres_of(vectors: DataFrame, edges: DataFrame, sizes: DataFrame) -> dict:
    """(label, size) -> unit vectors of the centres, of the largest labels that take more than a block; CENTRES in all at most."""
    cells = sizes.where(F.col("n") > F.col("rows")).withColumn("cells", F.least(F.lit(CENTRES), F.ceil(F.col("n") / F.col("rows"))))
    most = cells.orderBy(F.desc("n"), "label", "size").limit(CENTRES)
    total = F.sum("cells").over(Window.orderBy(F.desc("n"), "label", "size"))   # of CENTRES rows at most
    most = most.withColumn("total", total).where(F.col("total") <= CENTRES).select("label", "size", "cells")
    named = edges.groupBy(F.col("b").alias("vec")).agg(F.count(F.lit(1)).alias("named"))
    nth = F.row_number().over(Window.partitionBy("label", "size").orderBy(F.desc("named"), F.xxhash64("vec"), "vec"))
    hubs = vectors.join(most, ["label", "size"]).join(named, "vec", "left").withColumn("named", F.coalesce("named", F.lit(0)))
    rows = hubs.withColumn("nth", nth).where(F.col("nth") <= CANDIDATES * F.col("cells")).orderBy("label", "size", "nth").collect()
    out: dict = {}
    for key in dict.fromkeys((r["label"], r["size"]) for r in rows):
        some = [r for r in rows if (r["label"], r["size"]) == key]
        x = np.array([unit(r["unit"]) for r in some])
        chosen, near = [0], x @ x[0]
        while len(chosen) < min(some[0]["cells"], len(x)):
            chosen.append(int(near.argmin()))
            near = np.maximum(near, x @ x[chosen[-1]])
        out[key] = x[chosen]
    return out


def angles(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ centres.T, -1, 1))


def by_kind(batch: pa.RecordBatch, centres: dict):
    """(key, rows, angles to its centres) of each label and size of a batch that has centres."""
    keys = list(zip(batch.column("label").to_pylist(), batch.column("size").to_pylist()))
    for key in set(keys) & centres.keys():
        at = np.array([i for i, k in enumerate(keys) if k == key])
        cosine = matrix(batch.column("unit").take(pa.array(at))) @ centres[key].T
        yield key, at, np.arccos(np.clip(cosine, -1, 1))


def in_cells(centres: dict):
    """Adds the cell of each vector and its angle to the centre."""

    def place(batches):
        for batch in batches:
            cell, angle = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for _, at, far in by_kind(batch, centres):
                cell[at], angle[at] = far.argmin(axis=1), far.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], [*batch.schema.names, "cell", "angle"])

    return place


def near_cells(centres: dict, radii: dict):
    """Adds the cells that come within the threshold's angle of each vector."""
    reach = np.arccos(THRESHOLD) + 1e-6

    def place(batches):
        for batch in batches:
            meets = [[0]] * batch.num_rows
            for key, at, far in by_kind(batch, centres):
                for i, row in zip(at.tolist(), far <= radii[key][None, :] + reach):
                    meets[i] = np.flatnonzero(row).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(meets, pa.list_(pa.int32()))], [*batch.schema.names, "meets"])

    return place


def all_links(vectors: DataFrame, edges: DataFrame) -> DataFrame:
    """(vec, n, root): parts of the number of links of each linked vector, and links that span its component."""
    what = ("label", "size", "vec", "unit", "copies")
    schema = "label string, size long, vec long, unit binary, copies long, cell int, angle double"
    sizes = vectors.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = stored(sizes.withColumn("rows", F.greatest(F.lit(BLOCK), F.least(F.lit(MOST_IN_BLOCK), F.ceil(F.col("n") / 8)))), "sizes")
    centres = centres_of(vectors, edges, sizes)
    radii = {key: np.zeros(len(x)) for key, x in centres.items()}
    placed = stored(vectors.select(*what).mapInArrow(in_cells(centres), schema), "placed")
    # Of labels without centres nothing comes to the driver: all their angles are 0.
    for r in placed.where("angle > 0").groupBy("label", "size", "cell").agg(F.max("angle").alias("r")).collect():
        radii[r["label"], r["size"]][r["cell"]] = r["r"]
    placed = placed.mapInArrow(near_cells(centres, radii), f"{schema}, meets array<int>").drop("angle")
    # Cells with many vectors are several blocks.
    blocks = placed.groupBy("label", "size", "cell").agg(F.count(F.lit(1)).alias("n")).join(sizes.drop("n"), ["label", "size"])
    blocks = blocks.select("label", "size", "cell", F.ceil(F.col("n") / F.col("rows")).alias("pieces"))
    before = Window.partitionBy("label", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored(blocks.withColumn("start", F.coalesce(F.sum("pieces").over(before), F.lit(0))), "blocks")
    own = F.col("start") + F.pmod(F.xxhash64("vec"), F.col("pieces"))
    members = placed.join(blocks, ["label", "size", "cell"]).select(*what, own.alias("own"), F.explode("meets").alias("cell"))
    met = members.join(blocks, ["label", "size", "cell"])
    other = F.explode(F.sequence("start", F.col("start") + F.col("pieces") - 1))
    met = met.select(*what, "own", other.alias("other"))
    one = met.where("other >= own").select(*what, F.col("own").alias("block"), F.col("other").alias("meets"), F.lit(0).alias("side"))
    two = met.where("other <= own").select(*what, F.col("other").alias("block"), F.col("own").alias("meets"), F.lit(1).alias("side"))
    found = one.union(two).groupBy("label", "size", "block", "meets").applyInArrow(block_pairs, "vec long, n long, root long")
    return stored(found, "met")


def embedding_links(rows: DataFrame, id_col="vec_id", vector_col="embedding", label_col="label", seed: int = 7):
    """(vec, rep, copies) of all usable rows, (vec, n) with the links of each linked class, and links that span the components."""
    units = rows.select(
        F.col(id_col).cast("long").alias("vec"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v")
    ).mapInArrow(usable_vectors, "vec long, label string, size long, unit binary")
    units = stored(units, "units")
    # Equal vectors of a label are one class (-0.0 was made 0.0), under its least id, with the number of its members.
    vectors = stored(units.groupBy("label", "size", "unit").agg(F.min("vec").alias("vec"), F.count(F.lit(1)).alias("copies")), "vectors")
    sizes = vectors.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    depth = F.greatest(F.lit(0), F.least(F.lit(30), F.ceil(F.log2(F.col("n") / CELL)))).cast("long")
    dealt = vectors.join(sizes, "label").select("vec", "label", "size", "unit", depth.alias("depth"))
    placed = dealt.mapInArrow(cells_of(0, TREES, seed), "tree long, cell long, vec long, label string, unit binary")
    # A crowded cell is cut into blocks; its vectors meet others in other trees and in the joins.
    crowd = placed.groupBy("label", "tree", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    placed = placed.join(crowd, ["label", "tree", "cell"]).withColumn("block", F.pmod(F.xxhash64("vec", "tree"), F.col("blocks")))
    edges = stored(lists(placed.groupBy("label", "tree", "cell", "block").applyInArrow(cell_edges, EDGES)), "lists")
    sample, linked = sample_of(vectors)
    for r in range(MOST_ROUNDS):
        wide = min(WIDEST, LIST << r)
        both = edges.select(F.col("a").alias("owner"), F.col("b").alias("vec")).union(
            edges.select(F.col("b").alias("owner"), F.col("a").alias("vec"))
        ).distinct()
        # Those who list a hub are many: they meet in blocks around it.
        crowd = both.groupBy("owner").agg(F.ceil(F.count(F.lit(1)) / (4 * LIST)).alias("blocks"))
        both = both.join(crowd, "owner").withColumn("block", F.pmod(F.xxhash64("vec", F.lit(r)), F.col("blocks")))
        # Lists are small: many of them share a task's group.
        deal = F.pmod(F.xxhash64("owner", "block"), F.lit(-(-edges.count() // LISTED_IN_GROUP) or 1))
        both = both.join(vectors.select("vec", "size", "unit"), "vec").withColumn("deal", deal)
        met = both.groupBy("deal").applyInArrow(join_edges(wide), EDGES)
        edges = stored(lists(edges.union(met), 2 * wide), "lists")
        if r + 1 >= ROUNDS and min(audit(edges, sample, linked).values()) >= RECALL:
            break
    met = all_links(vectors, edges)
    counts = met.groupBy("vec").agg(F.sum("n").alias("n"))
    links = met.where("vec <> root").select(F.col("vec").alias("a"), F.col("root").alias("b"))
    classes = units.join(vectors.select("label", "unit", F.col("vec").alias("rep"), "copies"), ["label", "unit"])
    return classes.select("vec", "rep", "copies"), counts, links


def embedding_dedup(rows: DataFrame, id_col="vec_id", vector_col="embedding", label_col="label") -> DataFrame:
    """Adds n_links, component_id and kept to all columns of `rows`.

    Linked: equal label, not null, and a cosine of at least THRESHOLD in double precision.  Vectors
    that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors
    of different length.  Equal vectors link with each other.  Ids are taken to be unique; a row with a
    null id links with nothing and its component is null.  Columns of `rows` with the added names are
    replaced.  An empty table gives none.
    """
    added = ("n_links", "component_id", "kept")
    out = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in added])
    classes, counts, links = embedding_links(rows, id_col, vector_col, label_col)
    same = classes.where("vec <> rep").select(F.col("vec").alias("a"), F.col("rep").alias("b"))
    comps = components(links.union(same))
    per = classes.join(counts.select(F.col("vec").alias("rep"), "n"), "rep", "left").select(
        F.col("vec").alias("emb__vec"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("emb__n")
    ).join(comps, F.col("emb__vec") == F.col("id"), "left").select("emb__vec", "emb__n", F.col("component_id").alias("emb__c"))
    joined = out.join(per, F.col(id_col) == F.col("emb__vec"), "left")
    component = F.coalesce("emb__c", F.col(id_col).cast("long"))
    return joined.withColumns({
        "n_links": F.coalesce("emb__n", F.lit(0)).cast("long"), "component_id": component,
        "kept": F.coalesce(F.col(id_col) == component, F.lit(True)),
    }).drop("emb__vec", "emb__n", "emb__c")
