"""MinHash near-dedup with SetSketch registers, verified on full shingle sets.

A register is the truncated logarithm (base 1.001) of the least of one exponential variate per
shingle: registers of a union are the maxima of registers, and two sets agree in a register with a
probability close to their Jaccard similarity.  Bands of four registers choose candidates; a joint
likelihood estimate from all registers leaves out pairs that are far from the threshold; the rest is
confirmed on the full sets of shingle names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.hashing import BASES, Roll, lower_ascii, mix, text_slices, word_names, words_of
from webcorpus.llm.links import components
from webcorpus.llm.packing_io import from_bytes, gathered, groups_of, ids_of, pack, split, to_bytes, unpack
from webcorpus.llm.repeats import first_of
from webcorpus.sources.storage import stored

SHINGLE = 4           # words, unless a caller says otherwise
NO_IDS = 1 << 62      # rows without an id have keys from here on; ids are taken to be smaller
PERCENT = 80          # least Jaccard similarity of a link
REGISTERS = 128
ROWS = 4              # registers in a band: 32 bands miss a link at the threshold once in 2e7
FIRST_BANDS = 6       # bands whose buckets are compared first; the others only where groups differ
BASE = 1.001
FAR = 5.0             # standard errors below the threshold at which a pair is left out
BLOCK = 512           # members of a bucket that are compared in one block
GROUP_BYTES = 8 << 20
COLUMNS = 2048        # shingles that are compared at once


def row_key(id_col: str, text_col: str):
    """The id of a row; rows without one get a key behind all ids, by their text, so that only equal ones share it."""
    place = F.pmod(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.lit(NO_IDS))
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), place + F.lit(NO_IDS))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """(row of each distinct shingle of `width` words, its name), sorted by row and name."""
    data = lower_ascii(data)
    starts, ends, borders = words_of(data, offsets)
    roll = Roll(word_names(data, starts, ends), BASES[1])
    size = np.diff(borders)
    n = np.where(size >= width, size - width + 1, np.minimum(size, 1))
    row = np.repeat(np.arange(len(n)), n)
    first = np.repeat(borders[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    names = roll.of(first, np.minimum(first + width, borders[row + 1]))
    order = np.lexsort((names, row))
    row, names = row[order], names[order]
    once = first_of(row, names)
    return row[once], names[once]


def sketches(row: np.ndarray, names: np.ndarray, n_rows: int) -> np.ndarray:
    """SetSketch registers of each row's set; rows without shingles get zeros."""
    out = np.zeros((n_rows, REGISTERS), dtype=np.uint16)
    if not len(row):
        return out
    starts = np.flatnonzero(first_of(row))
    low = names.astype(np.uint32)
    high = (names >> np.uint64(32)).astype(np.uint32)
    seeds = mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64))
    least = np.empty((REGISTERS, len(starts)), dtype=np.uint32)
    for start in range(0, len(starts), 256):
        # A few hundred sets at a time stay in the processor's cache.
        a = starts[start]
        b = starts[start + 256] if start + 256 < len(starts) else len(low)
        x, y, at = low[a:b], high[a:b], starts[start : start + 256] - a
        for j in range(REGISTERS):
            v = x * np.uint32((int(seeds[2 * j]) | 1) & 0xFFFFFFFF)
            v += y ^ np.uint32(int(seeds[2 * j + 1]) & 0xFFFFFFFF)
            v ^= v >> np.uint32(15)
            v *= np.uint32(0x2C1B3C6D)
            v ^= v >> np.uint32(13)
            least[j, start : start + len(at)] = np.minimum.reduceat(v, at)
    # Least uniform value -> least exponential variate -> register.
    variate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2**32)
    out[row[starts]] = np.clip(np.floor(1 - np.log(variate) / np.log(BASE)), 1, 65535).astype(np.uint16).T
    return out


def estimate(greater, smaller, equal, u, v):
    """Joint maximum-likelihood estimate of the Jaccard similarity from compared registers.

    u, v are the sizes' shares of their sum.  As the base is close to 1, a register is greater, smaller
    or equal with the probabilities u - v J, v - u J and J; the likelihood is greatest at a root of a
    quadratic equation.
    """
    uv = u * v
    lead = (greater + smaller + equal) * uv
    half = equal * (u * u + v * v) + greater * v * v + smaller * u * u
    return (half - np.sqrt(np.maximum(half * half - 4 * lead * equal * uv, 0))) / (2 * lead)


FLOOR = PERCENT / 100 - FAR * np.sqrt(PERCENT / 100 * (1 - PERCENT / 100) / REGISTERS)


def sketch_rows(width: int):
    """(doc, n_shingles, print of the set, sketch) per document."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = ids_of(batch.column("id"))
            for at, data, offsets in text_slices(batch.column("text")):
                n_rows = len(offsets) - 1
                row, names = shingle_sets(data, offsets, width)
                registers = sketches(row, names, n_rows)
                sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(names + np.uint64(s)), dtype=np.uint64))) for s in (1, 2)]
                border = np.searchsorted(row, np.arange(n_rows + 1))
                one, two = ((s[border[1:]] - s[border[:-1]]).view(np.int64) for s in sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at : at + n_rows]), pa.array(np.diff(border)), pa.array(one), pa.array(two),
                     pa.array([r.tobytes() for r in registers], pa.binary())],
                    ["doc", "n_shingles", "one", "two", "sketch"],
                )

    return sketch


def band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, bucket key, rep) of each band of each sketch."""
    for batch in batches:
        rep = batch.column("rep").to_numpy()
        if not len(rep):
            continue
        registers = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(len(rep), -1)
        bands = registers.reshape(len(rep), REGISTERS // ROWS, ROWS).astype(np.uint64)
        band = np.tile(np.arange(REGISTERS // ROWS), len(rep))
        key = bands[:, :, 0] | (bands[:, :, 1] << np.uint64(16)) | (bands[:, :, 2] << np.uint64(32)) | (bands[:, :, 3] << np.uint64(48))
        key = mix(mix(key.ravel()) + band.astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(band.astype(np.int32)), pa.array(key), pa.array(np.repeat(rep, REGISTERS // ROWS))], ["band", "key", "rep"]
        )


def send_texts(groups: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            group = groups_of(ids_of(batch.column("id")), batch.column("text"), groups)
            rows = [(g, 0, to_bytes(batch.take(pa.array(r)))) for g, r in split(group)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["grp", "kind", "body"])

    return send


def send_ids(groups: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("rep").to_numpy()
            target = (mix(ids.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
            rows = [(g, 1, pack(rep=ids[r])) for g, r in split(target)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["grp", "kind", "body"])

    return send


def wanted_sets(width: int):
    """The shingle sets of the documents that were asked for, from a group of texts."""

    def sets_of(table: pa.Table) -> pa.Table:
        schema = pa.schema([("rep", pa.int64()), ("names", pa.binary())])
        kind = table["kind"].to_numpy()
        bodies = table["body"].to_pylist()
        asked = [b for b, k in zip(bodies, kind) if k == 1]
        texts = [from_bytes(b) for b, k in zip(bodies, kind) if k == 0]
        if not asked or not texts:
            return schema.empty_table()
        texts = pa.concat_tables(texts)
        ids = ids_of(texts["id"])
        rows = np.flatnonzero(np.isin(ids, unpack(asked)["rep"]))
        ids, out = ids[rows], []
        for _, data, offsets in text_slices(texts["text"].combine_chunks().take(pa.array(rows))):
            row, names = shingle_sets(data, offsets, width)
            border = np.searchsorted(row, np.arange(len(offsets)))
            out += [names[a:b].tobytes() for a, b in zip(border[:-1], border[1:])]
        return pa.table([pa.array(ids), pa.array(out, pa.binary())], schema=schema)

    return sets_of


def similar(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Which sets are linked, from exact sizes of their intersections; rows against all rows, or against `others`."""
    both = sets if others is None else [*sets, *others]
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    names = np.concatenate(both) if both else np.zeros(0, np.uint64)
    order = np.argsort(names, kind="stable")
    names, owner = names[order], owner[order]
    first = first_of(names)
    column = np.cumsum(first) - 1
    shared = np.bincount(column)[column] > 1 if len(column) else first
    owner, column = owner[shared], column[shared]
    column = np.cumsum(np.concatenate(([True], column[1:] != column[:-1]))) - 1 if len(column) else column
    n = len(sets)
    common = np.zeros((n, n if others is None else len(others)))
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (start, start + COLUMNS))
        member = np.zeros((len(both), COLUMNS), dtype=np.float32)
        member[owner[a:b], column[a:b] - start] = 1
        common += member[:n] @ (member if others is None else member[n:]).T
    size = np.array([len(s) for s in both], dtype=np.float64)
    total = size[:n, None] + (size if others is None else size[n:])[None, :] - common
    return (100 * common >= PERCENT * total) & (total > 0)


def keep_near(table: pa.Table) -> pa.Table:
    """Members of a block with a partner that the sketches do not rule out."""
    x = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(table.num_rows, -1)
    size = table["n_shingles"].to_numpy().astype(np.float64)
    equal = np.zeros((len(x), len(x)), dtype=np.int16)
    greater = np.zeros_like(equal)
    for j in range(x.shape[1]):
        equal += x[:, j, None] == x[None, :, j]
        greater += x[:, j, None] > x[None, :, j]
    u = size[:, None] / (size[:, None] + size[None, :])
    near = estimate(greater, REGISTERS - equal - greater, equal, u, 1 - u) >= FLOOR
    np.fill_diagonal(near, False)
    return table.select(["band", "key", "block", "rep"]).filter(pa.array(near.any(axis=1)))


def labels_of(linked: np.ndarray) -> np.ndarray:
    """Component of each member of a block: the least place in it."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked))
        after = np.minimum(label, least)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def blocks_to_links(table: pa.Table) -> pa.Table:
    """Links (rep, least rep of its component in the block) of one block of a bucket."""
    rep = table["rep"].to_numpy()
    order = np.argsort(rep)
    rep = rep[order]
    sets = [np.frombuffer(b, np.uint64) for b in table["names"].to_pylist()]
    label = labels_of(similar([sets[i] for i in order]))
    moved = label != np.arange(len(rep))
    return pa.table({"a": rep[moved], "b": rep[label[moved]]})


def guests_to_links(table: pa.Table) -> pa.Table:
    """Links between guests of a block and its members."""
    guest = table["guest"].to_numpy(zero_copy_only=False)
    rep = table["rep"].to_numpy()
    sets = [np.frombuffer(b, np.uint64) for b in table["names"].to_pylist()]
    g, m = np.flatnonzero(guest), np.flatnonzero(~guest)
    a, b = [], []
    if len(g) and len(m):
        linked = similar([sets[i] for i in g], [sets[i] for i in m])
        # One link of a guest to each block is not enough: members may be of several components.
        i, j = np.nonzero(linked)
        a, b = rep[g[i]], rep[m[j]]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def in_blocks(buckets: DataFrame) -> DataFrame:
    """Members with the block of their bucket and the number of its blocks."""
    counts = buckets.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK)
    return buckets.join(counts, ["band", "key"]).where("n > 1").withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("rep", "band"), F.col("blocks"))
    )


def near_links(buckets: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links of the members of buckets (band, key, rep); large buckets go in blocks."""
    block = ["band", "key", "block"]
    # The comparisons cost more than their bytes tell: a fixed number of partitions keeps all cores busy.
    parts = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = in_blocks(buckets).join(reps, "rep").select(*block, "rep", "n_shingles", "sketch")
    near = drawn.repartition(parts, *block).groupBy(*block).applyInArrow(keep_near, "band int, key long, block long, rep long")
    full = near.distinct().join(sets, "rep").select(*block, "rep", "names")
    return full.repartition(parts, *block).groupBy(*block).applyInArrow(blocks_to_links, "a long, b long")


def leftover_links(buckets: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """For buckets in several blocks: members outside of the bucket's largest component against all its blocks."""
    many = in_blocks(buckets).where("blocks > 1").join(labels, F.col("rep") == F.col("id"), "left").withColumn(
        "label", F.coalesce("component_id", "rep")
    )
    main = many.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("band", "key").agg(
        F.max(F.struct("c", "label")).alias("m")
    )
    guests = many.join(main, ["band", "key"]).where(F.col("label") != F.col("m.label")).select(
        "band", "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "rep", F.lit(True).alias("guest")
    )
    members = many.select("band", "key", "block", "rep", F.lit(False).alias("guest"))
    return members.union(guests).join(sets, "rep").groupBy("band", "key", "block").applyInArrow(guests_to_links, "a long, b long")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = SHINGLE) -> DataFrame:
    """Adds n_shingles, component_id and kept to all columns of `docs`.

    Linked: Jaccard similarity of 80 % or more of the sets of shingles (of `shingle` words), ASCII letters in lower
    case.  Null or wordless text has an empty set and is linked with nothing.  component_id is the
    smallest id that can be reached; kept where it is the row's own.  Rows that share an id count as
    one document, with the size of its largest set.  Rows without an id are documents of their own, equal texts
    among them one; they come after all others, and a component of them alone is null.  Columns of `docs`
    with the added names are replaced.  An empty table gives none.
    """
    added = ("n_shingles", "component_id", "kept")
    slim = docs.select(row_key(id_col, text_col).alias("id"), F.col(text_col).alias("text"))
    sketched = stored(
        slim.mapInArrow(sketch_rows(shingle), "doc long, n_shingles long, one long, two long, sketch binary"), "sketches"
    )
    # Equal sets are one class, under its least document.
    full = sketched.where("n_shingles > 0")
    classes = full.groupBy("one", "two").agg(F.min("doc").alias("rep"))
    reps = full.join(classes, ["one", "two"]).where("doc = rep").select("rep", "n_shingles", "sketch").dropDuplicates(["rep", "sketch"])
    in_class = full.join(classes, ["one", "two"]).where("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    members = reps.select("rep", "sketch").mapInArrow(band_rows, "band int, key long, rep long")
    shared = members.groupBy("band", "key").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x < y")
    buckets = stored(members.join(shared.select("band", "key"), ["band", "key"]).distinct(), "buckets")
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    groups = max(8, -(-total // GROUP_BYTES))
    packed = "grp long, kind long, body binary"
    asked = buckets.select("rep").distinct().mapInArrow(send_ids(groups), packed)
    texts = slim.mapInArrow(send_texts(groups), packed)
    sets = stored(texts.union(asked).groupBy("grp").applyInArrow(wanted_sets(shingle), "rep long, names binary"), "sets")
    links = stored(near_links(buckets.where(F.col("band") < FIRST_BANDS), reps, sets), "links")
    found = stored(components(links), "found")
    # A bucket of the other bands matters only if its members are not all in one component yet.
    later = buckets.where(F.col("band") >= FIRST_BANDS).join(found, F.col("rep") == F.col("id"), "left").select(
        "band", "key", "rep", F.coalesce("component_id", "rep").alias("label")
    )
    mixed = later.groupBy("band", "key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    later = later.join(mixed.select("band", "key"), ["band", "key"]).select("band", "key", "rep")
    links = stored(links.union(near_links(later, reps, sets)), "links")
    if buckets.groupBy("band", "key").count().where(F.col("count") > BLOCK).take(1):
        links = stored(links.union(leftover_links(buckets, sets, components(links))), "links")
    labels = components(links.union(in_class))
    per_id = sketched.groupBy("doc").agg(F.max("n_shingles").alias("n_shingles")).join(labels, F.col("doc") == F.col("id"), "left")
    per_id = per_id.select(F.col("doc").alias("near__doc"), "n_shingles", F.coalesce("component_id", "doc").alias("component_id"))
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    key = row_key(id_col, text_col)
    joined = out.join(per_id, key == F.col("near__doc")).withColumn("kept", F.col("near__doc") == F.col("component_id"))
    own = F.when(F.col("component_id") < NO_IDS, F.col("component_id"))
    return joined.drop("near__doc").withColumn("component_id", own)
