"""When each URL is requested if a bounded number of workers share the list and hosts are spaced.

The URLs of a list are dealt to its workers in turn, and a worker takes its own in order.  A request starts when
its worker is free and its host may be asked again, so start times follow from the starts before by
maxima and sums alone.  A block of URLs therefore maps the times at which its workers and hosts are ready
before it to those after it as a max-plus matrix, whatever these times are: blocks become matrices in
parallel, a scan applies the (small) matrices of a list in order, and with the times in front of it each
block works out its own starts, again in parallel.  Times are whole microseconds, so all of it is exact.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.functions.text import url_netloc

BLOCK = 4096      # URLs that one call handles
HOSTS = 48        # hosts in a matrix; a block with more of them gives several
NEVER = np.int64(-(2**62))
MAPS = "root string, block long, part int, hosts array<string>, map binary"
STATES = "root string, block long, kind int, part int, number long, host string, ready binary"


def pieces(hosts: list, limit: int):
    """(begin, end, different hosts) of consecutive URLs with at most so many hosts."""
    begin, seen = 0, {}
    for i, host in enumerate(hosts):
        if host not in seen and len(seen) == limit:
            yield begin, i, list(seen)
            begin, seen = i, {}
        seen[host] = True
    if seen:
        yield begin, len(hosts), list(seen)


def run(ready, workers, places, duration: int, spacing: int, latest=max):
    """Starts of some URLs, and what their workers and hosts are ready at afterwards.

    ``ready`` has a row per worker and host: a time, or the max-plus vector that gives it.
    """
    starts = []
    for worker, host in zip(workers, places):
        start = latest(ready[worker], ready[host])
        ready[worker] = start + duration
        ready[host] = start + spacing
        starts.append(start)
    return starts


def block_maps(n_workers: int, duration: int, spacing: int, limit: int):
    """Max-plus matrices of a block, one for each piece of it."""

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        hosts, numbers = table["host"].to_pylist(), table["number"].to_numpy()
        rows = []
        for part, (a, b, some) in enumerate(pieces(hosts, limit)):
            size = n_workers + len(some)
            ready = np.full((size, size), NEVER, dtype=np.int64)
            np.fill_diagonal(ready, 0)
            place = {h: n_workers + k for k, h in enumerate(some)}
            run(ready, (numbers[a:b] % n_workers).tolist(), [place[h] for h in hosts[a:b]], duration, spacing, np.maximum)
            rows.append({"part": part, "hosts": some, "map": ready.tobytes()})
        out = pa.Table.from_pylist(rows, schema=pa.schema([("part", pa.int32()), ("hosts", pa.list_(pa.string())), ("map", pa.binary())]))
        first = [pa.array([table[c][0].as_py()] * len(rows), t) for c, t in (("root", pa.string()), ("block", pa.int64()))]
        return pa.table([*first, *out.columns], names=["root", "block", *out.column_names])

    return solve


def scan(n_workers: int):
    """Applies the matrices of each list in order; gives the times in front of each piece."""

    def apply(batches):
        root, ready, hosts = (), None, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["root"],) != root:
                    root, ready, hosts = (row["root"],), np.zeros(n_workers, dtype=np.int64), {}
                state = np.concatenate((ready, np.array([hosts.get(h, 0) for h in row["hosts"]], dtype=np.int64)))
                out.append({"root": row["root"], "block": row["block"], "kind": 1, "part": row["part"], "ready": state.tobytes()})
                matrix = np.frombuffer(row["map"], dtype=np.int64).reshape(len(state), len(state))
                after = (matrix + state[None, :]).max(axis=1)
                ready = after[:n_workers]
                hosts.update(zip(row["hosts"], after[n_workers:].tolist()))
            yield pa.RecordBatch.from_pylist(out, schema=STATE_ROWS)

    return apply


STATE_ROWS = pa.schema([
    ("root", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("number", pa.int64()),
    ("host", pa.string()), ("ready", pa.binary()),
])


def block_starts(n_workers: int, duration: int, spacing: int, limit: int):
    """Start of each URL of a block, from the times in front of its pieces."""

    def solve(table: pa.Table) -> pa.Table:
        kinds = table["kind"].to_numpy()
        urls = table.filter(pa.array(kinds == 0)).sort_by("number")
        states = table.filter(pa.array(kinds == 1)).sort_by("part")["ready"].to_pylist()
        hosts, numbers = urls["host"].to_pylist(), urls["number"].to_numpy()
        starts = []
        for state, (a, b, some) in zip(states, pieces(hosts, limit)):
            ready = np.frombuffer(state, dtype=np.int64).tolist()
            place = {h: n_workers + k for k, h in enumerate(some)}
            starts += run(ready, (numbers[a:b] % n_workers).tolist(), [place[h] for h in hosts[a:b]], duration, spacing)
        return pa.table([urls["root"], urls["number"], pa.array(starts, pa.int64())], names=["root", "number", "start"])

    return solve


def placed(urls: DataFrame, root: str, order: str, block: int) -> DataFrame:
    """URLs with their ``number`` in their list, from 0: ranks within ranges of the order, shifted by the ranges before."""
    ranged = urls.withColumns({"_root": F.col(root).cast("string"), "_range": F.floor(F.col(order) / block), "_host": url_netloc("url")})
    sizes = ranged.groupBy("_root", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_root").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(F.col("_root").alias("_r"), F.col("_range").alias("_g"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    rank = F.row_number().over(Window.partitionBy("_root", "_range").orderBy(order, "url")) - 1
    ranked = ranged.withColumn("_rank", rank)
    joined = ranked.join(first, ranked["_root"].eqNullSafe(first["_r"]) & ranked["_range"].eqNullSafe(first["_g"]))
    return joined.withColumn("number", F.col("_first") + F.col("_rank")).drop("_r", "_g", "_first", "_rank", "_range")


def worker_schedule(
    urls: DataFrame,
    n_workers: int = 10,
    duration: float = 1.0,
    rate_limit: float = 0.1,
    root: str = "root",
    order: str = "ord",
    block: int = BLOCK,
    hosts: int = HOSTS,
) -> DataFrame:
    """Add ``number`` (place in the list of its root), ``host``, ``worker`` and ``start_offset`` (seconds).

    A request takes ``duration`` seconds and keeps its worker as long, also while that waits for the host;
    starts to one host are ``rate_limit`` seconds apart at least.  Each root has a list and workers of its
    own.  ``order`` must be a whole number; equal ones are taken by URL.  A list of any length is spread over
    blocks: what one task sees in order is a matrix for each, not the URLs.
    """
    if n_workers < 1 or duration < 0 or rate_limit < 0:
        raise ValueError("schedules need a worker and times that are not negative")
    micros, spacing = round(duration * 1_000_000), round(rate_limit * 1_000_000)
    listed = placed(urls, root, order, block)
    slim = listed.select(
        F.col("_root").alias("root"), F.floor(F.col("number") / block).alias("block"), "number", F.coalesce("_host", F.lit("")).alias("host")
    )
    maps = slim.groupBy("root", "block").applyInArrow(block_maps(n_workers, micros, spacing, hosts), MAPS)
    in_order = maps.repartition("root").sortWithinPartitions("root", "block", "part")
    states = in_order.mapInArrow(scan(n_workers), STATES)
    rows = slim.select(
        "root", "block", F.lit(0).alias("kind"), F.lit(None).cast("int").alias("part"), "number", "host",
        F.lit(None).cast("binary").alias("ready"),
    )
    starts = rows.unionByName(states).groupBy("root", "block").applyInArrow(
        block_starts(n_workers, micros, spacing, hosts), "root string, number long, start long"
    ).toDF("_r", "_i", "_start")
    done = listed.join(starts, listed["_root"].eqNullSafe(starts["_r"]) & (listed["number"] == starts["_i"]))
    return done.select(
        *urls.columns, "number", F.col("_host").alias("host"), (F.col("number") % n_workers).cast("int").alias("worker"),
        (F.col("_start") / 1_000_000).alias("start_offset"),
    )
