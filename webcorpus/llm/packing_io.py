"""Columns packed into one binary value, for exchanges of many small records."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from webcorpus.llm.hashing import byte_roll, mix, text_slices

NO_ID = np.iinfo(np.int64).max
SENT_AT_ONCE = 16 << 20   # bytes of texts that are dealt to groups at once


def to_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_bytes(body: bytes | pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def pack(**columns: np.ndarray) -> bytes:
    return to_bytes(pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns)))


def unpack(bodies: Iterable[bytes | pa.Buffer]) -> dict[str, np.ndarray]:
    """The packed columns of all bodies, one after another; none at all if there is no body."""
    tables = [from_bytes(b) for b in bodies]
    if not tables:
        return {}
    return {name: np.concatenate([t[name].to_numpy() for t in tables]) for name in tables[0].column_names}


def gathered(batches: Iterator[pa.RecordBatch], size: int = SENT_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Small batches put together up to `size` bytes, so that records do not shrink with Arrow's batches."""
    held, n = [], 0
    for batch in batches:
        if held and n + batch.nbytes > size:
            yield pa.concat_batches(held)
            held, n = [], 0
        if batch.num_rows:
            held.append(batch)
            n += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def split(target: np.ndarray, n: int | None = None):
    """(target, rows) of each distinct target; rows keep their order."""
    order = np.argsort(target, kind="stable")
    sorted_targets = target[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_targets[1:] != sorted_targets[:-1]))) if len(order) else []
    for start, end in zip(starts, [*starts[1:], len(order)]):
        yield int(sorted_targets[start]), order[start:end]


def ids_of(column: pa.Array) -> np.ndarray:
    """Ids as 64-bit integers; null comes after every other id."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def groups_of(ids: np.ndarray, text: pa.Array, groups: int) -> np.ndarray:
    """The group of each row: by its id, and by its text where it has none."""
    values = mix(ids.astype(np.uint64))
    if (ids == NO_ID).any():
        prints = np.concatenate([byte_roll(d).of(o[:-1], o[1:]) for _, d, o in text_slices(text)])
        values = np.where(ids == NO_ID, prints, values)
    return (values % np.uint64(groups)).astype(np.int64)
