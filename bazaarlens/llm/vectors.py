"""Checks and blocks of vectors that the vector operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.llm.common import partitions


def usable(vector: Column) -> Column:
    """True where the vector is not null, not empty, not zero, and holds finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def as_floats(vector: Column, kind: str) -> Column:
    """The vector as doubles, or as it is if it holds floats or doubles."""
    return vector if kind in ("array<float>", "array<double>") else vector.cast("array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def packed(column: pa.Array) -> pa.Array:
    """A list column of floats or doubles as bytes, which are cheaper to send and sort."""
    values = np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False))
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)) * values.itemsize
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def unpacked(column: pa.Array, kind: str) -> np.ndarray:
    """Packed vectors of one length as rows of doubles; `kind` is the list's type."""
    values = np.frombuffer(b"".join(column.to_pylist()), dtype=np.float32 if kind == "array<float>" else np.float64)
    return values.astype(np.float64).reshape(len(column), -1)


def by_tile(rows: DataFrame, keys: list[str], work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Calls `work` with all rows of each tile at a time; the caller bounds a tile's rows.

    Tiles are dealt by their keys and sorted; a partition's batches are cut
    where the keys change, and only the last, open tile is carried on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if kept is not None and kept.num_rows:
                batch = pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            tile = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(keys))], axis=1)
            edges = [0, *(np.flatnonzero((tile[1:] != tile[:-1]).any(axis=1)) + 1).tolist()]
            for a, b in zip(edges, edges[1:], strict=False):
                yield from work(batch.slice(a, b - a))
            kept = batch.slice(edges[-1])
        if kept is not None and kept.num_rows:
            yield from work(kept)

    dealt = rows.select(*keys, *[c for c in rows.columns if c not in keys]).repartition(partitions(rows.sparkSession), *keys)
    return dealt.sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
