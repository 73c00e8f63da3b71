"""Vector compression: integer parts coded by small codebooks, distances taken along a trie of the distinct parts."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from bazaarlens.llm.common import col, written
from bazaarlens.llm.vectors import as_floats, matrix

BLOCK = 32_768  # vectors whose parts make one trie
SUBTREE = 2_048  # leaves that are finished together
SAFE = 1 << 24  # integer components below this keep squares and sums in 64 bits
LIMB = 32  # bits of a sum that are added up apart


def integers(x: np.ndarray, scale: int = 256) -> np.ndarray:
    """floor(scale * x) of doubles: 64-bit integers, or Python's where one is too large for them."""
    if not x.size or np.abs(x).max() * scale < SAFE:
        return np.floor(x * scale).astype(np.int64)
    whole = [[math.floor(v * scale) if abs(v) < 2.0**44 else math.floor(v) * scale for v in row] for row in x.tolist()]
    out = np.empty(x.shape, dtype=object)
    out[:] = whole
    return out


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, and for each row its place among them."""
    n, width = parts.shape
    if not width:
        return parts[: min(n, 1)], np.zeros(n, dtype=np.int64)
    if parts.dtype == object:
        rows = [tuple(r) for r in parts]
        order = {r: k for k, r in enumerate(sorted(set(rows)))}
        out = np.empty((len(order), width), dtype=object)
        out[:] = list(order)
        return out, np.array([order[r] for r in rows], dtype=np.int64)
    low = parts.min(axis=0)
    bits = [int(b).bit_length() for b in parts.max(axis=0) - low]
    if sum(bits) < 63:
        key = np.zeros(n, dtype=np.int64)
        for j in range(width):
            key = (key << bits[j]) | (parts[:, j] - low[j])
        _, first, place = np.unique(key, return_index=True, return_inverse=True)
        return parts[first], place
    order = np.lexsort(parts.T[::-1])
    fresh = np.concatenate([[True], (parts[order][1:] != parts[order][:-1]).any(axis=1)])
    place = np.empty(n, dtype=np.int64)
    place[order] = np.cumsum(fresh) - 1
    return parts[order][fresh], place


def nearest_entries(distinct: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each of the sorted distinct parts; ties go to the lower entry.

    The parts are the leaves of a trie, a level per component. A node holds the distances of its
    prefix to all entries, computed once from its parent's. The tree is walked depth
    first; a subtree of at most `SUBTREE` leaves is finished level by level at once.
    """
    n, width = distinct.shape
    near, far = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=distinct.dtype)
    stack = [(0, n, 0, np.zeros(len(entries), dtype=distinct.dtype))]
    while stack:
        lo, hi, depth, above = stack.pop()
        if hi - lo > SUBTREE and depth < width:
            values = distinct[lo:hi, depth]
            edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), hi - lo]
            for a, b in zip(edges[-2::-1], edges[:0:-1], strict=True):
                gap = values[a] - entries[:, depth]
                stack.append((lo + a, lo + b, depth + 1, above + gap * gap))
            continue
        held, node, same = above[None], np.zeros(hi - lo, dtype=np.int64), np.zeros(hi - lo, dtype=bool)
        same[1:] = True
        for j in range(depth, width):
            values = distinct[lo:hi, j]
            same[1:] &= values[1:] == values[:-1]
            first = np.flatnonzero(~same)
            gap = values[first][:, None] - entries[None, :, j]
            held, node = held[node[first]] + gap * gap, np.cumsum(~same) - 1
        best = held.argmin(axis=1)
        near[lo:hi] = best[node]
        far[lo:hi] = held[np.arange(len(best)), best][node]
    return near, far


@dataclass(frozen=True)
class Codebooks:
    """Entries of each part position for vectors of one length: a list per position of tuples of integers."""

    entries: list[list[tuple[int, ...]]]

    def table(self, position: int) -> np.ndarray:
        rows = self.entries[position]
        small = all(abs(v) < SAFE for r in rows for v in r)
        out = np.empty((len(rows), len(rows[0])), dtype=np.int64 if small else object)
        if rows[0]:
            out[:] = rows
        return out

    def sha256(self) -> str:
        text = ",".join(str(v) for position in self.entries for entry in position for v in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def _coded(x: np.ndarray, books: Codebooks) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, distinct parts, each row's place among them, entry, distance) of a block of vectors of one length."""
    whole = integers(x)
    width = whole.shape[1] // len(books.entries)
    for position in range(len(books.entries)):
        table = books.table(position)
        parts = np.ascontiguousarray(whole[:, position * width : (position + 1) * width])
        if table.dtype == object:
            parts = parts.astype(object)
        elif parts.dtype == object:
            table = table.astype(object)
        distinct, place = distinct_parts(parts)
        yield position, distinct, place, *nearest_entries(distinct, table)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together up to `size` rows, so that more parts share a trie."""
    kept, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            if n + part.num_rows > size:
                yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                kept, n = [], 0
            kept.append(part)
            n += part.num_rows
    if n:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their vectors as doubles)."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        x = matrix(column.take(pa.array(rows))) if size else np.zeros((len(rows), 0))
        yield size, rows, x


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(number, value) of a signed integer's limbs, the last one signed: value = sum of limb << number * LIMB."""
    at = 0
    while not -(1 << LIMB) < value < 1 << LIMB:
        yield at, value & ((1 << LIMB) - 1)
        value >>= LIMB
        at += 1
    yield at, value


def _sums(rows: DataFrame, books: dict[int, Codebooks]) -> DataFrame:
    """(length, position, entry, dim, limb, total): components added up over the parts of each entry; dim -1 counts the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int, int], list[int]] = {}
        for batch in _blocks(batches, BLOCK):
            for size, _, x in _by_length(batch.column(0)):
                for position, distinct, place, near, _ in _coded(x, books[size]):
                    weight = np.bincount(place, minlength=len(distinct))
                    for entry in np.unique(near).tolist():
                        of = near == entry
                        w = weight[of]
                        added = [int(w.sum()), *[int(v) for v in (distinct[of] * w[:, None]).sum(axis=0)]]
                        old = totals.get((size, position, entry))
                        totals[size, position, entry] = added if old is None else [a + b for a, b in zip(old, added, strict=True)]
        out = [(*key, dim - 1, at, part) for key, sums in totals.items() for dim, v in enumerate(sums) for at, part in _limbs(v)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["length", "position", "entry", "dim", "limb", "total"])

    found = rows.select("vector").mapInArrow(run, "length long, position long, entry long, dim long, limb long, total long")
    # a row per codebook component and limb, as many as the codebooks are long
    return found.groupBy("length", "position", "entry", "dim", "limb").agg(F.sum("total").alias("total"))


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> dict[int, Codebooks]:
    """For each length, the parts of the vectors with the smallest ids. `entries` vectors a length come to the driver."""
    place = F.row_number().over(Window.partitionBy("length").orderBy(F.asc_nulls_last("vec_id"), "vector"))
    first = rows.withColumn("r", place).where(F.col("r") <= entries).select("length", "r", "vector").collect()
    books = {}
    for size in sorted({r["length"] for r in first}):
        x = np.array([r["vector"] for r in sorted((r for r in first if r["length"] == size), key=lambda r: r["r"])], dtype=np.float64)
        whole, width = integers(x.reshape(len(x), size)), size // parts
        books[size] = Codebooks([[tuple(int(v) for v in row) for row in whole[:, p * width : (p + 1) * width]] for p in range(parts)])
    return books


def trained(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> dict[int, Codebooks]:
    """Codebooks per vector length, after `rounds` of assigning all parts and moving each used entry to the floor of its parts' mean."""
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books else 0):
        sums: dict[tuple[int, int, int], dict[int, int]] = {}
        for r in _sums(rows, books).collect():
            held = sums.setdefault((r["length"], r["position"], r["entry"]), {})
            held[r["dim"]] = held.get(r["dim"], 0) + (r["total"] << (r["limb"] * LIMB))
        for (size, position, entry), held in sums.items():
            books[size].entries[position][entry] = tuple(held[j] // held[-1] for j in range(size // parts))
    return books


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each row whose vector is not null and holds finite components only.

    Components become floor(256 x). A vector is cut into `parts` equal parts; a part's code is its
    nearest codebook entry, two hex digits. Distinct parts of a block of vectors are sorted into a trie (`nearest_entries`); its leaves,
    weighted by how often a part occurs, give the entries' sums. Vectors stay where they are: what is shuffled is a
    row per codebook component and task. At most 256 entries; fewer vectors make fewer entries.

    Vectors of each length have codebooks of their own. A length that `parts` doesn't divide has none: its rows have null
    code, error and codebooks_sha256. Null ids sort last, repeated ids by their vectors; every row is coded on
    its own, zero and empty vectors as any other. Null labels are one label. Sums are exact at any size; an
    error beyond 64 bits is given as the largest long. No rows: no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    vector = as_floats(col(vector_col), vectors.schema[vector_col].dataType.simpleString())
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(col(id_col).alias("vec_id"), col(label_col).alias("label"), vector.alias("vector")).where(F.col("vector").isNotNull() & finite)
    rows = rows.withColumn("length", F.size("vector"))
    even = rows.where(F.col("length") % parts == 0)
    books = trained(even, parts, entries, rounds)
    most = (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, BLOCK):
            codes, errors, shas = (np.full(batch.num_rows, None, dtype=object) for _ in range(3))
            for size, at, x in _by_length(batch.column(2)):
                if size not in books:
                    continue
                digits, error = np.zeros((len(at), parts), dtype=np.uint8), 0
                for position, _, place, near, far in _coded(x, books[size]):
                    digits[:, position] = near[place]
                    error = error + far[place]
                text = digits.tobytes().hex()
                codes[at] = [text[k : k + 2 * parts] for k in range(0, len(text), 2 * parts)]
                errors[at] = [min(int(e), most) for e in error]
                shas[at] = books[size].sha256()
            cols = [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64()), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    coded = rows.select("vec_id", "label", "vector").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long, codebooks_sha256 string")
    coded = written(coded, "codes")
    # summed before the shuffle; the join's sides are plain tables, so a hot label is split
    sums = written(coded.groupBy("label").agg(_bounded(F.sum(F.col("error").cast("decimal(38,0)")), most).alias("label_error")), "label-errors")
    met = coded.join(sums.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")), "left")
    return met.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _bounded(total: Column, most: int) -> Column:
    return F.when(total > F.lit(most).cast("decimal(38,0)"), F.lit(most)).otherwise(total).cast("long")
