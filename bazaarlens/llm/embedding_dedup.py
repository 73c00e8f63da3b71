"""Embedding near-duplicates: spherical k-means cells, blocked cosine products within cells."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bazaarlens.llm.common import col, written
from bazaarlens.llm.components import connected_components, star_links
from bazaarlens.llm.vectors import as_floats, by_tile, matrix, packed, unpacked, usable

TILE = 1024  # vectors of one side of a block
ROWS = 256  # of them multiplied at a time
PER_CELL = 16_384  # vectors that a cell is meant to have
MOST_CELLS = 64  # more cells mean more vectors near a border, each of which visits other cells


def spherical_kmeans(sample: np.ndarray, cells: int, rounds: int = 10, seed: int = 0) -> np.ndarray:
    """Unit centroids of unit vectors; a cell that loses all its vectors keeps its centroid."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.permutation(len(sample))[:cells]].copy()
    for _ in range(rounds):
        near = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(size > 0, sums / np.maximum(size, 1e-300), centroids)
    return centroids


def _placed(classes: DataFrame, centroids: np.ndarray, reach: float) -> DataFrame:
    """Every vector in its nearest centroid's cell (home), and as a visitor in each cell that may hold a vector within `reach`.

    A vector of another cell lies beyond the plane halfway between the two
    centroids, so a link across needs a distance to that plane of at most `reach`.
    """
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = np.linalg.norm(centroids[:, None] - centroids[None], axis=2)
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            main = np.flatnonzero(sizes == dim)
            rows, cells, homes = [np.flatnonzero(sizes != dim)], [], []
            cells.append(np.full(len(rows[0]), -1))
            homes.append(np.ones(len(rows[0]), dtype=bool))
            if len(main):
                x = matrix(batch.column(1).take(pa.array(main)))
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                dots = x @ centroids.T
                home = dots.argmax(axis=1)
                margin = dots[np.arange(len(x)), home][:, None] - dots
                visits = margin <= reach * gaps[home] + 1e-9
                visits[np.arange(len(x)), home] = True
                at, cell = np.nonzero(visits)
                rows.append(main[at])
                cells.append(cell)
                homes.append(home[at] == cell)
            at = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), packed(batch.column(1)).take(at), batch.column(2).take(at), batch.column(3).take(at), pa.array(np.concatenate(cells).astype(np.int64)), pa.array(np.concatenate(homes)), pa.array(sizes.astype(np.int32)).take(at)],
                names=["class", "vector", "label", "n", "cell", "home", "size"],
            )

    kinds = classes.schema
    schema = f"class long, vector binary, label {kinds['label'].dataType.simpleString()}, n long, cell long, home boolean"
    return classes.select("class", "vector", "label", "n").mapInArrow(run, schema + ", size int")


def _compared(threshold: float, kind: str):
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        get = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
        i, j = get("i")[0], get("j")[0]
        ids, n, home, own = get("class"), get("n"), get("home"), get("own")
        x = unpacked(batch.column(batch.schema.get_field_index("vector")), kind)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        count, held = np.zeros(len(x), dtype=np.int64), []
        for a in range(0, len(x), ROWS):
            rows = np.arange(a, min(a + ROWS, len(x)))
            near = x[rows] @ x.T >= threshold
            near[np.arange(len(rows)), rows] = False
            if i != j:
                near &= own[rows, None] != own[None, :]  # pairs of one part are compared in that part's own block
            count[rows] = np.where(home[rows], near @ n, 0)
            u, v = np.nonzero(near & (home[rows, None] | home[None, :]))
            if len(u):
                held.append(star_links(ids[rows[u]], ids[v]))
        links = star_links(*map(np.concatenate, zip(*held, strict=True))) if held else ([], [])
        root = {int(u): int(v) for u, v in zip(*links, strict=True)}
        at = np.flatnonzero((count > 0) | np.isin(ids, list(root)))
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(count[at].astype(np.int64)), pa.array([root.get(int(k), int(k)) for k in ids[at]], pa.int64())], names=["class", "links", "root"])

    return work


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, sample: int = 20_000) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row.

    Equal vectors of a label are one class. Centroids are fitted to at most
    `sample` classes (least hashes); all classes go to cells, home and
    visits, such that both ends of every link meet at the home of either; no link is lost to a
    border. A cell of a label is cut into parts, each pair of parts a block whose cosine products are one
    matrix product; a block gives link counts and at most one link per vector, never its pairs.

    Null ids and labels and unusable vectors (null, zero, null or non-finite
    components) link with nothing: n_links 0, component their own id.
    Vectors of different lengths never link. Repeated rows count as further vectors.
    """
    rows = written(vectors.select(col(id_col).cast("long").alias("vec_id"), as_floats(col(vector_col), vectors.schema[vector_col].dataType.simpleString()).alias("vector"), col(label_col).alias("label")), "vectors")
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    classes = rows.where(fit).groupBy("label", "vector").agg(F.min("vec_id").alias("class"), F.count("*").alias("n"))
    classes = written(classes, "classes")
    sizes = classes.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes:
        dim, total = sizes
        some = classes.where(F.size("vector") == dim).orderBy(F.xxhash64("class"), "class").limit(sample).select("vector").toPandas()["vector"]
        points = np.stack([np.asarray(v, dtype=np.float64) for v in some])
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        centroids = spherical_kmeans(points, min(MOST_CELLS, math.ceil(total / PER_CELL), len(points)))
        placed = _placed(classes, centroids, math.sqrt(2 - 2 * threshold))
    else:
        placed = _placed(classes, np.ones((1, 1)), 2.0)
    # the label is part of a block's key by its hash: a clash would only compare more, and is undone below
    placed = placed.withColumn("tag", F.xxhash64("label", "size"))
    cuts = written(placed.groupBy("tag", "cell").agg(F.ceil(F.count("*") / TILE).cast("long").alias("cuts")), "cells")
    met = placed.join(cuts, ["tag", "cell"]).withColumn("own", F.pmod(F.xxhash64("class", F.lit("part")), F.col("cuts")))
    dealt = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    tiles = dealt.select("tag", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "class", "n", "home", "vector")
    found = written(by_tile(tiles, ["tag", "cell", "i", "j"], _compared(threshold, rows.schema["vector"].dataType.simpleString()), "class long, links long, root long"), "links")
    roots = connected_components(found.where("class <> root").select(F.col("class").alias("u"), F.col("root").alias("v")))
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    named = classes.join(counts, "class", "left").join(roots, F.col("class") == F.col("node"), "left").select(
        F.col("label").alias("_label"), F.col("vector").alias("_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "class").alias("component_id"),
    )
    named = written(named, "named")
    out = rows.withColumn("_fit", fit).join(named, F.col("_fit") & (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
