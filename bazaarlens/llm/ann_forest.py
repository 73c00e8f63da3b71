"""Approximate nearest neighbours by a forest of hash-prefix trees."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from bazaarlens.llm.common import col, written
from bazaarlens.llm.vectors import as_floats, by_tile, matrix, packed, unpacked, usable

POINTS, ASKED = 1024, 256  # points and queries that meet in one block
FINE = 8  # rotated axes that the letters after the first choose from
SAMPLE, RECALL = 128, 0.95  # queries that recall is measured on, and the share of their neighbours to be met


class Forest:
    """`trees` hash strings of `letters` letters for each vector.

    A letter is the axis, with its sign, that lies nearest to the centred vector
    after a random rotation: near vectors share it far more often than others. The
    first letter chooses from all axes, the further ones, which refine it
    step by step, from a few. Rotations follow from the seed.
    """

    def __init__(self, centre: np.ndarray, trees: int, letters: int, seed: int = 7):
        self.centre, self.trees, self.letters, self.seed, self._turns = centre, trees, letters, seed, None

    def __getstate__(self):
        return self.__dict__ | {"_turns": None}

    def strings(self, x: np.ndarray) -> np.ndarray:
        """Array of (vector, tree, letter)."""
        dim = len(self.centre)
        if self._turns is None:
            rng = np.random.default_rng(self.seed)
            turns = [np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(self.trees * self.letters)]
            self._turns = [t if k % self.letters == 0 else t[:, :FINE] for k, t in enumerate(turns)]
        x = x - self.centre
        out = np.empty((len(x), self.trees * self.letters), dtype=np.int64)
        for k, turn in enumerate(self._turns):
            y = x @ turn
            axis = np.abs(y).argmax(axis=1)
            out[:, k] = axis * 2 + (y[np.arange(len(x)), axis] < 0)
        return out.reshape(len(x), self.trees, self.letters)

    def prefixes(self, x: np.ndarray) -> np.ndarray:
        """Array of (vector, tree, length): the string's first `length` letters as one number, from length 0 on."""
        strings = self.strings(x)
        out = np.zeros((len(x), self.trees, self.letters + 1), dtype=np.int64)
        for k in range(self.letters):
            out[:, :, k + 1] = out[:, :, k] * (2 * len(self.centre) + 1) + strings[:, :, k] + 1
        return out


def _keyed(points: DataFrame, forest: Forest, lengths: list[int], vectors: bool) -> DataFrame:
    """(class, tree, length, prefix) of each point, for the prefix lengths asked for; the empty prefix only in tree 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                prefixes, bytes_of = forest.prefixes(matrix(part.column(1))), packed(part.column(1))
                for length in lengths:
                    trees = forest.trees if length else 1
                    rows = np.repeat(np.arange(part.num_rows), trees)
                    cols = [part.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(trees), part.num_rows)), pa.array(np.full(len(rows), length)), pa.array(prefixes[:, :trees, length].ravel())]
                    yield pa.RecordBatch.from_arrays([*cols, *([bytes_of.take(pa.array(rows))] if vectors else [])], names=["class", "tree", "length", "prefix", "vector"][: 4 + vectors])

    schema = "class long, tree long, length long, prefix long"
    return points.select("class", "vector").mapInArrow(run, schema + ", vector binary" * vectors)


def _nearest(k: int, kind: str):
    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(batch.schema.get_field_index("class")).to_numpy(zero_copy_only=False)
        asks = batch.column(batch.schema.get_field_index("asks")).to_numpy(zero_copy_only=False).astype(bool)
        if not asks.any() or asks.all():
            return
        x = unpacked(batch.column(batch.schema.get_field_index("vector")), kind)
        points, names = x[~asks], ids[~asks]
        out = []
        for who, q in zip(ids[asks], x[asks], strict=True):
            gap = points - q
            far = np.sqrt((gap * gap).sum(axis=1))
            best = np.lexsort((names, far))[:k] if len(far) <= k else _least(far, names, k)
            out.append((np.full(len(best), who), names[best], far[best]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["query", "class", "score"])

    return work


def _least(far: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    limit = np.partition(far, k - 1)[k - 1]
    near = np.flatnonzero(far <= limit)
    return near[np.lexsort((names[near], far[near]))][:k]


def _true_nearest(classes: DataFrame, names: np.ndarray, asked: np.ndarray, k: int) -> DataFrame:
    """(query, class, score): the `k` nearest other points of each of a few queries, by comparing all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, far = np.empty((len(names), 0), dtype=np.int64), np.empty((len(names), 0))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                points, x = part.column(0).to_numpy(zero_copy_only=False), matrix(part.column(1))
                gap = np.maximum((asked * asked).sum(axis=1)[:, None] + (x * x).sum(axis=1) - 2 * asked @ x.T, 0)
                gap[names[:, None] == points] = np.inf
                ids, far = np.concatenate([ids, np.broadcast_to(points, gap.shape)], axis=1), np.concatenate([far, gap], axis=1)
                if far.shape[1] > k:
                    best = np.argpartition(far, k - 1, axis=1)[:, :k]
                    ids, far = np.take_along_axis(ids, best, axis=1), np.take_along_axis(far, best, axis=1)
        row, at = np.nonzero(np.isfinite(far))
        yield pa.RecordBatch.from_arrays([pa.array(names[row]), pa.array(ids[row, at]), pa.array(far[row, at])], names=["query", "class", "score"])

    found = classes.select("class", "vector").mapInArrow(run, "query long, class long, score double")
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "class"))
    return found.withColumn("r", place).where(F.col("r") <= k).drop("r")


def _points_needed(found: np.ndarray, reached: np.ndarray, least: float) -> float:
    """The smallest count from `least` on at which queries that stop there reach `RECALL` of their neighbours on average.

    Both arrays are (query, length): points met and share of the true neighbours among them.
    """
    for limit in [least, *np.unique(found[found >= least] + 1).tolist()]:
        fits = found >= limit
        fits[:, 0] = True  # the empty prefix, which meets all
        stop = fits.shape[1] - 1 - fits[:, ::-1].argmax(axis=1)
        if not len(found) or reached[np.arange(len(found)), stop].mean() >= RECALL:
            break
    return limit


def _measured(classes: DataFrame, asking: DataFrame, met: DataFrame, forest: Forest, k: int, least: float) -> float:
    """The points that a query must meet, from the recall of each prefix length on at most `SAMPLE` queries."""
    sample = asking.orderBy(F.xxhash64("class"), "class").select("class", "vector").limit(SAMPLE).collect()
    if not sample:
        return least
    names, asked = np.array([r[0] for r in sample], dtype=np.int64), np.array([r[1] for r in sample], dtype=np.float64)
    row = {n: at for at, n in enumerate(names.tolist())}
    near = written(_true_nearest(classes, names, asked, k), "true")
    pairs = near.join(classes.select("class", "vector"), "class").select("query", "vector").collect()  # at most `SAMPLE` times `k`
    found = np.zeros((len(names), forest.letters + 1))
    for r in met.where(F.col("class").isin(list(row))).collect():
        found[row[r["class"]], r["length"]] = r["found"]
    hits, total = np.zeros(found.shape), np.zeros(len(names))
    if pairs:
        of = np.array([row[r[0]] for r in pairs])
        same = forest.strings(asked)[of] == forest.strings(np.array([r[1] for r in pairs], dtype=np.float64))
        depth = np.cumprod(same, axis=2).sum(axis=2).max(axis=1)  # the longest prefix shared in any tree
        np.add.at(hits, of, depth[:, None] >= np.arange(forest.letters + 1))
        np.add.at(total, of, 1)
    return _points_needed(found, np.where(total[:, None] > 0, hits / np.maximum(total, 1)[:, None], 1.0), least)


def search(
    vectors: DataFrame, is_query: Column | None = None, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = 64, letters: int = 5, effort: float = 11.0,
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the `k` nearest found for each query row.

    Every tree has all points by their hash strings. A query descends in all
    trees to its longest matching prefixes, then ascends in all of them at once, a
    letter at a time, until the points that share the prefix are enough; the empty prefix has them all.
    Enough is what a sample of at most `SAMPLE` queries needs to meet `RECALL` of their true
    neighbours, which all points are compared for, and at least `effort` times
    the 0.6th power of all points, and `k`. Counts of points per prefix decide
    this, only for the prefixes that queries have. What is found is scored by the exact
    distance, in blocks of at most about `POINTS` points and `ASKED` queries, of which the best leave.

    Equal vectors are one point, of which the `k` + 1 smallest ids can be
    among a query's nearest. Ties go to smaller ids. Rows with a null id or an unusable
    vector (null, zero, null or non-finite components) take no part; rows
    equal in id and vector are one. Vectors of each length have a forest of their own and are searched among themselves.
    Without queries or points the result is empty.
    """
    asked = F.pmod(col(id_col).cast("long"), F.lit(100)) == 0 if is_query is None else is_query
    rows = vectors.select(col(id_col).cast("long").alias("vec_id"), as_floats(col(vector_col), vectors.schema[vector_col].dataType.simpleString()).alias("vector"), asked.alias("asks"))
    rows = written(rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct(), "vectors")
    # one entry per vector length: as many forests
    lengths = sorted(r[0] for r in rows.select(F.size("vector")).distinct().collect()) or [1]
    return reduce(DataFrame.unionByName, [_searched(rows.where(F.size("vector") == n) if len(lengths) > 1 else rows, k, trees, letters, effort) for n in lengths])


def _searched(rows: DataFrame, k: int, trees: int, letters: int, effort: float) -> DataFrame:
    """`search` among the usable vectors of one length: vec_id, vector, asks."""
    classes = rows.groupBy("vector").agg(F.min("vec_id").alias("class"), F.max("asks").alias("asks"))
    classes = written(classes, "classes")
    mean = classes.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(F.avg(F.col("x").cast("double")).alias("m")).orderBy("at").collect()
    forest = Forest(np.array([r["m"] for r in mean] or [0.0]), trees, letters)
    total = classes.count()
    enough = max(effort * total**0.6, trees * k)  # a point counts once per tree, so these are k others at least

    asking = classes.where("asks")
    wanted = written(_keyed(asking, forest, list(range(letters + 1)), False), "asked")
    keys = ["tree", "length", "prefix"]
    # counts of points per prefix that some query has
    present = written(wanted.groupBy(*keys).agg(F.count("*").alias("queries")), "prefixes")
    counts = _keyed(classes, forest, list(range(letters + 1)), False).groupBy(*keys).agg(F.count("*").alias("points"))
    sized = written(present.join(counts, keys), "buckets")
    met = wanted.join(sized, keys).groupBy("class", "length").agg((F.sum("points") - F.when(F.col("length") > 0, trees).otherwise(1)).alias("found"))  # without itself
    met = written(met, "met")
    enough = _measured(classes, asking, met, forest, k, enough)
    stop = met.where((F.col("found") >= enough) | (F.col("length") == 0)).groupBy("class").agg(F.max("length").alias("length"))
    stop = written(stop, "stops")
    used = wanted.join(stop, ["class", "length"])
    buckets = used.groupBy(*keys).agg(F.count("*").alias("queries")).join(sized.drop("queries"), keys)
    buckets = written(buckets.select(*keys, F.ceil(F.col("points") / POINTS).cast("long").alias("p"), F.ceil(F.col("queries") / ASKED).cast("long").alias("q")), "used")
    lengths = sorted(r[0] for r in buckets.select("length").distinct().collect())  # at most letters + 1

    part = lambda n: F.pmod(F.xxhash64("class"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    points = _keyed(classes, forest, lengths, True).join(buckets, keys).withColumn("pi", part("p")).withColumn("qi", every("q")).withColumn("asks", F.lit(0))
    queries = _keyed(asking, forest, lengths, True).join(stop, ["class", "length"]).join(buckets, keys).withColumn("qi", part("q")).withColumn("pi", every("p")).withColumn("asks", F.lit(1))
    blocks = points.select(*keys, "pi", "qi", "class", "asks", "vector").unionByName(queries.select(*keys, "pi", "qi", "class", "asks", "vector"))
    near = by_tile(blocks, [*keys, "pi", "qi"], _nearest(k + 1, rows.schema["vector"].dataType.simpleString()), "query long, class long, score double")
    near = near.groupBy("query", "class").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "class"))
    near = written(near.withColumn("r", place).where(F.col("r") <= k + 1).drop("r"), "near")

    ids = rows.select(F.col("vector").alias("_v"), "vec_id", "asks").join(classes.select("vector", "class"), F.col("_v") == F.col("vector")).select("class", "vec_id", "asks")
    ids = written(ids, "members")
    place = F.row_number().over(Window.partitionBy("class").orderBy("vec_id"))
    members = ids.withColumn("r", place).where(F.col("r") <= k + 1).select("class", "vec_id")
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    listed = near.join(members, "class").withColumn("r", place).where(F.col("r") <= k + 1)
    listed = written(listed.select("query", "vec_id", "score"), "listed")
    asks = ids.where("asks").select(F.col("class").alias("query"), F.col("vec_id").alias("query_id"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    out = asks.join(listed, "query").where("query_id <> vec_id").withColumn("rank", place).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
