"""Helpers shared by the operators: columns, written tables, distributed ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from bazaarlens.session import scratch_path


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a parquet table in the shared scratch folder.

    Cuts lineage: what was written is there whatever executors are lost, and
    both sides of a later join are plain exchanges, which AQE can split when a
    key is hot.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, order: list[str], within: list[str] = (), rank: str = "rank", name: str = "ranked") -> DataFrame:
    """Adds a gapless rank from 0 in the order of `order`, counted anew for each value of `within`.

    `within` must be a prefix of `order`. Rows are range partitioned on all of
    `order`, so a hot value of `within` spreads over many tasks; each slice
    numbers its own rows, and is shifted by the row counts of the slices before
    it. The table of shifts has a row per slice and value of `within` in it; without
    `within`, it is as long as there are shuffle partitions. Null sorts first; ties are interchangeable.
    """
    spark = df.sparkSession
    keys = [col(c) for c in order]
    dealt = df.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    rows = written(dealt.withColumn("_at", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("_slice", F.shiftright("_at", 33))
    by = [col(c) for c in within]
    counts = rows.groupBy("_slice", *by).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    counts = written(counts, f"{name}-slices")
    if within:
        before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    else:
        # one row per slice: as many as there are shuffle partitions, not rows
        total, shifts = 0, []
        for at, n, first in sorted(tuple(r) for r in counts.select("_slice", "_n", "_first").collect()):
            shifts.append((at, total, first))
            total += n
        counts = spark.createDataFrame(shifts, "_slice long, _before long, _first long")
    shift = counts.select(F.col("_slice").alias("_s"), "_before", "_first", *[col(c).alias(f"_w{k}") for k, c in enumerate(within)])
    same = F.col("_slice") == F.col("_s")
    for k, c in enumerate(within):
        same = same & col(c).eqNullSafe(F.col(f"_w{k}"))
    out = rows.join(F.broadcast(shift) if not within else shift, same)
    drop = ["_at", "_slice", "_s", "_before", "_first", *[f"_w{k}" for k in range(len(within))]]
    return out.withColumn(rank, F.col("_at") - F.col("_first") + F.col("_before")).drop(*drop)


