"""Exact order statistics and running totals that stay distributed when one group is huge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import DecimalType

from bazaarlens.session import materialise


def value_counts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(group, value, n): collapses repeated values before any group is brought together."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def lead_quantiles(df: DataFrame, by: list[str], wanted: dict[str, tuple[str, float, float]], digits: int = 6) -> DataFrame:
    """Exact interpolated quantiles of whole-second measures: {name: (column, quantile, seconds per unit)}.

    All measures are counted in one pass as (group, measure, value). Their
    resolution bounds the distinct values, and so every aggregation buffer: a
    year of seconds is 32 million, and spans of several years are bad data that
    the caller may leave out.
    """
    cols = sorted({c for c, _, _ in wanted.values()})
    cells = F.array(*[F.struct(F.lit(c).alias("m"), F.col(c).cast("bigint").alias("v")) for c in cols])
    counts = value_counts(df.select(*by, F.explode(cells).alias("_c")).select(*by, F.col("_c.m").alias("_m"), F.col("_c.v").alias("_v")), [*by, "_m"], "_v")

    def quantile(col: str, q: float, per: float) -> Column:
        own = F.when(F.col("_m") == col, F.col("_v"))
        return F.round(F.percentile(own, F.lit(q), F.col("n")) / F.lit(per), digits)

    return counts.groupBy(*by).agg(*[quantile(*spec).alias(name) for name, spec in wanted.items()])


def running_total(df: DataFrame, order: list[Column], value: str, name: str, total: str) -> DataFrame:
    """Running sum of `value` in `order`, and its grand total, with no single-task window.

    Rows are range-partitioned once into balanced slices and written; each
    slice is then summed by its own task and shifted by the totals of the
    slices before it (one row per slice, at most the shuffle partition count).
    """
    def exact(col: Column) -> Column:
        # a decimal sum of full precision would lose digits in the addition below
        kind = df.schema[value].dataType
        return col.cast(DecimalType(37, kind.scale)) if isinstance(kind, DecimalType) else col

    slices = materialise(
        df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "running"
    )
    starts = (
        slices.groupBy("_slice").agg(F.sum(value).alias("_part"))
        .select(
            "_slice",
            F.coalesce(F.sum("_part").over(W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
            F.sum("_part").over(W.partitionBy()).alias(total),
        )
    )
    inner = W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        slices.withColumn("_local", F.sum(value).over(inner))
        .join(F.broadcast(starts), "_slice")
        .withColumn(name, exact(F.col("_start")) + exact(F.col("_local")))
        .drop("_slice", "_start", "_local")
    )
