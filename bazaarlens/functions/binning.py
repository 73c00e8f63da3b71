"""Bins, dense spines and top-k helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def bin_index(value: Column, edges: tuple, right_closed: bool = False) -> Column:
    """0-based bin of `value` among `edges`; null outside. [a,b) by default, (a,b] if right_closed.

    Rows outside fall away in the join with the bins; filtering on the bin
    would copy the expression below the projection.
    """
    def below(edge) -> Column:
        return value <= edge if right_closed else value < edge

    chain = F.when(below(edges[0]), None)
    for i, upper in enumerate(edges[1:]):
        chain = chain.when(below(upper), F.lit(i))
    return chain


def spine(spark: SparkSession, name: str, values: list) -> DataFrame:
    """One row per listed value; at most a few hundred rows, from parameters."""
    items = F.array(*[F.lit(v) for v in values])
    return spark.range(1).select(F.explode(items).alias(name))


def labelled_spine(spark: SparkSession, key: str, label: str, labels: tuple) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(i).alias(key), F.lit(t).alias(label)) for i, t in enumerate(labels)])
    return spark.range(1).select(F.explode(pairs).alias("p")).select(f"p.{key}", f"p.{label}")
