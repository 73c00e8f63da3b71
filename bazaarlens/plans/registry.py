"""All registered queries, and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from bazaarlens.plans.oracle_base import with_views
from bazaarlens.sources.fixtures import Fixture

GROUPS = ("core", "metrics", "ingest", "money")


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text: one form every engine prints alike."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (DateType, TimestampNTZType, TimestampType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _bind(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: portable(build(Fixture(spark, folder)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {}
    for group in GROUPS:
        for name, build in import_module(f"bazaarlens.plans.queries_{group}").QUERIES.items():
            found[name] = _bind(build)
    return found


def oracle_sql() -> dict[str, str]:
    found = {}
    for group in GROUPS:
        for name, sql in import_module(f"bazaarlens.plans.oracle_{group}").SQL.items():
            found[name] = with_views(sql() if callable(sql) else sql)
    return found
