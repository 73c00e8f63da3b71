"""Digests of whole results, column by column, that Spark and SQL take alike."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SCALE = 10_000


# what a text must look like for Spark to read it as a double (`NUMBER` of java.lang.Double, a little wider); another one is told from a number without an exception, which takes longer than its hash
NUMBER = r"^[\x00-\x20]*[+-]?(?:(?i:nan|inf|infinity)|\.?[0-9][0-9a-fA-FxXpP.+-]*)[\x00-\x20]*$"
EXACT = ("tinyint", "smallint", "int", "bigint", "double", "decimal")  # types whose doubles are those of their texts


def _number(c: Column, kind: str) -> Column:
    """A value, or text, as a double; null where it is none."""
    if kind.split("(")[0] in EXACT:
        return c.cast("double")
    text = c.cast("string")
    return F.when(~text.contains(":") & text.rlike(NUMBER), text.try_cast("double"))


def _whole(units: Column) -> Column:
    """A double's text as a whole number, halves away from zero. Below 2^52 its fraction is exact, so that no decimal is made of it."""
    down = units.cast("bigint")
    rest = units - down
    near = down + F.when(rest >= 0.5, 1).when(rest <= -0.5, -1).otherwise(0)
    return F.when(F.abs(units) < 2.0**52, near.cast("string")).otherwise(F.round(units).cast("decimal(38,0)").cast("string"))


ZERO = int(hashlib.md5(b"0").hexdigest()[:8], 16)


def _code(text: Column) -> Column:
    """A text's hash as a number; that of 0, the most common cell, isn't made again."""
    return F.when(text == "0", F.lit(ZERO)).otherwise(_hash(text))


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def digest(results: dict[str, DataFrame]) -> DataFrame:
    """(block, column_name, n_known, total): known values of every column of every result, and a sum of their hashes, whatever the order of rows.

    A value's text is hashed: numbers, or text that reads as one, as whole multiples of 1 / `SCALE`. All columns of a
    result are summed side by side: a row isn't spread to one for each of its cells.
    """
    out = []
    for name, df in results.items():
        places = range(len(df.columns))
        named = [(F.col(f"`{c}`"), kind) for c, kind in df.dtypes]
        texts = [(F.lit(None) if kind.split("(")[0] in EXACT else c).cast("string").alias(f"t{k}") for k, (c, kind) in enumerate(named)]
        units = df.select(*texts, *[(_number(c, kind) * SCALE).alias(f"n{k}") for k, (c, kind) in enumerate(named)])
        plain = [F.when(F.col(f"n{k}").isNull(), F.col(f"t{k}")).otherwise(_whole(F.col(f"n{k}"))) for k in places]
        # an array's function isn't part of a whole stage's code: the texts become methods of their own, where a whole stage puts all into one, too long to be compiled to machine code
        codes = units.select(F.transform(F.array(*plain), _code).alias("codes"))
        sums = codes.agg(*[F.struct(F.lit(c).alias("column_name"), F.count(F.col("codes")[k]).alias("n_known"), F.sum(F.col("codes")[k]).alias("total")).alias(f"_{k}") for k, c in enumerate(df.columns)])
        out.append(sums.select(F.explode(F.array(*sums.columns)).alias("s")).select(F.lit(name).alias("block"), "s.*").where("n_known > 0"))
    return reduce(DataFrame.unionByName, out)


def digest_sql(results: dict[str, str]) -> str:
    """The same over SQL texts."""
    number = "TRY_CAST(COLUMNS(*)::VARCHAR AS DOUBLE)"
    plain = f"CASE WHEN {number} IS NULL THEN COLUMNS(*)::VARCHAR ELSE CAST(CAST(round({number} * {SCALE}) AS HUGEINT) AS VARCHAR) END"
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS block, column_name, count(*) AS n_known, CAST(sum(CAST('0x' || substr(md5(v), 1, 8) AS BIGINT)) AS BIGINT) AS total
 FROM (UNPIVOT (SELECT {plain} FROM ({sql})) ON COLUMNS(*) INTO NAME column_name VALUE v) GROUP BY column_name""" for name, sql in results.items())
