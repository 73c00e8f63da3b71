"""Digests of whole results, against values hashed one by one."""

import hashlib
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from bazaarlens.plans.digests import digest

# texts that Spark reads as doubles, with what they are worth, and others that come near
NUMBERS = {"1": "1", "-1.5": "-1.5", "+2": "2", "1E-3": "0.001", ".5": "0.5", "5.": "5", "1d": "1", "2.5f": "2.5", "0x1.8p1": "3", " 7 ": "7", "00012": "12", "-0.0": "0",
           "0.00015": "0.00015", "-0.00005": "-0.00005", "0.00004": "0.00004", "123456789012": "123456789012"}
TEXTS = ["1 2", "1996-01-02", "1996-01-02 00:00:00", "1:2", "S12", "", "-", ".", "e5", "1e", "abc", "1,5", "1.2.3", "1_000", "true", "12L"]


def code(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def whole(value):
    return str(int(Decimal(float(value) * 10_000).to_integral_value(ROUND_HALF_UP)))


def test_digest_of_texts_and_numbers(spark):
    rows = [(t, whole(v)) for t, v in NUMBERS.items()] + [(t, t) for t in TEXTS]
    # a column each: a text's own hash shows
    wide = spark.createDataFrame([tuple(t for t, _ in rows), tuple([None] * len(rows))], ", ".join(f"c{k} string" for k in range(len(rows))))
    found = {r["column_name"]: (r["block"], r["n_known"], r["total"]) for r in digest({"b": wide}).collect()}
    assert found == {f"c{k}": ("b", 1, code(plain)) for k, (_, plain) in enumerate(rows)}


def test_digest_of_typed_columns(spark):
    typed = spark.range(40).select(
        F.col("id").alias("n"), (F.col("id") * 0.5 - 3).alias("x"), (F.col("id") / 7).cast("decimal(18,7)").alias("d"), (F.col("id") + 2**53).alias("big"), (F.col("id") % 2 == 0).alias("b"),
        F.lit(None).cast("bigint").alias("none"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), "id")).alias("t"))
    rows = typed.collect()
    shown = {"n": whole, "x": whole, "d": whole, "b": lambda v: str(v).lower(), "t": str}
    found = {r["column_name"]: (r["n_known"], r["total"]) for r in digest({"b": typed.drop("big")}).collect()}
    assert found == {c: (sum(r[c] is not None for r in rows), sum(code(f(r[c])) for r in rows if r[c] is not None)) for c, f in shown.items()}
    # past 2^52 a number's text is that of its double as a decimal
    assert digest({"b": typed.select("big")}).first()["n_known"] == 40 and digest({"b": typed.limit(0)}).count() == 0


def test_digest_keeps_a_row_one_row(spark):
    plan = digest({"b": spark.range(9).select("id", F.col("id").cast("string").alias("t"))})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Exchange hashpartitioning" not in plan
