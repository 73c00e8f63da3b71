"""Writing tables and results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

MANIFEST = "manifest"
# times in full, which Spark else cuts to thousandths of a second
TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"}


def export_csv(tables: dict[str, DataFrame], folder: str, mode: str = "errorifexists") -> dict[str, str]:
    """One CSV folder with header per table; maps are written as JSON text. Returns the paths."""
    paths = {}
    for name, df in tables.items():
        maps = {f.name: F.to_json(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() in ("map", "array", "struct")}
        paths[name] = f"{folder.rstrip('/')}/{name}"
        plain = df.withColumns(maps) if maps else df
        plain.write.mode(mode).options(**TIMES).option("header", "true").option("escape", "\"").csv(paths[name])
    return paths


def row_code(df: DataFrame) -> Column:
    """A number from all columns of a row, which tells nulls from values and one column from another; maps as JSON text."""
    cols = [F.to_json(f"`{f.name}`") if f.dataType.typeName() == "map" else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.xxhash64(*cols, F.concat(*[F.isnull(c).cast("string") for c in cols]))


def _sums(df: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(row_code(df).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("checksum")]


def export_results(results: dict[str, DataFrame], folder: str, fmt: str = "json", mode: str = "errorifexists") -> dict[str, str]:
    """Every result block under its name, as JSON lines (null fields kept) or parquet. Returns the paths.

    Rows and a checksum over all columns, whatever the order of rows, are taken of each block as it is written, without a
    second pass, and are listed in `manifest`, which is written last: an export without one isn't complete.
    """
    paths, listed = {}, []
    for name, df in results.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        seen = Observation(f"export-{name}")
        writer = df.observe(seen, *_sums(df)).write.mode(mode)
        if fmt == "json":
            writer = writer.options(**TIMES)
            writer = writer.option("ignoreNullFields", "false")
        writer.format(fmt).save(paths[name])
        listed.append((name, fmt, seen.get["n_rows"], str(seen.get["checksum"])))
    if results:
        spark = next(iter(results.values())).sparkSession
        blocks = spark.createDataFrame(listed, "name string, format string, n_rows bigint, checksum string")
        blocks.coalesce(1).write.mode(mode).json(f"{folder.rstrip('/')}/{MANIFEST}")
    return paths


def read_results(spark: SparkSession, folder: str, schemas: dict) -> dict[str, DataFrame]:
    """The blocks of a complete export, by the manifest; `schemas` by name. Fails where there is no manifest."""
    listed = spark.read.schema("name string, format string, n_rows bigint, checksum string").json(f"{folder.rstrip('/')}/{MANIFEST}")
    return {r["name"]: spark.read.schema(schemas[r["name"]]).options(**TIMES).format(r["format"]).load(f"{folder.rstrip('/')}/{r['name']}") for r in listed.collect() if r["name"] in schemas}


def verify_results(spark: SparkSession, folder: str, schemas: dict) -> DataFrame:
    """(name, n_rows, found_rows, same) of each block of an export: whether the files hold what was written, every column of it."""
    listed = spark.read.schema("name string, format string, n_rows bigint, checksum string").json(f"{folder.rstrip('/')}/{MANIFEST}")
    found = reduce(DataFrame.unionByName, [df.agg(F.lit(name).alias("name"), *_sums(df)) for name, df in read_results(spark, folder, schemas).items()])
    found = found.select("name", F.col("n_rows").alias("found_rows"), F.col("checksum").cast("string").alias("found"))
    return listed.join(found, "name").select("name", "n_rows", "found_rows", (F.col("checksum") == F.col("found")).alias("same"))
