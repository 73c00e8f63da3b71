"""Incremental load: newly landed exports are upserted as they arrive, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bazaarlens.session import materialise
from bazaarlens.sources.catalog import logical_file
from bazaarlens.sources.reports import FILE, ROW, load_batch, parse_orders
from bazaarlens.sources.tables import upsert_tables


def load_new_orders(spark: SparkSession, landing: str, root: str, checkpoint: str, header: list[str],
                    salt: str | None, marketplace: str, slots: int = 16) -> None:
    """Process all order files that have landed since the last call, then stop.

    The file-source checkpoint remembers which files were read. Each batch is
    an idempotent upsert by key into `orders` and `order_lines` under `root`, so
    a batch repeated after a failure leaves the same tables, and a batch
    rewrites only the months and key slots of its packages. A file whose
    header differs from `header` stops the load: columns are never taken by place.
    """
    schema = ", ".join(f"`{c}` string" for c in header)
    files = spark.readStream.schema(schema).option("header", "true").option("enforceSchema", "false").option("multiLine", "true").option("escape", '"').csv(landing)
    rows = files.select("*", logical_file(F.col("_metadata.file_path")).alias(FILE))

    def apply(batch: DataFrame, _: int) -> None:
        placed = batch.withColumn(ROW, F.monotonically_increasing_id())
        tables = parse_orders(placed, salt, marketplace)
        tables["orders"] = materialise(tables["orders"], "orders")  # lines take their folder from it
        upsert_tables(tables, root, slots)

    rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def load_new_reports(spark: SparkSession, landing: str, root: str, checkpoint: str, salt: str | None, marketplace: str, slots: int = 16, default_year: int = 2026, most_files: int = 1000) -> None:
    """Process the files of all six reports that have landed since the last call, then stop; at most `most_files` part files at a time.

    What streams is the list of files: their type and month are read off their names, their columns off their headers, and
    every batch is a `load_batch`, with its gate, replacement, stamps and ledger. So files that
    land one by one, in any order, give the tables that they give together, and a batch that is
    repeated after a failure finds its files in the ledger.
    """
    listing = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(listing).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", most_files).load(landing)

    def apply(batch: DataFrame, _: int) -> None:
        # one short text per file of the batch; a report in part files is one
        paths = [r[0] for r in batch.select(logical_file(F.col("path")).alias("file")).distinct().collect()]
        if paths:
            load_batch(spark, sorted(paths), root, salt, marketplace, default_year, slots=slots)

    files.select("path").writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
