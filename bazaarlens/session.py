"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans are written for. AQE picks partition counts and
# splits skewed joins; nothing below depends on the size of the cluster.
SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # no call-site capture for every column expression: plans here have thousands
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bazaarlens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
    )
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the setting spark.checkpoint.dir.

    Only a single local process (master local[...], as in tests), where it is
    unset, makes a folder of its own, and removes it when it ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if master not in _own:
        _own[master] = tempfile.mkdtemp(prefix="bazaarlens-")
        atexit.register(shutil.rmtree, _own[master], ignore_errors=True)
    return _own[master]


_own: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, inside one folder per application, which can go when the run is over."""
    return f"{scratch_root(spark).rstrip('/')}/bazaarlens-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written in here go as soon as it is written, not when the driver happens to collect its garbage: nothing else reads them."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, name: str = "table", file_rows: int = 0, codec: str | None = None) -> DataFrame:
    """Write `df` once as parquet under the shared folder and read it back.

    Used where several branches must see the same physical rows (range slices)
    or where a costly relation feeds many results. A written table survives the
    loss of executors and keeps column pruning and size statistics. `file_rows`
    is the most rows a file gets (0: any): Spark packs at most 32 files into a read task. `codec`: of the files, where not the session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("maxRecordsPerFile", file_rows).options(**({"compression": codec} if codec else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


TASK_ROWS = 1 << 19  # rows that a task groups at a time where `dealt` spreads them


def dealt(df: DataFrame, *keys: str, name: str = "table", rows: int = TASK_ROWS) -> DataFrame:
    """`df`, written, dealt by `keys` to tasks of about `rows` rows each, however many rows there are.

    For grouping rows that hardly shrink by it: what a task holds then doesn't grow with its share of bytes, which
    holds the more rows the better they are packed. Small files do the same for the tasks that deal. The count is read from the files' footers.
    """
    table = materialise(df, name, max(1, rows // 4))
    return table.repartition(max(1, -(-table.count() // rows)), *keys)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote under the shared folder. Call it when no result that was built is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark).rstrip('/')}/bazaarlens-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
