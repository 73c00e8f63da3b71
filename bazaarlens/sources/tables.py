"""The commerce tables at rest: parquet folders by month and key slot, and a short list of the folders that each version consists of."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bazaarlens.operators import ingest
from bazaarlens.operators.core import latest_by
from bazaarlens.schemas import KEYS, LOAD_ORDER, TABLES, conform, table_schema
from bazaarlens.session import materialise

MONTH, SLOT, BATCH = "stored_month", "key_slot", "batch"
STAMP = "loaded_from"  # file that a row came from: of two versions of a row, that of the greater stamp counts
VERSIONS = "versions"
INDEX = "package_months"  # where a package's rows lie: its month may change
# tables of the store that aren't tables of the report
STORED = {INDEX: f"package_no string, {MONTH} string",
       "files": "file_name string, digest string, report_type string, period date, landed_at timestamp, bytes bigint, status string, reason string, row_count bigint, loaded_at timestamp_ntz"}
OWN_KEYS = {"files": ["file_name", "digest"]}
# folder columns by table; the others lie in one folder
FOLDERS = {"orders": [MONTH, SLOT], "order_lines": [MONTH, SLOT], INDEX: [SLOT], "sales_monthly": [MONTH], "distribution": [MONTH], "ops_monthly": [MONTH], "store_daily": [MONTH]}
# what the coverage map calls the dated tables
REPORTS = {"sales_monthly": "sales", "orders": "orders", "distribution": "distribution", "store_daily": "store", "ops_monthly": "ops"}
DATES = {"orders": "order_at", "sales_monthly": "period", "distribution": "period", "ops_monthly": "period", "store_daily": "day"}


def month_part(date: str) -> Column:
    """Month of a row as its folder's name; 'none' without a date."""
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit("none"))


class Store:
    """A folder of tables that change together: all new folders are written first, then a version names them.

    `<root>/<table>/batch=<id>/stored_month=.../key_slot=...` holds rows, and is never changed. `<root>/versions/<n>.json` lists
    the folders of every table, with the rows and days that the dated ones hold; it appears by one rename. A reader takes the newest version, so
    that it sees a load whole or not at all, and a load that fails leaves the tables as they were. One load at a
    time: two that start from one version can't both publish the next.
    """

    def __init__(self, spark: SparkSession, root: str, slots: int = 16):
        self.spark, self.root, self.slots, self.batch = spark, root.rstrip("/"), slots, uuid.uuid4().hex[:12]
        found = self.versions()
        self.version, (self.folders, self.facts) = (found[-1], self.listed(found[-1])) if found else (0, ({}, {}))
        self.fresh = {name: list(paths) for name, paths in self.folders.items()}

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        fs, place = self._fs(), self._path(VERSIONS)
        names = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def listed(self, version: int) -> tuple[dict[str, list[str]], dict[str, list]]:
        """Folders of each table in a version, a short text per folder, and what the dated ones hold: rows, rows with a value, days, last day of the month."""
        path = self._path(VERSIONS, f"{version:09d}.json").toString()
        found = json.loads("\n".join(r[0] for r in self.spark.read.option("wholetext", "true").text(path).collect()))
        return found["folders"], found["facts"]

    def month_facts(self) -> DataFrame:
        """(report, month, n, reached_day) of the dated tables, as `coverage.coverage_by_month` counts them, from the version's list alone: no rows are read."""
        rows = []
        for name, report in REPORTS.items():
            for path in self.folders.get(name, []):
                month, (n, known, days, last) = self.value(path)[0], self.facts[f"{name}/{path}"]
                if month != "none":
                    rows.append((report, month, {"store": days, "ops": known}.get(report, n), last if report == "orders" else None))
        found = self.spark.createDataFrame(rows, "report string, month string, n bigint, reached_day int").groupBy("report", "month")
        return found.agg(F.sum("n").alias("n"), F.max("reached_day").alias("reached_day")).where("n > 0")

    def schema(self, name: str) -> StructType:
        rows = StructType.fromDDL(STORED[name]) if name in STORED else table_schema(name)
        own = [StructField(STAMP, StringType())] if name in KEYS else []
        parts = [StructField(c, StringType() if c != SLOT else StructType.fromDDL("s int")["s"].dataType) for c in [BATCH, *FOLDERS.get(name, [])] if c not in rows.names]
        return StructType([*[f for f in rows.fields if f.name not in FOLDERS.get(name, [])], *own, *parts, *[f for f in rows.fields if f.name in FOLDERS.get(name, [])]])

    def read(self, name: str, touched: set[tuple] | None = None, fresh: bool = False) -> DataFrame:
        """Rows of a table, of the given folders alone if `touched` lists their values; with the folder columns."""
        paths = (self.fresh if fresh else self.folders).get(name, [])
        if touched is not None:
            paths = [p for p in paths if self.value(p) in touched]
        if not paths:
            return self.spark.createDataFrame([], self.schema(name))
        base = f"{self.root}/{name}"
        return self.spark.read.schema(self.schema(name)).option("basePath", base).parquet(*[f"{base}/{p}" for p in paths])

    def holds(self, name: str, touched: set[tuple] | None = None) -> bool:
        """Whether any folder of the table, or of those that `touched` lists, is there."""
        return any(touched is None or self.value(p) in touched for p in self.folders.get(name, []))

    @staticmethod
    def value(folder: str) -> tuple:
        """Folder column values of a folder's path, after its batch."""
        return tuple(p.split("=", 1)[1] for p in folder.split("/")[1:])

    def write(self, name: str, rows: DataFrame, replaced: set[tuple] | None = None) -> DataFrame:
        """Rows into folders of this load, in place of those `replaced` (all of them: None); returns them as written."""
        parts, path = FOLDERS.get(name, []), f"{self.root}/{name}/{BATCH}={self.batch}"
        kept = [p for p in self.fresh.get(name, []) if replaced is not None and self.value(p) not in replaced]
        rows = rows.select(*[F.col(c) for c in self.schema(name).names if c != BATCH])
        # small folders are written by one task, large ones by several
        (rows.hint("rebalance", *parts) if parts else rows).write.partitionBy(*parts).parquet(path)
        made = [f"{BATCH}={self.batch}"]
        if parts:
            # one row per folder, from the folder columns, and the date of tables that have one
            folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in parts])
            day = F.dayofmonth(DATES[name]) if name in DATES else F.lit(None)
            known = F.count("value") if name == "ops_monthly" else F.count(F.lit(1))
            found = self.spark.read.option("basePath", path).schema(rows.schema).parquet(path).groupBy(folder.alias("folder")).agg(F.count(F.lit(1)), known, F.size(F.collect_set(day)), F.max(day)).collect()
            made = [f"{BATCH}={self.batch}/{r['folder']}" for r in found]
            self.facts |= {f"{name}/{p}": list(r)[1:] for p, r in zip(made, found, strict=True)} if name in DATES else {}
        self.fresh[name] = sorted([*kept, *made])
        return self.read(name, {self.value(p) for p in made}, fresh=True)

    def _text(self) -> str:
        used = {f"{name}/{p}" for name, paths in self.fresh.items() for p in paths}
        return json.dumps({"folders": self.fresh, "facts": {p: f for p, f in self.facts.items() if p in used}}, indent=0)

    def publish(self) -> int:
        """The next version, by renaming its list into place."""
        fs, text = self._fs(), self._text()
        place, aside = self._path(VERSIONS, f"{self.version + 1:09d}.json"), self._path(VERSIONS, f".{self.batch}")
        out = fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.exists(place) or not fs.rename(aside, place):
            raise RuntimeError("another load has published this version: load again")
        self.version, self.folders = self.version + 1, self.fresh
        self.fresh = {name: list(paths) for name, paths in self.folders.items()}
        return self.version

    def prune(self, keep: int = 2) -> int:
        """Remove what none of the last `keep` versions lists, failed loads' folders included; not while another load runs. Returns the folders removed."""
        fs, kept = self._fs(), self.versions()[-keep:]
        used = {f"{name}/{p}" for v in kept for name, paths in self.listed(v)[0].items() for p in paths}
        batches, gone = {"/".join(u.split("/")[:2]) for u in used}, 0
        for name in {u.split("/")[0] for u in used}:
            for status in fs.listStatus(self._path(name)):
                at = f"{name}/{status.getPath().getName()}"
                if at not in batches:
                    gone += fs.delete(status.getPath(), True)
        for v in self.versions()[:-keep]:
            fs.delete(self._path(VERSIONS, f"{v:09d}.json"), False)
        return gone


def _newer(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key of both: that with the greater stamp, the new one if they are equal or either has none."""
    both = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    free = F.col("_new") & F.col(STAMP).isNull()
    return latest_by(both, keys, [F.desc(free), F.desc_nulls_last(STAMP), F.desc("_new")]).drop("_new")


def _stamped(name: str, df: DataFrame) -> DataFrame:
    """The table's own columns, one row per key, and the stamp (null where the rows have none)."""
    stamp = F.col(STAMP) if STAMP in df.columns else F.lit(None).cast("string")
    rows = conform(df, name).columns
    return ingest.unique_by(conform(df.withColumn(STAMP, stamp), name, [STAMP]), KEYS[name], [F.desc_nulls_last(STAMP), *[F.desc(f"`{c}`") for c in rows if c not in KEYS[name]]])


def _values(rows: DataFrame, columns: list[str]) -> set[tuple]:
    """Folder column values; as many as folders."""
    return {tuple(str(v) for v in r) for r in rows.select(*columns).distinct().collect()}


def _upsert_dated(store: Store, name: str, df: DataFrame) -> None:
    """A table whose folder follows from its key, or that has but one."""
    rows = _stamped(name, df)
    if name in DATES:
        rows = rows.withColumn(MONTH, month_part(DATES[name]))
    rows = materialise(rows, "batch")
    touched = _values(rows, FOLDERS[name]) if name in FOLDERS else None
    # new folders hold the batch, which has one row per key
    store.write(name, _newer(store.read(name, touched).drop(BATCH), rows, KEYS[name]) if store.holds(name, touched) else rows, touched)


def _upsert_packages(store: Store, tables: dict[str, DataFrame]) -> None:
    """Package headers and lines. Both lie by order month and a slot of the package number, which is found without its month.

    The index tells in which months the batch's packages lie now. Those folders and the ones
    they belong to by the batch are rewritten, so that a package whose date has changed, gone or come back moves with all its lines.
    """
    slot = ingest.key_slot(["package_no"], store.slots)
    new = {name: materialise(_stamped(name, df).withColumn(SLOT, slot), name) for name, df in tables.items() if name in ("orders", "order_lines")}
    # stored tables are wide and mostly null, so that Spark guesses their key columns at a small part of their size: joins of a row per package are told not to broadcast
    packages = [rows.select("package_no", SLOT) for rows in new.values()]
    packages = (packages[0].unionByName(packages[1]) if len(packages) > 1 else packages[0]).distinct()
    slots = _values(packages, [SLOT])
    index = store.read(INDEX, slots).select("package_no", MONTH, SLOT)
    places = index.join(packages.drop(SLOT).hint("merge"), "package_no", "left_semi").select(MONTH, SLOT)
    if "orders" in new:
        places = places.unionByName(new["orders"].select(month_part("order_at").alias(MONTH), SLOT))
    places = places.unionByName(packages.select(F.lit("none").alias(MONTH), SLOT))  # lines whose package wasn't known
    touched = _values(places, [MONTH, SLOT])
    if "orders" in new:
        merged = _newer(store.read("orders", touched).drop(BATCH, MONTH), new["orders"], KEYS["orders"]).withColumn(MONTH, month_part("order_at"))
        merged = store.write("orders", merged, touched).select("package_no", MONTH, SLOT)
        index = store.write(INDEX, index.join(merged.hint("merge"), "package_no", "left_anti").unionByName(merged), slots).select("package_no", MONTH, SLOT)
    lines = store.read("order_lines", touched).drop(BATCH, MONTH)
    if "order_lines" in new:
        lines = _newer(lines, new["order_lines"], KEYS["order_lines"])
    months = index.select(F.col("package_no").alias("_of"), MONTH).hint("merge")
    lines = lines.join(months, F.col("package_no") == F.col("_of"), "left").drop("_of").withColumn(MONTH, F.coalesce(MONTH, F.lit("none")))
    store.write("order_lines", lines, touched)


def upsert_tables(tables: dict[str, DataFrame], root: str, slots: int = 16, ledger: DataFrame | None = None) -> int:
    """Upsert of every given table under `root`, published together as one version, whose number is returned.

    Rows may carry `loaded_from`, the stamp of their file: of two rows with one key the one with
    the greater stamp stays, whichever was loaded first. A row without a stamp counts as the newest. `uploads` rows
    are appended. `ledger` rows (one per file) go into the same version.
    """
    spark = next(iter(tables.values())).sparkSession if tables else ledger.sparkSession
    store = Store(spark, root, slots)
    if "orders" in tables or "order_lines" in tables:
        _upsert_packages(store, tables)
    for name in sorted((n for n in tables if n not in ("orders", "order_lines")), key=[*LOAD_ORDER, *TABLES].index):
        if name in KEYS:
            _upsert_dated(store, name, tables[name])
        else:
            store.write(name, conform(tables[name], name), set())
    if ledger is not None:
        kept = store.read("files").drop(BATCH).join(ledger, OWN_KEYS["files"], "left_anti")
        store.write("files", kept.unionByName(ledger))
    return store.publish()


def read_tables(spark: SparkSession, root: str, names: tuple[str, ...] = tuple(TABLES), version: int | None = None) -> dict[str, DataFrame]:
    """The tables found under `root` in their newest version, or a given one, with their declared schemas.

    A filter on the folder column (`stored_month`) reads only its folders, so it is kept.
    """
    store = Store(spark, root)
    if version is not None:
        store.folders, store.facts = store.listed(version)
    found = {}
    for name in names:
        if name in store.folders:
            df = store.read(name)
            found[name] = df.select(*[F.col(c) for c in conform(df, name).columns], *[F.col(c) for c in (MONTH,) if c in df.columns])
    return found


def read_month_facts(spark: SparkSession, root: str) -> DataFrame:
    """(report, month, n, reached_day) of the stored reports, from the newest version's list: see `coverage.covered`."""
    return Store(spark, root).month_facts()


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """The ledger: one row per file content that was loaded, archived or refused."""
    return Store(spark, root).read("files").drop(BATCH)
