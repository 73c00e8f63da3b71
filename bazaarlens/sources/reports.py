"""Reading landed report exports (CSV with header, or parquet) into the commerce tables.

Exports keep the marketplace's own headers. Every column is read as text and
parsed by column expressions; nothing is inferred.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bazaarlens.functions.parsing import locale_number, report_timestamp
from bazaarlens.operators import core, ingest
from bazaarlens.schemas import KEYS, conform
from bazaarlens.session import materialise, shuffles_removed
from bazaarlens.sources.catalog import DEFAULT_YEAR, active_files, file_slot, inspected_files, landed_files, logical_file, report_file_catalog
from bazaarlens.sources.tables import STAMP, STORED, read_files, upsert_tables

# --- fixed values: headers of the exports and the names of our columns ---
SALES_TEXT = {"Barkod": "barcode", "Model Kodu": "model_code", "Ürün Adı": "name", "Kategori": "category", "Marka": "brand",
              "Renk": "color", "Beden": "size"}
SALES_NUMBERS = {"Güncel Satış Fiyatı": "current_price", "Güncel Stok": "stock", "Brüt Sipariş Adedi": "gross_order_qty",
                 "Brüt Satış Adedi": "gross_sales_qty", "İptal Adedi": "cancel_qty", "İade Adedi": "return_qty",
                 "Net Satış Adedi": "net_sales_qty", "Brüt Ciro": "gross_revenue", "İndirim Tutarı": "discount", "Net Ciro": "net_revenue",
                 "Toplam Komisyon Tutarı": "commission", "Ortalama Komisyon Oranı": "commission_rate", "Ortalama Satış Fiyatı": "avg_price"}
REASON_POSITIONS = slice(23, 44)
ORDER_TEXT = {"Paket No": "package_no", "Sipariş Numarası": "order_no", "Kargo Firması": "carrier", "Sipariş Statüsü": "status",
              "İl": "city", "İlçe": "district", "Müşteri Sipariş Adedi": "customer_nth", "Yaş": "age_band", "Cinsiyet": "gender", "Barkod": "barcode"}
ORDER_TIMES = {"Sipariş Tarihi": "order_at", "Termin Süresinin Bittiği Tarih": "deadline_at", "Kargoya Teslim Tarihi": "shipped_at",
               "Teslim Tarihi": "delivered_at"}
ORDER_NUMBERS = {"Adet": "qty", "Birim Fiyatı": "unit_price", "Satış Tutarı": "gross", "İndirim Tutarı": "discount",
                 "Faturalanacak Tutar": "net", "Faturalanan Kargo Tutarı": "cargo_fee", "Kargodan alınan desi": "desi", "Komisyon Oranı": "commission_rate"}
FAST_DELIVERY = "Müşteriye “Yarın Kapında” gösterildi"
DISTRIBUTION_COUNTS = {"Sipariş Adedi": "orders", "Müşteri Adedi": "customers"}
STORE = {"Mağaza Görüntülenme Sayısı": "store_views", "Toplam Takipçi Sayısı": "followers_total",
         "Toplam Takipçi Sayısı - Kazanılan": "followers_gained", "Toplam Takipçi Sayısı - Kaybedilen": "followers_lost",
         "Tekil Ziyaretçi Sayısı": "visitors", "Yeni Gelen Tekil Ziyaretçi Sayısı": "new_visitors",
         "Ziyaretçinin Takipçiye Dönüş Oranı": "follow_rate", "Ziyaretçinin Müşteriye Dönüş Oranı": "customer_rate",
         "Mağazanın Brüt Sipariş Adedi": "store_orders", "Toplam Brüt Sipariş Adedi": "total_orders", "Mağazanın Brüt Satış Adedi": "store_units",
         "Toplam Brüt Satış Adedi": "total_units", "Mağazanın Satışa Dönüş Oranı": "store_conversion", "Mağazanın Brüt Cirosu": "store_revenue",
         "Toplam Brüt Ciro": "total_revenue", "Mağaza Müşteri Sayısı": "store_customers", "Toplam Müşteri Sayısı": "total_customers"}
ADS = {"Reklam Adı": "name", "Reklam Statüsü": "status", "Başlangıç Tarihi": "started_at", "Ürün Adedi": "product_count",
       "Ürün ContentId Listesi": "product_ids", "Toplam Bütçe": "total_budget", "Günlük Bütçe": "daily_budget", "Harcanan Bütçe": "spent",
       "Gerçekleşen TBM": "cpc", "Tıklanma": "clicks", "Görüntülenme": "impressions", "Doğrudan Satış Adedi": "direct_sales",
       "Dolaylı Satış Adedi": "indirect_sales", "Doğrudan Reklam Cirosu": "direct_revenue", "Dolaylı Reklam Cirosu": "indirect_revenue",
       "Harcama Getirisi": "roas"}
# --- end of fixed values ---

MONEY = "decimal(18,7)"
FILE, ROW, PERIOD = "file_name", "row_no", "period"
OWN = (FILE, ROW, PERIOD)
# what a file must have to be taken: its required headers
REQUIRED = {"sales": ["Barkod", "Brüt Sipariş Adedi"], "orders": ["Paket No", "Alıcı", "İl", "İlçe", "Barkod", "Adet"], "distribution": ["dimension", *DISTRIBUTION_COUNTS],
            "store": ["Tarih"], "ops": ["Kalite Metriklerim"], "ads": ["Reklam Adı"]}


def read_export(spark: SparkSession, paths: list[str], header: list[str], parquet: bool = False, renamed: bool = False) -> DataFrame:
    """Files of one report with the same header as text rows, with the file each row came from and its place in it.

    A CSV export is read whole by one task: its cells may hold line breaks, and the
    order of its rows decides which one counts. Exports are a file per seller and month. `renamed`: names of the
    header were told apart (`named_apart`), so that they can't be compared with the file's again.
    """
    if parquet:
        raw = spark.read.parquet(*paths)
    else:
        raw = spark.read.schema(", ".join(f"`{c}` string" for c in header)).option("header", "true").option("enforceSchema", str(renamed).lower()).option("multiLine", "true").option("escape", '"').csv(paths)
    return raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in header], logical_file(F.col("_metadata.file_path")).alias(FILE), F.monotonically_increasing_id().alias(ROW))


def _text(raw: DataFrame, names: dict[str, str]) -> list[Column]:
    return [(F.col(f"`{h}`") if h in raw.columns else F.lit(None)).cast("string").alias(n) for h, n in names.items()]


def _numbers(raw: DataFrame, names: dict[str, str], kind: str | None = None) -> list[Column]:
    out = []
    for header, name in names.items():
        value = locale_number(F.col(f"`{header}`")) if header in raw.columns else F.lit(None).cast("double")
        out.append((value.cast(kind) if kind else value).alias(name))
    return out


def sales_rows(raw: DataFrame) -> DataFrame:
    """Sales rows typed and named, with the reasons (columns that go by position) as JSON text of the non-zero ones."""
    reasons = [c for c in raw.columns if c not in OWN][REASON_POSITIONS]
    counts = [F.coalesce(locale_number(F.col(f"`{r}`")).cast("int"), F.lit(0)).alias(r) for r in reasons]
    rows = raw.select(*OWN, *_text(raw, SALES_TEXT), *_numbers(raw, SALES_NUMBERS), *counts)
    money = {c: F.col(c).cast(MONEY) for c in ("current_price", "gross_revenue", "discount", "net_revenue", "commission")}
    whole = {c: F.col(c).cast("int") for c in ("stock", "gross_order_qty", "gross_sales_qty", "cancel_qty", "return_qty", "net_sales_qty")}
    kept = [c for c in (*OWN, *SALES_TEXT.values(), *SALES_NUMBERS.values()) if c not in ("period", "barcode")]
    return ingest.sales_monthly_fact(rows.withColumns({**money, **whole}), kept, tuple(reasons))


def parse_sales(rows: DataFrame) -> dict[str, DataFrame]:
    """Products (latest period wins) and the monthly fact."""
    attributes = [c for c in SALES_TEXT.values() if c != "barcode"]
    products = ingest.product_dimension_latest(rows, [*attributes, "current_price", "stock", PERIOD, FILE]).withColumnRenamed("stock", "current_stock")
    return {"products": products, "sales_monthly": last_of(rows, "sales_monthly")}


def last_of(rows: DataFrame, table: str) -> DataFrame:
    """One row per key: that of the last file, in it the last row."""
    return core.latest_by(rows, KEYS[table], [F.desc(FILE), F.desc(ROW)])


def stamp(file: dict) -> str:
    """What files are ordered by: their month (one without a month last; store and operations files: their names), then the time they landed, then their names."""
    month = file[PERIOD].strftime("%Y-%m") if file[PERIOD] else "none"
    first = {"store": file["file_name"].rsplit("/", 1)[-1], "ads": ""}
    first["ops"] = first["store"]
    landed = file["landed_at"].astimezone(dt.timezone.utc).isoformat(timespec="milliseconds")
    return "\t".join([first.get(file["report_type"], month), landed, file["file_name"]])


def order_rows(raw: DataFrame, salt: str | None, marketplace: str) -> DataFrame:
    """Order rows typed and named. Rows equal in every column of their file count once; only then the personal columns go.

    Two lines that differ in a personal or a delivery number alone are two lines.
    """
    own = [c for c in raw.columns if c != ROW]
    # dealt by package, whose rows lie side by side: what they share is packed away in the shuffle, the written rows and the roll-up after it
    once = raw.repartition(FILE, "Paket No").groupBy(*[F.col(f"`{c}`") for c in own]).agg(F.min(ROW).alias(ROW))
    coded = ingest.pseudonymise_customers(once, salt)
    return coded.select(
        FILE, ROW, F.col("customer_hash").alias("customer"), *_text(coded, {**ORDER_TEXT, FAST_DELIVERY: "fast_delivery"}),
        *[(report_timestamp(F.col(f"`{h}`")) if h in coded.columns else F.lit(None).cast("timestamp_ntz")).alias(n) for h, n in ORDER_TIMES.items()],
        *_numbers(coded, {**ORDER_NUMBERS, f"{marketplace} İndirim Tutarı": "ty_discount"}, MONEY),
    ).withColumn("qty", F.col("qty").cast("bigint"))


def file_orders(rows: DataFrame) -> dict[str, DataFrame]:
    """Package headers and order lines of each file."""
    attributes = (*ingest.ATTRIBUTES, "deadline_at", "fast_delivery")
    return {
        "orders": ingest.package_rollup_ingest(rows, attributes=attributes, distinct=False, keys=("package_no", FILE)),
        "order_lines": core.order_line_rollup(rows, keys=("package_no", "barcode", FILE)),
    }


def parse_orders(raw: DataFrame, salt: str | None, marketplace: str) -> dict[str, DataFrame]:
    """Package headers and order lines; one that is in two files is taken from the file that sorts last."""
    parts = file_orders(order_rows(raw, salt, marketplace))
    return {name: conform(core.latest_by(df, KEYS[name], [F.desc(FILE)]), name) for name, df in parts.items()}


def distribution_rows(raw: DataFrame) -> DataFrame:
    """Sheets landed with a `dimension` column, one row per key of a file: the first."""
    counted = raw.select(*[F.col(f"`{c}`") for c in raw.columns if c not in DISTRIBUTION_COUNTS], *_numbers(raw, DISTRIBUTION_COUNTS, "int"))
    # a sheet's own order of columns: buckets first, then counts and shares
    order = [DISTRIBUTION_COUNTS.get(c, c) for c in raw.columns]
    rows = ingest.distribution_sheet(F.col("dimension"), counted.select(*[F.col(f"`{c}`") for c in order]), [FILE, ROW])
    return core.latest_by(rows, [*KEYS["distribution"], FILE], [F.asc(ROW)])


def typed_rows(raw: DataFrame, report: str, salt: str | None, marketplace: str) -> DataFrame:
    """Rows of files with one header, under our names."""
    if report == "sales":
        return sales_rows(raw)
    if report == "orders":
        return order_rows(raw, salt, marketplace)
    if report == "distribution":
        return distribution_rows(raw)
    plain, keep = raw.drop(PERIOD), [FILE, ROW]
    if report == "store":
        return ingest.store_daily_normalise(plain, STORE, keep=keep)
    if report == "ads":
        return ingest.ad_campaigns_normalise(plain, ADS, keep=keep)
    return ingest.ops_unpivot(plain, keep=keep)


# the table whose keys tell whether a report's row is one
MAIN = {"sales": "sales_monthly", "orders": "orders", "distribution": "distribution", "store": "store_daily", "ops": "ops_monthly", "ads": "ad_campaigns"}
SMALL = {"store": "store_daily", "ops": "ops_monthly", "ads": "ad_campaigns"}


def report_tables(rows: DataFrame, report: str) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Tables of one report, and what each file holds of them (with its file name)."""
    if report == "sales":
        return parse_sales(rows), [rows, rows]
    if report == "orders":
        parts = file_orders(rows)
        return {name: core.latest_by(df, KEYS[name], [F.desc(FILE)]) for name, df in parts.items()}, list(parts.values())
    name = SMALL.get(report, "distribution")
    return {name: last_of(rows, name)}, [rows]


def named_apart(header: list[str]) -> list[str]:
    """Column names of a CSV as Spark gives them: one without a name by its place, those that occur twice with their place."""
    low = [c.lower() for c in header]
    return [f"_c{k}" if not c else f"{c}{k}" if low.count(c.lower()) > 1 else c for k, c in enumerate(header)]


def listed(files: DataFrame, default_year: int = DEFAULT_YEAR) -> list[dict]:
    """One short entry per known report file, as Spark's own file index holds one: path, type, period, time, size."""
    return [r.asDict() for r in report_file_catalog(files, default_year=default_year).collect()]


def inspected(spark: SparkSession, files: list[dict]) -> list[dict]:
    """The entries with their digests, headers and missing columns."""
    if not files:
        return []
    of = lambda parquet: [f["file_name"] for f in files if f["parquet"] == parquet]
    seen = {r["file_name"]: r for r in inspected_files(spark, of(False), of(True)).collect()}
    out = []
    for f in files:
        header = seen[f["file_name"]]["header"]
        names = header if f["parquet"] else named_apart(header)
        out.append({**f, "digest": seen[f["file_name"]]["digest"], "header": names, "renamed": names != header, "missing": ",".join(c for c in REQUIRED[f["report_type"]] if c not in names)})
    return out


def parsed(spark: SparkSession, files: list[dict], salt: str | None, marketplace: str) -> dict[str, DataFrame]:
    """Typed rows of each report, all of its files under one another by name. A read per distinct header, none per file."""
    months = spark.createDataFrame([(f["file_name"], f[PERIOD]) for f in files], "file_name string, period date")
    out = {}
    for report in {f["report_type"]: None for f in files}:
        groups: dict[tuple, list[str]] = defaultdict(list)
        for f in files:
            if f["report_type"] == report:
                groups[f["parquet"], f["renamed"], *f["header"]].append(f["file_name"])
        read = [read_export(spark, sorted(paths), list(header), parquet, renamed) for (parquet, renamed, *header), paths in sorted(groups.items(), key=lambda g: min(g[1]))]
        # the month is read off the name once per file, and joined to its rows
        dated = [raw.join(months, FILE, "left") if report in ("sales", "distribution") else raw.withColumn(PERIOD, F.lit(None).cast("date")) for raw in read]
        typed = [typed_rows(raw.drop(PERIOD) if report == "orders" else raw, report, salt, marketplace) for raw in dated]
        out[report] = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), typed)
    return out


def gated(files: list[dict], rows: dict[str, DataFrame]) -> list[dict]:
    """The entries with the rows that their parser gave, and why a file is refused: missing columns, or no row with a key."""
    counts: dict[str, int] = {}
    for report, df in rows.items():
        verdicts = ingest.file_verdicts(df, FILE, [k for k in KEYS[MAIN[report]] if k in df.columns])
        counts |= {r[FILE]: r["n_rows"] - r["null_keys"] for r in verdicts.collect()}
    return [{**f, "reason": f"missing columns: {f['missing']}" if f["missing"] else "" if counts.get(f["file_name"]) else "no rows"} for f in files]


def newest(spark: SparkSession, files: list[dict]) -> set[tuple]:
    """Names and times of the files that count of those that passed (`active_files`)."""
    if not files:
        return set()
    known = spark.createDataFrame([(f["file_name"], f["report_type"], f[PERIOD], f["landed_at"]) for f in files], "file_name string, report_type string, period date, landed_at timestamp")
    return {tuple(r) for r in active_files(known).select("file_name", "landed_at").collect()}


# bytes of landed files that are shuffled at a time, and at least so many for each core there is
PORTION, CORE_BYTES = 1 << 30, 32 << 20


def portions(files: list[dict], most: int) -> list[list[dict]]:
    """Files in portions of `most` bytes or of one file, so that a load's shuffles don't grow with it. No row is told from those of other files."""
    out: list[list[dict]] = []
    size = 0
    for f in files:
        size += f["bytes"]
        if not out or size > most:
            out.append([])
            size = f["bytes"]
        out[-1].append(f)
    return out


def load_files(spark: SparkSession, files: list[dict], salt: str | None, marketplace: str, replaced: bool = False, standing: list[dict] | None = None,
               loaded_at: dt.datetime | None = None) -> tuple[dict[str, DataFrame], list[dict]]:
    """Tables of the given files, and the files with their verdicts. First the gate, then the replacement.

    A file whose header lacks a required column, or that its parser finds no row in, is refused, and replaces
    nothing. Of those that pass, with `replaced`, the newest of a slot counts, `standing` files of
    earlier loads among them. Rows carry the stamp of their file, so that loads in any order give one table.
    """
    seen = files if files and "digest" in files[0] else inspected(spark, files)
    whole = [f for f in seen if not f["missing"]]
    written: dict[str, list[DataFrame]] = defaultdict(list)
    for some in portions(whole, max(PORTION, CORE_BYTES * spark.sparkContext.defaultParallelism)):
        for report, df in parsed(spark, some, salt, marketplace).items():
            with shuffles_removed(spark):
                written[report].append(materialise(df, report, codec="zstd"))
    rows = {report: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) for report, parts in written.items()}
    checked = gated(seen, rows)
    passed = [f for f in checked if not f["reason"]]
    taken = newest(spark, [*passed, *(standing or [])]) if replaced else {(f["file_name"], f["landed_at"]) for f in passed}
    verdicts = [{**f, "status": "refused" if f["reason"] else "active" if (f["file_name"], f["landed_at"]) in taken else "archived"} for f in checked]
    tables, counts = {}, []
    active = [f for f in verdicts if f["status"] == "active"]
    stamps = spark.createDataFrame([(f["file_name"], stamp(f)) for f in active], "of string, stamp string")
    for report in {f["report_type"]: None for f in active}:
        # a short entry per file, as the driver has them: rows stay where they are
        kept = rows[report].join(F.broadcast(stamps), F.col(FILE) == F.col("of")).drop(FILE, "of").withColumnRenamed("stamp", FILE)
        found, parts = report_tables(kept, report)
        # a product's row goes by its month first; a file without one is the latest
        of = {name: F.concat_ws("\t", F.coalesce(F.date_format(PERIOD, "yyyy-MM"), F.lit("none")), FILE) if name == "products" else F.col(FILE) for name in found}
        tables |= {name: conform(df.withColumn(STAMP, of[name]), name, [STAMP]) for name, df in found.items()}
        counts += [p.select(FILE) for p in parts]
    if counts:
        per_file = reduce(DataFrame.unionByName, [c.groupBy(FILE).count() for c in counts]).groupBy(FILE).agg(F.sum("count").alias("row_count"))
        known = spark.createDataFrame([(f["file_name"], f["report_type"], f[PERIOD]) for f in active], "path string, report_type string, period date")
        uploads = known.join(per_file, F.col("path") == F.substring_index(FILE, "\t", -1)).select(
            "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "report_type", F.coalesce(F.date_format("period", "yyyy-MM-dd"), F.lit("")).alias("period"), "row_count",
            F.lit(loaded_at or dt.datetime.now()).cast("timestamp_ntz").alias("uploaded_at"))
        tables["uploads"] = conform(uploads, "uploads", ["path"])
    return tables, verdicts


def refused(spark: SparkSession, verdicts: list[dict]) -> dict[str, DataFrame]:
    """The refused files as a table, if there are any; one without rows lacks no columns."""
    found = [(f["file_name"], f["report_type"], f["missing"]) for f in verdicts if f["status"] == "refused"]
    return {"refused": spark.createDataFrame(found, "file_name string, report_type string, missing_columns string")} if found else {}


def load_reports(spark: SparkSession, folder: str, salt: str | None, marketplace: str, default_year: int = 2026, ad_totals: DataFrame | None = None,
                 replaced: bool = False, loaded_at: dt.datetime | None = None) -> dict[str, DataFrame]:
    """Tables of every report found in a folder, with the declared schemas. Unknown files are skipped.

    Files of a report with different headers are read apart and put under one
    another by name. A file without its required columns, or without rows, is refused: it is in
    `refused` (file_name, report_type, missing_columns). `ad_totals` are the panel's
    own sums, which no export holds. With `replaced`, a newer file of a
    report's month that passes takes the place of the older one. `uploads` lists the files
    read, with the rows of the tables that each gave.
    """
    found, verdicts = load_files(spark, listed(landed_files(spark, folder), default_year), salt, marketplace, replaced, loaded_at=loaded_at)
    tables = {name: conform(df, name) for name, df in found.items()}
    if ad_totals is not None:
        tables["ad_totals"] = conform(ad_totals, "ad_totals")
    return tables | refused(spark, verdicts)


def load_batch(spark: SparkSession, folder: str | list[str], root: str, salt: str | None, marketplace: str, default_year: int = 2026, ad_totals: DataFrame | None = None,
               slots: int = 16, loaded_at: dt.datetime | None = None) -> dict[str, DataFrame]:
    """Load a folder of reports, or some files, into the tables at rest under `root`: gate, newest file per month, upsert, ledger and upload log, as one version.

    The ledger (`read_files`) keeps each file's digest and whether it is active, archived (a newer one stands for it) or refused. What it
    holds already isn't loaded again, so running the same folder twice changes nothing and logs
    nothing twice, after a failure as well: ledger, log and tables appear together. Returns what was loaded
    (`load_reports`); nothing new gives no tables.
    """
    now, ledger = loaded_at or dt.datetime.now(), read_files(spark, root)
    # what comes to the driver from the ledger has to do with the files of this load
    landed = listed(landed_files(spark, folder).join(ledger.select("file_name", "landed_at", "bytes"), ["file_name", "landed_at", "bytes"], "left_anti"), default_year)
    seen = inspected(spark, landed)
    if not seen and ad_totals is None:
        return {}
    at_hand = spark.createDataFrame([(f["file_name"], f["digest"], f["report_type"], f[PERIOD]) for f in seen], "file_name string, digest string, report_type string, period date")
    same = {tuple(r) for r in ledger.join(at_hand, ["file_name", "digest"], "left_semi").select("file_name", "digest").collect()}
    new = [f for f in seen if (f["file_name"], f["digest"]) not in same]
    slots_of = at_hand.select(F.col("report_type").alias("_type"), file_slot().alias("_slot")).distinct()
    active = ledger.where("status = 'active'").join(slots_of, (F.col("report_type") == F.col("_type")) & (file_slot() == F.col("_slot")), "left_semi")
    standing = [r.asDict() for r in active.collect()]
    tables, verdicts = load_files(spark, new, salt, marketplace, True, standing, now) if new else ({}, [])
    if ad_totals is not None:
        tables["ad_totals"] = conform(ad_totals, "ad_totals")
    if not tables and not verdicts:
        return {}
    winners = newest(spark, [*(f for f in verdicts if f["status"] == "active"), *standing])
    gone = [{**r, "status": "archived"} for r in standing if (r["file_name"], r["landed_at"]) not in winners]
    if "uploads" in tables:
        tables["uploads"] = materialise(tables["uploads"], "uploads")
    counts = {r["path"]: r["row_count"] for r in tables["uploads"].collect()} if "uploads" in tables else {}
    entries = [(f["file_name"], f["digest"], f["report_type"], f[PERIOD], f["landed_at"], f["bytes"], f["status"], f["reason"], counts.get(f["file_name"], 0), now) for f in verdicts]
    entries += [tuple(r[c] for c in ("file_name", "digest", "report_type", PERIOD, "landed_at", "bytes", "status", "reason", "row_count", "loaded_at")) for r in gone]
    upsert_tables(tables, root, slots, ledger=spark.createDataFrame(entries, STORED["files"]))
    return {name: conform(df, name) for name, df in tables.items()} | refused(spark, verdicts)
