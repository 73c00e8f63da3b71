"""Cleaning, ingestion, key and sink queries over raw rows written from the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from bazaarlens.functions.parsing import locale_number, month_header, report_day, report_timestamp
from bazaarlens.operators import core, coverage, ingest, kpis, sinks
from bazaarlens.plans.digests import digest
from bazaarlens.plans.queries_money import TODAY
from bazaarlens.schemas import KEYS
from bazaarlens.session import scratch_path
from bazaarlens.sources import catalog, raw_fixtures as raw, reports, tables as tables_at_rest
from bazaarlens.sources.fixtures import REASON_CODES, Fixture, WrittenFixture

SALT = "fixture-salt"


def header_batches(fx: Fixture) -> tuple[DataFrame, DataFrame]:
    """All headers, and a later batch: a third of them with changed status and no carrier, and as many new ones."""
    base = fx.orders_place.select("package_no", "order_key", "order_at", "status", "carrier", "city")
    late = base.where(F.col("order_key") % 3 == 0).withColumns({"status": F.lit("İade edildi"), "carrier": F.lit(None).cast("string")})
    fresh = base.where(F.col("order_key") % 3 == 1).withColumn("package_no", F.concat(F.lit("N"), "package_no"))
    return base.drop("order_key"), late.unionByName(fresh).drop("order_key")


def keep_last(fx: Fixture) -> DataFrame:
    """Two files; the second has every package twice, the right row last."""
    first, second = header_batches(fx)
    twice = second.withColumns({"status": F.lit("ara"), "row_no": F.lit(1)}).unionByName(second.withColumn("row_no", F.lit(2)))
    return ingest.union_keep_last([("agustos.xlsx", first), ("eylul.xlsx", twice)], KEYS["orders"]).drop("row_no")


def upserted(fx: Fixture) -> DataFrame:
    """A batch with every package twice, the right row marked."""
    first, second = header_batches(fx)
    twice = second.withColumns({"status": F.lit("ara"), "row_no": F.lit(1)}).unionByName(second.withColumn("row_no", F.lit(2)))
    return ingest.upsert(first, twice, KEYS["orders"], [F.desc("row_no")])


def tightened(fx: Fixture) -> DataFrame:
    lines = fx.table("lineitem")
    return ingest.tighten_integer_columns(lines.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("qty"), F.col("l_quantity").alias("unit_price"), F.col("l_discount").alias("share"),
        F.lit(None).cast("double").alias("unknown")))


def validation(fx: Fixture) -> DataFrame:
    numbers = raw.number_texts(fx).withColumnRenamed("text", "net")
    orders = raw.raw_orders(fx)
    empty = fx.store_daily.where(F.lit(False))
    return (
        ingest.validate_report(numbers, "prices", ["l_orderkey", "net"], ["l_orderkey"], {"net": locale_number(F.col("net"))})
        .unionByName(ingest.validate_report(orders, "orders", ["package_no", "barcode", "net"], ["package_no", "carrier"]))
        .unionByName(ingest.validate_report(fx.distribution, "distribution", ["month", "bucket", "no_such_column"], ["month"]))
        .unionByName(ingest.validate_report(empty, "store", ["day"], ["day"]))
    )


def exported_csv(fx: Fixture) -> DataFrame:
    """All ten tables as CSV and back: rows per table, and the sum of a measure; the sales with their reasons are compared in full by `export_csv_sales`."""
    tables = fixture_tables(fx)
    paths = sinks.export_csv(tables, scratch_path(fx.spark, "csv"))
    counted = []
    for name, path in paths.items():
        text = ", ".join(f"`{c}` string" for c in tables[name].columns)
        back = fx.spark.read.schema(text).option("header", "true").option("escape", '"').csv(path)
        counted.append(back.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(EXPORT_SUMS[name]).cast("decimal(30,7)")).alias("total")))
    return reduce(DataFrame.unionByName, counted)


EXPORT_SUMS = {"products": "current_price", "sales_monthly": "net_revenue", "orders": "cargo_fee", "order_lines": "net", "distribution": "orders", "ops_monthly": "value_scaled",
               "store_daily": "store_revenue", "ad_campaigns": "spent", "ad_totals": "spend", "uploads": "row_count"}


def fixture_tables(fx: Fixture) -> dict[str, DataFrame]:
    fx = WrittenFixture(fx.spark, fx.folder, fx.params)  # order lines are a table, and the distribution sums them
    return {
        "products": fx.products.select("barcode", "model_code", "name", "category", "current_price"),
        "sales_monthly": exported_facts(fx),
        "orders": fx.orders.drop("order_key"), "order_lines": fx.order_lines.drop("returned"), "distribution": fx.distribution,
        "ops_monthly": fx.ops.withColumn("value_scaled", F.round(F.col("value") * 1000).cast("bigint")), "store_daily": fx.store_daily,
        "ad_campaigns": fx.ad_campaigns, "ad_totals": fx.ad_totals, "uploads": raw.uploads(fx),
    }


def exported_facts(fx: Fixture) -> DataFrame:
    return fx.sales_monthly.select("month", "barcode", "net_sales_qty", F.col("net_revenue").cast("decimal(18,7)").alias("net_revenue"), "reasons")


def exported_sales(fx: Fixture) -> DataFrame:
    """The sales table as CSV and back, the reasons as JSON text."""
    path = sinks.export_csv({"sales_monthly": exported_facts(fx)}, scratch_path(fx.spark, "csv"))["sales_monthly"]
    back = fx.spark.read.schema("month string, barcode string, net_sales_qty bigint, net_revenue decimal(18,7), reasons string").option("header", "true").option("escape", '"').csv(path)
    return core.reasons_wide(back, REASON_CODES)


# results of the report that `export_results_whole` writes and reads again, by their registered names
EXPORTED = (
    "monthly_sales_kpis", "monthly_mix_shares", "ops_history", "category_summary", "category_month_matrix", "cancel_return_reasons", "stock_snapshot", "oos_summary", "sku_presence",
    "low_cover_list", "lost_revenue", "customers", "cohort_retention", "distribution_totals", "city_top", "weekday_profile", "day_of_month_profile", "daily_sales", "amount_bins", "net_histogram",
    "threshold_cliff", "multicolor", "fulfilment_summary", "carrier_scorecard", "returns_by_delivery_time", "ad_campaign_metrics", "ad_totals_kpis", "unattributed_spend", "store_averages", "store_funnel",
)


def exported_whole(fx: Fixture) -> DataFrame:
    """Thirty result blocks as JSON and back: every column of every block."""
    from bazaarlens.plans import queries_core, queries_metrics, queries_money
    from bazaarlens.plans.registry import portable

    known = {**queries_core.QUERIES, **queries_metrics.QUERIES, **queries_money.QUERIES}
    fx = WrittenFixture(fx.spark, fx.folder, fx.params)  # ten blocks read the packages, as many the sales
    results = {name: portable(known[name](fx)) for name in EXPORTED}
    folder = scratch_path(fx.spark, "json")
    sinks.export_results(results, folder)
    return digest(sinks.read_results(fx.spark, folder, {name: df.schema for name, df in results.items()}))


def exported_tables(fx: Fixture) -> DataFrame:
    """All ten tables as CSV and back: every column of every table, the reasons as their columns."""
    tables = fixture_tables(fx)
    paths = sinks.export_csv(tables, scratch_path(fx.spark, "csv"))
    back = {}
    for name, path in paths.items():
        schema = ", ".join(f"`{c}` {'string' if kind.startswith('map') else kind}" for c, kind in tables[name].dtypes)
        # an empty text is quoted, a null isn't: a null value that no cell holds tells them apart
        back[name] = portable_times(fx.spark.read.schema(schema).option("header", "true").option("escape", '"').option("nullValue", "\\N").option("emptyValue", "").csv(path))
    back["sales_monthly"] = core.reasons_wide(back["sales_monthly"], REASON_CODES)
    return digest(back)


def portable_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c, kind in df.dtypes if kind in ("date", "timestamp_ntz")})


def exported_results(fx: Fixture) -> DataFrame:
    result = kpis.monthly_sales_kpis(fx.sales).select("month", "gross_units", "net_units", F.col("net_rev").cast("double").alias("net_rev"), "ret_rate")
    folder = scratch_path(fx.spark, "json")
    paths = sinks.export_results({"monthly": result}, folder)
    return fx.spark.read.schema(result.schema).json(paths["monthly"])


def upserted_table(fx: Fixture) -> DataFrame:
    """The written form of the upsert: a month-partitioned table, a batch of changed and new rows."""
    table = fx.sales_monthly.select("month", "barcode", "net_sales_qty", "return_qty")
    path = scratch_path(fx.spark, "table")
    table.write.partitionBy("month").parquet(path)
    window = table.where(F.col("month").isin(*fx.params.months))
    batch = window.where(F.col("return_qty") > 0).withColumn("net_sales_qty", F.lit(0).cast("bigint"))
    batch = batch.unionByName(batch.withColumn("net_sales_qty", F.lit(-1).cast("bigint")))  # repeated keys: the greater row counts
    batch = batch.unionByName(window.select("month", F.concat(F.lit("N"), "barcode").alias("barcode"), "net_sales_qty", "return_qty"))
    ingest.upsert_table(path, batch, ["month", "barcode"], ["month"])
    return fx.spark.read.schema(batch.schema).parquet(path).select("month", "barcode", "net_sales_qty", "return_qty")


def landed(fx: Fixture, name: str) -> str:
    return scratch_path(fx.spark, f"landing-{name}")


def loaded_orders(fx: Fixture) -> DataFrame:
    """Order exports written from the test tables, a file per month, and loaded."""
    folder = landed(fx, "orders")
    raw.land(raw.order_export(fx), folder, None)
    orders = reports.load_reports(fx.spark, folder, SALT, "Pazar")["orders"]
    return orders.select("package_no", "carrier", "status", "city", "gross", "discount", "net", "commission", "cargo_fee")


def loaded_ops(fx: Fixture) -> DataFrame:
    """Two operations files with different months, loaded."""
    folder = landed(fx, "ops")
    for k, part in enumerate(raw.ops_export(fx)):
        raw.land(part, f"{folder}/{k}", ["Kalite Metriklerim"])
    return reports.load_reports(fx.spark, folder, None, "Pazar")["ops_monthly"].select("period", "metric", "value")


def loaded_distribution(fx: Fixture) -> DataFrame:
    """Distribution sheets with share columns and repeated rows, loaded."""
    folder = landed(fx, "distribution")
    for k, part in enumerate(raw.distribution_export(fx)):
        raw.land(part, f"{folder}/{k}", ["dimension", "row_no"])
    return reports.load_reports(fx.spark, folder, None, "Pazar")["distribution"].select("period", "dimension", "bucket", "bucket2", "orders", "customers")


SALES_COLUMNS = ("gross_order_qty", "cancel_qty", "return_qty", "net_sales_qty", "gross_revenue", "net_revenue", "commission")


def loaded_beside(fx: Fixture, header: list[str], rows: bool) -> DataFrame:
    """Sales exports, a file per month, and a newer file of each month that must not replace it: with a wrong header and a row, or without rows."""
    folder, export = landed(fx, "sales"), raw.sales_export(fx)
    raw.land(export, f"{folder}/1", ["Barkod"])
    # their names are those of the landed files: no second look at the rows
    names = catalog.landed_files(fx.spark, f"{folder}/1").select(F.regexp_extract("file_name", r"file=([^/]+)$", 1).alias("file"))
    newer = raw.header_files(names, header, "-yeni")
    lines = newer.unionByName(newer.withColumn("value", F.lit("b1" + ",7" * (len(header) - 1)))) if rows else newer
    lines.repartition("file").sortWithinPartitions("file", F.desc("value")).write.partitionBy("file").text(f"{folder}/2")
    root = scratch_path(fx.spark, "tables")
    reports.load_batch(fx.spark, folder, root, None, "Pazar")
    return tables_at_rest.read_tables(fx.spark, root)["sales_monthly"].select("period", "barcode", *SALES_COLUMNS)


def loaded_backwards(fx: Fixture) -> DataFrame:
    """The two operations files, the later one loaded first: its rows stay, whatever comes after."""
    folder, root = landed(fx, "ops"), scratch_path(fx.spark, "tables")
    for k, part in reversed(list(enumerate(raw.ops_export(fx)))):
        raw.land(part, f"{folder}/{k}", ["Kalite Metriklerim"])
        reports.load_batch(fx.spark, f"{folder}/{k}", root, None, "Pazar")
    return tables_at_rest.read_tables(fx.spark, root)["ops_monthly"].select("period", "metric", "value")


def moved_packages(fx: Fixture) -> DataFrame:
    """Packages at rest after their dates changed: a third moved by 40 days, a third lost theirs and got it back; with the lines found in the folder of their package."""
    heads = fx.orders_place.select("package_no", "order_key", "order_at", "status", "carrier", "city")
    lines, root = fx.order_lines.select("package_no", "barcode", "qty", "net"), scratch_path(fx.spark, "tables")
    third = lambda k: heads.where(F.col("order_key") % 3 == k)
    tables_at_rest.upsert_tables({"orders": heads, "order_lines": lines}, root, slots=2)
    moved = third(0).withColumn("order_at", F.col("order_at") + F.expr("INTERVAL 40 DAYS"))
    tables_at_rest.upsert_tables({"orders": moved.unionByName(third(1).withColumn("order_at", F.lit(None).cast("timestamp_ntz")))}, root, slots=2)
    tables_at_rest.upsert_tables({"orders": third(1)}, root, slots=2)
    found = tables_at_rest.read_tables(fx.spark, root, ("orders", "order_lines"))
    # no broadcast: a row per package on one side, of which Spark guesses a small part
    return found["orders"].hint("merge").join(found["order_lines"].select("package_no", "stored_month", "qty"), ["package_no", "stored_month"]).groupBy("package_no", "order_at", "stored_month").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("qty").alias("qty"))


def coverage_at_rest(fx: Fixture) -> DataFrame:
    """Coverage of the stored tables, from the list of their folders."""
    root, period = scratch_path(fx.spark, "tables"), F.to_date(F.concat("month", F.lit("-01"))).alias("period")
    tables_at_rest.upsert_tables({
        "sales_monthly": fx.sales_monthly.select(period, "barcode", "net_sales_qty"), "orders": fx.orders_lite.select("package_no", "order_at"), "store_daily": fx.store_daily,
        "distribution": fx.distribution.select(period, "dimension", "bucket", "bucket2", "orders", "customers"), "ops_monthly": fx.ops.select(period, "metric", "value"),
    }, root, slots=2)
    return coverage.covered(tables_at_rest.read_month_facts(fx.spark, root), TODAY)


QUERIES = {
    "report_file_catalog": lambda fx: raw.file_list(fx).select("file_name", "report_type", "period"),
    "parse_locale_numbers": lambda fx: raw.number_texts(fx).select(
        "l_orderkey", "l_linenumber", "text", locale_number(F.col("text")).alias("report_value"), locale_number(F.col("text"), "ads").alias("ads_value")),
    "parse_report_dates": lambda fx: raw.date_texts(fx).select(
        "package_no", report_timestamp(F.col("shipped_text")).alias("shipped_at"), report_day(F.col("day_text")).alias("day"),
        month_header(F.col("header_text")).alias("period")),
    "product_dimension_latest": lambda fx: ingest.product_dimension_latest(raw.raw_sales(fx), ["model_code", "name", "category", "current_price"]),
    "sales_monthly_fact": lambda fx: ingest.sales_monthly_fact(
        core.reasons_wide(fx.sales_monthly, REASON_CODES).withColumnRenamed("month", "period"),
        ["gross_order_qty", "cancel_qty", "return_qty", "net_sales_qty", "gross_revenue", "net_revenue", "commission"], REASON_CODES),
    "package_rollup_ingest": lambda fx: ingest.package_rollup_ingest(raw.raw_orders(fx)),
    "order_line_rollup": lambda fx: fx.order_lines.select(
        "package_no", "barcode", "qty", "unit_price", "gross", "discount", "net", "commission_rate"),
    "pseudonymise_customers": lambda fx: ingest.pseudonymise_customers(raw.raw_buyers(fx), SALT).select("package_no", F.col("İl").alias("city"), "customer_hash"),
    "distribution_long": lambda fx: ingest.distribution_long(raw.raw_sheets(fx)),
    "store_daily_normalise": lambda fx: ingest.store_daily_normalise(raw.raw_store(fx), raw.STORE_HEADERS).select("day", *raw.STORE_HEADERS.values()),
    "ops_unpivot": lambda fx: ingest.ops_unpivot(raw.raw_ops(fx)),
    "ad_campaigns_normalise": lambda fx: ingest.ad_campaigns_normalise(raw.raw_ads(fx), raw.AD_HEADERS),
    "union_keep_last": keep_last,
    "upsert": upserted,
    "upsert_table": upserted_table,
    "upload_manifest": lambda fx: catalog.upload_manifest(raw.file_rows(fx), F.lit("1998-08-17 10:00:00").cast("timestamp_ntz")),
    "export_csv": exported_csv,
    "export_csv_sales": exported_sales,
    "export_csv_whole": exported_tables,
    "export_results_whole": exported_whole,
    "load_orders": loaded_orders,
    "load_ops": loaded_ops,
    "load_distribution": loaded_distribution,
    "load_refused_newer": lambda fx: loaded_beside(fx, ["Barkod", "x"], True),
    "load_empty_newer": lambda fx: loaded_beside(fx, raw.sales_export(fx).drop("file").columns, False),
    "load_ops_backwards": loaded_backwards,
    "upsert_moved_orders": moved_packages,
    "coverage_at_rest": coverage_at_rest,
    "export_results": exported_results,
    "tighten_integer_columns": tightened,
    "replace_snapshot": lambda fx: catalog.active_files(raw.file_list(fx)).select("file_name", "report_type", "landed_at"),
    "validate_report": validation,
}
