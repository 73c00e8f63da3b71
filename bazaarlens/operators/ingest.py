"""From raw report rows to table rows: cleaning, roll-up, personal data, keys and upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.parsing import locale_number, month_header, report_day
from bazaarlens.operators.core import first_known, latest_by, line_commission
from bazaarlens.schemas import STORE_MEASURES
from bazaarlens.session import materialise

# --- fixed values: personal columns of the order export, and name endings that stay decimal ---
PII_COLUMNS = ("Alıcı", "Teslimat Adresi", "Fatura Adresi", "Alıcı - Fatura Adresi", "E-Posta", "Müşteri Telefon No",
               "Vergi Kimlik Numarası", "Vergi Dairesi", "Şirket İsmi", "Kargo Kodu", "Fatura No", "Teslimat Numarası")
DECIMAL_ENDINGS = ("price", "revenue", "discount", "gross", "net", "fee", "budget", "spent", "cpc", "roas", "rate", "commission",
                   "value", "desi", "spend")
# --- end of fixed values ---

ATTRIBUTES = ("order_no", "order_at", "shipped_at", "delivered_at", "carrier", "status", "city", "district", "customer",
              "customer_nth", "age_band", "gender")


def parse_numbers(raw: DataFrame, columns: list[str], flavor: str = "report") -> DataFrame:
    """The given text columns as doubles."""
    return raw.withColumns({c: locale_number(F.col(c), flavor) for c in columns})


def product_dimension_latest(raw_sales: DataFrame, columns: list[str]) -> DataFrame:
    """One row per barcode: the whole row of the latest period, a file without one being the latest; then of the last file, in it the last row."""
    last = [F.desc_nulls_first("period"), F.desc("file_name")] + ([F.desc("row_no")] if "row_no" in raw_sales.columns else [])
    return latest_by(raw_sales, ["barcode"], last).select("barcode", *columns)


def sales_monthly_fact(raw: DataFrame, measures: list[str], reasons: tuple[str, ...]) -> DataFrame:
    """Monthly fact with the reason columns packed into a JSON object of the non-zero ones."""
    packed = F.map_from_arrays(F.array(*[F.lit(r) for r in reasons]), F.array(*[F.col(f"`{r}`").cast("int") for r in reasons]))
    kept = F.map_filter(packed, lambda k, v: v.isNotNull() & (v != 0))
    return raw.select("period", "barcode", *measures, F.to_json(kept).alias("reasons"))


def pseudonymise_customers(raw: DataFrame, salt: str | None, name: str = "Alıcı", city: str = "İl", district: str = "İlçe",
                           pii: tuple[str, ...] = PII_COLUMNS) -> DataFrame:
    """Salted customer code in place of the personal columns."""
    if not salt:
        raise ValueError("a salt is needed to code customers")

    def part(c: str) -> Column:
        return F.lower(F.coalesce(F.col(f"`{c}`"), F.lit("")))

    plain = F.regexp_replace(F.regexp_replace(part(name), r"^\s+|\s+$", ""), r"\s+", " ")
    key = F.concat(plain, F.lit("|"), part(city), F.lit("|"), part(district))
    coded = raw.withColumn("customer_hash", F.substring(F.sha2(F.concat(F.lit(salt), key), 256), 1, 24))
    return coded.drop(*[c for c in {*pii, name} if c in raw.columns])


def package_rollup_ingest(raw: DataFrame, order: str = "row_no", attributes: tuple[str, ...] = ATTRIBUTES, distinct: bool = True,
                          keys: tuple[str, ...] = ("package_no",)) -> DataFrame:
    """Equal rows once (unless the caller saw to that), then one row per package: first known attribute in row order, sums of the amounts."""
    def added(col: str) -> Column:
        return F.coalesce(F.sum(col), F.lit(0)).cast("decimal(18,7)").alias(col)

    rows = raw.dropDuplicates() if distinct else raw
    commission = F.coalesce(F.sum(line_commission()), F.lit(0)).cast("decimal(18,9)").alias("commission")
    extra = [c for c in ("cargo_fee", "desi") if c in raw.columns]
    return rows.groupBy(*keys).agg(
        *[first_known(c, order) for c in (*attributes, *extra)], *[added(c) for c in ("gross", "discount", "ty_discount", "net")], commission)


def distribution_sheet(dimension: str | Column, sheet: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One sheet (bucket[, second bucket], orders, share, customers, share) as rows; the second bucket is there if it has six columns."""
    keep = keep or []
    own = [c for c in sheet.columns if c not in ("period", "dimension", *keep)]
    second = F.coalesce(F.col(f"`{own[1]}`").cast("string"), F.lit("")) if len(own) == 6 else F.lit("")
    return sheet.select(
        "period", (F.lit(dimension) if isinstance(dimension, str) else dimension).alias("dimension"), F.col(f"`{own[0]}`").cast("string").alias("bucket"),
        second.alias("bucket2"), F.col("orders").cast("bigint").alias("orders"), F.col("customers").cast("bigint").alias("customers"), *keep)


def distribution_long(sheets: dict[str, DataFrame], order: str = "row_no") -> DataFrame:
    """Sheets under one another, one row per key: of rows with one key the first of the file stays."""
    long = reduce(DataFrame.unionByName, [distribution_sheet(d, s, [order]) for d, s in sheets.items()])
    return latest_by(long, ["period", "dimension", "bucket", "bucket2"], [F.asc(order)]).drop(order)


def store_daily_normalise(raw: DataFrame, names: dict[str, str], day: str = "Tarih", keep: list[str] | None = None) -> DataFrame:
    """Store report with our column names: {report header: measure}; day and numbers parsed from text."""
    found = {m: h for h, m in names.items() if h in raw.columns}
    cols = [(locale_number(F.col(f"`{found[m]}`")) if m in found else F.lit(None).cast("double")).alias(m) for m in STORE_MEASURES]
    return raw.select(report_day(F.col(f"`{day}`")).alias("day"), *cols, *(keep or []))


def ops_unpivot(raw: DataFrame, metric: str = "Kalite Metriklerim", skip: int = 1, keep: list[str] | None = None) -> DataFrame:
    """Metric x month matrix to rows (period, metric, value); `skip` columns after the metric are ignored."""
    keep = keep or []
    months = [c for c in raw.columns if c != metric and c not in keep][skip:]
    texts = raw.select(F.col(f"`{metric}`").alias("metric"), *keep, *[F.col(f"`{c}`").cast("string").alias(c) for c in months])
    long = texts.unpivot(["metric", *keep], months, "header", "text")
    return long.select(month_header(F.col("header")).alias("period"), "metric", locale_number(F.col("text")).alias("value"), *keep)


AD_NUMBERS = ("total_budget", "daily_budget", "spent", "cpc", "clicks", "impressions", "direct_sales", "indirect_sales",
              "direct_revenue", "indirect_revenue", "roas")


def ad_campaigns_normalise(raw: DataFrame, names: dict[str, str], flavor: str = "report", keep: list[str] | None = None) -> DataFrame:
    """Campaign list with our column names: {report header: column}; numbers parsed, dates typed."""
    out = []
    for header, name in names.items():
        c = F.col(f"`{header}`") if header in raw.columns else F.lit(None).cast("string")
        if name in AD_NUMBERS:
            c = locale_number(c, flavor)
        elif name == "started_at":
            c = c.try_cast("timestamp_ntz")
        elif name == "product_count":
            c = c.try_cast("int")
        out.append(c.alias(name))
    return raw.select(*out, *(keep or []))


def union_keep_last(parts: list[tuple[str, DataFrame]], keys: list[str], order: list[str] | None = None, row: str = "row_no") -> DataFrame:
    """All files of a table under one another; on equal keys the last file wins (after `order`, if given), in it the last row."""
    tagged = [df.withColumn("_file", F.lit(name)) for name, df in parts]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    ranking = [F.desc(c) for c in (order or [])] + [F.desc("_file")] + ([F.desc(row)] if row in rows.columns else [])
    return latest_by(rows, keys, ranking).drop("_file")


def unique_by(batch: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key: the first in `order`, or else the greatest by its other columns."""
    others = [F.desc(f"`{c}`") for c in batch.columns if c not in keys]
    return latest_by(batch, keys, order or others or [F.lit(0)])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Target with the batch's rows inserted, or in place of the row with the same key, nulls included.

    Of batch rows with one key the first in `order` counts (`unique_by`).
    """
    single = unique_by(batch, keys, order)
    same = reduce(lambda a, b: a & b, [target[k].eqNullSafe(F.col(f"_new.{k}")) for k in keys])
    kept = target.join(single.select(*keys).alias("_new"), same, "left_anti")
    return kept.unionByName(single.select(*target.columns))


def upsert_table(path: str, batch: DataFrame, keys: list[str], partition_by: list[str], order: list[Column] | None = None) -> list[tuple]:
    """Upsert into a partitioned parquet table, reading and rewriting only the partitions the batch touches; returns those.

    Partition columns must be part of the key, so a row never changes
    partition. Their values in the batch (as many as folders it touches) are
    listed on the driver and filter the target's scan as literals. The merged
    partitions are written aside before the overwrite, which replaces one
    folder after the other: a failure between leaves some folders new and
    some old, and the same batch run again gives the whole result.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("partition columns must belong to the key")
    spark = batch.sparkSession
    batch = materialise(unique_by(batch, keys, order), "batch")
    parts = sorted(tuple(r) for r in batch.select(*partition_by).distinct().collect()) if partition_by else []
    try:
        target = spark.read.schema(batch.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        batch.write.partitionBy(*partition_by).parquet(path)
        return parts
    if partition_by:
        for k, column in enumerate(partition_by):
            target = target.where(F.col(column).isin(*sorted({p[k] for p in parts})))
        target = target.join(F.broadcast(spark.createDataFrame(parts, batch.select(*partition_by).schema)), partition_by, "left_semi") if parts else target.where(F.lit(False))
    merged = materialise(upsert(target, batch, keys), "merged")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return parts


def key_slot(keys: list[str], slots: int = 256) -> Column:
    """Stable partition number of a key, for tables whose key has no date."""
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def tighten_integer_columns(df: DataFrame, endings: tuple[str, ...] = DECIMAL_ENDINGS) -> DataFrame:
    """Floating columns that hold only whole numbers become integers, unless their name says money or rate.

    One aggregation row decides all columns; NaN is no value; columns without any value stay.
    """
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float") and not f.name.endswith(endings)]
    if not floats:
        return df
    def known(c: str) -> Column:
        return F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`"))

    whole = df.agg(*[F.bool_and((known(c) == F.round(known(c))) & (F.abs(known(c)) < 2.0**63)).alias(c) for c in floats]).first()
    return df.withColumns({c: known(c).cast("bigint") for c in floats if whole[c]})


def file_verdicts(rows: DataFrame, file: str, keys: list[str]) -> DataFrame:
    """(file, n_rows, null_keys) of each file that has rows: those without all of their key count in the latter, too."""
    bad_key = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys], F.lit(False))
    return rows.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad_key).alias("null_keys"))


def validate_report(batch: DataFrame, report: str, required: list[str], keys: list[str], typed: dict[str, Column] | None = None) -> DataFrame:
    """One verdict row: missing columns, rows, rows without key, values that did not parse, accepted or not.

    `typed` gives the parsed form of text columns; text that parses to null is a bad value.
    """
    missing = [c for c in required if c not in batch.columns]
    present = [k for k in keys if k in batch.columns]
    bad_key = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in present], F.lit(False))
    bad = [F.count_if(F.col(f"`{c}`").isNotNull() & (F.trim(f"`{c}`") != "") & (F.trim(f"`{c}`") != "-") & parsed.isNull())
           for c, parsed in (typed or {}).items() if c in batch.columns]
    checked = batch.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad_key).alias("null_keys"), reduce(lambda a, b: a + b, bad, F.lit(0)).cast("bigint").alias("bad_values"))
    accepted = (F.col("n_rows") > 0) & F.lit(not missing)
    return checked.select(F.lit(report).alias("report"), F.lit(",".join(missing)).alias("missing_columns"), "n_rows", "null_keys", "bad_values", accepted.alias("accepted"))
