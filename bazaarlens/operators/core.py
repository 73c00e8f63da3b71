"""Core relations: enriched sales (S), category months (K), enriched lines (O), packages (P)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bazaarlens.functions.money import cargo_tier, ratio
from bazaarlens.functions.timing import in_months, month_of, seconds_between
from bazaarlens.params import CARGO_TIERS, OTHER_CATEGORY

SALES_MEASURES = ["gross_sales_qty", "cancel_qty", "return_qty", "net_sales_qty", "gross_revenue", "discount",
                  "net_revenue", "commission"]


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The whole row that sorts first per key. Spark prunes each key's rows before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


# ---------------------------------------------------------------- sales

def sales_enriched(sales_monthly: DataFrame, products: DataFrame) -> DataFrame:
    """Sales fact joined to the product dimension. The join side is chosen by size statistics, not by hint."""
    wanted = [c for c in ("barcode", "name", "model_code", "category", "color", "current_price", "current_stock") if c in products.columns]
    out = sales_monthly.join(products.select(*wanted), "barcode")
    if "stock" not in out.columns:
        out = out.withColumnRenamed("current_stock", "stock")
    return out


def reasons_wide(sales: DataFrame, reasons: tuple[str, ...], column: str = "reasons") -> DataFrame:
    """One numeric column per reason, 0 where the map (or its JSON text) has no entry."""
    if dict(sales.dtypes)[column] == "string":
        sales = sales.withColumn(column, F.from_json(column, "map<string,int>"))
    cols = {r: F.coalesce(F.try_element_at(F.col(column), F.lit(r)), F.lit(0)).cast("double") for r in reasons}
    return sales.withColumns(cols).drop(column)


def category_month(sales: DataFrame) -> DataFrame:
    """Eight measures summed by category and month."""
    return (
        sales.where(F.col("category").isNotNull()).groupBy("category", "month")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SALES_MEASURES])
    )


def barcode_master(sales: DataFrame, columns: tuple[str, ...] = ("model_code", "category")) -> DataFrame:
    """Per barcode the last non-null value of each column, by month."""
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("month"))).alias(c) for c in columns]
    return sales.groupBy("barcode").agg(*last)


# ---------------------------------------------------------------- lines

def first_known(col: str, order: str = "row_no") -> Column:
    """Value of the first row, in report order, that has one."""
    return F.min_by(col, F.when(F.col(col).isNotNull(), F.col(order))).alias(col)


def order_line_rollup(raw: DataFrame, order: str = "row_no", extra: list[Column] | None = None,
                      keys: tuple[str, ...] = ("package_no", "barcode")) -> DataFrame:
    """Sums per (package, barcode); unit price and commission rate of the first line that has one.

    `order` is the row's place in its report, a single number, so that the
    aggregation stays a hash aggregation.
    """
    return raw.groupBy(*keys).agg(
        F.coalesce(F.sum("qty"), F.lit(0)).alias("qty"),
        first_known("unit_price", order),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(18,7)").alias(c) for c in ("gross", "discount", "ty_discount", "net")],
        first_known("commission_rate", order),
        *(extra or []),
    )


def line_commission(net: str = "net", rate: str = "commission_rate") -> Column:
    return (F.col(net) * F.col(rate) * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,9)")


def lines_with_product(lines: DataFrame, master: DataFrame) -> DataFrame:
    """Model and category per line (barcode and a fixed category where the barcode is unknown), and commission."""
    known = master.select("barcode", F.col("model_code").alias("_m"), F.col("category").alias("_c"))
    return (
        lines.join(known, "barcode", "left")
        .withColumn("model", F.coalesce("_m", "barcode"))
        .withColumn("category", F.coalesce("_c", F.lit(OTHER_CATEGORY)))
        .withColumn("commission", line_commission())
        .drop("_m", "_c")
    )


def order_lines_enriched(lines: DataFrame, orders: DataFrame, months: tuple[str, ...] | None = None) -> DataFrame:
    """Lines joined to their package header, with the order month; only known months are kept."""
    known = orders.where(in_months("order_at", months)) if months else orders.where(F.col("order_at").isNotNull())
    return lines.join(known, "package_no").withColumn("month", month_of(F.col("order_at")))


# ---------------------------------------------------------------- packages

HEADER = ["package_no", "order_no", "order_at", "shipped_at", "delivered_at", "carrier", "city", "district", "customer",
          "customer_nth", "age_band", "gender", "cargo_fee"]


def packages(lines: DataFrame, orders: DataFrame, variety: bool = True) -> DataFrame:
    """One row per package: line sums joined to the header.

    Lines are summed before the join, which therefore meets one row per
    package even if a single package holds a large part of all lines.
    """
    return headed(package_sums(lines, variety), orders)


def package_sums(lines: DataFrame, variety: bool = True) -> DataFrame:
    """Sums of the lines of each package. Lines are unique on (package, barcode), so counting them counts barcodes."""
    commission = F.col("commission") if "commission" in lines.columns else line_commission()
    sums = [
        F.sum("gross").cast("decimal(18,7)").alias("gross"),
        F.sum("net").cast("decimal(18,7)").alias("net"),
        F.sum("discount").cast("decimal(18,7)").alias("disc"),
        F.sum("ty_discount").cast("decimal(18,7)").alias("tydisc"),
        F.sum("qty").alias("units"),
        F.count("barcode").alias("lines"),
        F.sum(commission).cast("decimal(18,9)").alias("commission"),
        F.max("returned").alias("returned"),
    ]
    if variety:
        # sets, not distinct counts: lines are read once, and a set is at most the models or categories there are
        sums += [F.size(F.collect_set("model")).cast("bigint").alias("models"), F.size(F.collect_set("category")).cast("bigint").alias("cats")]
    return lines.groupBy("package_no").agg(*sums)


def headed(sums: DataFrame, orders: DataFrame) -> DataFrame:
    """Line sums joined to the package header, with the order month."""
    header = orders.select(*[c for c in HEADER if c in orders.columns])
    return header.join(sums, "package_no").withColumn("month", month_of(F.col("order_at")))


def impute_cargo(packs: DataFrame, tiers=CARGO_TIERS) -> DataFrame:
    """Known cargo fee, else the tier of the package value."""
    return packs.withColumns({
        "cargo_known": F.col("cargo_fee").isNotNull(),
        "cargo": F.coalesce("cargo_fee", cargo_tier(F.col("net"), tiers)),
    })


def lead_times(packs: DataFrame) -> DataFrame:
    """Seconds to ship, from shipping to delivery, and in total, with the derived hours and days."""
    spans = {
        "s_to_ship": seconds_between(F.col("order_at"), F.col("shipped_at")),
        "s_to_deliver": seconds_between(F.col("shipped_at"), F.col("delivered_at")),
        "s_total": seconds_between(F.col("order_at"), F.col("delivered_at")),
    }
    return packs.withColumns(spans).withColumns({
        "h_to_ship": F.col("s_to_ship") / F.lit(3600.0),
        "d_to_deliv": F.col("s_to_deliver") / F.lit(86400.0),
        "d_total": F.col("s_total") / F.lit(86400.0),
    })


# ---------------------------------------------------------------- small relations

def distribution_shares(dist: DataFrame) -> DataFrame:
    """Share of orders and of customers in each (month, dimension); the denominator is at least 1.

    Denominators come from an aggregation joined back, so a dimension with
    very many buckets is not gathered into one window.
    """
    sums = dist.groupBy("month", "dimension").agg(
        F.greatest(F.sum("orders"), F.lit(1)).alias("_o"), F.greatest(F.sum("customers"), F.lit(1)).alias("_c")
    )
    return dist.join(sums, ["month", "dimension"]).select(
        "month", "dimension", "bucket", "bucket2", "orders", "customers",
        ratio(F.col("orders"), F.col("_o"), 100.0).alias("order_share"),
        ratio(F.col("customers"), F.col("_c"), 100.0).alias("customer_share"),
    )


def ops_pivot(ops: DataFrame, months: tuple[str, ...] | None = None, newest_first: bool = True) -> DataFrame:
    """metric x month matrix of all months, found by one distinct, or of the months given."""
    if months is None:
        months = tuple(r[0] for r in ops.select("month").where("month is not null").distinct().collect())  # a row per month
    ordered = sorted(months, reverse=newest_first)
    if not ordered:
        return ops.select("metric").distinct()
    return ops.groupBy("metric").pivot("month", ordered).agg(F.first("value", ignorenulls=True))


def store_daily_ratios(store: DataFrame) -> DataFrame:
    """Share of revenue, orders and customers that the store page brought, per day (%)."""
    return store.withColumns({
        "store_revenue_share": ratio(F.col("store_revenue"), F.col("total_revenue"), 100.0),
        "store_order_share": ratio(F.col("store_orders"), F.col("total_orders"), 100.0),
        "store_customer_share": ratio(F.col("store_customers"), F.col("total_customers"), 100.0),
    })


def ad_campaigns_derived(ads: DataFrame) -> DataFrame:
    """Remaining budget, and direct + indirect sales and revenue with nulls as 0."""
    def plus(a: str, b: str) -> Column:
        return F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0))

    return ads.withColumns({
        "remaining_budget": F.col("total_budget") - F.col("spent"),
        "total_sales": plus("direct_sales", "indirect_sales"),
        "total_ad_revenue": plus("direct_revenue", "indirect_revenue"),
    })


def ad_cover(totals: DataFrame, window: tuple[dt.date, dt.date] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per source (and `by`): the sums of its periods, no day counted twice.

    The panel gives sums of whole periods, which may overlap (to August, to September) or adjoin. Of all sets of periods that
    don't overlap the one that covers most days counts, of those the one of fewest periods, then the latest. Periods
    outside the window of the sales, and rows without any date, are left out. A source has few periods: one row per pair of
    days and group. `roas` is the panel's own for a single period, else that of the sums. Totals without
    period columns are of one period.
    """
    measures = [c for c in AD_MEASURES if c in totals.columns]
    if not {"period_from", "period_to"} <= set(totals.columns):
        return _ad_sums(totals, measures, by)
    first, last = F.coalesce("period_from", "period_to"), F.coalesce("period_to", "period_from")
    dated = totals.withColumns({"_f": F.least(first, last), "_t": F.greatest(first, last)}).where(F.col("_f").isNotNull())
    if window:
        dated = dated.where((F.col("_t") >= F.lit(window[0])) & (F.col("_f") <= F.lit(window[1])))
    period = F.struct("_t", "_f", *measures)
    listed = dated.groupBy(*by, "source").agg(F.array_sort(F.collect_list(period)).alias("_all"))
    kind = listed.schema["_all"].dataType.simpleString()
    none = F.array().cast(f"array<struct<days:int,few:int,t:date,kept:{kind}>>")

    def chained(chains: Column, p: Column) -> Column:
        """The best set that ends with `p`, after those that end with earlier periods."""
        before = F.array_max(F.filter(chains, lambda c: c["t"] < p["_f"]))
        days = F.coalesce(before["days"], F.lit(0)) + F.datediff(p["_t"], p["_f"]) + 1
        kept = F.concat(F.coalesce(before["kept"], F.array().cast(kind)), F.array(p))
        return F.concat(chains, F.array(F.struct(days.alias("days"), (F.coalesce(before["few"], F.lit(0)) - 1).alias("few"), p["_t"].alias("t"), kept.alias("kept"))))

    best = listed.select(*by, "source", F.array_max(F.aggregate("_all", none, chained))["kept"].alias("_kept"))
    return _ad_sums(best.select(*by, "source", F.explode("_kept").alias("_p")).select(*by, "source", *[F.col(f"_p.{c}").alias(c) for c in measures]), measures, by)


AD_MEASURES = ("impressions", "clicks", "sales", "revenue", "spend", "roas")


def _ad_sums(rows: DataFrame, measures: list[str], by: tuple[str, ...]) -> DataFrame:
    sums = rows.groupBy(*by, "source").agg(F.count(F.lit(1)).alias("_n"), F.max("roas").alias("_roas"), *[F.sum(c).alias(c) for c in measures if c != "roas"])
    own = F.when(F.col("_n") == 1, F.col("_roas").cast("double")).otherwise(ratio(F.col("revenue"), F.col("spend")))
    return sums.withColumn("roas", own).drop("_n", "_roas")


def ad_totals_by_source(totals: DataFrame, window: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Panel figures and, where present, the meta figures on one row (`ad_cover`)."""
    def pick(source: str, col: str) -> Column:
        return F.max(F.when(F.col("source") == source, F.col(col))).alias(f"{source}_{col}")

    return ad_cover(totals, window).agg(*[pick(s, c) for s in ("panel", "meta") for c in AD_MEASURES])
