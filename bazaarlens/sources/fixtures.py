"""The commerce tables, derived from the star-schema test tables (see FIXTURES.md).

Money is divided by 1000 and kept as exact decimals, so sums do not depend on
the order of rows. Every view is a lazy DataFrame over the parquet files.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from bazaarlens.functions.money import ratio
from bazaarlens.functions.timing import in_months, month_of, seconds_between
from bazaarlens.operators import core, products
from bazaarlens.params import FIRST_ORDER, Params
from bazaarlens.session import materialise

WINDOW = Params(
    months=("1997-04", "1997-05", "1997-06", "1997-07", "1997-08", "1997-09"),
    rising_min_revenue=150.0,
    mover_min_revenue=1000.0,
)
# fixed values: reason codes of the views, and labels of the distribution and operations reports
REASON_CODES = ("AF", "AO", "AP", "RF", "RO", "RP")
NAME_COLOURS = ("red", "blue", "green", "small", "large", "black", "white")  # leading words of the part names
NEW, EXISTING = "Yeni Müşteri", "Mevcut Müşteri"
DIM_AGE, DIM_GENDER, DIM_HOUR = "Yaş", "Cinsiyet", "Gün ve Saat"
DIM_AMOUNT, DIM_QTY, DIM_NEW, DIM_PLUS = "Tutar Bazlı", "Adet Bazlı", "Yeni & Mevcut Müşteri", "Plus"
OPS = {
    "units": "Satılan Ürün Adedi",
    "returns": "İade Oranı",
    "defects": "Kusurlu & Yanlış & Eksik İade Oranı",
    "ship_h": "Kargoya Teslim Süresi",
    "deliver_h": "Müşteriye Teslim Süresi",
    "on_time": "Kargoya Zamanında Teslim Oranı",
    "fast": "Hızlı Teslimatla Oluşan Gönderi Oranı",
}


# columns of the test tables that the views read; given, so no file is opened to infer them
COLUMNS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                "l_tax double, l_returnflag string",
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def hundredths(col: str) -> Column:
    """A non-negative amount with two decimals as a whole number of hundredths."""
    return (F.col(col) * 100 + 0.5).cast("bigint")


def scaled(units: Column, digits: int) -> Column:
    """Whole number of 10^-digits units as an exact decimal."""
    return (units.cast("decimal(18,0)") * F.lit("0." + "0" * (digits - 1) + "1").cast(f"decimal({digits},{digits})")).cast(f"decimal(18,{digits})")


def hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


class Fixture:
    """Views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str, params: Params = WINDOW):
        self.spark, self.folder, self.params = spark, folder, params
        self.shared = False  # whether several relations read the window's lines

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.cast("string").alias("barcode"),
            F.concat("p_brand", F.lit("/"), "p_type").alias("model_code"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.split("p_name", " ")[0].alias("color"),
            F.col("p_size").cast("string").alias("size"),
            (F.col("p_retailprice").cast("decimal(12,2)") * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(18,4)").alias("current_price"),
            F.when(key % 20 == 0, 0).otherwise(F.col("p_size") * 10).alias("current_stock"),
        )

    @cached_property
    def raw_lines(self) -> DataFrame:
        return self.line_rows(self.table("lineitem"))

    @staticmethod
    def line_rows(lines: DataFrame, *more: Column) -> DataFrame:
        """One row per line item. `row_no` orders the rows of a package: line number, then price, discount and tax."""
        cents, off, tax = hundredths("l_extendedprice"), hundredths("l_discount"), hundredths("l_tax")
        row_no = ((F.col("l_linenumber").cast("bigint") * 1_000_000_000 + cents) * 1000 + off) * 1000 + tax
        gross = scaled(cents, 5)
        return lines.select(
            F.col("l_orderkey").cast("string").alias("package_no"),
            F.col("l_partkey").cast("string").alias("barcode"),
            F.col("l_linenumber").alias("line_no"),
            row_no.alias("row_no"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            (cents / F.lit(100000.0) / F.col("l_quantity")).alias("unit_price"),
            gross.alias("gross"),
            scaled(cents * off, 7).alias("discount"),
            F.lit(0).cast("decimal(18,7)").alias("ty_discount"),
            scaled(cents * (100 - off), 7).alias("net"),
            tax.cast("decimal(6,2)").alias("commission_rate"),
            F.col("l_returnflag").alias("flag"),
            (F.col("l_returnflag") == "R").alias("returned"),
            *more,
        )

    @cached_property
    def first_orders(self) -> DataFrame:
        """package_no of each customer's first order (date, then key)."""
        first = F.min(F.struct("o_orderdate", "o_orderkey"))
        return (
            self.table("orders").groupBy("o_custkey").agg(first.alias("f"))
            .select(F.col("f.o_orderkey").alias("o_orderkey"), F.lit(True).alias("is_first"))
        )

    def orders_with(self, nth: bool, place: bool) -> DataFrame:
        """Package headers. The order label costs an aggregation by customer and the place two joins: only on demand."""
        orders = self.table("orders")
        if nth:
            orders = orders.join(self.first_orders, "o_orderkey", "left")
            label = F.when(F.col("is_first"), FIRST_ORDER).otherwise("2.Sipariş")
        else:
            label = F.lit(None).cast("string")
        return self.header_rows(self.placed(orders) if place else orders, label, place)

    def placed(self, orders: DataFrame) -> DataFrame:
        """Orders with the customer and nation of each."""
        return orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey")).join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))

    @staticmethod
    def header_rows(orders: DataFrame, label: Column, place: bool, *more: str) -> DataFrame:
        """Orders as package headers, with the place where they have one (`placed`)."""
        key = F.col("o_orderkey")
        shipped = F.when(key % 10 != 0, F.col("o_orderdate") + hours(key * 37 % 96))
        delivered = F.when(key % 13 != 0, shipped + hours(key * 53 % 160 + 12))
        about = {"city": "n_name", "district": "c_mktsegment", "buyer": "c_name", "age_band": "c_mktsegment"}
        return (
            orders.select(
                key.cast("string").alias("package_no"),
                key.alias("order_key"),
                F.concat(F.lit("S"), key.cast("string")).alias("order_no"),
                F.col("o_orderdate").alias("order_at"),
                shipped.alias("shipped_at"),
                delivered.alias("delivered_at"),
                F.col("o_orderpriority").alias("carrier"),
                F.col("o_orderstatus").alias("status"),
                *[(F.col(c) if place else F.lit(None).cast("string")).alias(name) for name, c in about.items()],
                F.col("o_custkey").cast("string").alias("customer"),
                label.alias("customer_nth"),
                F.when(F.col("o_custkey") % 3 == 0, "Kadın").when(F.col("o_custkey") % 3 == 1, "Erkek").alias("gender"),
                F.when(F.col("o_orderstatus") != "P", (key % 70 + 20).cast("decimal(10,2)")).alias("cargo_fee"),
                *more,
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.orders_with(nth=True, place=True)

    @cached_property
    def orders_place(self) -> DataFrame:
        return self.orders_with(nth=False, place=True)

    @cached_property
    def orders_lite(self) -> DataFrame:
        return self.orders_with(nth=False, place=False)

    @cached_property
    def order_lines(self) -> DataFrame:
        return core.order_line_rollup(self.raw_lines, extra=[F.max("returned").alias("returned")])

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with model and category."""
        return core.lines_with_product(self.order_lines, self.products)

    @cached_property
    def package_sums(self) -> DataFrame:
        return core.package_sums(self.order_lines, variety=False)

    def packages_from(self, headers: DataFrame, variety: bool = False) -> DataFrame:
        sums = core.package_sums(self.lines) if variety else self.package_sums
        return core.lead_times(core.impute_cargo(core.headed(sums, headers)))

    @cached_property
    def packages(self) -> DataFrame:
        """One row per package, with model and category counts."""
        return self.packages_from(self.orders_lite, variety=True)

    @cached_property
    def packages_lite(self) -> DataFrame:
        """Package roll-up without model and category counts: no product join."""
        return self.packages_from(self.orders_lite)

    @cached_property
    def packages_place(self) -> DataFrame:
        return self.packages_from(self.orders_place)

    @cached_property
    def packages_nth(self) -> DataFrame:
        return self.packages_from(self.orders_with(nth=True, place=False))

    def sold(self, months: tuple[str, ...] | None = None) -> DataFrame:
        """Lines with the status and month of their order. They meet as stored, before texts and decimals are made: these are wider to shuffle."""
        orders = self.table("orders")
        head = (orders.where(in_months("o_orderdate", months)) if months else orders).select("o_orderkey", "o_orderstatus", "o_orderdate")
        lines = self.window_rows if self.shared and months == self.params.months else self.table("lineitem")
        status, month = F.col("o_orderstatus").alias("status"), month_of(F.col("o_orderdate")).alias("month")
        return self.line_rows(lines.join(head, F.col("l_orderkey") == F.col("o_orderkey")), status, month)

    def sales_fact(self, months: tuple[str, ...] | None = None) -> DataFrame:
        """(month, barcode) sales fact without product attributes; reasons as a map of counts."""
        back = F.col("flag") == "R"
        cancelled = (F.col("flag") == "A") & (F.col("status") == "O")
        kept = ~back & ~cancelled
        code = F.concat("flag", "status")
        comm = (F.col("net") * F.col("commission_rate") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,9)")

        def money(c: Column, digits: int) -> Column:
            return F.sum(c).cast(f"decimal(38,{digits})")

        sums = [F.sum(F.when(code == c, F.col("qty"))).alias(f"r_{c}") for c in REASON_CODES]
        grouped = self.sold(months).groupBy("month", "barcode").agg(
            F.sum("qty").alias("gross_order_qty"),
            F.sum("qty").alias("gross_sales_qty"),
            F.coalesce(F.sum(F.when(cancelled, F.col("qty"))), F.lit(0)).alias("cancel_qty"),
            F.coalesce(F.sum(F.when(back, F.col("qty"))), F.lit(0)).alias("return_qty"),
            F.coalesce(F.sum(F.when(kept, F.col("qty"))), F.lit(0)).alias("net_sales_qty"),
            money(F.col("gross"), 5).alias("gross_revenue"),
            money(F.col("discount"), 7).alias("discount"),
            F.coalesce(money(F.when(kept, F.col("net")), 7), F.lit(0)).alias("net_revenue"),
            money(comm, 9).alias("commission"),
            *sums,
        )
        reasons = F.map_from_arrays(
            F.array(*[F.lit(c) for c in REASON_CODES]), F.array(*[F.coalesce(f"r_{c}", F.lit(0)) for c in REASON_CODES])
        )
        return grouped.select(
            *[c for c in grouped.columns if not c.startswith("r_")],
            ratio(F.col("commission"), F.col("net_revenue"), 100.0).alias("commission_rate"),
            ratio(F.col("net_revenue"), F.col("net_sales_qty")).alias("avg_price"),
            F.map_filter(reasons, lambda k, v: v != 0).alias("reasons"),
        )

    @cached_property
    def sales_monthly(self) -> DataFrame:
        return self.sales_fact()

    @cached_property
    def all_sales(self) -> DataFrame:
        """Sales fact of every month joined to products (the enriched sales relation)."""
        return core.sales_enriched(self.sales_monthly, self.products)

    @cached_property
    def sales(self) -> DataFrame:
        return core.sales_enriched(self.sales_fact(self.params.months), self.products)

    @cached_property
    def window_headers(self) -> DataFrame:
        return self.orders_lite.where(in_months("order_at", self.params.months))

    @property
    def window_rows(self) -> DataFrame:
        """Line items of the window's orders as stored; where several relations of a result read them, they are written once."""
        def chosen() -> DataFrame:
            keys = self.table("orders").where(in_months("o_orderdate", self.params.months)).select(F.col("o_orderkey").alias("l_orderkey"))
            return self.table("lineitem").join(keys, "l_orderkey", "left_semi")

        return self.written("window", chosen) if self.shared else chosen()

    @cached_property
    def window_order_lines(self) -> DataFrame:
        """Lines of the window's packages; the packages are chosen before lines are summed."""
        return core.order_line_rollup(self.line_rows(self.window_rows), extra=[F.max("returned").alias("returned")])

    @cached_property
    def window_lines(self) -> DataFrame:
        return core.lines_with_product(self.window_order_lines, self.products)

    @cached_property
    def window_packages_lite(self) -> DataFrame:
        return core.lead_times(core.impute_cargo(core.packages(self.window_order_lines, self.window_headers, variety=False)))

    @cached_property
    def window_packages_nth(self) -> DataFrame:
        headers = self.orders_with(nth=True, place=False).where(in_months("order_at", self.params.months))
        return core.lead_times(core.impute_cargo(core.packages(self.window_order_lines, headers, variety=False)))

    @cached_property
    def window_packages(self) -> DataFrame:
        return core.lead_times(core.impute_cargo(core.packages(self.window_lines, self.window_headers)))

    def written(self, name: str, build) -> DataFrame:
        """A relation that several branches of one result read, written once per result."""
        if name not in self._written:
            self._written[name] = materialise(build(), name)
        return self._written[name]

    @cached_property
    def _written(self) -> dict[str, DataFrame]:
        return {}

    @property
    def packs_table(self) -> DataFrame:
        """The window's packages as a written table."""
        self.shared = True
        return self.written("packs", lambda: self.window_packages_lite)

    @cached_property
    def sales_table(self) -> DataFrame:
        """The window's sales as a written table, as an ingested store would hold it; many results read it."""
        self.shared = True
        return materialise(self.sales, "sales")

    @cached_property
    def lines_table(self) -> DataFrame:
        self.shared = True
        return materialise(self.window_lines, "lines")

    @cached_property
    def model_facts(self) -> DataFrame:
        packs = core.impute_cargo(core.packages(self.lines_table, self.window_headers))
        return products.model_facts(self.sales_table, self.lines_table, packs, self.params, colours=NAME_COLOURS)

    @cached_property
    def models(self) -> DataFrame:
        return products.model_table(self.model_facts, self.params)

    @cached_property
    def ranking(self) -> DataFrame:
        return products.model_ranking(self.sales_table, self.params)

    @cached_property
    def distribution(self) -> DataFrame:
        pk = self.packages_from(self.orders).withColumn("_key", F.substring("order_no", 2, 20).cast("bigint"))
        band = F.floor(F.col("_key") % 24 / 3).cast("int")
        step = F.floor(F.col("net") / 250).cast("bigint")

        def dim(name: str, bucket: Column, bucket2: Column | None = None) -> Column:
            return F.struct(F.lit(name).alias("dimension"), bucket.cast("string").alias("bucket"),
                            (F.lit("") if bucket2 is None else bucket2).alias("bucket2"))

        dims = F.array(
            dim(DIM_AGE, F.col("age_band")),
            dim(DIM_GENDER, F.coalesce("gender", F.lit("Belirtilmemiş"))),
            dim(DIM_HOUR, F.weekday("order_at"), F.concat(band * 3, F.lit("-"), band * 3 + 3)),
            dim(DIM_QTY, F.col("lines")),
            dim(DIM_AMOUNT, F.concat(step * 250, F.lit(" TRY - "), (step + 1) * 250, F.lit(" TRY"))),
            dim(DIM_NEW, F.when(F.col("customer_nth") == FIRST_ORDER, NEW).otherwise(EXISTING)),
            dim(DIM_PLUS, F.when(F.col("carrier").isin("1-URGENT", "2-HIGH"), "Plus").otherwise("Standart")),
        )
        return (
            pk.select("month", "customer", F.explode(dims).alias("d"))
            .groupBy("month", "d.dimension", "d.bucket", "d.bucket2")
            .agg(F.count(F.lit(1)).alias("orders"), F.countDistinct("customer").alias("customers"))
        )

    @cached_property
    def ops(self) -> DataFrame:
        """(month, metric, value) operational metrics."""
        flags = self.sold().groupBy("month").agg(
            F.sum("qty").alias("units"),
            F.coalesce(F.sum(F.when(F.col("flag") == "R", F.col("qty"))), F.lit(0)).alias("back"),
            F.coalesce(F.sum(F.when((F.col("flag") == "R") & (F.col("status") == "F"), F.col("qty"))), F.lit(0)).alias("bad"),
        )
        to_ship = seconds_between(F.col("order_at"), F.col("shipped_at"))
        to_deliver = seconds_between(F.col("shipped_at"), F.col("delivered_at"))
        times = (
            self.orders_lite.select(month_of(F.col("order_at")).alias("month"), to_ship.alias("s"), to_deliver.alias("d"))
            .groupBy("month").agg(
                ratio(F.sum("s"), F.count("s") * 3600).alias("ship_h"),
                ratio(F.sum("d"), F.count("d") * 3600).alias("deliver_h"),
                ratio(F.count_if(F.col("s") <= 48 * 3600), F.count("s"), 100.0).alias("on_time"),
                ratio(F.count_if(F.col("d") <= 48 * 3600), F.count("d"), 100.0).alias("fast"),
            )
        )
        wide = flags.join(times, "month").select(
            "month", F.col("units").cast("double").alias("units"),
            ratio(F.col("back"), F.col("units"), 100.0).alias("returns"),
            ratio(F.col("bad"), F.col("units"), 100.0).alias("defects"),
            "ship_h", "deliver_h", "on_time", "fast",
        )
        rows = F.array(*[F.struct(F.lit(label).alias("metric"), F.col(c).alias("value")) for c, label in OPS.items()])
        return wide.select("month", F.explode(rows).alias("r")).select("month", "r.metric", "r.value")

    @cached_property
    def event_facts(self) -> DataFrame:
        return self.table("events").select(
            F.to_date("ts").alias("day"), "user_id", "event_type", F.col("value").cast("decimal(12,2)").alias("value"), "ts"
        )

    @cached_property
    def store_daily(self) -> DataFrame:
        kind, value, user = F.col("event_type"), F.col("value"), F.col("user_id")
        bought, wanted = kind == "purchase", kind.isin("purchase", "click")
        # one row per (day, user): the distinct counts below need no second expansion
        per_user = self.event_facts.groupBy("day", "user_id").agg(
            F.count_if(kind == "view").alias("v"), F.count_if(kind == "signup").alias("s"), F.count_if(kind == "error").alias("e"),
            F.count_if(bought).alias("b"), F.count_if(wanted).alias("w"),
            F.sum(F.when(bought, value)).alias("bv"), F.sum(F.when(wanted, value)).alias("wv"),
        )
        day = per_user.groupBy("day").agg(
            F.sum("v").alias("store_views"), F.sum("s").alias("followers_gained"), F.sum("e").alias("followers_lost"),
            F.count("user_id").alias("visitors"), F.count_if(F.col("s") > 0).alias("new_visitors"),
            F.sum("b").alias("store_orders"), F.sum("w").alias("total_orders"),
            F.coalesce(F.sum("bv"), F.lit(0)).alias("store_revenue"), F.coalesce(F.sum("wv"), F.lit(0)).alias("total_revenue"),
            F.count_if(F.col("b") > 0).alias("store_customers"), F.count_if(F.col("w") > 0).alias("total_customers"),
        )
        out = {
            "followers_total": (F.col("followers_gained") - F.col("followers_lost")),
            "follow_rate": ratio(F.col("followers_gained"), F.col("visitors"), 100.0),
            "customer_rate": ratio(F.col("store_orders"), F.col("visitors"), 100.0),
            "store_units": F.col("store_orders"),
            "total_units": F.col("total_orders"),
            "store_conversion": ratio(F.col("store_orders"), F.col("store_views"), 100.0),
        }
        return day.withColumns(out)

    @cached_property
    def ad_campaigns(self) -> DataFrame:
        kind, value = F.col("event_type"), F.col("value")
        slot = F.col("user_id") % 12
        agg = self.event_facts.groupBy(slot.alias("slot")).agg(
            F.count_if(kind == "view").alias("impressions"), F.count_if(kind == "click").alias("clicks"),
            F.count_if(kind == "purchase").alias("direct_sales"), F.count_if(kind == "signup").alias("indirect_sales"),
            F.sum(F.when(kind == "purchase", value)).alias("direct_revenue"),
            F.sum(F.when(kind == "signup", value)).alias("indirect_revenue"),
            F.min("day").alias("started_on"),
        )
        spent = (F.col("clicks") * F.lit("0.8").cast("decimal(2,1)")).cast("decimal(18,4)")
        return agg.select(
            F.concat(F.lit("Kampanya "), F.col("slot")).alias("name"),
            F.when(F.col("slot") % 3 == 0, "Yayında").otherwise("Durduruldu").alias("status"),
            "started_on", F.col("clicks").cast("decimal(18,4)").alias("total_budget"), spent.alias("spent"),
            "clicks", "impressions", "direct_sales", "indirect_sales", "direct_revenue", "indirect_revenue",
        )

    @cached_property
    def ad_periods(self) -> DataFrame:
        """Panel and meta rows of each week, and two that overlap them: one of the first three weeks, as much again, and one of three days in the fifth."""
        kind, week = F.col("event_type"), F.trunc("day", "week")
        weeks = self.event_facts.groupBy(week.alias("period_from"), F.when(kind == "error", "meta").otherwise("panel").alias("source")).agg(
            F.date_add(F.trunc(F.max("day"), "week"), 6).alias("period_to"), F.count_if(kind.isin("view", "error")).alias("impressions"), F.count_if(kind == "click").alias("clicks"),
            F.count_if(kind == "purchase").alias("sales"), F.sum(F.when(kind == "purchase", F.col("value"))).cast("decimal(18,4)").alias("revenue"),
            (F.count(F.lit(1)) * F.lit("0.25").cast("decimal(3,2)")).cast("decimal(18,4)").alias("spend"), F.lit(None).cast("double").alias("roas"))
        place = F.row_number().over(Window.partitionBy("source").orderBy("period_from"))
        placed = weeks.withColumn("n", place)
        measures = ("impressions", "clicks", "sales", "revenue", "spend")
        quarter = placed.where("n <= 3").groupBy("source").agg(F.min("period_from").alias("period_from"), F.max("period_to").alias("period_to"), *[(F.sum(c) * 2).alias(c) for c in measures], F.max("roas").alias("roas"))
        few = placed.where("n = 5").withColumns({"period_from": F.date_add("period_from", 3), "period_to": F.date_add("period_from", 5)})
        return weeks.unionByName(quarter).unionByName(few.drop("n"))

    @cached_property
    def ad_totals(self) -> DataFrame:
        """A panel row over all campaigns (10 % more spend than they report) and a meta row."""
        kind, value = F.col("event_type"), F.col("value")
        rows = self.event_facts.groupBy().agg(
            F.count_if(kind == "view").alias("impressions"), F.count_if(kind == "click").alias("clicks"),
            F.count_if(kind.isin("purchase", "signup")).alias("sales"),
            F.sum(F.when(kind.isin("purchase", "signup"), value)).alias("revenue"),
            F.count_if(kind == "error").alias("errors"),
            F.sum(F.when(kind == "error", value)).alias("error_value"),
        )
        money = "decimal(18,4)"
        panel = F.struct(
            F.lit("panel").alias("source"), F.col("impressions"), F.col("clicks"), F.col("sales"),
            F.col("revenue").cast(money).alias("revenue"), (F.col("clicks") * F.lit("0.88").cast("decimal(3,2)")).cast(money).alias("spend"),
        )
        meta = F.struct(
            F.lit("meta").alias("source"), F.col("errors").alias("impressions"), F.floor(F.col("errors") / 10).alias("clicks"),
            F.floor(F.col("errors") / 100).alias("sales"), F.col("error_value").cast(money).alias("revenue"),
            (F.col("errors") * F.lit("0.01").cast("decimal(2,2)")).cast(money).alias("spend"),
        )
        out = rows.select(F.explode(F.array(panel, meta)).alias("r")).select("r.*")
        return out.withColumn("roas", ratio(F.col("revenue"), F.col("spend")))


class WrittenFixture(Fixture):
    """The same views, those that many results read written once: for runs that make many results."""

    @cached_property
    def sales(self) -> DataFrame:
        self.shared = True
        lazy = super().sales
        return self.written("sales", lambda: lazy)

    @cached_property
    def order_lines(self) -> DataFrame:
        lazy = super().order_lines
        return self.written("order_lines", lambda: lazy)

    @cached_property
    def package_sums(self) -> DataFrame:
        lazy = super().package_sums
        return self.written("package_sums", lambda: lazy)

    @cached_property
    def packages_lite(self) -> DataFrame:
        lazy = super().packages_lite
        return self.written("packages", lambda: lazy)

    @cached_property
    def distribution(self) -> DataFrame:
        lazy = super().distribution
        return self.written("distribution", lambda: lazy)

    @cached_property
    def ops(self) -> DataFrame:
        lazy = super().ops
        return self.written("ops", lambda: lazy)

    @cached_property
    def store_daily(self) -> DataFrame:
        lazy = super().store_daily
        return self.written("store_daily", lambda: lazy)
