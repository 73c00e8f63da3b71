"""Monthly key figures, grand totals and headline ratios."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.money import beside, ratio, total
from bazaarlens.functions.stats import lead_quantiles
from bazaarlens.operators import core
from bazaarlens.params import FIRST_ORDER

def rows() -> Column:
    return F.count(F.lit(1))


def monthly_sales_kpis(sales: DataFrame, by: tuple[str, ...] = ("month",)) -> DataFrame:
    """Units, revenue, discount, commission, barcodes sold, and cancel/return/commission rates."""
    sums = sales.groupBy(*by).agg(
        total("gross_sales_qty").alias("gross_units"),
        total("cancel_qty").alias("cancel"),
        total("return_qty").alias("ret"),
        total("net_sales_qty").alias("net_units"),
        total("gross_revenue").alias("gross_rev"),
        total("discount").alias("disc"),
        total("net_revenue").alias("net_rev"),
        total("commission").alias("comm"),
        F.count_if(F.col("gross_sales_qty") > 0).alias("skus_sold"),
    )
    return sums.withColumns({
        "cancel_rate": ratio(F.col("cancel"), F.col("gross_units"), 100.0),
        "ret_rate": ratio(F.col("ret"), F.col("gross_units"), 100.0),
        "comm_rate": ratio(F.col("comm"), F.col("net_rev"), 100.0),
    })


def repeat_order(nth: str = "customer_nth") -> Column:
    """True for anything but a customer's first order; an unknown order number counts as a repeat."""
    return F.coalesce(F.col(nth) != FIRST_ORDER, F.lit(True))


def monthly_order_kpis(packs: DataFrame, by: tuple[str, ...] = ("month",)) -> DataFrame:
    """Orders, packages, basket value and size, cargo, customers, lead-time medians and repeat share.

    Two passes: one aggregation for sums and distinct counts, and one that
    counts equal lead times, which shrink to a few rows before any shuffle.
    """
    packs = packs.where(F.col(by[0]).isNotNull()) if by else packs
    n = F.col("pkgs")
    sums = packs.groupBy(*by).agg(
        rows().alias("pkgs"), F.countDistinct("order_no").alias("orders"), F.countDistinct("customer").alias("customers"),
        total("net").alias("order_rev"), total("gross").alias("_gross"), total("units").alias("_units"),
        total("lines").alias("_lines"), total("cargo").alias("_cargo"),
        F.count_if(F.col("lines") > 1).alias("_multi"), F.count_if(repeat_order()).alias("_repeat"),
    )
    medians = lead_quantiles(packs, list(by), {"h_to_ship": ("s_to_ship", 0.5, 3600.0), "d_to_deliv": ("s_to_deliver", 0.5, 86400.0)})
    joined = sums.join(medians, list(by), "left") if by else sums.crossJoin(medians)
    return joined.select(
        *by, "orders", "pkgs", ratio(F.col("order_rev"), n).alias("aov"), ratio(F.col("_gross"), n).alias("aov_gross"),
        ratio(F.col("_units"), n).alias("upt"), ratio(F.col("_lines"), n).alias("lines_per"),
        ratio(F.col("_cargo"), n).alias("cargo_avg"), ratio(F.col("_cargo"), F.col("order_rev"), 100.0).alias("cargo_share"),
        "customers", ratio(F.col("_multi"), n, 100.0).alias("multi_item"),
        "h_to_ship", "d_to_deliv", ratio(F.col("_repeat"), n, 100.0).alias("repeat_share"), "order_rev",
    )


def monthly_mix_shares(dist: DataFrame, dims: dict[str, str]) -> DataFrame:
    """Share of new customers, Plus members, single-item and small orders, from the distribution report.

    `dims` names the dimensions: new, plus, qty, amount.
    """
    def part(dim: str, hit: Column | None = None) -> Column:
        cond = F.col("dimension") == dims[dim]
        return F.sum(F.when(cond if hit is None else cond & hit, F.col("orders")))

    bucket = F.col("bucket")
    rules = {
        "new_share": ("new", bucket.startswith("Yeni")),
        "plus_share": ("plus", bucket.contains("Plus")),
        "single_item_share": ("qty", bucket == "1"),
        "under250_share": ("amount", bucket.startswith("0 TRY")),
    }
    shares = [ratio(F.coalesce(part(d, hit), F.lit(0)), part(d), 100.0).alias(name) for name, (d, hit) in rules.items()]
    return dist.groupBy("month").agg(*shares, F.coalesce(part("new"), F.lit(0)).alias("dist_orders"))


def monthly_ops(ops: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """One column per wanted operational metric: {column: metric name}."""
    cols = [F.first(F.when(F.col("metric") == m, F.col("value")), ignorenulls=True).alias(c) for c, m in metrics.items()]
    return ops.groupBy("month").agg(*cols)


def monthly_table(*parts: DataFrame) -> DataFrame:
    """The monthly blocks side by side; the first one decides the months."""
    return reduce(lambda a, b: a.join(b, "month", "left"), parts)


def totals(sales: DataFrame, packs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Grand totals of sales and packages on one row, or per group of `by`."""
    s = sales.groupBy(*by).agg(
        total("gross_revenue").alias("gross_rev"), total("net_revenue").alias("net_rev"),
        total("gross_sales_qty").alias("gross_units"), total("net_sales_qty").alias("net_units"),
        total("return_qty").alias("ret"), total("cancel_qty").alias("cancel"), total("discount").alias("disc"),
        total("commission").alias("comm"),
    )
    skus = sales.select(*by, "barcode").distinct().groupBy(*by).agg(F.count("barcode").alias("skus"))
    models = sales.select(*by, "model_code").distinct().groupBy(*by).agg(F.count("model_code").alias("models"))
    return beside(beside(beside(s, package_totals(packs, by), by), skus, by), models, by)


def package_totals(packs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return packs.groupBy(*by).agg(
        rows().alias("pk"), total("units").alias("units_o"), total("net").alias("net_o"), total("cargo").alias("cargo_o"),
        total("commission").alias("comm_o"),
    ).withColumn("aov_all", ratio(F.col("net_o"), F.col("pk")))


def monthly_order_totals(packs: DataFrame, months: tuple[str, ...]) -> DataFrame:
    """Packages, net, cargo and commission of the given months."""
    return packs.where(F.col("month").isin(*months)).groupBy("month").agg(
        rows().alias("pkgs"), total("net").alias("net"), total("cargo").alias("cargo"), total("commission").alias("comm")
    )


def run_rate(sales: DataFrame, snapshot: str, elapsed_days: int, full_days: int = 30, by: tuple[str, ...] = ()) -> DataFrame:
    """Revenue of the partial snapshot month, scaled to a whole month."""
    part = sales.where(F.col("month") == snapshot).groupBy(*by).agg(total("net_revenue").alias("snapshot_rev"))
    return part.withColumn("run_rate", F.col("snapshot_rev").cast("double") / F.lit(float(elapsed_days)) * F.lit(float(full_days)))


def headline_kpis(sales: DataFrame, packs: DataFrame, ad_totals: DataFrame, params, by: tuple[str, ...] = (), window: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Basket, return, stock, cargo and advertising headline figures on one row, or per group of `by` (columns of all three tables)."""
    first, fifth = params.months[0], params.months[params.full_months - 1]
    in_month = lambda m: F.col("month") == m
    snap = in_month(params.snapshot)
    s = sales.groupBy(*by).agg(
        total("gross_sales_qty").alias("_g"), total("return_qty").alias("_r"), total("cancel_qty").alias("_c"),
        F.count_if(snap).alias("_skus"), F.count_if(snap & (F.col("stock") == 0)).alias("_oos"),
        *[total(F.when(in_month(m), F.col("net_revenue"))).alias(a) for m, a in ((params.snapshot, "_s"), (first, "_m1"), (fifth, "_m5"))],
    )
    p = packs.groupBy(*by).agg(
        rows().alias("_n"), total("net").alias("_net"), total("units").alias("_u"), total("cargo").alias("_cargo"),
        F.count_if(F.col("models") == 1).alias("_one"), F.count_if(F.col("net") < 200).alias("_low"),
    )
    a = core.ad_cover(ad_totals.where(F.col("source") == "panel"), window, by).groupBy(*by).agg(total("sales").alias("_as"), total("clicks").alias("_ac"))
    return beside(beside(s, p, by), a, by).select(
        *by, ratio(F.col("_net"), F.col("_n")).alias("aov"),
        ratio(F.col("_u"), F.col("_n")).alias("upt"),
        ratio(F.col("_r"), F.col("_g"), 100.0).alias("return_pct"),
        ratio(F.col("_c"), F.col("_g"), 100.0).alias("cancel_pct"),
        ratio(F.col("_oos"), F.col("_skus"), 100.0).alias("oos_pct"),
        ratio(F.col("_cargo"), F.col("_net"), 100.0).alias("cargo_share"),
        (F.lit(100.0) - ratio(F.col("_one"), F.col("_n"), 100.0)).alias("multi_model_pct"),
        ratio(F.col("_low"), F.col("_n"), 100.0).alias("under200_pct"),
        ratio(F.col("_as"), F.col("_ac"), 100.0).alias("ad_cvr"),
        (F.col("_s").cast("double") / F.lit(float(params.elapsed_days)) * F.lit(30.0)).alias("run_rate"),
        ((ratio(F.col("_m5"), F.col("_m1")) - F.lit(1.0)) * F.lit(100.0)).alias("growth_pct"),
    )
