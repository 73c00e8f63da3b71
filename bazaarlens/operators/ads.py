"""Advertising and store-page results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from bazaarlens.functions.money import beside, ratio
from bazaarlens.functions.parsing import locale_number
from bazaarlens.operators.core import ad_cover


def ad_campaign_metrics(campaigns: DataFrame) -> DataFrame:
    """Campaigns with spend: cost per click, click rate, direct and total return on spend."""
    return campaigns.where(F.col("spent") > 0).withColumns({
        "cpc": ratio(F.col("spent"), F.col("clicks")), "ctr": ratio(F.col("clicks"), F.col("impressions"), 100.0),
        "direct_roas": ratio(F.col("direct_revenue"), F.col("spent")), "total_roas": ratio(F.col("total_ad_revenue"), F.col("spent")),
    })


def sales_totals(sales: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return sales.groupBy(*by).agg(F.sum("net_revenue").alias("net_rev"), F.sum("gross_sales_qty").alias("gross_units"))


def ad_totals_kpis(totals: DataFrame, sales: DataFrame, months: float = 5.75, by: tuple[str, ...] = (), window: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Return on spend, cost shares, click figures and monthly spend of the panel, its periods as one."""
    panel = ad_cover(totals.where(F.col("source") == "panel"), window, by).select(*by, "impressions", "clicks", "sales", "revenue", "spend", "roas")
    spend = F.col("spend")
    return beside(panel, sales_totals(sales, by), by).select(
        *by, "roas", ratio(spend, F.col("revenue"), 100.0).alias("acos"), ratio(spend, F.col("net_rev"), 100.0).alias("tacos"),
        ratio(spend, F.col("clicks")).alias("cpc"), ratio(F.col("clicks"), F.col("impressions"), 100.0).alias("ctr"),
        ratio(F.col("sales"), F.col("clicks"), 100.0).alias("cvr"), ratio(F.col("sales"), F.col("gross_units"), 100.0).alias("unit_share"),
        (spend.cast("double") / F.lit(months)).alias("monthly_spend"))


def unattributed_spend(totals: DataFrame, campaigns: DataFrame, window: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Panel spend that neither the product campaigns nor the meta row explain."""
    by_source = ad_cover(totals, window).agg(*[F.sum(F.when(F.col("source") == s, F.col("spend"))).alias(s) for s in ("panel", "meta")])
    product = campaigns.where(F.col("spent") > 0).agg(F.coalesce(F.sum("spent"), F.lit(0)).alias("product_spend"))
    return by_source.crossJoin(product).select(
        F.col("panel").alias("panel_spend"), "product_spend", F.coalesce("meta", F.lit(0)).alias("meta_spend"),
        (F.col("panel") - F.col("product_spend") - F.coalesce("meta", F.lit(0))).alias("other_spend"))


def store_averages(store: DataFrame, measures: list[str]) -> DataFrame:
    """Mean of each daily measure; measures may be text such as '+ 47'. Unknown values are left out."""
    kinds = dict(store.dtypes)
    value = {m: locale_number(F.col(m)) if kinds[m] == "string" else F.col(m) for m in measures}
    return store.agg(*[F.round(ratio(F.sum(v), F.count(v)), 9).alias(m) for m, v in value.items()])


def store_funnel(averages: DataFrame) -> DataFrame:
    """Daily visitors, a third of the views, visitors that follow, visitors that buy."""
    rate = lambda c: F.col("visitors") * F.col(c) / F.lit(100.0)
    stages = [("visitors", F.col("visitors")), ("views / 3", F.col("store_views") / F.lit(3.0)),
              ("followers", rate("follow_rate")), ("customers", rate("customer_rate"))]
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("stage"), F.round(v, 9).alias("per_day")) for i, (n, v) in enumerate(stages)])
    return averages.select(F.explode(rows).alias("s")).select("s.*")
