"""Advertising, storefront, margin, coupon and coverage queries over the fixture views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bazaarlens.operators import ads, baskets, category, core, coupons, coverage, customers, kpis, margin, products
from bazaarlens.params import Scenario, scenario_grid
from bazaarlens.sources import raw_fixtures as raw
from bazaarlens.sources.fixtures import Fixture

TODAY = dt.date(1998, 8, 17)
AVERAGED = ["store_views", "visitors", "followers_gained", "followers_lost", "follow_rate", "customer_rate", "store_conversion",
            "store_orders", "total_orders", "store_revenue_share"]


def packs(fx: Fixture):
    return fx.packs_table


def totals(fx: Fixture):
    return kpis.package_totals(packs(fx))


def rates(fx: Fixture):
    return fx.written("rates", lambda: margin.base_rates(totals(fx), fx.ad_totals, fx.sales_table))


def one(fx: Fixture):
    return margin.scenario_table(fx.spark, [Scenario()])


def grid(fx: Fixture):
    return margin.scenario_table(fx.spark, scenario_grid())


def default_margin(fx: Fixture):
    return margin.contribution_margin(totals(fx), rates(fx), one(fx))


def monthly_margin(fx: Fixture):
    full = packs(fx).where(F.col("month").isin(*fx.params.months[: fx.params.full_months]))
    return margin.contribution_margin(kpis.package_totals(full, ("month",)), rates(fx), one(fx), ("month",))


def category_inputs(fx: Fixture):
    lines, packages = fx.lines_table, core.lead_times(core.impute_cargo(core.packages(fx.lines_table, fx.window_headers)))
    summary = category.category_summary(core.category_month(fx.sales_table)).select("category", "net_rev", F.col("comm_rate").alias("comm_pct"))
    basket = category.category_basket(lines, packages, fx.products).select("category", "aov_with")
    cargo = products.category_cargo_share(lines, packages).select("category", "cargo_pct")
    return summary.join(basket, "category", "left").join(cargo, "category", "left")


def model_inputs(fx: Fixture):
    return fx.models.select("model_code", "segment", "net_rev", "asp", "comm_rate", "cargo_pct", "aov_with")


def clv(fx: Fixture):
    p = packs(fx)
    return customers.clv_12m(p, customers.customers(p), default_margin(fx), fx.params.observed_months)


def covered(fx: Fixture):
    return coverage.coverage_by_month(fx.sales_monthly, fx.orders_lite, fx.written("distribution", lambda: fx.distribution), fx.store_daily, fx.ops, TODAY)


def cells(fx: Fixture):
    return coverage.coverage_cells(fx.written("coverage", lambda: covered(fx)), TODAY)


QUERIES = {
    "ad_campaign_metrics": lambda fx: ads.ad_campaign_metrics(core.ad_campaigns_derived(fx.ad_campaigns)).select(
        "name", "status", "spent", "clicks", "impressions", "direct_sales", "total_sales", "direct_revenue", "total_ad_revenue", "cpc", "ctr",
        "direct_roas", "total_roas"),
    "ad_totals_kpis": lambda fx: ads.ad_totals_kpis(fx.ad_totals, fx.sales),
    "unattributed_spend": lambda fx: ads.unattributed_spend(fx.ad_totals, fx.ad_campaigns),
    "store_averages": lambda fx: ads.store_averages(core.store_daily_ratios(fx.store_daily).withColumn(
        "followers_gained", F.concat(F.lit("+ "), F.col("followers_gained").cast("string"))), AVERAGED),
    "store_funnel": lambda fx: ads.store_funnel(ads.store_averages(fx.store_daily, ["visitors", "store_views", "follow_rate", "customer_rate"])),
    "contribution_margin": default_margin,
    "monthly_margin": monthly_margin,
    "bin_margin": lambda fx: margin.bin_margin(baskets.amount_bins(packs(fx)), rates(fx), one(fx)),
    "category_margin": lambda fx: margin.category_margin(category_inputs(fx), rates(fx), one(fx)),
    "model_unit_economics": lambda fx: margin.model_unit_economics(model_inputs(fx), rates(fx), one(fx)),
    "breakeven_cost_ratio": lambda fx: margin.breakeven_cost_ratio(totals(fx), rates(fx), grid(fx)),
    "margin_curve": lambda fx: margin.margin_curve(packs(fx), rates(fx), scenario_grid()),
    "breakeven_basket": lambda fx: margin.breakeven_basket(rates(fx), grid(fx)),
    "breakeven_roas": lambda fx: margin.breakeven_roas(margin.contribution_margin(totals(fx), rates(fx), grid(fx)), rates(fx)),
    "scenario_grid": lambda fx: margin.contribution_margin(totals(fx), rates(fx), grid(fx)),
    "fee_saving": lambda fx: margin.fee_saving(totals(fx)),
    "coupon_scenarios": lambda fx: coupons.coupon_scenarios(coupons.histogram_values(baskets.net_histogram(packs(fx))), rates(fx), Scenario()),
    "coupon_scenarios_exact": lambda fx: coupons.coupon_scenarios(coupons.package_values(packs(fx)), rates(fx), Scenario()),
    "clv_12m": clv,
    "coverage_by_month": covered,
    "coverage_month_score": lambda fx: coverage.coverage_month_score(cells(fx)),
    "coverage_year_summary": lambda fx: coverage.coverage_year_summary(cells(fx)),
    "last_loads": lambda fx: coverage.last_loads(raw.uploads(fx), fx.ad_campaigns),
}
