"""From tables to every result block: the shared relations are written once, then each block is its own plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from bazaarlens.functions.timing import in_months, month_of
from bazaarlens.operators import (
    ads, baskets, category, core, coupons, coverage, customers, demographics, fulfilment, inventory, kpis, margin, products,
)
from bazaarlens.params import RETURNED_STATUS, Params, cancel_reasons, scenario_grid
from bazaarlens.session import materialise
from bazaarlens.sources.tables import MONTH


def in_folders(table: DataFrame, params: Params) -> DataFrame:
    """Only the month folders of the window, where the table is stored by month."""
    return table.where(F.col(MONTH).isin(*params.months)).drop(MONTH) if MONTH in table.columns else table


def shared_relations(tables: dict[str, DataFrame], params: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sales, lines and packages of the reporting window, each written once (the package roll-up feeds most blocks)."""
    fact = in_folders(tables["sales_monthly"], params).where(in_months("period", params.months)).withColumn("month", month_of(F.col("period")))
    if dict(fact.dtypes)["reasons"] == "string":
        fact = fact.withColumn("reasons", F.from_json("reasons", "map<string,int>"))
    sales = materialise(core.sales_enriched(fact, tables["products"]), "sales")
    headers = in_folders(tables["orders"], params).where(in_months("order_at", params.months))
    returned = headers.select("package_no", (F.col("status") == RETURNED_STATUS).alias("returned"))
    own = tables["order_lines"].join(returned, "package_no")
    lines = materialise(core.lines_with_product(own, core.barcode_master(sales)), "lines")
    packs = materialise(core.lead_times(core.impute_cargo(core.packages(lines, headers))), "packages")
    return sales, lines, packs


def result_blocks(tables: dict[str, DataFrame], params: Params = Params(), marketplace: str = "", today: dt.date | None = None,
                  names: DataFrame | None = None, facts: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every block the given tables allow, by name. `names` (code, name) overrides the display names of models.

    `facts` (`sources.tables.read_month_facts`) gives the coverage of stored tables without reading them.
    """
    sales, lines, packs = shared_relations(tables, params)
    blocks = order_blocks(sales, lines, packs, params, names)
    if marketplace:
        blocks["reasons_wide"] = core.reasons_wide(sales.select("month", "barcode", "reasons"), cancel_reasons(marketplace))
    if "distribution" in tables:
        blocks |= distribution_blocks(tables["distribution"], params, marketplace)
    if "ops_monthly" in tables:
        blocks["operations"] = core.ops_pivot(with_month(tables["ops_monthly"]), newest_first=False)
    if "store_daily" in tables:
        blocks |= store_blocks(tables["store_daily"])
    if "ad_campaigns" in tables:
        if "uploads" in tables:
            blocks["last_loads"] = coverage.last_loads(tables["uploads"], tables["ad_campaigns"])
        blocks["campaigns"] = ads.ad_campaign_metrics(core.ad_campaigns_derived(tables["ad_campaigns"]))
    if "ad_totals" in tables:
        blocks |= money_blocks(tables, sales, packs, blocks, params)
    if today and {"distribution", "store_daily", "ops_monthly"} <= set(tables):
        blocks |= coverage_blocks(tables, today, facts)
    return blocks


def with_month(df: DataFrame, params: Params | None = None) -> DataFrame:
    known = df.where(in_months("period", params.months)) if params else df
    return known.withColumn("month", month_of(F.col("period")))


def distribution_blocks(distribution: DataFrame, params: Params, marketplace: str) -> dict[str, DataFrame]:
    # fixed values: sheet names of the distribution report
    dims = {"new": "Yeni & Mevcut Müşteri", "plus": f"{marketplace} Plus", "qty": "Adet Bazlı", "amount": "Tutar Bazlı"}
    totals = ("Yaş", "Cinsiyet", "Gün ve Saat", "Tutar Bazlı", "Adet Bazlı", dims["plus"])
    dist = with_month(distribution, params)
    return {
        "mix_shares": kpis.monthly_mix_shares(dist, dims), "distribution_shares": core.distribution_shares(dist),
        "distribution_totals": demographics.distribution_totals(dist, totals),
    }


def store_blocks(store: DataFrame) -> dict[str, DataFrame]:
    daily = core.store_daily_ratios(store)
    measures = [f.name for f in daily.schema.fields if f.name != "day"]
    averages = ads.store_averages(daily, measures)
    return {"store_daily": daily, "store_averages": averages, "store_funnel": ads.store_funnel(averages)}


def money_blocks(tables: dict[str, DataFrame], sales: DataFrame, packs: DataFrame, blocks: dict[str, DataFrame], params: Params) -> dict[str, DataFrame]:
    """Advertising, margin, break-even, coupon and customer-value blocks."""
    totals, ad_totals, window = kpis.package_totals(packs), tables["ad_totals"], sales_window(params)
    rates = materialise(margin.base_rates(totals, ad_totals, sales, window), "rates")
    one = margin.scenario_table(packs.sparkSession, [params.scenario])
    grid = margin.scenario_table(packs.sparkSession, scenario_grid())
    cm = margin.contribution_margin(totals, rates, one)
    monthly = kpis.package_totals(packs.where(F.col("month").isin(*params.months[: params.full_months])), ("month",))
    categories = blocks["categories"].withColumnRenamed("comm_rate", "comm_pct")
    out = {
        "ad_totals": ads.ad_totals_kpis(ad_totals, sales, window=window), "headline": kpis.headline_kpis(sales, packs, ad_totals, params, window=window),
        "ad_sources": core.ad_totals_by_source(ad_totals, window),
        "margin": cm, "monthly_margin": margin.contribution_margin(monthly, rates, one, ("month",)),
        "bin_margin": margin.bin_margin(blocks["amount_bins"], rates, one), "category_margin": margin.category_margin(categories, rates, one),
        "unit_economics": margin.model_unit_economics(blocks["products"], rates, one),
        "breakeven_cost": margin.breakeven_cost_ratio(totals, rates, grid), "margin_curve": margin.margin_curve(packs, rates, scenario_grid()),
        "breakeven_basket": margin.breakeven_basket(rates, grid), "scenarios": margin.contribution_margin(totals, rates, grid),
        "breakeven_roas": margin.breakeven_roas(margin.contribution_margin(totals, rates, grid), rates),
        "fee_saving": margin.fee_saving(totals, observed_months=params.observed_months),
        "coupons": coupons.coupon_scenarios(coupons.histogram_values(blocks["net_histogram"]), rates, params.scenario, observed_months=params.observed_months),
        "clv": customers.clv_12m(packs, customers.customers(packs), cm, params.observed_months),
    }
    if "ad_campaigns" in tables:
        out["unattributed_spend"] = ads.unattributed_spend(ad_totals, tables["ad_campaigns"], window)
    return out


def sales_window(params: Params) -> tuple[dt.date, dt.date]:
    """First and last day of the months that sales are taken from."""
    first, last = min(params.months), max(params.months)
    after = dt.date(int(last[:4]) + (last[5:] == "12"), int(last[5:]) % 12 + 1, 1)
    return dt.date(int(first[:4]), int(first[5:]), 1), after - dt.timedelta(days=1)


def coverage_blocks(tables: dict[str, DataFrame], today: dt.date, facts: DataFrame | None = None) -> dict[str, DataFrame]:
    found = coverage.covered(facts, today) if facts is not None else coverage.coverage_by_month(
        with_month(tables["sales_monthly"]), tables["orders"], with_month(tables["distribution"]), tables["store_daily"],
        with_month(tables["ops_monthly"]), today)
    found = materialise(found, "coverage")
    cells = coverage.coverage_cells(found, today)
    return {"coverage": found, "coverage_months": coverage.coverage_month_score(cells), "coverage_years": coverage.coverage_year_summary(cells)}


def order_blocks(sales: DataFrame, lines: DataFrame, packs: DataFrame, params: Params, names: DataFrame | None = None) -> dict[str, DataFrame]:
    """Blocks from sales, lines and packages."""
    models = materialise(products.model_table(products.model_facts(sales, lines, packs, params, names), params), "models")
    pairs = materialise(baskets.model_pairs(lines), "pairs")
    cust = materialise(customers.customers(packs), "customers")
    gaps = customers.repurchase_gaps(packs)
    cat_month = core.category_month(sales)
    snap, days = params.snapshot, params.elapsed_days
    return {
        "monthly": kpis.monthly_sales_kpis(sales).join(kpis.monthly_order_kpis(packs), "month", "left"),
        "totals": kpis.totals(sales, packs),
        "monthly_order_totals": kpis.monthly_order_totals(packs, params.months[: params.full_months]),
        "categories": category.category_summary(cat_month).join(category.category_basket(lines, packs, sales), "category", "left")
        .join(products.category_cargo_share(lines, packs), "category", "left"),
        "category_months": category.category_month_matrix(cat_month, params.months),
        "reasons": category.cancel_return_reasons(sales),
        "products": products.product_roles(models),
        "product_trend": products.top_model_trend(models, params.months),
        "segments": products.segment_summary(models),
        "movers": products.movers(models, params.mover_min_revenue),
        "concentration": products.concentration(models),
        "stock": inventory.oos_summary(sales, snap, days),
        "sku_presence": inventory.sku_presence(sales, params.months),
        "low_cover": inventory.low_cover_list(sales, snap, days),
        "lost_revenue": inventory.lost_revenue(sales, snap, days),
        "run_rate": kpis.run_rate(sales, snap, days),
        "lost_items": inventory.lost_items(sales, snap, days),
        "repeat": customers.repeat_summary(cust),
        "order_counts": customers.order_count_histogram(cust),
        "order_labels": customers.order_label_counts(packs),
        "gaps": customers.gap_summary(gaps),
        "gap_bins": customers.gap_histogram(gaps),
        "cohorts": customers.cohort_retention(packs, params.months[:4], params.months[params.full_months - 1]),
        "cities": demographics.city_top(packs),
        "weekdays": demographics.weekday_profile(packs),
        "days_of_month": demographics.day_of_month_profile(packs),
        "daily": demographics.daily_sales(packs),
        "amount_bins": baskets.amount_bins(packs),
        "cliff": baskets.threshold_cliff(packs),
        "net_histogram": baskets.net_histogram(packs),
        "basket_sizes": baskets.basket_size_dists(packs, lines),
        "pairs": baskets.pair_advice(baskets.describe_pairs(baskets.top_pairs(pairs), models)),
        "pairs_by_lift": baskets.describe_pairs(baskets.top_pairs_by_lift(pairs), models),
        "category_pairs": baskets.category_pairs(lines),
        "category_counts": baskets.single_counts(baskets.item_packages(lines, "category")),
        "multicolor": baskets.multicolor_packages(lines),
        "multicolor_models": baskets.with_names(baskets.multicolor_models(lines), models),
        "multiunit_models": baskets.with_names(baskets.multiunit_models(lines), models),
        "fulfilment": fulfilment.fulfilment_summary(packs),
        "carriers": fulfilment.carrier_scorecard(packs),
        "returns_by_delivery_time": fulfilment.returns_by_delivery_time(packs),
    }
