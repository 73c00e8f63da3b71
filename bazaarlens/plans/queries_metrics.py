"""Category, product, stock, customer, calendar, basket and fulfilment queries over the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarlens.operators import baskets, category, core, customers, demographics, fulfilment, inventory, kpis, products
from bazaarlens.sources.fixtures import DIM_AGE, DIM_AMOUNT, DIM_GENDER, DIM_HOUR, DIM_PLUS, DIM_QTY, NAME_COLOURS, Fixture

TABLE = ["model_code", "name", "category", "segment", "net_rev", "rev_share", "cum", "net_units", "gross_units", "asp", "price", "ret_rate",
         "comm_rate", "growth", "months_active", "stock", "oos_var", "var_now", "variants", "cover_days", "daily_units", "pk", "multi",
         "aov_with", "cargo_pct", "solo", "disc", "cv", "snapshot_rev"]
COHORTS = ("1997-04", "1997-05", "1997-06", "1997-07")


def windowed_models(fx: Fixture):
    return products.model_rollup(fx.sales)


QUERIES = {
    # category and reasons
    "category_summary": lambda fx: category.category_summary(core.category_month(fx.sales)),
    "category_month_matrix": lambda fx: category.category_month_matrix(core.category_month(fx.sales), fx.params.months),
    "category_basket": lambda fx: category.category_basket(fx.lines, fx.packages, fx.products),
    "category_cargo_share": lambda fx: products.category_cargo_share(fx.lines, fx.packages_lite),
    "cancel_return_reasons": lambda fx: category.cancel_return_reasons(fx.sales),
    # products
    "model_rollup": lambda fx: products.model_rollup(fx.sales),
    "model_month_matrix": lambda fx: products.model_month_matrix(fx.sales, fx.params.months),
    "stock_snapshot": lambda fx: products.stock_snapshot(fx.sales, fx.params.snapshot),
    "model_display_name": lambda fx: products.model_names(
        fx.sales, fx.products.groupBy(F.col("model_code").alias("code")).agg(F.concat(F.lit("Özel "), F.min("brand")).alias("name"))
        .where(F.col("name").endswith("1")), NAME_COLOURS),
    "model_growth": lambda fx: products.model_growth(fx.sales, fx.params.months, fx.params.full_months),
    "stock_cover": lambda fx: products.stock_cover(
        products.model_growth(fx.sales, fx.params.months), products.stock_snapshot(fx.sales, fx.params.snapshot), fx.params.elapsed_days),
    "model_attach": lambda fx: products.model_attach(products.model_packages(fx.lines, fx.packages)),
    "cargo_allocation": lambda fx: products.model_cargo(products.model_packages(fx.lines, fx.packages)),
    "pareto": lambda fx: products.pareto(windowed_models(fx)).select("model_code", "net_rev", "rev_share", "cum"),
    "product_segments": lambda fx: fx.ranking.select("model_code", "net_rev", "rev_share", "cum", "growth", "months_active", "h2", "segment"),
    "segment_summary": lambda fx: products.segment_summary(fx.models),
    "top_model_trend": lambda fx: products.top_model_trend(
        products.model_rollup(fx.sales).join(products.model_month_wide(fx.sales, fx.params.months), "model_code"), fx.params.months),
    "movers": lambda fx: products.movers(fx.ranking, fx.params.mover_min_revenue),
    "product_roles": lambda fx: products.product_roles(fx.models).select("model_code", "segment", "asp", "cargo_pct", "solo", "multi", "role", "action"),
    "concentration": lambda fx: products.concentration(fx.ranking),
    "product_catalog": lambda fx: products.product_catalog(fx.models).select(*TABLE),
    # stock
    "oos_summary": lambda fx: inventory.oos_summary(fx.sales, fx.params.snapshot, fx.params.elapsed_days),
    "sku_presence": lambda fx: inventory.sku_presence(fx.sales, fx.params.months),
    "low_cover_list": lambda fx: inventory.low_cover_list(fx.sales, fx.params.snapshot, fx.params.elapsed_days),
    "lost_revenue": lambda fx: inventory.lost_revenue(fx.sales, fx.params.snapshot, fx.params.elapsed_days),
    "lost_revenue_items": lambda fx: inventory.lost_items(fx.sales, fx.params.snapshot, fx.params.elapsed_days, NAME_COLOURS),
    # customers
    "customers": lambda fx: customers.customers(fx.packages_lite),
    "repeat_summary": lambda fx: customers.repeat_summary(customers.customers(fx.packages_lite)),
    "order_count_histogram": lambda fx: customers.order_count_histogram(customers.customers(fx.packages_lite)),
    "order_label_counts": lambda fx: customers.order_label_counts(fx.packages_nth),
    "repurchase_gaps": lambda fx: customers.gap_summary(customers.repurchase_gaps(fx.packages_lite)),
    "repurchase_gap_bins": lambda fx: customers.gap_histogram(customers.repurchase_gaps(fx.packages_lite)),
    "cohort_retention": lambda fx: customers.cohort_retention(fx.window_packages_lite, COHORTS, "1997-08"),
    # demographics and calendar
    "distribution_totals": lambda fx: demographics.distribution_totals(
        fx.distribution, (DIM_AGE, DIM_GENDER, DIM_HOUR, DIM_AMOUNT, DIM_QTY, DIM_PLUS)),
    "city_top": lambda fx: demographics.city_top(fx.packages_place),
    "weekday_profile": lambda fx: demographics.weekday_profile(fx.packages_lite),
    "day_of_month_profile": lambda fx: demographics.day_of_month_profile(fx.packages_lite),
    "daily_sales": lambda fx: demographics.daily_sales(fx.packages_lite),
    "run_rate": lambda fx: kpis.run_rate(fx.sales, fx.params.snapshot, fx.params.elapsed_days),
    # baskets
    "amount_bins": lambda fx: baskets.amount_bins(fx.packages_lite),
    "threshold_cliff": lambda fx: baskets.threshold_cliff(fx.packages_lite),
    "net_histogram": lambda fx: baskets.net_histogram(fx.packages_lite),
    "basket_size_dists": lambda fx: baskets.basket_size_dists(fx.packages, fx.order_lines),
    "model_pairs": lambda fx: baskets.described_pairs(baskets.top_pairs(baskets.model_pairs(fx.lines)), fx.ranking, fx.sales_table, colours=NAME_COLOURS),
    "model_pairs_by_lift": lambda fx: baskets.described_pairs(baskets.top_pairs_by_lift(baskets.model_pairs(fx.lines)), fx.ranking, fx.sales_table, colours=NAME_COLOURS),
    # every package of more than two models crosses the block
    "model_pairs_blocked": lambda fx: baskets.pair_counts(baskets.saved_items(fx.lines, "model"), 12, block=2),
    "category_pairs": lambda fx: baskets.category_pairs(fx.lines),
    "category_single_counts": lambda fx: baskets.single_counts(baskets.item_packages(fx.lines, "category")),
    "multicolor": lambda fx: baskets.multicolor_packages(fx.lines),
    "multicolor_models": lambda fx: baskets.with_names(baskets.multicolor_models(fx.lines), products.model_names(fx.sales, colours=NAME_COLOURS)),
    "multiunit_models": lambda fx: baskets.with_names(baskets.multiunit_models(fx.lines), products.model_names(fx.sales, colours=NAME_COLOURS)),
    "pair_advice": lambda fx: baskets.pair_advice(baskets.model_pairs(fx.lines)).select("a", "b", "n", "lift", "advice"),
    # fulfilment
    "fulfilment_summary": lambda fx: fulfilment.fulfilment_summary(fx.packages_lite),
    "carrier_scorecard": lambda fx: fulfilment.carrier_scorecard(fx.packages_lite),
    "returns_by_delivery_time": lambda fx: fulfilment.returns_by_delivery_time(fx.packages_lite),
}
