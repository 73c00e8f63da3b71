"""Source, core and monthly queries over the fixture views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bazaarlens.operators import core, kpis
from bazaarlens.plans.oracle_core import OPS_COLS
from bazaarlens.sources.fixtures import DIM_AMOUNT, DIM_NEW, DIM_PLUS, DIM_QTY, REASON_CODES, Fixture

SALES = ["month", "barcode", "name", "model_code", "category", "color", "stock", "gross_order_qty", "gross_sales_qty", "cancel_qty",
         "return_qty", "net_sales_qty", "gross_revenue", "discount", "net_revenue", "commission", "commission_rate", "avg_price",
         "current_price"]
LINE = ["package_no", "barcode", "qty", "unit_price", "gross", "discount", "net", "commission_rate"]
PACK = ["package_no", "order_no", "month", "order_at", "shipped_at", "delivered_at", "carrier", "city", "customer", "customer_nth",
        "age_band", "gender", "gross", "net", "disc", "tydisc", "units", "lines", "models", "cats", "commission", "returned", "cargo_fee"]
MIX_DIMS = {"new": DIM_NEW, "plus": DIM_PLUS, "qty": DIM_QTY, "amount": DIM_AMOUNT}


def monthly_all(fx: Fixture):
    return kpis.monthly_table(
        kpis.monthly_sales_kpis(fx.sales_table),
        kpis.monthly_order_kpis(fx.written("nth", lambda: fx.window_packages_nth)),
        kpis.monthly_mix_shares(fx.written("distribution", lambda: fx.distribution), MIX_DIMS),
        kpis.monthly_ops(fx.ops, OPS_COLS),
    )


def as_rows(wide: DataFrame) -> DataFrame:
    """The matrix as rows, with the place of each month's column."""
    months = [c for c in wide.columns if c != "metric"]
    cells = F.array(*[F.struct(F.lit(k).alias("place"), F.lit(m).alias("month"), F.col(f"`{m}`").alias("value")) for k, m in enumerate(months)])
    return wide.select("metric", F.explode(cells).alias("c")).select("metric", "c.place", "c.month", "c.value")


QUERIES = {
    "sales_enriched": lambda fx: fx.sales.select(*SALES),
    "reasons_wide": lambda fx: core.reasons_wide(fx.sales.select("month", "barcode", "reasons"), REASON_CODES),
    "category_month": lambda fx: core.category_month(fx.sales),
    "order_lines_enriched": lambda fx: core.order_lines_enriched(fx.order_lines, fx.orders, fx.params.months).select(
        *LINE, "order_no", "order_at", "shipped_at", "delivered_at", "carrier", "city", "customer", "customer_nth", "month"),
    "distribution_shares": lambda fx: core.distribution_shares(fx.distribution),
    "ops_pivot": lambda fx: as_rows(core.ops_pivot(fx.ops)),
    "store_daily_ratios": lambda fx: core.store_daily_ratios(fx.store_daily).select(
        "day", "store_views", "visitors", "followers_gained", "followers_lost", "store_orders", "total_orders", "store_revenue",
        "total_revenue", "store_revenue_share", "store_order_share", "store_customer_share"),
    "ad_campaigns_derived": lambda fx: core.ad_campaigns_derived(fx.ad_campaigns).select(
        "name", "status", "total_budget", "spent", "remaining_budget", "total_sales", "total_ad_revenue"),
    "ad_period_cover": lambda fx: core.ad_cover(fx.ad_periods),
    "ad_totals_by_source": lambda fx: core.ad_totals_by_source(fx.ad_totals),
    "barcode_master": lambda fx: core.barcode_master(fx.sales),
    "lines_model_category": lambda fx: core.lines_with_product(fx.order_lines, core.barcode_master(fx.all_sales)).select(
        *LINE, "model", "category", "commission", "returned"),
    "packages": lambda fx: core.packages(fx.lines, fx.orders).select(*PACK),
    "cargo_imputed": lambda fx: fx.packages_lite.select("package_no", "net", "cargo_fee", "cargo_known", "cargo"),
    "lead_times": lambda fx: fx.packages_lite.select(
        "package_no", "s_to_ship", "s_to_deliver", "s_total", "h_to_ship", "d_to_deliv", "d_total"),
    "monthly_sales_kpis": lambda fx: kpis.monthly_sales_kpis(fx.sales),
    "monthly_order_kpis": lambda fx: kpis.monthly_order_kpis(fx.written("all_nth", lambda: fx.packages_nth)),
    "monthly_mix_shares": lambda fx: kpis.monthly_mix_shares(fx.distribution, MIX_DIMS),
    "monthly_ops_join": monthly_all,
    "ops_history": lambda fx: as_rows(core.ops_pivot(fx.ops, newest_first=False)),
    "totals": lambda fx: kpis.totals(fx.sales_table, fx.packs_table),
    "monthly_order_totals": lambda fx: kpis.monthly_order_totals(fx.window_packages_lite, fx.params.months[: fx.params.full_months]),
    "headline_kpis": lambda fx: kpis.headline_kpis(fx.sales_table, fx.window_packages, fx.ad_totals, fx.params),
}
