"""Contribution margin, break-even points and scenario tables.

`rates` is one row (comm_rate, tacos, aov, pk) and scenarios are parameters,
so each formula is a plain expression over packages or over small results.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bazaarlens.functions.binning import spine
from bazaarlens.functions.money import cargo_tier_double, ratio
from bazaarlens.operators.core import ad_cover
from bazaarlens.params import Scenario


def scenario_table(spark: SparkSession, scenarios: list[Scenario]) -> DataFrame:
    rows = [
        F.struct(F.lit(i).alias("scenario"), F.lit(s.cost).alias("cost"), F.lit(s.vat).alias("vat"), F.lit(s.fee).alias("fee"), F.lit(s.ads).alias("ads"))
        for i, s in enumerate(scenarios)
    ]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def base_rates(totals: DataFrame, ad_totals: DataFrame, sales: DataFrame, window: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Commission rate of the packages, advertising share of net revenue, mean basket and package count."""
    spend = ad_cover(ad_totals.where(F.col("source") == "panel"), window).agg(F.sum("spend").alias("_spend"))
    net = sales.agg(F.sum("net_revenue").alias("_rev"))
    return totals.crossJoin(spend).crossJoin(net).select(
        ratio(F.col("comm_o"), F.col("net_o")).alias("comm_rate"), ratio(F.col("_spend"), F.col("_rev")).alias("tacos"),
        F.col("aov_all").alias("aov"), "pk")


def ad_rate() -> Column:
    return F.when(F.col("ads"), F.col("tacos")).otherwise(F.lit(0.0))


def order_margin(v: Column) -> Column:
    """Margin of one package of value `v` under the scenario columns."""
    after_cost = v * (F.lit(1.0) - F.col("cost")) / (F.lit(1.0) + F.col("vat"))
    return after_cost - F.col("comm_rate") * v - cargo_tier_double(v) - F.col("fee") - ad_rate() * v


def contribution_margin(totals: DataFrame, rates: DataFrame, scenarios: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Margin of package totals (net_o, cargo_o, comm_o, pk), per group of `by`, for every scenario."""
    net, k, c = F.col("net"), F.col("vat"), F.col("cost")
    base = totals.select(
        *by, F.col("net_o").cast("double").alias("net"), F.col("cargo_o").cast("double").alias("cargo"),
        F.col("comm_o").cast("double").alias("comm"), F.col("pk").alias("pkgs"))
    parts = base.crossJoin(rates.select("tacos")).crossJoin(scenarios).withColumns({
        "vat_paid": (net - c * net) * k / (F.lit(1.0) + k), "cogs": c * net, "fees": F.col("fee") * F.col("pkgs"), "ad_cost": ad_rate() * net,
    })
    cm = net - F.col("vat_paid") - F.col("cogs") - F.col("comm") - F.col("cargo") - F.col("fees") - F.col("ad_cost")
    return parts.withColumn("cm", cm).withColumn("cm_pct", ratio(F.col("cm"), net, 100.0)).withColumn(
        "cm_per_package", ratio(F.col("cm"), F.col("pkgs"))).drop("tacos")


def bin_margin(bins: DataFrame, rates: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Margin of the mean basket of each value bin, and the share of packages in bins that lose money."""
    placed = bins.select("bin_no", "bin", "n", "net").crossJoin(rates).crossJoin(scenarios).withColumn("cm", order_margin(F.col("net")))
    loss = placed.groupBy("scenario").agg((ratio(F.sum(F.when(F.col("cm") < 0, F.col("n")).otherwise(0)), F.first("pk"), 100.0)).alias("loss_share"))
    return placed.join(loss, "scenario").select(
        "scenario", "bin_no", "bin", "n", "net", "cm", (F.try_divide(F.col("cm"), F.col("net")) * F.lit(100.0)).alias("cm_pct"), "loss_share")


def _share_margin(comm_pct: Column, cargo_pct: Column, basket: Column) -> Column:
    kept = (F.lit(1.0) - F.col("cost")) / (F.lit(1.0) + F.col("vat"))
    return kept - comm_pct / F.lit(100.0) - cargo_pct / F.lit(100.0) - ad_rate() - F.col("fee") / basket


def _or(col: str, default: Column) -> Column:
    """The value, or the default where it is null or zero."""
    return F.when(F.col(col) != 0, F.col(col)).otherwise(default)


def category_margin(categories: DataFrame, rates: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Margin per category that has a cargo share: columns net_rev, comm_pct, cargo_pct, aov_with."""
    rows = categories.where(F.col("cargo_pct") != 0).crossJoin(rates).crossJoin(scenarios)
    r = _share_margin(F.col("comm_pct"), F.col("cargo_pct"), _or("aov_with", F.col("aov")))
    return rows.select(
        "scenario", "category", "net_rev", "comm_pct", "cargo_pct", F.round(r * F.lit(100.0), 4).alias("cm_pct"),
        F.round(r * F.col("net_rev").cast("double"), 4).alias("cm"))


def model_unit_economics(models: DataFrame, rates: DataFrame, scenarios: DataFrame, k: int = 25,
                         default_comm: float = 18.6, default_cargo: float = 24.0) -> DataFrame:
    """Margin share, margin per unit and in total of the k models with most revenue."""
    top = models.orderBy(F.desc("net_rev"), "model_code").limit(k)
    r = _share_margin(_or("comm_rate_pct", F.lit(default_comm)), _or("cargo_pct", F.lit(default_cargo)), _or("aov_with", F.col("aov")))
    rows = top.withColumnRenamed("comm_rate", "comm_rate_pct").crossJoin(rates).crossJoin(scenarios)
    return rows.select(
        "scenario", "model_code", "segment", "asp", F.round(r * F.lit(100.0), 4).alias("cm_pct"), F.round(r * F.col("asp"), 4).alias("cm_per_unit"),
        F.round(r * F.col("net_rev").cast("double"), 4).alias("cm"))


def breakeven_cost_ratio(totals: DataFrame, rates: DataFrame, scenarios: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Cost ratio at which the margin is zero: 1 - X (1 + vat) / net, kept within [0, 1]."""
    margin = contribution_margin(totals, rates, scenarios, by)
    other = F.col("comm") + F.col("cargo") + F.col("fees") + F.col("ad_cost")
    c = F.lit(1.0) - F.try_divide(other * (F.lit(1.0) + F.col("vat")), F.col("net"))
    return margin.select(*by, "scenario", "vat", "fee", "ads", F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)).alias("breakeven_cost"))


def margin_curve(packs: DataFrame, rates: DataFrame, scenarios: list[Scenario], lo: int = 50, hi: int = 800, step: int = 5) -> DataFrame:
    """Order margin on a value grid, with the packages of each grid step and the share of them at a loss.

    Scenarios become aggregate columns, so packages are read once and not copied per scenario.
    """
    spark = packs.sparkSession
    slot = F.floor(F.col("net") / step).cast("int") * step
    valued = packs.where((F.col("net") >= lo) & (F.col("net") < hi + step)).select(
        slot.alias("v"), F.col("net").cast("double").alias("_net")).crossJoin(F.broadcast(rates))

    def margin(s: Scenario) -> Column:
        after = F.col("_net") * F.lit(1.0 - s.cost) / F.lit(1.0 + s.vat) - F.col("comm_rate") * F.col("_net")
        ads = F.col("tacos") * F.col("_net") if s.ads else F.lit(0.0)
        return after - cargo_tier_double(F.col("_net")) - F.lit(s.fee) - ads

    counts = valued.groupBy("v").agg(F.count(F.lit(1)).alias("pkgs"), *[F.count_if(margin(s) < 0).alias(f"l{i}") for i, s in enumerate(scenarios)])
    losses = F.array(*[F.struct(F.lit(i).alias("scenario"), F.col(f"l{i}").alias("losing")) for i in range(len(scenarios))])
    per = counts.select("v", "pkgs", F.explode(losses).alias("s")).select("v", "pkgs", "s.*")
    grid = spine(spark, "v", list(range(lo, hi + 1, step))).crossJoin(rates).crossJoin(scenario_table(spark, scenarios))
    curve = grid.withColumn("cm", order_margin(F.col("v").cast("double")))
    return curve.join(per, ["scenario", "v"], "left").select(
        "scenario", "v", "cm", F.coalesce("pkgs", F.lit(0)).alias("pkgs"), ratio(F.col("losing"), F.col("pkgs"), 100.0).alias("loss_share"))


def breakeven_basket(rates: DataFrame, scenarios: DataFrame, lo: float = 60.0, hi: float = 200.0, step: float = 0.5) -> DataFrame:
    """Smallest basket in [lo, hi) whose margin is not negative; null if there is none."""
    points = [lo + i * step for i in range(int((hi - lo) / step))]
    grid = rates.crossJoin(scenarios).withColumn("v", F.explode(F.array(*[F.lit(p) for p in points])))
    return grid.groupBy("scenario").agg(F.min(F.when(order_margin(F.col("v")) >= 0, F.col("v"))).alias("breakeven_basket"))


def breakeven_roas(margin: DataFrame, rates: DataFrame) -> DataFrame:
    """Return on spend at which advertising pays; TACoS is added back whether or not the scenario has ads."""
    base = F.col("cm_pct") / F.lit(100.0) + F.col("tacos")
    return margin.select("scenario", "cm_pct").crossJoin(rates.select("tacos")).select(
        "scenario", "cm_pct", (F.lit(1.0) / F.greatest(F.lit(0.01), base)).alias("breakeven_roas"))


def fee_saving(totals: DataFrame, per_package: float = 4.0, observed_months: int = 5) -> DataFrame:
    """Monthly saving if every package shipped on the same day."""
    return totals.select("pk", (F.lit(per_package) * F.col("pk") / F.lit(float(observed_months))).alias("monthly_saving"))
