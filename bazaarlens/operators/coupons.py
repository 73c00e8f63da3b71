"""What a coupon would cost and bring, over the distribution of package values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.money import cargo_tier_double
from bazaarlens.params import COUPON_PRESETS, Scenario


def histogram_values(hist: DataFrame) -> DataFrame:
    """(v, n) of a value histogram: bin middles, and the tail mean for the open last bin."""
    return hist.select(F.coalesce("tail_mean", F.col("bin_no") * 10.0 + 5.0).alias("v"), "n")


def package_values(packs: DataFrame) -> DataFrame:
    """(v, n) of the packages themselves, equal values counted together."""
    return packs.groupBy(F.col("net").cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))


def coupon_scenarios(values: DataFrame, rates: DataFrame, scenario: Scenario, coupons=COUPON_PRESETS, observed_months: int = 5,
                     step_from: float = 0.7, step_over: float = 10.0) -> DataFrame:
    """Monthly cost, revenue and margin change per coupon (name, minimum, discount, use %, step-up %, extra %).

    Baskets over the minimum use the coupon; baskets near it may step up to just
    over it; extra orders come at the minimum or the mean basket. All coupons
    are summed in one pass over the values.
    """
    c, k, ads = F.lit(scenario.cost), F.lit(1.0 + scenario.vat), F.lit(1.0 if scenario.ads else 0.0)
    comm, tacos = F.col("comm_rate"), F.col("tacos")

    def cm(v: Column) -> Column:
        return v * (F.lit(1.0) - c) / k - comm * v - cargo_tier_double(v) - F.lit(scenario.fee) - ads * tacos * v

    v = F.col("v")
    n = F.col("n").cast("double") / F.lit(float(observed_months))
    aggs: list[Column] = [F.sum(n * v).alias("base"), F.sum(n).alias("base_n")]
    for i, (_, minimum, discount, use, step, _) in enumerate(coupons):
        t, d = F.lit(float(minimum)), F.lit(float(discount))
        used, stepped = v >= t, (v < t) & (v >= F.lit(step_from) * t)
        uses, steps = n * F.lit(use / 100.0), n * F.lit(step / 100.0)
        target = t + F.lit(step_over)
        paid = target - d
        use_cm = -d / k + comm * d + ads * tacos * d - (cargo_tier_double(v - d) - cargo_tier_double(v))
        step_cm = cm(paid) - cm(v) - (c * (target - v) - c * (paid - v)) / k
        aggs += [
            F.sum(F.when(used, uses * d).when(stepped, steps * d).otherwise(0.0)).alias(f"cost{i}"),
            F.sum(F.when(used, -uses * d).when(stepped, steps * (paid - v)).otherwise(0.0)).alias(f"rev{i}"),
            F.sum(F.when(used, uses * use_cm).when(stepped, steps * step_cm).otherwise(0.0)).alias(f"cm{i}"),
        ]
    sums = values.crossJoin(F.broadcast(rates.select("comm_rate", "tacos"))).groupBy("comm_rate", "tacos").agg(*aggs).crossJoin(rates.select("aov", "pk"))
    rows = F.array(*[
        F.struct(F.lit(i).alias("coupon_no"), F.lit(name).alias("coupon"), F.lit(float(t)).alias("t"), F.lit(float(d)).alias("d"), F.lit(g / 100.0).alias("g"),
                 F.col(f"cost{i}").alias("cost"), F.col(f"rev{i}").alias("rev"), F.col(f"cm{i}").alias("dcm"))
        for i, (name, t, d, _, _, g) in enumerate(coupons)
    ])
    one = sums.select("comm_rate", "tacos", "aov", "pk", "base", "base_n", F.explode(rows).alias("r")).select(
        "comm_rate", "tacos", "aov", "pk", "base", "base_n", "r.*")
    per_month = F.col("pk") / F.lit(float(observed_months))
    extra_value = F.greatest(F.col("t"), F.col("aov")) + F.lit(step_over) - F.col("d")
    full = one.withColumns({"per_month": per_month, "extra_n": F.col("g") * per_month, "extra_f": extra_value}).withColumn(
        "extra_cm", cm(F.col("extra_f")) - c * F.col("d") / k)
    needed = F.when(F.col("extra_cm") > 0, F.greatest(F.lit(0.0), -F.col("dcm") / F.col("extra_cm")))
    revenue = F.col("rev") + F.col("extra_n") * F.col("extra_f")
    return full.select(
        "coupon_no", "coupon", F.round(F.col("cost") + F.col("extra_n") * F.col("d"), 4).alias("cost"), F.round(revenue, 4).alias("revenue_change"),
        F.round(F.col("dcm") + F.col("extra_n") * F.col("extra_cm"), 4).alias("margin_change"),
        F.round((F.col("base") + revenue) / (F.col("base_n") + F.col("extra_n")), 6).alias("aov_after"),
        F.round("extra_cm", 6).alias("extra_margin"), F.round(needed, 4).alias("breakeven_orders"),
        F.round(needed / F.col("per_month") * F.lit(100.0), 4).alias("breakeven_pct"))
