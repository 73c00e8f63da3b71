"""Shipping and delivery results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bazaarlens.functions.binning import bin_index, labelled_spine
from bazaarlens.functions.money import ratio
from bazaarlens.functions.stats import lead_quantiles
from bazaarlens.params import DELIVERY_EDGES, DELIVERY_LABELS


def fulfilment_summary(packs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Medians and 90th percentiles of the lead times among shipped packages, and the share shipped within a day."""
    shipped = packs.where(F.col("s_to_ship").isNotNull())
    hour, day = 3600.0, 86400.0
    quantiles = lead_quantiles(packs, list(by), {
        "h_ship_med": ("s_to_ship", 0.5, hour), "h_ship_p90": ("s_to_ship", 0.9, hour), "d_deliv_med": ("s_to_deliver", 0.5, day),
        "d_total_med": ("s_total", 0.5, day), "d_total_p90": ("s_total", 0.9, day),
    })
    base = shipped.groupBy(*by).agg(ratio(F.count_if(F.col("s_to_ship") < 86400), F.count(F.lit(1)), 100.0).alias("same_day"))
    return base.join(quantiles, list(by), "left") if by else base.crossJoin(quantiles)


def carrier_scorecard(packs: DataFrame) -> DataFrame:
    """Packages, median lead times, mean cargo and return share per carrier."""
    known = packs.where(F.col("carrier").isNotNull())
    base = known.groupBy("carrier").agg(
        F.count(F.lit(1)).alias("n"), ratio(F.sum("cargo"), F.count(F.lit(1))).alias("cargo"),
        ratio(F.count_if("returned"), F.count(F.lit(1)), 100.0).alias("ret"),
    )
    times = lead_quantiles(known, ["carrier"], {"h": ("s_to_ship", 0.5, 3600.0), "d": ("s_to_deliver", 0.5, 86400.0)})
    return base.join(times, "carrier", "left").withColumn("carrier", F.replace("carrier", F.lit(" Marketplace"), F.lit("")))


def returns_by_delivery_time(packs: DataFrame, edges: tuple = DELIVERY_EDGES, labels: tuple = DELIVERY_LABELS) -> DataFrame:
    """Packages and return share per (a, b] days from order to delivery; other packages are left out."""
    i = bin_index(F.col("s_total"), tuple(e * 86400 for e in edges), right_closed=True)
    per = packs.withColumn("i", i).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("returned").alias("_r"))
    return labelled_spine(packs.sparkSession, "i", "bin", labels).join(per, "i", "left").select(
        "bin", F.coalesce("n", F.lit(0)).alias("n"), ratio(F.col("_r"), F.col("n"), 100.0).alias("ret"))
