"""Distribution totals, cities and calendar profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bazaarlens.functions.binning import spine
from bazaarlens.functions.money import ratio


def distribution_totals(dist: DataFrame, dimensions: tuple[str, ...]) -> DataFrame:
    """Orders per bucket, summed over months."""
    return dist.where(F.col("dimension").isin(*dimensions)).groupBy("dimension", "bucket", "bucket2").agg(F.sum("orders").alias("orders"))


def city_top(packs: DataFrame, k: int = 12) -> DataFrame:
    """Cities with most packages: packages, revenue, basket value, share of all packages."""
    cities = packs.where(F.col("city").isNotNull()).groupBy("city").agg(F.count(F.lit(1)).alias("pkgs"), F.sum("net").alias("rev"))
    whole = packs.agg(F.count(F.lit(1)).alias("_all"))
    return cities.orderBy(F.desc("pkgs"), "city").limit(k).crossJoin(whole).select(
        "city", "pkgs", "rev", ratio(F.col("rev"), F.col("pkgs")).alias("aov"), ratio(F.col("pkgs"), F.col("_all"), 100.0).alias("share"))


def weekday_profile(packs: DataFrame) -> DataFrame:
    """Packages and basket value per weekday, Monday = 0; every day appears."""
    per = packs.groupBy(F.weekday("order_at").alias("weekday")).agg(F.count(F.lit(1)).alias("pkgs"), F.sum("net").alias("_net"))
    return spine(packs.sparkSession, "weekday", list(range(7))).join(per, "weekday", "left").select(
        "weekday", F.coalesce("pkgs", F.lit(0)).alias("pkgs"), ratio(F.col("_net"), F.col("pkgs")).alias("aov"))


def day_of_month_profile(packs: DataFrame, long_month_scale: float = 5 / 3) -> DataFrame:
    """Packages per day of month; the 31st is also given rescaled, as only some months have one."""
    per = packs.groupBy(F.dayofmonth("order_at").alias("dom")).agg(F.count(F.lit(1)).alias("pkgs"))
    n = F.coalesce("pkgs", F.lit(0))
    scaled = F.when(F.col("dom") == 31, n * F.lit(long_month_scale)).otherwise(n.cast("double"))
    return spine(packs.sparkSession, "dom", list(range(1, 32))).join(per, "dom", "left").select("dom", n.alias("pkgs"), scaled.alias("pkgs_scaled"))


def daily_sales(packs: DataFrame) -> DataFrame:
    """Packages and revenue per calendar day."""
    return packs.groupBy(F.to_date("order_at").alias("day")).agg(F.count(F.lit(1)).alias("pkgs"), F.sum("net").alias("rev"))
