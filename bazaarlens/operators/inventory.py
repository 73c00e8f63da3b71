"""Stock results of the snapshot month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.money import ratio
from bazaarlens.functions.names import clean_name, short_name
from bazaarlens.operators.category import month_spine


def daily(elapsed_days: int) -> Column:
    return F.col("net_sales_qty").cast("double") / F.lit(float(elapsed_days))


def cover(elapsed_days: int) -> Column:
    return ratio(F.col("stock"), daily(elapsed_days))


def oos_summary(sales: DataFrame, snapshot: str, elapsed_days: int = 22, low_days: float = 21, by: tuple[str, ...] = ()) -> DataFrame:
    """Barcodes, out of stock, out of stock but selling, and stock lasting less than `low_days`."""
    empty = F.col("stock") == 0
    return sales.where(F.col("month") == snapshot).groupBy(*by).agg(
        F.count(F.lit(1)).alias("skus_now"), F.count_if(empty).alias("oos_now"),
        F.count_if(empty & (F.col("gross_sales_qty") > 0)).alias("oos_selling"),
        F.count_if(cover(elapsed_days) < low_days).alias("low_cover"),
    )


def sku_presence(sales: DataFrame, months: tuple[str, ...]) -> DataFrame:
    """Distinct barcodes with a row in each month; every month appears."""
    seen = sales.groupBy("month").agg(F.countDistinct("barcode").alias("skus"))
    return month_spine(sales.sparkSession, months).join(seen, "month", "left").select("month", F.coalesce("skus", F.lit(0)).alias("skus"))


def low_cover_list(sales: DataFrame, snapshot: str, elapsed_days: int = 22, below: float = 30, min_units: int = 5, k: int = 15) -> DataFrame:
    """Selling barcodes whose stock runs out soonest."""
    rows = sales.where((F.col("month") == snapshot) & (F.col("net_sales_qty") >= min_units)).withColumn("_cover", cover(elapsed_days))
    return rows.where(F.col("_cover") < below).orderBy("_cover", "barcode").limit(k).select(
        "barcode", F.substring(short_name(F.col("name")), 1, 60).alias("name"), F.coalesce("color", F.lit("")).alias("color"),
        "stock", F.round(daily(elapsed_days), 1).alias("daily"), F.round("_cover", 1).alias("cover"),
    )


def lost_items(sales: DataFrame, snapshot: str, elapsed_days: int = 22, colours: tuple[str, ...] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Barcodes without stock, with the units and price they sold at per day."""
    named = clean_name(F.col("name")) if colours is None else clean_name(F.col("name"), colours)
    return sales.where((F.col("month") == snapshot) & (F.col("stock") == 0)).select(
        *by, "barcode", named.alias("name"), F.coalesce("color", F.lit("")).alias("color"),
        F.round(daily(elapsed_days), 1).alias("daily"), F.col("avg_price").alias("asp"),
        (daily(elapsed_days) * F.col("avg_price")).alias("lost_per_day"),
    )


def lost_revenue(sales: DataFrame, snapshot: str, elapsed_days: int = 22, by: tuple[str, ...] = ()) -> DataFrame:
    """Revenue per day that empty stock costs."""
    return lost_items(sales, snapshot, elapsed_days, by=by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("items"), F.round(F.coalesce(F.sum("lost_per_day"), F.lit(0.0)), 4).alias("lost_daily")
    )
