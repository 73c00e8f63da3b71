"""Category results: summary, month matrix, baskets, cargo share, and cancel/return reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bazaarlens.functions.binning import spine
from bazaarlens.functions.money import ratio
from bazaarlens.operators.core import SALES_MEASURES


def category_summary(cat_month: DataFrame) -> DataFrame:
    """Sums per category with return rate, average price, commission rate and revenue share."""
    names = dict(zip(SALES_MEASURES, ["gross_units", "cancel", "ret", "net_units", "gross_rev", "disc", "net_rev", "comm"]))
    cats = cat_month.groupBy("category").agg(*[F.sum(c).alias(n) for c, n in names.items()])
    whole = cat_month.agg(F.sum("net_revenue").alias("_all"))
    return cats.crossJoin(whole).select(
        "category", *names.values(),
        ratio(F.col("ret"), F.col("gross_units"), 100.0).alias("ret_rate"),
        ratio(F.col("net_rev"), F.col("net_units")).alias("asp"),
        ratio(F.col("comm"), F.col("net_rev"), 100.0).alias("comm_rate"),
        ratio(F.col("net_rev"), F.col("_all"), 100.0).alias("share"),
    )


def category_month_matrix(cat_month: DataFrame, months: tuple[str, ...]) -> DataFrame:
    """Net revenue per category and month, 0 where there was none."""
    wide = cat_month.groupBy("category").pivot("month", list(months)).agg(F.sum("net_revenue"))
    return wide.select("category", *[F.coalesce(F.col(f"`{m}`"), F.lit(0)).alias(m) for m in months])


def package_categories(lines: DataFrame) -> DataFrame:
    return lines.groupBy("package_no", "category").agg(F.sum("net").alias("cat_net"))


def category_basket(lines: DataFrame, packs: DataFrame, categories: DataFrame, low: float = 200) -> DataFrame:
    """Packages that contain a category: count, mean value, share with other categories, share below `low`."""
    per = (
        package_categories(lines).join(packs.select("package_no", F.col("net").alias("pnet"), "cats"), "package_no")
        .groupBy("category").agg(
            F.count(F.lit(1)).alias("pkgs"), F.sum("pnet").alias("_net"),
            F.count_if(F.col("cats") > 1).alias("_cross"), F.count_if(F.col("pnet") < low).alias("_low"),
        )
    )
    zero = F.lit(0.0)
    return categories.select("category").distinct().join(per, "category", "left").select(
        "category", F.coalesce("pkgs", F.lit(0)).alias("pkgs"),
        F.coalesce(ratio(F.col("_net"), F.col("pkgs")), zero).alias("aov_with"),
        F.coalesce(ratio(F.col("_cross"), F.col("pkgs"), 100.0), zero).alias("cross_cat"),
        F.coalesce(ratio(F.col("_low"), F.col("pkgs"), 100.0), zero).alias("under200"),
    )


def cargo_allocation(lines: DataFrame, packs: DataFrame, key: str) -> DataFrame:
    """Package cargo spread over `key` by share of package value; a package of value 0 spreads nothing.

    Lines are summed per (package, key) first, so the join sees each pair once.
    """
    per = lines.groupBy("package_no", key).agg(F.sum("net").alias("_net"), F.sum("commission").alias("_comm"))
    head = packs.select("package_no", F.col("net").alias("_pnet"), F.col("cargo").alias("_cargo"))
    part = F.try_divide(F.col("_cargo").cast("double") * F.col("_net").cast("double"), F.col("_pnet").cast("double"))
    return per.join(head, "package_no").groupBy(key).agg(
        F.coalesce(F.sum(part), F.lit(0.0)).alias("cargo_alloc"), F.sum("_net").alias("orev"), F.sum("_comm").alias("ocomm")
    )


def allocation_shares(alloc: DataFrame, key: str) -> DataFrame:
    """Allocated cargo and commission as a share of order revenue (%)."""
    return alloc.select(
        key, F.round("cargo_alloc", 4).alias("cargo_alloc"), "orev", "ocomm",
        F.round(ratio(F.col("cargo_alloc"), F.col("orev"), 100.0), 6).alias("cargo_pct"),
        ratio(F.col("ocomm"), F.col("orev"), 100.0).alias("comm_pct_o"),
    )


def cancel_return_reasons(sales: DataFrame) -> DataFrame:
    """Total per reason, positive ones only, largest first."""
    return (
        sales.select(F.explode("reasons").alias("reason", "n")).groupBy("reason").agg(F.sum("n").alias("n"))
        .where("n > 0").orderBy(F.desc("n"), "reason")
    )


def month_spine(spark, months: tuple[str, ...]) -> DataFrame:
    return spine(spark, "month", list(months))
