"""Which report has arrived for which month, and how completely."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.binning import spine
from bazaarlens.functions.money import ratio
from bazaarlens.functions.timing import month_of

TYPES = ("sales", "orders", "distribution", "store", "ops")


def expected_days(month: Column, today: dt.date) -> Column:
    """Days a month should have by now: all of a past month, up to yesterday in the current one, none ahead."""
    start, now = F.to_date(F.concat(month, F.lit("-01"))), F.lit(today)
    end = F.last_day(start)
    return F.when(start > now, 0).when(end < now, F.dayofmonth(end)).otherwise(F.datediff(now, start))


def coverage_by_month(sales: DataFrame, orders: DataFrame, distribution: DataFrame, store: DataFrame, ops: DataFrame,
                      today: dt.date) -> DataFrame:
    """(report, month, n, reached_day, coverage). Orders count the last day reached, the store report distinct days."""
    none = F.lit(None).cast("int")

    def present(df: DataFrame, report: str) -> DataFrame:
        return df.where(F.col("month").isNotNull()).groupBy("month").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(report).alias("report"), "month", "n", none.alias("reached_day"))

    placed = orders.where(F.col("order_at").isNotNull()).groupBy(month_of(F.col("order_at")).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.dayofmonth("order_at")).alias("reached_day"))
    days = store.select("day").distinct().groupBy(month_of(F.col("day")).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    found = (
        present(sales, "sales").unionByName(placed.select(F.lit("orders").alias("report"), "month", "n", "reached_day"))
        .unionByName(present(distribution, "distribution"))
        .unionByName(days.select(F.lit("store").alias("report"), "month", "n", none.alias("reached_day")))
        .unionByName(present(ops.where(F.col("value").isNotNull()), "ops"))
    )
    return covered(found, today)


def covered(found: DataFrame, today: dt.date) -> DataFrame:
    """Coverage from (report, month, n, reached_day), however those were counted."""
    expected = expected_days(F.col("month"), today)
    part = F.when(F.col("report") == "orders", F.col("reached_day")).when(F.col("report") == "store", F.col("n"))
    value = F.when(part.isNull() | (F.col("expected") == 0), F.lit(1.0)).otherwise(F.least(F.lit(1.0), ratio(part, F.col("expected"))))
    return found.withColumn("expected", expected).select("report", "month", "n", "reached_day", F.bround(value, 3).alias("coverage"))


def coverage_cells(coverage: DataFrame, today: dt.date, types: tuple[str, ...] = TYPES) -> DataFrame:
    """(month, report, v) for every month of every year with data, up to the current month; missing reports are 0."""
    spark = coverage.sparkSession
    this = today.strftime("%Y-%m")
    years = coverage.select(F.substring("month", 1, 4).alias("year")).union(spine(spark, "year", [this[:4]])).distinct()
    months = years.crossJoin(spine(spark, "mm", [f"{m:02d}" for m in range(1, 13)])).select(F.concat("year", F.lit("-"), "mm").alias("month"))
    grid = months.where(F.col("month") <= this).crossJoin(spine(spark, "report", list(types)))
    return grid.join(coverage, ["month", "report"], "left").select("month", "report", F.coalesce("coverage", F.lit(0.0)).alias("v"))


def coverage_month_score(cells: DataFrame, full: float = 0.999) -> DataFrame:
    """Mean over the reports of a month: full, partial or missing."""
    n = F.count(F.lit(1))
    scored = cells.groupBy("month").agg(
        (F.sum(F.col("v").cast("decimal(10,3)")).cast("double") / n).alias("score"), F.count_if(F.col("v") >= full).alias("full_reports"))
    label = F.when(F.col("score") >= full, "full").when(F.col("score") > 0, "partial").otherwise("missing")
    return scored.withColumn("label", label)


def coverage_year_summary(cells: DataFrame, full: float = 0.999) -> DataFrame:
    """Average coverage, full months, missing and partial cells per year."""
    year = F.substring("month", 1, 4).alias("year")
    scores = coverage_month_score(cells, full).groupBy(year).agg(F.count(F.lit(1)).alias("months"), F.count_if(F.col("label") == "full").alias("full_months"))
    sums = cells.groupBy(year).agg(
        (F.sum(F.col("v").cast("decimal(10,3)")).cast("double") / F.count(F.lit(1)) * F.lit(100.0)).alias("avg_pct"),
        F.count_if(F.col("v") == 0).alias("missing"), F.count_if((F.col("v") > 0) & (F.col("v") < full)).alias("partial"))
    return scores.join(sums, "year")


def last_loads(uploads: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Last upload of any report and of the ad report, and the number of campaigns."""
    up = uploads.agg(F.max("uploaded_at").alias("last_upload"), F.max(F.when(F.col("report_type") == "ads", F.col("uploaded_at"))).alias("last_ads_upload"))
    return up.crossJoin(campaigns.agg(F.count(F.lit(1)).alias("campaigns")))
