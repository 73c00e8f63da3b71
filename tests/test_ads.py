"""Ad periods: overlapping and adjoining ones, the same rule in all five results."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import ads, core, kpis, margin
from bazaarlens.params import Params

SCHEMA = "period_from date, period_to date, source string, impressions bigint, clicks bigint, sales bigint, revenue decimal(18,4), spend decimal(18,4), roas double"


def day(month, d=1):
    return dt.date(2026, month, d)


def totals(spark, periods, source="panel"):
    from decimal import Decimal

    return spark.createDataFrame([(a, b, source, 1000, 100, 10, Decimal(5 * s), Decimal(s), float(s)) for a, b, s in periods], SCHEMA)


def spend(df):
    return {r["source"]: float(r["spend"]) for r in df.collect()}


@pytest.mark.parametrize(("periods", "want"), [
    ([(day(4), day(8, 31), 50), (day(4), day(9, 30), 60)], 60),  # the later sum holds the earlier one
    ([(day(4), day(6, 30), 50), (day(7), day(9, 30), 60)], 110),  # they adjoin
    ([(day(4), day(6, 30), 50), (day(6, 30), day(9, 30), 60)], 60),  # one day in both: the longer one
    ([(day(4), day(9, 30), 45), (day(4), day(6, 30), 50), (day(7), day(9, 30), 60)], 45),  # as many days in fewer periods
    ([(day(4), day(5, 31), 10), (day(5), day(8, 31), 20), (day(9), day(9, 30), 30), (day(9, 5), None, 3)], 50),
    ([(None, day(4), 7), (None, None, 9)], 7),
])
def test_cover_counts_no_day_twice(spark, periods, want):
    assert spend(core.ad_cover(totals(spark, periods))) == {"panel": float(want)}


def test_cover_has_the_most_days_of_all_sets(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for k in range(25):
        periods = [(a := day(4) + dt.timedelta(days=rng.randrange(60)), a + dt.timedelta(days=rng.randrange(25)), 2**j) for j in range(rng.randint(1, 7))]
        sets = (c for n in range(1, len(periods) + 1) for c in itertools.combinations(sorted(periods), n) if all(x[1] < y[0] for x, y in zip(c, c[1:], strict=False)))
        want[f"s{k}"] = max((sum((b - a).days + 1 for a, b, _ in c), -len(c)) for c in sets)
        rows += [(a, b, f"s{k}", s) for a, b, s in periods]
    df = spark.createDataFrame(rows, "period_from date, period_to date, source string, spend bigint").withColumns({"revenue": F.datediff("period_to", "period_from") + 1, "roas": F.lit(1.0), "sales": F.lit(1)})
    assert {r["source"]: (r["revenue"], -r["sales"]) for r in core.ad_cover(df).collect()} == want


def test_all_results_read_periods_alike(spark):
    given = totals(spark, [(day(4), day(8, 31), 50), (day(4), day(9, 30), 60), (day(10), day(12, 31), 1000)]).unionByName(totals(spark, [(day(4), day(4, 30), 4)], "meta"))
    window = (day(4), day(9, 30))
    sales = spark.createDataFrame([("2026-04", 1000.0, 100, 1, 1, 5)], "month string, net_revenue double, gross_sales_qty bigint, return_qty bigint, cancel_qty bigint, stock int")
    packs = spark.createDataFrame([("P1", 100.0, 2, 10.0, 1)], "package_no string, net double, units bigint, cargo double, models int")
    campaigns = spark.createDataFrame([("A", 20.0)], "name string, spent double")
    rates = spark.createDataFrame([(1.0, 10.0, 100.0, 1)], "comm_o double, net_o double, aov_all double, pk bigint")
    by_source = core.ad_totals_by_source(given, window).first()
    figures = ads.ad_totals_kpis(given, sales, window=window).collect()
    assert (float(by_source["panel_spend"]), by_source["panel_roas"], float(by_source["meta_spend"])) == (60.0, 60.0, 4.0)
    assert len(figures) == 1 and figures[0]["tacos"] == 6.0
    assert margin.base_rates(rates, given, sales, window).first()["tacos"] == 0.06
    assert float(ads.unattributed_spend(given, campaigns, window).first()["other_spend"]) == 36.0
    assert kpis.headline_kpis(sales, packs, given, Params(months=("2026-04", "2026-09"), full_months=2), window=window).first()["ad_cvr"] == 10.0
    by = given.withColumn("seller", F.explode(F.array(F.lit(0), F.lit(1))))
    assert sorted((r["seller"], r["source"], float(r["spend"])) for r in core.ad_cover(by, window, ("seller",)).collect()) == [(0, "meta", 4.0), (0, "panel", 60.0), (1, "meta", 4.0), (1, "panel", 60.0)]
