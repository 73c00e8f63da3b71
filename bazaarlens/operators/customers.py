"""Customer results: roll-up, repeat behaviour, gaps, cohorts and twelve-month value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from bazaarlens.functions.binning import bin_index, spine
from bazaarlens.functions.money import beside, ratio
from bazaarlens.functions.timing import seconds_between
from bazaarlens.params import GAP_EDGES


def customers(packs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct orders, packages, revenue, first and last order per known customer.

    Packages are summed per (customer, order) first; a customer with very many
    packages is spread over tasks until only sums are left.
    """
    per_order = packs.where(F.col("customer").isNotNull()).groupBy(*by, "customer", "order_no").agg(
        F.sum("net").alias("rev"), F.count(F.lit(1)).alias("pkgs"), F.min("order_at").alias("first_at"), F.max("order_at").alias("last_at")
    )
    return per_order.groupBy(*by, "customer").agg(
        F.count("order_no").alias("n"), F.sum("pkgs").alias("pkgs"), F.sum("rev").alias("rev"),
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"),
    )


def repeat_summary(cust: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Customers, repeaters and their shares; basket values are per package of each customer class."""
    rep, one = F.col("n") > 1, F.col("n") == 1
    sums = cust.groupBy(*by).agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(rep).alias("repeaters"), F.sum("n").alias("_n"), F.sum("rev").alias("_rev"),
        F.sum(F.when(rep, F.col("rev"))).alias("_rev2"), F.sum(F.when(rep, F.col("pkgs"))).alias("_pk2"),
        F.sum(F.when(one, F.col("rev"))).alias("_rev1"), F.sum(F.when(one, F.col("pkgs"))).alias("_pk1"),
    )
    c = F.col("customers")
    return sums.select(
        *by, "customers", "repeaters", ratio(F.col("repeaters"), c, 100.0).alias("rpr"), ratio(F.col("_n"), c).alias("orders_per"),
        ratio(F.col("_rev"), c).alias("rev_per"), ratio(F.col("_rev2"), F.col("_rev"), 100.0).alias("rev_rep_share"),
        ratio(F.col("_rev2"), F.col("_pk2")).alias("aov_rep"), ratio(F.col("_rev1"), F.col("_pk1")).alias("aov_one"),
    )


def order_count_histogram(cust: DataFrame, top: int = 5) -> DataFrame:
    """Customers by number of orders, the last class open."""
    return cust.groupBy(F.least(F.col("n"), F.lit(top)).alias("orders")).agg(F.count(F.lit(1)).alias("customers"))


def order_label_counts(packs: DataFrame) -> DataFrame:
    """Packages per order-number label."""
    return packs.where(F.col("customer_nth").isNotNull()).groupBy("customer_nth").agg(F.count(F.lit(1)).alias("pkgs"))


def repurchase_gaps(packs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(gap_days, n): whole 24-hour days between consecutive packages of a customer, gaps under a day left out.

    Two packages on one calendar day are less than 24 hours apart, so only the
    step from the last package of a day to the first of the next active day
    can count. One row per (customer, day) bounds every window by the calendar.
    """
    days = packs.where(F.col("customer").isNotNull()).groupBy(*by, "customer", F.to_date("order_at").alias("day")).agg(
        F.min("order_at").alias("lo"), F.max("order_at").alias("hi")
    )
    before = F.lag("hi").over(W.partitionBy(*by, "customer").orderBy("day"))
    gap = F.floor(seconds_between(F.col("before"), F.col("lo")) / 86400).cast("bigint")
    return (
        days.withColumn("before", before).where(F.col("before").isNotNull())
        .select(*by, gap.alias("gap_days")).where("gap_days > 0")
        .groupBy(*by, "gap_days").agg(F.count(F.lit(1)).alias("n"))
    )


def gap_summary(gaps: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Median and quartiles of the gaps (linear interpolation)."""
    q = {"gap_median": 0.5, "gap_p25": 0.25, "gap_p75": 0.75}
    return gaps.groupBy(*by).agg(F.sum("n").alias("gaps"), *[F.round(F.percentile("gap_days", F.lit(v), F.col("n")), 6).alias(k) for k, v in q.items()])


def gap_histogram(gaps: DataFrame, edges: tuple = GAP_EDGES) -> DataFrame:
    """Gaps per [a, b) bin; longer gaps are left out, empty bins stay."""
    counted = gaps.withColumn("i", bin_index(F.col("gap_days"), edges)).groupBy("i").agg(F.sum("n").alias("n"))
    bins = spine(gaps.sparkSession, "i", list(range(len(edges) - 1)))
    lo = F.array(*[F.lit(e) for e in edges])
    return bins.join(counted, "i", "left").select(
        lo[F.col("i")].alias("from_day"), lo[F.col("i") + 1].alias("to_day"), F.coalesce("n", F.lit(0)).alias("n"))


def cohort_retention(packs: DataFrame, cohorts: tuple[str, ...], until: str) -> DataFrame:
    """Share of each cohort (month of first package) that bought again in each later month, by calendar month."""
    active = packs.where(F.col("customer").isNotNull()).select("customer", "month").distinct()
    first = active.groupBy("customer").agg(F.min("month").alias("cohort")).where(F.col("cohort").isin(*cohorts))
    size = first.groupBy("cohort").agg(F.count(F.lit(1)).alias("size"))
    seen = (
        active.where(F.col("month") <= until).join(first, "customer")
        .groupBy("cohort", "month").agg(F.count(F.lit(1)).alias("buyers"))
    )
    spans = [F.struct(F.lit(c).alias("cohort"), F.lit(m).alias("month"), F.lit(k).alias("offset"))
             for c in cohorts for k, m in enumerate(_months(c, until))]
    grid = packs.sparkSession.range(1).select(F.explode(F.array(*spans)).alias("g")).select("g.*")
    return (
        grid.join(size, "cohort").join(seen, ["cohort", "month"], "left")
        .select("cohort", "month", "offset", "size", F.coalesce("buyers", F.lit(0)).alias("buyers"),
                ratio(F.coalesce("buyers", F.lit(0)), F.col("size"), 100.0).alias("retention"))
    )


def _months(start: str, end: str) -> list[str]:
    """Calendar months 'yyyy-MM' from start to end."""
    y, m = map(int, start.split("-"))
    out = []
    while f"{y:04d}-{m:02d}" <= end:
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def clv_12m(packs: DataFrame, cust: DataFrame, margin: DataFrame, observed_months: int = 5, by: tuple[str, ...] = ()) -> DataFrame:
    """Twelve-month revenue per customer from the observed order rate, and its margin at `cm_pct`."""
    p = packs.groupBy(*by).agg(ratio(F.sum("net"), F.count(F.lit(1))).alias("aov"))
    c = cust.groupBy(*by).agg(ratio(F.sum("n"), F.count(F.lit(1))).alias("orders_per"))
    rev = F.col("aov") * (F.lit(1.0) + (F.col("orders_per") - F.lit(1.0)) * F.lit(12.0) / F.lit(float(observed_months)))
    return beside(beside(p, c, by), margin.select(*by, "cm_pct"), by).select(
        *by, "aov", "orders_per", rev.alias("clv_rev"), F.round(rev * F.col("cm_pct") / F.lit(100.0), 6).alias("clv_margin"))
