"""Product (model) results: roll-up, growth, stock, attach, Pareto, segments and the lists built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bazaarlens.functions.money import beside, ratio
from bazaarlens.functions.names import COLOURS, clean_name, short_name, with_override
from bazaarlens.functions.stats import running_total, value_counts
from bazaarlens.operators.category import allocation_shares, cargo_allocation
from bazaarlens.params import Params


def model_rollup(sales: DataFrame) -> DataFrame:
    """Sums per model; ratios are null where the denominator is zero. First category by (month, barcode)."""
    z = F.lit(0)
    sums = {"gross_units": "gross_sales_qty", "net_units": "net_sales_qty", "ret": "return_qty", "cancel": "cancel_qty",
            "net_rev": "net_revenue", "gross_rev": "gross_revenue", "disc": "discount", "comm": "commission"}
    # one row per (model, barcode) first: variants is then a plain count
    per_sku = sales.where(F.col("model_code").isNotNull()).groupBy("model_code", "barcode").agg(
        F.min(F.when(F.col("category").isNotNull(), F.struct("month", "barcode", "category"))).alias("_c"),
        *[F.sum(c).alias(n) for n, c in sums.items()],
    )
    model = per_sku.groupBy("model_code").agg(
        F.min("_c")["category"].alias("category"),
        *[F.coalesce(F.sum(n), z).alias(n) for n in sums], F.count("barcode").alias("variants"),
    )
    return model.withColumns({
        "asp": ratio(F.col("net_rev"), F.col("net_units")),
        "ret_rate": ratio(F.col("ret"), F.col("gross_units"), 100.0),
        "comm_rate": ratio(F.col("comm"), F.col("net_rev"), 100.0),
    })


def model_month_wide(sales: DataFrame, months: tuple[str, ...]) -> DataFrame:
    """Net revenue (r0, r1, ...) and net units (u0, ...) per model, one column per month, dense zeros."""
    def pick(col: str, m: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("month") == m, F.col(col))), F.lit(0))

    cols = [pick("net_revenue", m).alias(f"r{i}") for i, m in enumerate(months)]
    cols += [pick("net_sales_qty", m).alias(f"u{i}") for i, m in enumerate(months)]
    return sales.where(F.col("model_code").isNotNull()).groupBy("model_code").agg(*cols)


def model_month_matrix(sales: DataFrame, months: tuple[str, ...]) -> DataFrame:
    """(model, month, net_rev, net_units) with a row for every month."""
    wide = model_month_wide(sales, months)
    cells = F.array(*[
        F.struct(F.lit(m).alias("month"), F.col(f"r{i}").alias("net_rev"), F.col(f"u{i}").alias("net_units"))
        for i, m in enumerate(months)
    ])
    return wide.select("model_code", F.explode(cells).alias("c")).select("model_code", "c.month", "c.net_rev", "c.net_units")


def stock_snapshot(sales: DataFrame, snapshot: str) -> DataFrame:
    """Stock, median price, zero-stock and present variants of the snapshot month."""
    now = sales.where((F.col("month") == snapshot) & F.col("model_code").isNotNull())
    base = now.groupBy("model_code").agg(
        F.coalesce(F.sum("stock"), F.lit(0)).alias("stock"), F.count_if(F.col("stock") == 0).alias("oos_var"),
        F.countDistinct("barcode").alias("var_now"),
    )
    prices = value_counts(now.withColumn("price", F.col("current_price").cast("double")), ["model_code"], "price")
    median = prices.groupBy("model_code").agg(F.round(F.percentile("price", F.lit(0.5), F.col("n")), 6).alias("price"))
    return base.join(median, "model_code", "left")


def model_names(sales: DataFrame, overrides: DataFrame | None = None, colours: tuple[str, ...] = COLOURS) -> DataFrame:
    """Most frequent name per model (ties: first in text order), shortened, cleaned, or overridden."""
    counts = sales.where(F.col("model_code").isNotNull()).groupBy("model_code", "name").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.when(F.col("name").isNotNull(), F.struct(-F.col("n"), "name")))["name"]
    mode = counts.groupBy("model_code").agg(F.coalesce(best, F.lit("")).alias("full_name"))
    named = mode.select("model_code", "full_name", clean_name(short_name(F.col("full_name")), colours).alias("name"))
    return with_override(named, overrides, "model_code", "name")


def model_growth(sales: DataFrame, months: tuple[str, ...], full_months: int = 5) -> DataFrame:
    """Means of the first and last two full months, growth, active months, variation, snapshot units."""
    wide = model_month_wide(sales, months)
    r = [F.col(f"r{i}").cast("double") for i in range(len(months))]
    early = (r[0] + r[1]) / F.lit(2.0)
    late = (r[full_months - 2] + r[full_months - 1]) / F.lit(2.0)
    growth = (
        F.when(F.col("h1") > 0, (F.try_divide(F.col("h2"), F.col("h1")) - F.lit(1.0)) * F.lit(100.0))
        .when(F.col("h2") > 0, F.lit(999.0)).otherwise(F.lit(0.0))
    )
    full = r[:full_months]
    mean = sum(full[1:], full[0]) / F.lit(float(full_months))
    spread = [(v - F.col("_mean")) * (v - F.col("_mean")) for v in full]
    std = F.sqrt(sum(spread[1:], spread[0]) / F.lit(float(full_months - 1)))
    active = sum([F.when(v > 0, 1).otherwise(0) for v in r[1:]], F.when(r[0] > 0, 1).otherwise(0))
    last = len(months) - 1
    return wide.select(
        "model_code", *[f"r{i}" for i in range(len(months))], F.col(f"u{last}").alias("snapshot_units"),
        F.col(f"r{last}").alias("snapshot_rev"), early.alias("h1"), late.alias("h2"), mean.alias("_mean"), active.alias("months_active"),
    ).withColumns({"growth": growth, "cv": F.round(F.try_divide(std, F.col("_mean")), 6)}).drop("_mean")


def stock_cover(growth: DataFrame, stock: DataFrame, elapsed_days: int) -> DataFrame:
    """Daily units of the snapshot month and the days its stock lasts."""
    return growth.select("model_code", "snapshot_units").join(stock.select("model_code", "stock"), "model_code", "left").select(
        "model_code", "stock", (F.col("snapshot_units").cast("double") / F.lit(float(elapsed_days))).alias("daily_units"),
    ).withColumn("cover_days", ratio(F.col("stock"), F.col("daily_units")))


def model_packages(lines: DataFrame, packs: DataFrame) -> DataFrame:
    """(package, model) pairs with the package's value and model count, and the pair's own sums."""
    pair = lines.groupBy("package_no", "model").agg(F.sum("net").alias("line_net"), F.sum("commission").alias("line_comm"))
    head = packs.select("package_no", F.col("net").alias("pnet"), F.col("cargo").alias("pcargo"), "models")
    return pair.join(head, "package_no")


def model_attach(pairs: DataFrame) -> DataFrame:
    """Per model: packages, share of them with other models, mean package value."""
    return _attach(pairs).select(F.col("model").alias("model_code"), "pk", "multi", "aov_with")


def _attach(pairs: DataFrame) -> DataFrame:
    alloc = F.try_divide(F.col("pcargo").cast("double") * F.col("line_net").cast("double"), F.col("pnet").cast("double"))
    per = pairs.groupBy("model").agg(
        F.count(F.lit(1)).alias("pk"), F.count_if(F.col("models") > 1).alias("_multi"), F.count_if(F.col("models") == 1).alias("_solo"),
        F.sum("pnet").alias("_pnet"), F.coalesce(F.sum(alloc), F.lit(0.0)).alias("cargo_alloc"),
        F.sum("line_net").alias("orev"), F.sum("line_comm").alias("ocomm"),
    )
    return per.withColumns({
        "multi": ratio(F.col("_multi"), F.col("pk"), 100.0), "solo": ratio(F.col("_solo"), F.col("pk"), 100.0),
        "aov_with": ratio(F.col("_pnet"), F.col("pk")),
        "cargo_pct": F.round(ratio(F.col("cargo_alloc"), F.col("orev"), 100.0), 6),
        "comm_pct_o": ratio(F.col("ocomm"), F.col("orev"), 100.0),
    }).drop("_multi", "_solo", "_pnet")


def model_cargo(pairs: DataFrame) -> DataFrame:
    """Allocated cargo, cargo and commission share, and share of packages with this model alone."""
    return _attach(pairs).select(
        F.col("model").alias("model_code"), F.round("cargo_alloc", 4).alias("cargo_alloc"), "orev", "ocomm", "cargo_pct", "comm_pct_o", "solo")


def pareto(models: DataFrame) -> DataFrame:
    """Models with revenue, their share and the cumulative share in descending order (ties by code)."""
    rev = F.col("net_rev")
    ranked = running_total(models.where(rev > 0), [rev.desc(), F.col("model_code").asc()], "net_rev", "_cum", "_all")
    return ranked.withColumns({
        "rev_share": ratio(rev, F.col("_all"), 100.0), "cum": ratio(F.col("_cum"), F.col("_all"), 100.0),
    }).drop("_cum", "_all")


def segment(min_revenue: float = 1500.0) -> Column:
    """Hero, Rising, Core or Long Tail, by ordered rules."""
    growth = F.col("growth")
    return (
        F.when((F.col("cum") <= 50.5) | (F.col("rev_share") >= 4), "Hero")
        .when((F.col("cum") <= 80) & (growth >= 40) & (F.col("months_active") >= 3), "Rising")
        .when(F.col("cum") <= 80, "Core")
        .when((growth >= 60) & (F.col("h2") >= min_revenue), "Rising")
        .otherwise("Long Tail")
    )


def model_facts(sales: DataFrame, lines: DataFrame, packs: DataFrame, params: Params,
                overrides: DataFrame | None = None, colours: tuple[str, ...] = COLOURS) -> DataFrame:
    """Every per-model figure on one row, before ranking."""
    growth = model_growth(sales, params.months, params.full_months)
    stock = stock_snapshot(sales, params.snapshot)
    attach = _attach(model_packages(lines, packs)).withColumnRenamed("model", "model_code")
    daily = F.col("snapshot_units").cast("double") / F.lit(float(params.elapsed_days))
    return (
        model_rollup(sales).join(growth, "model_code").join(stock, "model_code", "left")
        .join(model_names(sales, overrides, colours).select("model_code", "name"), "model_code", "left")
        .join(attach, "model_code", "left")
        .withColumn("daily_units", daily)
        .withColumn("cover_days", ratio(F.col("stock"), F.col("daily_units")))
    )


def model_table(facts: DataFrame, params: Params) -> DataFrame:
    """Facts with Pareto figures and segment."""
    return pareto(facts).withColumn("segment", segment(params.rising_min_revenue))


def model_ranking(sales: DataFrame, params: Params) -> DataFrame:
    """Sales-side part of the model table: enough for Pareto, segments, trend and concentration."""
    base = model_rollup(sales).join(model_growth(sales, params.months, params.full_months), "model_code")
    return model_table(base, params)


def segment_summary(models: DataFrame) -> DataFrame:
    """Models, revenue, units, means and medians per segment, and share of revenue.

    One aggregation; a median's buffer holds a segment's distinct values, so at most its models.
    """
    per = models.groupBy("segment").agg(
        F.count("model_code").alias("n"), F.sum("net_rev").alias("rev"), F.sum("net_units").alias("units"),
        F.round(F.avg("ret_rate"), 6).alias("ret"), F.round(F.avg("multi"), 6).alias("multi"), F.round(F.avg("cargo_pct"), 4).alias("cargo"),
        *[F.round(F.percentile(c, F.lit(0.5)), 6).alias(c) for c in ("growth", "asp")],
    )
    whole = models.agg(F.sum("net_rev").alias("_all"))
    return per.crossJoin(whole).withColumn("share", ratio(F.col("rev"), F.col("_all"), 100.0)).drop("_all")


def top_model_trend(models: DataFrame, months: tuple[str, ...], k: int = 40) -> DataFrame:
    """Monthly revenue of the k models with most revenue."""
    top = models.where(F.col("net_rev") > 0).orderBy(F.desc("net_rev"), "model_code").limit(k)
    cells = F.array(*[F.struct(F.lit(m).alias("month"), F.col(f"r{i}").alias("net_rev")) for i, m in enumerate(months)])
    return top.select("model_code", F.explode(cells).alias("c")).select("model_code", "c.month", "c.net_rev")


def movers(models: DataFrame, min_revenue: float = 20000.0, min_months: int = 4, k: int = 6) -> DataFrame:
    """The k models that grew and the k that shrank most, among those of size."""
    sized = models.where((F.col("net_rev") > min_revenue) & (F.col("months_active") >= min_months))
    cols = ["model_code", "segment", "growth", "snapshot_rev"]
    up = sized.orderBy(F.desc("growth"), "model_code").limit(k).select(F.lit("up").alias("direction"), *cols)
    down = sized.orderBy(F.asc("growth"), "model_code").limit(k).select(F.lit("down").alias("direction"), *cols)
    return up.unionByName(down)


# --- fixed values: role and action labels ---
ROLE_ANCHOR, ROLE_MAGNET, ROLE_PARTNER, ROLE_EXTRA = "Kâr çapası", "Trafik mıknatısı", "Sepet ortağı", "Tamamlayıcı"
ACTIONS = {
    "hero_magnet": "Stok + reklam; sete çapa yap",
    "hero": "Ölçekle, renk genişlet",
    "rising": "Ayrı reklam, stok 60 gün",
    "core_partner": "Set içine al",
    "core_falling": "İçerik/fiyat revizyonu",
    "core": "Koru",
    "tail_overstock": "Yeni alım yok, setle erit",
    "tail_partner": "Çapraz öneri",
    "tail": "Kupon kapsamında tut",
}
# --- end of fixed values ---


def product_roles(models: DataFrame) -> DataFrame:
    """Role in the basket, and the action that follows from segment, role, growth and cover."""
    role = (
        F.when((F.col("asp") >= 180) & (F.col("cargo_pct") < 21), ROLE_ANCHOR)
        .when(F.col("solo") >= 80, ROLE_MAGNET).when(F.col("multi") >= 35, ROLE_PARTNER).otherwise(ROLE_EXTRA)
    )
    seg, r = F.col("segment"), F.col("role")
    rules = [
        ("hero_magnet", (seg == "Hero") & (r == ROLE_MAGNET)), ("hero", seg == "Hero"), ("rising", seg == "Rising"),
        ("core_partner", (seg == "Core") & (r == ROLE_PARTNER)), ("core_falling", (seg == "Core") & (F.col("growth") < -30)),
        ("core", seg == "Core"), ("tail_overstock", F.col("cover_days") > 365), ("tail_partner", r == ROLE_PARTNER),
    ]
    action = F.when(rules[0][1], ACTIONS[rules[0][0]])
    for name, hit in rules[1:]:
        action = action.when(hit, ACTIONS[name])
    return models.withColumn("role", role).withColumn("action", action.otherwise(ACTIONS["tail"]))


def concentration(models: DataFrame, rising: str = "Rising", by: tuple[str, ...] = ()) -> DataFrame:
    """Share of the five largest models, how many models make 80 % of revenue, the leader, rising models."""
    place = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("net_rev"), "model_code")) if by else None
    top = models.withColumn("_place", place).where("_place <= 5") if by else models.orderBy(F.desc("net_rev"), "model_code").limit(5)
    five = top.groupBy(*by).agg(F.sum("net_rev").alias("_five"))
    lead = F.max_by("model_code", F.struct(F.col("net_rev"), F.col("cum").cast("double") * F.lit(-1.0)))
    whole = models.groupBy(*by).agg(
        F.count(F.lit(1)).alias("models"), F.sum("net_rev").alias("_all"), F.count_if(F.col("cum") < 80).alias("_below"),
        F.max("net_rev").alias("leader_rev"), lead.alias("leader"), F.count_if(F.col("segment") == rising).alias("rising"),
    )
    return beside(whole, five, by).select(
        *by, "models", ratio(F.col("_five"), F.col("_all"), 100.0).alias("top5_share"),
        (F.col("_below") + 1).alias("models_for_80"), ratio(F.col("_below") + 1, F.col("models"), 100.0).alias("models_for_80_pct"),
        "leader", "leader_rev", "rising",
    )


def product_catalog(models: DataFrame, segment_is: str | None = None, category_is: str | None = None,
                    sort_by: str = "net_rev", limit: int | None = None) -> DataFrame:
    """Models filtered by segment and category, sorted by a measure, unknown values last."""
    out = models
    if segment_is:
        out = out.where(F.col("segment") == segment_is)
    if category_is:
        out = out.where(F.col("category") == category_is)
    key = F.col(sort_by).asc_nulls_last() if sort_by == "cover_days" else F.col(sort_by).desc_nulls_last()
    out = out.orderBy(key, "model_code")
    return out.limit(limit) if limit else out


def category_cargo_share(lines: DataFrame, packs: DataFrame) -> DataFrame:
    return allocation_shares(cargo_allocation(lines, packs, "category"), "category")
