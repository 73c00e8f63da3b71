"""Basket results: value bins, size distributions, and products or categories bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bazaarlens.functions.binning import bin_index, labelled_spine, spine
from bazaarlens.functions.money import ratio
from bazaarlens.params import AMOUNT_EDGES, AMOUNT_LABELS, CLIFF_BANDS
from bazaarlens.operators.products import model_names
from bazaarlens.session import dealt, materialise


def amount_bins(packs: DataFrame, edges: tuple = AMOUNT_EDGES, labels: tuple = AMOUNT_LABELS) -> DataFrame:
    """Packages per value bin [a, b): count, means of cargo, net, commission and units, shares of means."""
    sums = packs.withColumn("i", bin_index(F.col("net"), edges)).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"_{c}") for c in ("cargo", "net", "commission", "units")]
    )
    mean = {c: ratio(F.col(f"_{c}"), F.col("n")) for c in ("cargo", "net", "commission", "units")}
    return labelled_spine(packs.sparkSession, "i", "bin", labels).join(sums, "i", "left").select(
        F.col("i").alias("bin_no"), "bin", F.coalesce("n", F.lit(0)).alias("n"), *[v.alias(k) for k, v in mean.items()],
        (F.try_divide(mean["cargo"], mean["net"]) * F.lit(100.0)).alias("cargo_pct"),
        (F.try_divide(mean["commission"], mean["net"]) * F.lit(100.0)).alias("comm_pct"),
    )


def threshold_cliff(packs: DataFrame, bands: tuple = CLIFF_BANDS, low: float = 200, by: tuple[str, ...] = ()) -> DataFrame:
    """Packages just below and above the cargo tiers, with totals."""
    net = F.col("net")
    counts = [F.count_if((net >= a) & (net < b)).alias(f"n_{a}_{b}") for a, b in bands]
    sums = packs.groupBy(*by).agg(
        *counts, F.count_if(net < low).alias("_low"), F.count(F.lit(1)).alias("pk"), F.sum("cargo").alias("cargo_total"),
        F.sum("net").alias("rev_total"), F.sum("commission").alias("comm_total"), F.count_if("cargo_known").alias("_known"),
    )
    return sums.select(
        *by, *[f"n_{a}_{b}" for a, b in bands], ratio(F.col("_low"), F.col("pk"), 100.0).alias("share_under200"), "pk", "cargo_total",
        "rev_total", "comm_total", ratio(F.col("_known"), F.col("pk"), 100.0).alias("cargo_known_share"))


def net_histogram(packs: DataFrame, width: int = 10, bins: int = 60) -> DataFrame:
    """Packages per value class; the last class is open. `tail_mean` is the mean value inside it."""
    top = bins * width - 1
    i = F.floor(F.least(F.col("net"), F.lit(top).cast("decimal(18,7)")) / F.lit(width)).cast("int")
    counts = packs.where(F.col("net") >= 0).groupBy(i.alias("i")).agg(F.count(F.lit(1)).alias("n"), F.sum("net").alias("_net"))
    tail = F.when(F.col("i") == bins - 1, ratio(F.col("_net"), F.col("n")))
    return spine(packs.sparkSession, "i", list(range(bins))).join(counts, "i", "left").select(
        F.col("i").alias("bin_no"), (F.col("i") * width).alias("from_net"), F.coalesce("n", F.lit(0)).alias("n"), tail.alias("tail_mean"))


def basket_size_dists(packs: DataFrame, lines: DataFrame) -> DataFrame:
    """Packages by units, barcodes and models, and lines by quantity; the largest class of each is open."""
    kinds = [("units", 8), ("lines", 5), ("models", 5)]
    sizes = F.array(*[F.struct(F.lit(k).alias("kind"), F.least(F.col(k), F.lit(c)).cast("bigint").alias("size")) for k, c in kinds])
    per_pack = packs.select(F.explode(sizes).alias("s")).select("s.kind", "s.size")
    per_line = lines.select(F.lit("line_qty").alias("kind"), F.least(F.col("qty"), F.lit(6)).cast("bigint").alias("size"))
    return per_pack.unionByName(per_line).groupBy("kind", "size").agg(F.count(F.lit(1)).alias("n"))


def item_packages(lines: DataFrame, item: str) -> DataFrame:
    """Distinct (package, item)."""
    return lines.select("package_no", F.col(item).alias("item")).distinct()


def saved_items(lines: DataFrame, item: str) -> DataFrame:
    """Distinct (package, item), written once: pair counting reads these two narrow columns several times.

    Lines are written first, so that no task holds the tables of their roll-up and of this step at once.
    """
    found = lines.select("package_no", F.col(item).alias("item"))
    return materialise(dealt(found, "package_no", "item", name="line-items").distinct(), "items")


def single_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def pair_counts(items: DataFrame, min_n: int = 1, block: int = 256) -> DataFrame:
    """(a, b, n): packages that hold both items, a < b, at least `min_n` of them.

    Items rarer than `min_n` cannot be in such a pair and go first. A package
    of more than `block` items is cut into blocks of items; its pairs are then
    made block against block in many tasks, each pair once, and are summed
    before they are shuffled. Ordinary packages are a single block. `block`
    only decides how the work of a large package is split, never the result.
    """
    if min_n > 1:
        frequent = single_counts(items).where(F.col("n") >= min_n).select("item")
        items = items.join(frequent, "item", "left_semi")
    large = items.groupBy("package_no").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > block).select(
        "package_no", F.ceil(F.col("_k") / block).cast("int").alias("_blocks"))
    cut = items.join(large, "package_no", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    cut = cut.withColumn("own", F.when(F.col("_blocks") == 1, 0).otherwise(F.pmod(F.xxhash64("item"), F.col("_blocks"))).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        "package_no", "item", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    a, b = met.alias("a"), met.alias("b")
    once = (F.col("a.lo") == F.col("a.hi")) | (F.col("a.own") != F.col("b.own"))
    same = (F.col("a.package_no") == F.col("b.package_no")) & (F.col("a.lo") == F.col("b.lo")) & (F.col("a.hi") == F.col("b.hi"))
    joined = a.join(b, same & (F.col("a.item") < F.col("b.item")) & once)
    pairs = joined.groupBy(F.col("a.item").alias("a"), F.col("b.item").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return pairs.where(F.col("n") >= min_n) if min_n > 1 else pairs


def pair_measures(pairs: DataFrame, singles: DataFrame, n_packages: DataFrame) -> DataFrame:
    """Support %, confidence both ways % and lift. `n_packages` is one row with column `packages`."""
    sa = singles.select(F.col("item").alias("a"), F.col("n").alias("na"))
    sb = singles.select(F.col("item").alias("b"), F.col("n").alias("nb"))
    n, na, nb, whole = (F.col(c).cast("double") for c in ("n", "na", "nb", "packages"))
    support = n / whole
    return pairs.join(sa, "a").join(sb, "b").crossJoin(n_packages).select(
        "a", "b", "n", (support * F.lit(100.0)).alias("support"), (n / na * F.lit(100.0)).alias("conf_ab"),
        (n / nb * F.lit(100.0)).alias("conf_ba"), (support / ((na / whole) * (nb / whole))).alias("lift"))


def package_count(items: DataFrame) -> DataFrame:
    return items.select("package_no").distinct().agg(F.count(F.lit(1)).alias("packages"))


def model_pairs(lines: DataFrame, min_n: int = 12) -> DataFrame:
    """All model pairs with at least `min_n` common packages."""
    items = saved_items(lines, "model")
    return pair_measures(pair_counts(items, min_n), single_counts(items), package_count(items))


def top_pairs(pairs: DataFrame, k: int = 60) -> DataFrame:
    """Pairs with most common packages."""
    return pairs.orderBy(F.desc("n"), "a", "b").limit(k)


def top_pairs_by_lift(pairs: DataFrame, min_n: int = 15, k: int = 30) -> DataFrame:
    """Pairs of at least `min_n` packages with the highest lift."""
    return pairs.where(F.col("n") >= min_n).orderBy(F.desc("lift"), "a", "b").limit(k)


def describe_pairs(pairs: DataFrame, models: DataFrame) -> DataFrame:
    """Name, category, segment and average price of both sides; unknown models keep their code as name."""
    for side in ("a", "b"):
        about = models.select(
            F.col("model_code").alias(side), F.col("name").alias(f"{side}_name"), F.col("category").alias(f"{side}_category"),
            F.col("segment").alias(f"{side}_segment"), F.col("asp").alias(f"{side}_asp"))
        pairs = pairs.join(about, side, "left").withColumns({
            f"{side}_name": F.coalesce(f"{side}_name", side), f"{side}_category": F.coalesce(f"{side}_category", F.lit("")),
            f"{side}_segment": F.coalesce(f"{side}_segment", F.lit("")), f"{side}_asp": F.coalesce(f"{side}_asp", F.lit(0.0)),
        })
    return pairs


def described_pairs(pairs: DataFrame, ranking: DataFrame, sales: DataFrame, **naming) -> DataFrame:
    """`describe_pairs` for a short list of pairs: names are made for its models alone, segments and prices come from the ranking of all."""
    pairs = materialise(pairs, "top-pairs")
    codes = pairs.select(F.col("a").alias("model_code")).unionByName(pairs.select(F.col("b").alias("model_code"))).distinct()
    names = model_names(sales.join(codes, "model_code", "left_semi"), **naming).select("model_code", "name")
    about = ranking.join(codes, "model_code", "left_semi").select("model_code", "category", "segment", "asp")
    return describe_pairs(pairs, about.join(names, "model_code", "left"))


def category_pairs(lines: DataFrame, k: int = 20, hide: tuple[str, ...] = ()) -> DataFrame:
    """Category pairs with most common packages; `hide` leaves categories out of the list."""
    items = saved_items(lines, "category")
    out = pair_measures(pair_counts(items), single_counts(items), package_count(items)).drop("support")
    if hide:
        out = out.where(~F.col("a").isin(*hide) & ~F.col("b").isin(*hide))
    return out.orderBy(F.desc("n"), "a", "b").limit(k)


def pair_advice(pairs: DataFrame) -> DataFrame:
    """Bundle, cross-sell, or leave to volume, by lift."""
    # fixed values: advice labels
    label = F.when(F.col("lift") >= 3, "Set yap").when(F.col("lift") >= 1.2, "Çapraz öner").otherwise("Hacimden kaynaklı: öneri yeterli")
    return pairs.withColumn("advice", label)


def with_names(items: DataFrame, models: DataFrame) -> DataFrame:
    """Name of each model; an unknown one keeps its code."""
    named = models.select(F.col("model_code").alias("model"), "name")
    return items.join(named, "model", "left").withColumn("name", F.coalesce("name", "model"))


def model_barcodes(lines: DataFrame) -> DataFrame:
    """(package, model, k): barcodes of the model in the package; lines are unique on (package, barcode).

    Lines are written first, so that no task holds the tables of their roll-up and of this step at once.
    """
    found = lines.select("package_no", "model", F.col("barcode").isNotNull().alias("known"))
    return dealt(found, "package_no", "model", name="barcodes").groupBy("package_no", "model").agg(F.count_if("known").alias("k"))


def multicolor_packages(lines: DataFrame) -> DataFrame:
    """Packages with several barcodes of one model, among all packages."""
    most = model_barcodes(lines).groupBy("package_no").agg(F.max("k").alias("k"))
    return most.agg(F.count_if(F.col("k") > 1).alias("pk_same_model_multi"), F.count(F.lit(1)).alias("pk"))


def multicolor_models(lines: DataFrame, k: int = 10) -> DataFrame:
    """Models most often bought in several barcodes, and the share of the model's packages."""
    multi = model_barcodes(lines).groupBy("model").agg(F.count_if(F.col("k") > 1).alias("n"), F.count(F.lit(1)).alias("_all")).where("n > 0")
    top = multi.orderBy(F.desc("n"), "model").limit(k).where(F.col("model").isNotNull())
    return top.select("model", "n", ratio(F.col("n"), F.col("_all"), 100.0).alias("share"))


def multiunit_models(lines: DataFrame, min_lines: int = 100, k: int = 10) -> DataFrame:
    """Models with the highest quantity per line, among those with enough lines."""
    per = lines.groupBy("model").agg(F.sum("qty").alias("_q"), F.count(F.lit(1)).alias("lines")).where(F.col("lines") >= min_lines)
    return per.select("model", ratio(F.col("_q"), F.col("lines")).alias("avg_qty"), "lines").orderBy(F.desc("avg_qty"), "model").limit(k)
