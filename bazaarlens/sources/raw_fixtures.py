"""Raw report rows as an export would hold them, written as text from the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from bazaarlens.functions.parsing import MONTH_SHORT
from bazaarlens.operators.core import ops_pivot
from bazaarlens.operators.ingest import key_slot
from bazaarlens.session import shuffles_removed
from bazaarlens.sources.catalog import report_file_catalog
from bazaarlens.sources.fixtures import DIM_AGE, DIM_AMOUNT, DIM_GENDER, DIM_HOUR, DIM_NEW, DIM_PLUS, DIM_QTY, Fixture

FILE_MONTHS = ("Ocak", "Şubat", "Mart", "Nisan", "may_s", "Haziran", "Temmuz", "Ağustos", "eyl_l", "Ekim", "Kasım", "Aralık")
FILE_PARTS = 16
FILE_KINDS = ("tum-siparisler", "Satış-Raporu", "sat__-raporu", "siparis-dagilim-raporu", "Mağaza-Raporu", "operasyon-raporu",
              "urun-reklamlari-raporu", "diger-rapor")


def pick(values: tuple[str, ...], i: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[i]


def file_rows(fx: Fixture) -> DataFrame:
    """One row per order with the report file it would have come from; every fifth file names no year."""
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    month = pick(FILE_MONTHS, F.month(at) - 1)
    year = F.when(key % 5 != 0, F.concat(F.lit("-"), (F.year(at) + 20).cast("string"))).otherwise("")
    kind = pick(FILE_KINDS, (key % 8).cast("int"))
    return fx.table("orders").select(key.alias("order_key"), at.alias("order_at"), F.concat(month, year, F.lit("-"), kind, F.lit(".xlsx")).alias("file_name"))


def file_list(fx: Fixture) -> DataFrame:
    """The files, with the time they landed; the name as an aggregate, so it is parsed once per file."""
    seen = file_rows(fx).groupBy(F.col("file_name").alias("_group")).agg(
        F.max("file_name").alias("file_name"), F.count(F.lit(1)).alias("row_count"), F.max("order_at").alias("landed_at"))
    return report_file_catalog(seen.drop("_group"))


def uploads(fx: Fixture) -> DataFrame:
    return file_list(fx).withColumnRenamed("landed_at", "uploaded_at")


def number_texts(fx: Fixture) -> DataFrame:
    """Line prices as an export might spell them."""
    slot = F.col("l_partkey") % 8
    price = F.col("l_extendedprice").cast("decimal(14,2)")
    text = price.cast("string")
    spelt = (
        F.when(slot == 0, F.translate(F.format_number(price.cast("double"), 2), ",.", ".,"))
        .when(slot == 1, F.replace(text, F.lit("."), F.lit(",")))
        .when(slot == 2, text)
        .when(slot == 3, F.concat(F.lit("+ "), F.col("l_quantity").cast("int").cast("string")))
        .when(slot == 4, "-").when(slot == 5, "").when(slot == 6, "abc")
    )
    return fx.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", spelt.alias("text"))


def date_texts(fx: Fixture) -> DataFrame:
    """Times of the package headers as text, some of them unreadable."""
    key = F.col("order_key")
    return fx.orders_lite.select(
        "package_no",
        F.when(key % 11 == 0, "bozuk").otherwise(F.date_format("shipped_at", "dd.MM.yyyy HH:mm")).alias("shipped_text"),
        F.when(key % 7 == 0, F.concat(F.lit("31-02-"), F.year("order_at").cast("string"), F.lit(" 00:00"))).otherwise(
            F.date_format("order_at", "dd-MM-yyyy HH:mm")).alias("day_text"),
        F.concat_ws(" ", pick(MONTH_SHORT, F.month("order_at") - 1), F.year("order_at").cast("string")).alias("header_text"),
    )


def raw_sales(fx: Fixture) -> DataFrame:
    """Monthly sales rows with product attributes; the price moves with the month."""
    month = F.substring("month", 6, 2).cast("int")
    return fx.all_sales.select(
        F.to_date(F.concat("month", F.lit("-01"))).alias("period"), F.concat("month", F.lit("-satis-raporu.xlsx")).alias("file_name"),
        "barcode", "model_code", "name", "category", (F.col("current_price") + month).cast("decimal(18,4)").alias("current_price"),
    )


def raw_orders(fx: Fixture) -> DataFrame:
    """Order export rows: line amounts with the package's attributes, unknown on odd lines; some rows twice."""
    head = fx.orders.select("package_no", "order_key", "order_no", "order_at", "shipped_at", "delivered_at", "carrier", "status", "city",
                            "district", "customer", "customer_nth", "age_band", "gender", "cargo_fee")
    rows = fx.raw_lines.join(head, "package_no").withColumns({
        "carrier": F.when(F.col("line_no") % 2 == 0, F.col("carrier")), "desi": (F.col("line_no") * 2).cast("decimal(10,2)")})
    return rows.unionByName(rows.where(F.col("order_key") % 50 == 0)).drop("flag", "returned", "order_key")


def raw_buyers(fx: Fixture) -> DataFrame:
    """Package headers with personal columns, names spelt unevenly."""
    key = F.col("order_key")
    name = F.when(key % 3 == 0, F.upper(F.concat(F.lit("  "), F.replace("buyer", F.lit("#"), F.lit("   ")), F.lit(" ")))).when(
        key % 3 == 1, F.replace("buyer", F.lit("#"), F.lit(" ")))
    return fx.orders_place.select(
        "package_no", name.alias("Alıcı"), F.upper("city").alias("İl"), F.when(key % 7 != 0, F.col("district")).alias("İlçe"),
        F.col("buyer").alias("E-Posta"), F.col("buyer").alias("Teslimat Adresi"), F.col("order_no").alias("Fatura No"))


def raw_sheets(fx: Fixture) -> dict[str, DataFrame]:
    """All distribution sheets, one frame per dimension with its rows numbered; each row comes a second time further down, with other counts."""
    dist = fx.written("distribution", lambda: fx.distribution).withColumn("period", F.to_date(F.concat("month", F.lit("-01"))))
    share = F.lit(0.0)

    def sheet(dimension: str, *first: str) -> DataFrame:
        rows = dist.where(F.col("dimension") == dimension)
        once = rows.select(*first, "orders", share.alias("order_share"), "customers", share.alias("customer_share"), "period", F.lit(1).alias("row_no"))
        return once.unionByName(once.withColumns({"orders": F.col("orders") + 7, "customers": F.col("customers") + 5, "row_no": F.lit(2)}))

    return {d: sheet(d, "bucket", *(["bucket2"] if d == DIM_HOUR else [])) for d in (DIM_AGE, DIM_GENDER, DIM_HOUR, DIM_QTY, DIM_AMOUNT, DIM_NEW, DIM_PLUS)}


def order_export(fx: Fixture) -> DataFrame:
    """The order export under its own headers, with personal columns, a file per month in parts, dealt to them and in order there.

    Rows of every fiftieth package come twice, equal; those of the next come twice with another invoice number.
    """
    lines = fx.table("lineitem").drop("l_returnflag")
    # the label of first orders isn't exported
    head = fx.placed(fx.table("orders")).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "c_mktsegment", "n_name")
    # lines meet headers, come again and are dealt to their files as stored, which is narrower to shuffle and sort than texts
    place, month = F.col("o_orderkey") % 50, pick(FILE_MONTHS, F.month("o_orderdate") - 1)
    copies = F.when(place < 2, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    name = F.concat(F.lit("rapor-"), month, F.lit("-"), F.year("o_orderdate").cast("string"), F.lit("-tum-siparisler"))
    stored = lines.join(head, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("copy", F.explode(copies)).withColumn("file", name)
    # a file's part has whole packages, few enough to be sorted in memory
    dealt = stored.repartition("file", key_slot(["o_orderkey"], FILE_PARTS)).sortWithinPartitions("file", F.col("o_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    more = ["order_key", "order_no", "order_at", "shipped_at", "carrier", "status", "city", "district", "customer", "cargo_fee", "copy", "file"]
    texts = dealt.withColumns({"c_name": F.lit(None).cast("string"), "l_returnflag": F.lit(None).cast("string")})
    rows = fx.line_rows(fx.header_rows(texts, F.lit(None).cast("string"), True, *lines.columns, "l_returnflag", "copy", "file"), *map(F.col, more))
    place = F.col("order_key") % 50
    rows = rows.withColumn("invoice", F.concat(F.lit("F"), "package_no", F.when((place == 1) & (F.col("copy") == 2), "-2").otherwise("")))

    def when(c: str) -> Column:
        return F.date_format(c, "dd.MM.yyyy HH:mm")

    return rows.select(
        F.col("package_no").alias("Paket No"), F.col("order_no").alias("Sipariş Numarası"), when("order_at").alias("Sipariş Tarihi"), when("shipped_at").alias("Kargoya Teslim Tarihi"),
        F.col("carrier").alias("Kargo Firması"), F.col("status").alias("Sipariş Statüsü"), F.concat(F.lit("Ad  "), "customer").alias("Alıcı"), F.col("city").alias("İl"),
        F.col("district").alias("İlçe"), F.col("invoice").alias("Fatura No"), F.col("line_no").cast("string").alias("Stok Kodu"), F.col("barcode").alias("Barkod"), F.col("qty").cast("string").alias("Adet"),
        comma(F.col("gross")).alias("Satış Tutarı"), comma(F.col("discount")).alias("İndirim Tutarı"), comma(F.col("net")).alias("Faturalanacak Tutar"),
        comma(F.col("commission_rate")).alias("Komisyon Oranı"), comma(F.col("cargo_fee")).alias("Faturalanan Kargo Tutarı"),
        "file",
    )


def sales_export(fx: Fixture) -> DataFrame:
    """The sales report under its own headers, a file per month, twenty years on."""
    s = fx.sales_monthly
    named = {"Barkod": "barcode", "Brüt Sipariş Adedi": "gross_order_qty", "İptal Adedi": "cancel_qty", "İade Adedi": "return_qty", "Net Satış Adedi": "net_sales_qty"}
    amounts = {"Brüt Ciro": "gross_revenue", "Net Ciro": "net_revenue", "Toplam Komisyon Tutarı": "commission"}
    month = F.substring("month", 6, 2).cast("int")
    name = F.concat(F.lit("rapor-"), pick(FILE_MONTHS, month - 1), F.lit("-"), (F.substring("month", 1, 4).cast("int") + 20).cast("string"), F.lit("-satis-raporu"))
    return s.select(*[F.col(c).cast("string").alias(h) for h, c in named.items()], *[comma(F.col(c).cast("decimal(18,7)")).alias(h) for h, c in amounts.items()], name.alias("file"))


def header_files(files: DataFrame, header: list[str], mark: str) -> DataFrame:
    """A later file for each one of an export (`file`): its header alone (`value`), with `mark` at the end of its name."""
    return files.select("file").distinct().select(F.lit(",".join(header)).alias("value"), F.concat("file", F.lit(mark)).alias("file"))


def distribution_export(fx: Fixture) -> tuple[DataFrame, DataFrame]:
    """Distribution sheets under their own headers with share columns, those of one bucket and those of two, a file per month; each row comes again with other counts."""
    def under_headers(rows: DataFrame, dimension: str, first: list[str]) -> DataFrame:
        month = pick(FILE_MONTHS, F.month("period") - 1)
        return rows.select(
            F.lit(dimension).alias("dimension"), *[F.col(c).alias(f"Kova {c}") for c in first], F.col("orders").cast("string").alias("Sipariş Adedi"), F.lit("40").alias("Sipariş Payı"),
            F.col("customers").cast("string").alias("Müşteri Adedi"), F.lit("30").alias("Müşteri Payı"),
            F.concat(F.lit("rapor-"), month, F.lit("-"), (F.year("period") + 20).cast("string"), F.lit("-siparis-dagilim")).alias("file"), "row_no")

    sheets = raw_sheets(fx)
    one = reduce(DataFrame.unionByName, [under_headers(rows, d, ["bucket"]) for d, rows in sheets.items() if d != DIM_HOUR])
    return one, under_headers(sheets[DIM_HOUR], DIM_HOUR, ["bucket", "bucket2"])


def ops_export(fx: Fixture) -> tuple[DataFrame, DataFrame]:
    """Two operations reports: the first half of the months and one more, spoilt there, and from that month on."""
    wide = raw_ops(fx)
    metric, note, *months = wide.columns
    half = len(months) // 2
    early = wide.select(metric, note, *[F.col(f"`{m}`") for m in months[:half]], *[F.lit("9").alias(m) for m in months[half : half + 1]], F.lit("operasyon-raporu-1").alias("file"))
    late = wide.select(metric, note, *[F.col(f"`{m}`") for m in months[half:]], F.lit("operasyon-raporu-2").alias("file"))
    return early, late


def land(df: DataFrame, folder: str, order: list[str] | None) -> None:
    """One folder of compressed CSV per value of `file`, its rows in order; `row_no` orders and isn't written. Without `order` rows are dealt and in order already."""
    dealt = (df.repartition("file").sortWithinPartitions("file", *order) if order else df).drop("row_no")
    with shuffles_removed(df.sparkSession):
        dealt.write.option("header", "true").option("emptyValue", "").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").partitionBy("file").csv(folder)


STORE_HEADERS = {
    "Mağaza Görüntülenme Sayısı": "store_views", "Toplam Takipçi Sayısı - Kazanılan": "followers_gained",
    "Toplam Takipçi Sayısı - Kaybedilen": "followers_lost", "Tekil Ziyaretçi Sayısı": "visitors",
    "Ziyaretçinin Takipçiye Dönüş Oranı": "follow_rate", "Mağazanın Brüt Sipariş Adedi": "store_orders", "Mağazanın Brüt Cirosu": "store_revenue",
}
AD_HEADERS = {
    "Reklam Adı": "name", "Reklam Statüsü": "status", "Başlangıç Tarihi": "started_at", "Toplam Bütçe": "total_budget",
    "Harcanan Bütçe": "spent", "Tıklanma": "clicks", "Görüntülenme": "impressions", "Doğrudan Satış Adedi": "direct_sales",
    "Doğrudan Reklam Cirosu": "direct_revenue",
}


def comma(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit("."), F.lit(","))


def raw_store(fx: Fixture) -> DataFrame:
    s = fx.store_daily
    texts = {m: F.col(m).cast("string") for m in STORE_HEADERS.values()}
    texts["followers_gained"] = F.concat(F.lit("+ "), F.col("followers_gained").cast("string"))
    texts["follow_rate"] = comma(F.col("follow_rate").cast("decimal(10,2)"))
    texts["store_revenue"] = F.translate(F.format_number(F.col("store_revenue").cast("double"), 2), ",.", ".,")
    return s.select(F.concat(F.date_format("day", "dd-MM-yyyy"), F.lit(" 00:00")).alias("Tarih"), *[texts[m].alias(h) for h, m in STORE_HEADERS.items()])


def raw_ops(fx: Fixture) -> DataFrame:
    wide = ops_pivot(fx.ops)
    headers = {m: f"{MONTH_SHORT[int(m[5:]) - 1]} {m[:4]}" for m in wide.columns if m != "metric"}
    return wide.select(F.col("metric").alias("Kalite Metriklerim"), F.lit(None).cast("string").alias("Bu yılki performans"),
                       *[F.col(f"`{m}`").cast("string").alias(h) for m, h in headers.items()])


def raw_ads(fx: Fixture) -> DataFrame:
    a = fx.ad_campaigns
    texts = {
        "name": F.col("name"), "status": F.col("status"), "started_at": F.concat(F.date_format("started_on", "yyyy-MM-dd"), F.lit(" 09:30:00")),
        "total_budget": comma(F.col("total_budget").cast("decimal(18,2)")), "spent": comma(F.col("spent").cast("decimal(18,2)")),
        "clicks": F.col("clicks").cast("string"), "impressions": F.col("impressions").cast("string"), "direct_sales": F.col("direct_sales").cast("string"),
        "direct_revenue": comma(F.col("direct_revenue")),
    }
    return a.select(*[texts[m].alias(h) for h, m in AD_HEADERS.items()])
