"""Landed exports to tables to result files, in batch and as an incremental load."""

import csv
import datetime as dt
import glob
import json
import os
import subprocess
import sys
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaarlens.operators import sinks
from bazaarlens.params import Params
from bazaarlens.plans.reporting import result_blocks
from bazaarlens.schemas import conform
from bazaarlens.sources import reports
from bazaarlens.sources.tables import read_tables, upsert_tables
from bazaarlens.streaming.landing import load_new_orders

MARKET = "Pazar"
ORDER_HEADER = ["Paket No", "Sipariş Numarası", "Sipariş Tarihi", "Kargoya Teslim Tarihi", "Teslim Tarihi", "Kargo Firması", "Sipariş Statüsü", "Alıcı", "İl", "İlçe",
                "E-Posta", "Müşteri Sipariş Adedi", "Barkod", "Adet", "Satış Tutarı", "İndirim Tutarı", f"{MARKET} İndirim Tutarı", "Faturalanacak Tutar",
                "Birim Fiyatı", "Faturalanan Kargo Tutarı", "Komisyon Oranı"]


def order_rows(month, count, status="Teslim edildi"):
    out = []
    for i in range(count):
        at = dt.datetime(2026, month, 1 + i % 27, 9, 30)
        for line in range(1 + i % 3):
            out.append([f"{month}{i:03d}", f"S{month}{i}", at.strftime("%d.%m.%Y %H:%M"), (at + dt.timedelta(hours=20)).strftime("%d.%m.%Y %H:%M"),
                        (at + dt.timedelta(days=3)).strftime("%d.%m.%Y %H:%M"), "Hızlı Marketplace", status, f"Ad  Soyad {i % 17}", "İzmir", "Konak", "a@b", "1.Sipariş",
                        f"b{(i + line) % 9}", "2", "120,50", "10", "0", "110,50", "60,25", "" if i % 2 else "40,99", "18,6"])
    return out


def write_csv(path, header, rows):
    with open(path, "w", encoding="utf-8", newline="") as f:
        csv.writer(f).writerows([header, *rows])


def write_reports(folder):
    for month, name in ((4, "nisan"), (5, "mayis"), (6, "haziran")):
        rows = order_rows(month, 60)
        write_csv(folder / f"{name}-2026-tum-siparisler.csv", ORDER_HEADER, rows + rows[:5])
        header = ["Barkod", "Model Kodu", "Ürün Adı", "Kategori", "Marka", "Renk", "Beden", "Güncel Satış Fiyatı", "Güncel Stok", "Brüt Sipariş Adedi", "Brüt Satış Adedi",
                  "İptal Adedi", "İade Adedi", "Net Satış Adedi", "Brüt Ciro", "İndirim Tutarı", "Net Ciro", "Toplam Komisyon Tutarı", "Ortalama Komisyon Oranı",
                  "Ortalama Satış Fiyatı", "x1", "x2", "x3", "Vazgeçtim", "Tazmin"]
        sales = [[f"b{i}", f"m{i % 4}", f"Pembe Ürün {i % 4}, 10 m", f"k{i % 2}", "M", "Pembe", "S", "1.250,50", 10 * i, 30, 30, 1, 2, 27, 3000 + i, 100, 2700 + 10 * i * month, "500,25", "18,6",
                  100, "", "", "", i % 3, 0] for i in range(9)]
        write_csv(folder / f"{name}-2026-satis-raporu.csv", header, sales)
    write_csv(folder / "magaza-raporu.csv", ["Tarih", "Tekil Ziyaretçi Sayısı", "Toplam Takipçi Sayısı - Kazanılan"], [["01-05-2026 00:00", "1.250,0", "+ 47"], ["02-05-2026 00:00", "80", "-"]])
    write_csv(folder / "operasyon-raporu.csv", ["Kalite Metriklerim", "Bu yıl", "Nis 2026", "May 2026"], [["İade Oranı", "", "2,5", "3"], ["Süre", "", "-", "20"]])
    write_csv(folder / "urun-reklamlari-raporu.csv", ["Reklam Adı", "Reklam Statüsü", "Başlangıç Tarihi", "Harcanan Bütçe", "Tıklanma"], [["A", "Yayında", "2026-05-01 10:00:00", "1.000,50", "200"]])
    write_csv(folder / "notlar.csv", ["a"], [["1"]])


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    write_reports(folder)
    return reports.load_reports(spark, str(folder), "salt", MARKET)


def test_tables(tables):
    assert set(tables) == {"products", "sales_monthly", "orders", "order_lines", "store_daily", "ops_monthly", "ad_campaigns", "uploads"}
    assert tables["orders"].count() == 180 and tables["orders"].where("cargo_fee is null").count() == 90
    first = tables["order_lines"].where("package_no = '4002' and barcode = 'b2'").first()
    assert (first["qty"], float(first["net"]), float(first["unit_price"])) == (2, 110.5, 60.25)
    assert not {"Alıcı", "E-Posta"} & set(tables["orders"].columns)
    reasons = tables["sales_monthly"].where("barcode = 'b1' and period = date'2026-05-01'").first()["reasons"]
    assert json.loads(reasons) == {"Vazgeçtim": 1}
    assert float(tables["products"].where("barcode = 'b3'").first()["current_price"]) == 1250.5
    store = {str(r["day"]): (r["visitors"], r["followers_gained"]) for r in tables["store_daily"].collect()}
    assert store == {"2026-05-01": (1250.0, 47.0), "2026-05-02": (80.0, None)}
    ops = {(str(r["period"]), r["metric"]): r["value"] for r in tables["ops_monthly"].collect()}
    assert ops == {("2026-04-01", "İade Oranı"): 2.5, ("2026-05-01", "İade Oranı"): 3.0, ("2026-04-01", "Süre"): None, ("2026-05-01", "Süre"): 20.0}
    assert tables["ad_campaigns"].first()["spent"] == 1000.5


def test_result_files(spark, tables, tmp_path):
    day = dt.date(2026, 4, 1)
    given = {
        **tables,
        "ad_totals": spark.createDataFrame([(day, day, "panel", 1000, 100, 10, 5000.0, 400.0, 12.5)], "period_from date, period_to date, source string, "
                                           "impressions bigint, clicks bigint, sales bigint, revenue double, spend double, roas double"),
        "distribution": spark.createDataFrame([(day, "Adet Bazlı", "1", "", 30, 20), (day, "Adet Bazlı", "2", "", 10, 9), (day, f"{MARKET} Plus", "Plus", "", 4, 4)],
                                              "period date, dimension string, bucket string, bucket2 string, orders int, customers int"),
    }
    params = Params(months=("2026-04", "2026-05", "2026-06"), full_months=3, mover_min_revenue=0.0)
    blocks = result_blocks(given, params, MARKET, dt.date(2026, 6, 20))
    assert {"monthly", "products", "clv", "coupons", "coverage_months", "store_funnel", "campaigns", "unattributed_spend", "distribution_totals"} <= set(blocks)
    assert blocks["mix_shares"].first()["single_item_share"] == 75.0 and blocks["mix_shares"].first()["plus_share"] == 100.0
    assert blocks["scenarios"].count() == 24 and blocks["coupons"].count() == 6 and blocks["coverage_years"].first()["months"] == 6
    cost = blocks["margin"].first()
    assert cost["cm"] == pytest.approx(cost["net"] - cost["vat_paid"] - cost["cogs"] - cost["comm"] - cost["cargo"] - cost["fees"] - cost["ad_cost"])
    assert blocks["unit_economics"].count() == 4 and blocks["category_margin"].count() == 2
    assert {r["Vazgeçtim"] for r in blocks["reasons_wide"].where("barcode = 'b2'").collect()} == {2.0} and len(blocks["reasons_wide"].columns) == 23
    assert {"lost_revenue", "run_rate", "category_counts", "last_loads"} <= set(blocks)
    paths = sinks.export_results(blocks, str(tmp_path / "out"))
    assert set(paths) == set(blocks)
    got = {k: spark.read.schema(blocks[k].schema).json(p) for k, p in paths.items()}
    assert all(got[k].count() == blocks[k].count() for k in ("pairs", "multicolor_models", "categories", "margin_curve", "last_loads"))
    assert {r["month"]: r["pkgs"] for r in got["monthly"].collect()} == {"2026-04": 60, "2026-05": 60, "2026-06": 60}
    assert got["totals"].first()["pk"] == 180 and got["products"].agg(F.max("cum")).first()[0] == pytest.approx(100)
    assert got["fulfilment"].first()["h_ship_med"] == 20.0
    schemas = {k: df.schema for k, df in blocks.items()}
    checked = sinks.verify_results(spark, str(tmp_path / "out"), schemas).collect()
    assert {r["name"] for r in checked} == set(blocks) and not [r for r in checked if not r["same"] or r["n_rows"] != r["found_rows"]]
    back = sinks.read_results(spark, str(tmp_path / "out"), schemas)
    for column in back["categories"].columns:  # any wrong column is found
        wrong = back["categories"].withColumn(column, F.lit(None).cast(back["categories"].schema[column].dataType))
        sinks.export_results({"categories": wrong}, str(tmp_path / "wrong" / column.replace("/", "")))
        listed = spark.read.json(str(tmp_path / "out" / sinks.MANIFEST)).where("name = 'categories'").first()["checksum"]
        assert spark.read.json(str(tmp_path / "wrong" / column.replace("/", "") / sinks.MANIFEST)).first()["checksum"] != listed
    os.replace(tmp_path / "out" / sinks.MANIFEST, tmp_path / "gone")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sinks.read_results(spark, str(tmp_path / "out"), schemas)
    csvs = sinks.export_csv(given, str(tmp_path / "csv"))
    assert set(csvs) == set(given) and all(glob.glob(f"{p}/*.csv") for p in csvs.values())


def test_new_files_are_upserted_once(spark, tmp_path):
    landing, root = tmp_path / "in", str(tmp_path / "tables")
    landing.mkdir()
    load = lambda: load_new_orders(spark, str(landing), root, str(tmp_path / "cp"), ORDER_HEADER, "salt", MARKET, slots=4)
    write_csv(landing / "nisan-2026-tum-siparisler.csv", ORDER_HEADER, order_rows(4, 20))
    load()
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "tables" / "orders").rglob("*.parquet")}
    write_csv(landing / "mayis-2026-tum-siparisler.csv", ORDER_HEADER, order_rows(5, 10))
    load()
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "tables" / "orders").rglob("*.parquet")}
    assert all(after.get(p) == t for p, t in before.items())  # another month's folders aren't rewritten
    write_csv(landing / "nisan-2026-tum-siparisler-2.csv", ORDER_HEADER, order_rows(4, 5, "İade edildi"))
    load()
    load()
    orders = read_tables(spark, root)["orders"]
    assert orders.count() == 30 and orders.where("status = 'İade edildi'").count() == 5
    lines = read_tables(spark, root)["order_lines"]
    assert lines.count() == lines.select("package_no", "barcode").distinct().count() == len({(r[0], r[12]) for r in order_rows(4, 20) + order_rows(5, 10)})


def test_streamed_columns_go_by_name(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    swapped = [ORDER_HEADER.index(c) for c in ORDER_HEADER]
    i, j = ORDER_HEADER.index("İl"), ORDER_HEADER.index("İlçe")
    swapped[i], swapped[j] = j, i
    write_csv(landing / "nisan-2026-tum-siparisler.csv", [ORDER_HEADER[k] for k in swapped], [[r[k] for k in swapped] for r in order_rows(4, 3)])
    with pytest.raises(Exception, match="header does not conform"):
        load_new_orders(spark, str(landing), str(tmp_path / "tables"), str(tmp_path / "cp"), ORDER_HEADER, "salt", MARKET)


def test_lines_that_differ_in_a_personal_column_are_two(spark, tmp_path):
    header = [*ORDER_HEADER, "Fatura No"]
    row = order_rows(4, 1)[0]
    write_csv(tmp_path / "nisan-2026-tum-siparisler.csv", header, [[*row, "F1"], [*row, "F2"], [*row, "F2"]])
    tables = reports.load_reports(spark, str(tmp_path), "salt", MARKET)
    line, head = tables["order_lines"].first(), tables["orders"].first()
    assert (line["qty"], float(line["net"]), float(head["net"])) == (4, 221.0, 221.0)
    assert tables["uploads"].first()["row_count"] == 2  # a package and a line


def test_operations_files_of_other_months(spark, tmp_path):
    write_csv(tmp_path / "operasyon-raporu.csv", ["Kalite Metriklerim", "Bu yıl", "Nis 2026", "May 2026"], [["Süre", "", "1", "2"], ["Süre", "", "1", "3"]])
    write_csv(tmp_path / "operasyon-raporu-2.csv", ["Kalite Metriklerim", "Bu yıl", "May 2026", "Haz 2026"], [["Süre", "", "4", "5"]])
    ops = reports.load_reports(spark, str(tmp_path), None, MARKET)["ops_monthly"]
    # the file that sorts last wins, in it the last row
    assert {(str(r["period"])[:7], r["value"]) for r in ops.collect()} == {("2026-04", 1.0), ("2026-05", 3.0), ("2026-06", 5.0)}


def test_distribution_sheets_with_shares(spark, tmp_path):
    counts = ["Sipariş Adedi", "Sipariş Payı", "Müşteri Adedi", "Müşteri Payı"]
    write_csv(tmp_path / "mayis-2026-siparis-dagilim-yas.csv", ["dimension", "Yaş", *counts], [["Yaş", "18-24", 3, "40", 2, "30"], ["Yaş", "18-24", 5, "60", 4, "70"]])
    write_csv(tmp_path / "mayis-2026-siparis-dagilim-saat.csv", ["dimension", "Gün", "Saat", *counts], [["Gün ve Saat", "Pzt", "0-3", 7, "1", 6, "1"]])
    rows = reports.load_reports(spark, str(tmp_path), None, MARKET)["distribution"].collect()
    assert {(r["dimension"], r["bucket"], r["bucket2"], r["orders"], r["customers"]) for r in rows} == {("Yaş", "18-24", "", 3, 2), ("Gün ve Saat", "Pzt", "0-3", 7, 6)}


def test_last_row_of_a_file_counts(spark, tmp_path):
    write_csv(tmp_path / "magaza-raporu.csv", ["Tarih", "Tekil Ziyaretçi Sayısı"], [["01-05-2026 00:00", v] for v in (1, 2, 0)])
    assert reports.load_reports(spark, str(tmp_path), None, MARKET)["store_daily"].first()["visitors"] == 0


def test_tables_survive_storage(spark, tables, tmp_path):
    """What the loader returns, written and read back, gives the same results; a second load changes nothing."""
    given = {**tables, "ad_totals": conform(ad_totals(spark), "ad_totals")}
    for _ in range(2):
        upsert_tables(given, str(tmp_path / "t"), slots=2)
    kept = read_tables(spark, str(tmp_path / "t"))
    params = Params(months=("2026-04", "2026-05", "2026-06"), full_months=3, mover_min_revenue=0.0)
    assert {n: kept[n].count() for n in given if n != "uploads"} == {n: given[n].count() for n in given if n != "uploads"}
    plan = kept["orders"].where("stored_month = '2026-04'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stored_month" in plan
    fresh, stored = (result_blocks(t, params, MARKET) for t in (given, kept))
    assert set(fresh) == set(stored)
    for name in ("monthly", "totals", "products", "clv", "unit_economics", "cohorts"):
        rows = [sorted(str([round(float(v), 6) if isinstance(v, (float, Decimal)) else v for v in r]) for r in t[name].collect()) for t in (fresh, stored)]
        assert rows[0] == rows[1], name


def test_batch_load_with_gate_and_replacement(spark, tmp_path):
    landing, root = tmp_path / "in", str(tmp_path / "tables")
    landing.mkdir()
    write_reports(landing)
    write_csv(landing / "temmuz-2026-satis-raporu.csv", ["Barkod", "x"], [["b1", 1]])
    old = landing / "nisan-2026-tum-siparisler-eski.csv"
    write_csv(old, ORDER_HEADER, order_rows(4, 90))
    os.utime(old, (1, 1))
    loaded = reports.load_batch(spark, str(landing), root, "salt", MARKET, ad_totals=ad_totals(spark), slots=2)
    assert [tuple(r)[1:] for r in loaded["refused"].collect()] == [("sales", "Brüt Sipariş Adedi")]
    found = read_tables(spark, root)
    assert set(found) == {"products", "sales_monthly", "orders", "order_lines", "store_daily", "ops_monthly", "ad_campaigns", "ad_totals", "uploads"}
    assert found["orders"].count() == 180  # the older April file has given way
    assert {r["file_name"]: r["row_count"] for r in found["uploads"].collect()}["nisan-2026-satis-raporu.csv"] == 18
    params = Params(months=("2026-04", "2026-05", "2026-06"), full_months=3, mover_min_revenue=0.0)
    assert {"margin", "coupons", "clv", "last_loads"} <= set(result_blocks(found, params, MARKET))


def ad_totals(spark):
    day = dt.date(2026, 4, 1)
    return spark.createDataFrame([(day, day, "panel", 1000, 100, 10, 5000.0, 400.0, 12.5)], "period_from date, period_to date, source string, "
                                 "impressions bigint, clicks bigint, sales bigint, revenue double, spend double, roas double")


def test_scratch_has_a_lifetime(tmp_path):
    """In a process of its own, as it removes what the application wrote: nothing is left, and a cluster needs a shared folder."""
    code = """
import os, sys
from pyspark.sql import SparkSession
from bazaarlens import session
spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', sys.argv[1]).getOrCreate()
df = session.materialise(spark.range(3), 'x')
assert df.count() == 3 and os.listdir(sys.argv[1])
session.clear_scratch(spark)
assert not [x for x in os.listdir(sys.argv[1]) if x.startswith('bazaarlens')]
"""
    subprocess.run([sys.executable, "-c", code, str(tmp_path)], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=120)
