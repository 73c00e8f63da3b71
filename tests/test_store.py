"""Tables at rest: versions, moved packages, files in any order, the ledger, and the stream of all reports."""

import datetime as dt
import os
import shutil

import pytest
from test_pipeline import MARKET, ORDER_HEADER, order_rows, write_csv, write_reports

from bazaarlens.sources import reports, tables as at_rest
from bazaarlens.sources.tables import Store, read_files, read_tables, upsert_tables
from bazaarlens.streaming.landing import load_new_reports

STORE_HEADER = ["Tarih", "Tekil Ziyaretçi Sayısı"]


def heads(spark, rows):
    return spark.createDataFrame([(p, None if d is None else dt.datetime.fromisoformat(d), s) for p, d, s in rows], "package_no string, order_at timestamp_ntz, status string")


def lines(spark, rows):
    return spark.createDataFrame(rows, "package_no string, barcode string, qty bigint")


def state(spark, root):
    found = read_tables(spark, root, ("orders", "order_lines"))
    return ({(r["package_no"], r["status"], r["stored_month"]) for r in found["orders"].collect()}, sorted((r["package_no"], r["barcode"], r["qty"], r["stored_month"]) for r in found["order_lines"].collect()))


def test_a_moved_nulled_and_restored_date_leaves_one_row(spark, tmp_path):
    root = str(tmp_path / "t")
    upsert_tables({"orders": heads(spark, [("P1", "2026-05-03", "a"), ("P2", "2026-05-04", "a")]), "order_lines": lines(spark, [("P1", "x", 1), ("P1", "y", 2), ("P2", "x", 3), ("P9", "z", 4)])}, root, 2)
    assert state(spark, root)[1] == [("P1", "x", 1, "2026-05"), ("P1", "y", 2, "2026-05"), ("P2", "x", 3, "2026-05"), ("P9", "z", 4, "none")]
    for date, month in (("2026-06-01", "2026-06"), (None, "none"), ("2026-05-09", "2026-05")):
        upsert_tables({"orders": heads(spark, [("P1", date, str(month))]), "order_lines": lines(spark, [("P1", "x", 7)])}, root, 2)
        assert state(spark, root) == ({("P1", month, month), ("P2", "a", "2026-05")}, [("P1", "x", 7, month), ("P1", "y", 2, month), ("P2", "x", 3, "2026-05"), ("P9", "z", 4, "none")])
    upsert_tables({"orders": heads(spark, [("P9", "2026-06-02", "late")])}, root, 2)  # the header of lines that were there before it
    assert ("P9", "z", 4, "2026-06") in state(spark, root)[1]
    upsert_tables({"order_lines": lines(spark, [("P9", "z", 5), ("P9", "w", 1)])}, root, 2)  # lines alone
    assert [r for r in state(spark, root)[1] if r[0] == "P9"] == [("P9", "w", 1, "2026-06"), ("P9", "z", 5, "2026-06")]
    plan = read_tables(spark, root)["orders"].where("stored_month = '2026-06'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stored_month" in plan


def test_a_load_that_fails_halfway_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    first = {"orders": heads(spark, [("P1", "2026-05-03", "a"), ("P2", "2026-06-04", "a")]), "order_lines": lines(spark, [("P1", "x", 1), ("P2", "x", 3)])}
    assert upsert_tables(first, root, 2) == 1
    before = state(spark, root)
    second = {"orders": heads(spark, [("P1", "2026-07-03", "b"), ("P2", "2026-07-04", "b")]), "order_lines": lines(spark, [("P1", "x", 9), ("P2", "x", 9)])}
    whole = Store.write

    def failing(self, name, rows, replaced=None):
        if name == "order_lines":
            raise OSError("disk full")
        return whole(self, name, rows, replaced)

    monkeypatch.setattr(Store, "write", failing)
    with pytest.raises(OSError):
        upsert_tables(second, root, 2)
    monkeypatch.setattr(Store, "write", whole)
    assert state(spark, root) == before  # the headers were written, but no version names them
    assert upsert_tables(second, root, 2) == 2
    assert state(spark, root)[1] == [("P1", "x", 9, "2026-07"), ("P2", "x", 9, "2026-07")]
    old = read_tables(spark, root, ("orders",), version=1)["orders"]
    assert {(r["package_no"], r["status"]) for r in old.collect()} == {("P1", "a"), ("P2", "a")}
    assert Store(spark, root).prune(keep=1) > 0
    assert state(spark, root)[0] == {("P1", "b", "2026-07"), ("P2", "b", "2026-07")} and Store(spark, root).versions() == [2]


def test_two_loads_from_one_version_cannot_both_publish(spark, tmp_path):
    root = str(tmp_path / "t")
    upsert_tables({"orders": heads(spark, [("P1", "2026-05-03", "a")])}, root, 2)
    one, two = Store(spark, root), Store(spark, root)
    assert one.publish() == 2
    with pytest.raises(RuntimeError, match="load again"):
        two.publish()


@pytest.mark.parametrize("order", [("1", "2"), ("2", "1")])
def test_files_in_any_order_give_one_table(spark, tmp_path, order):
    root = str(tmp_path / "t")
    for name in order:
        folder = tmp_path / f"in{name}"
        folder.mkdir()
        write_csv(folder / f"magaza-raporu-{name}.csv", STORE_HEADER, [["01-05-2026 00:00", {"1": 1, "2": 9}[name]], [f"0{int(name) + 1}-05-2026 00:00", 5]])
        reports.load_batch(spark, str(folder), root, "salt", MARKET)
    assert {(str(r["day"]), r["visitors"]) for r in read_tables(spark, root)["store_daily"].collect()} == {("2026-05-01", 9.0), ("2026-05-02", 5.0), ("2026-05-03", 5.0)}


SALES_HEADER = ["Barkod", "Model Kodu", "Brüt Sipariş Adedi", "Net Ciro"]


def test_a_newer_file_replaces_only_if_it_passes(spark, tmp_path):
    root, folder = str(tmp_path / "t"), tmp_path / "in"
    folder.mkdir()
    net = lambda: {(r["barcode"], float(r["net_revenue"])) for r in read_tables(spark, root)["sales_monthly"].collect()}
    status = lambda: {(r["file_name"].rsplit("/", 1)[-1].removeprefix("mayis-2026-").removesuffix(".csv"), r["status"], r["reason"]) for r in read_files(spark, root).collect()}

    def land(mark, header, rows, at):
        path = folder / f"mayis-2026-satis-raporu{mark}.csv"
        write_csv(path, header, rows)
        os.utime(path, (at, at))
        reports.load_batch(spark, str(folder), root, None, MARKET)

    land("-a", SALES_HEADER, [["b1", "m", 3, "10,5"]], 100)
    assert net() == {("b1", 10.5)}
    land("-b", ["Barkod", "x"], [["b1", 1]], 200)
    land("-c", SALES_HEADER, [], 300)
    land("-d", SALES_HEADER, [["", "m", 3, "9"]], 310)  # rows, but none with a key
    assert net() == {("b1", 10.5)}
    land("-f", SALES_HEADER, [["b1", "m", 3, "20"]], 400)
    assert net() == {("b1", 20.0)}
    land("-e", SALES_HEADER, [["b1", "m", 3, "15"]], 350)  # passes, but is older than the one that counts
    assert net() == {("b1", 20.0)}
    assert status() == {("satis-raporu-a", "archived", ""), ("satis-raporu-b", "refused", "missing columns: Brüt Sipariş Adedi"), ("satis-raporu-c", "refused", "no rows"),
                        ("satis-raporu-d", "refused", "no rows"), ("satis-raporu-e", "archived", ""), ("satis-raporu-f", "active", "")}
    land("-f", SALES_HEADER, [["b1", "m", 3, "21"]], 500)  # the same name with other content
    assert net() == {("b1", 21.0)} and sorted(s for n, s, _ in status() if n.endswith("-f")) == ["active", "archived"]


def test_one_entry_a_file_however_often_it_is_loaded(spark, tmp_path):
    root, folder = str(tmp_path / "t"), tmp_path / "in"
    folder.mkdir()
    write_reports(folder)
    assert reports.load_batch(spark, str(folder), root, "salt", MARKET, slots=2)
    log, version = read_tables(spark, root)["uploads"].count(), Store(spark, root).version
    assert log == read_files(spark, root).count() == 9
    assert reports.load_batch(spark, str(folder), root, "salt", MARKET, slots=2) == {}
    os.utime(folder / "magaza-raporu.csv", (2_000_000_000, 2_000_000_000))  # another time, the same content
    reports.load_batch(spark, str(folder), root, "salt", MARKET, slots=2)
    assert read_tables(spark, root)["uploads"].count() == log and read_files(spark, root).count() == 9 and Store(spark, root).version == version


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    jobs = []
    for n in (2, 12):
        folder = tmp_path / str(n)
        folder.mkdir()
        for k in range(n):
            write_csv(folder / f"magaza-raporu-{k}.csv", STORE_HEADER, [[f"{k + 1:02}-05-2026 00:00", k]])
        spark.sparkContext.setJobGroup(f"files{n}", "")
        assert reports.load_reports(spark, str(folder), None, MARKET)["store_daily"].count() == n
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"files{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_headers_of_all_kinds(spark, tmp_path):
    """Quotes, line breaks and commas in names, a byte order mark, names that occur twice or not at all; parquet beside CSV."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    odd = ["Tarih", 'a "b", c', "x\ny", "x2", "", "Tekil Ziyaretçi Sayısı", "iki", "iki"]
    write_csv(tmp_path / "magaza-raporu-1.csv", odd, [["01-05-2026 00:00", 1, 2, 3, 4, 5, 6, 7]])
    (tmp_path / "magaza-raporu-2.csv").write_bytes("﻿Tarih,Tekil Ziyaretçi Sayısı\r\n02-05-2026 00:00,8\r\n".encode())
    pq.write_table(pa.table({"Tarih": ["03-05-2026 00:00"], "Tekil Ziyaretçi Sayısı": ["9"]}), tmp_path / "magaza-raporu-3.parquet")
    pq.write_table(pa.table({"x": ["03-05-2026 00:00"]}), tmp_path / "magaza-raporu-4.parquet")
    (tmp_path / "magaza-raporu-5.csv").write_bytes(b"")
    files = reports.inspected(spark, reports.listed(reports.landed_files(spark, str(tmp_path))))
    names = {f["file_name"][-5 - (f["file_name"].endswith("t") * 4) :][0]: f["header"] for f in files}
    assert names["1"] == ["Tarih", 'a "b", c', "x\ny", "x2", "_c4", "Tekil Ziyaretçi Sayısı", "iki6", "iki7"] and names["2"] == ["Tarih", "Tekil Ziyaretçi Sayısı"]
    found = reports.load_reports(spark, str(tmp_path), None, MARKET)
    assert {(r["day"].day, r["visitors"]) for r in found["store_daily"].collect()} == {(1, 5.0), (2, 8.0), (3, 9.0)}
    assert [r["missing_columns"] for r in found["refused"].collect()] == ["Tarih"]  # a file of no bytes isn't there for Spark


def test_all_reports_land_by_stream_as_by_batch(spark, tmp_path):
    batch, stream, landing, checkpoint = str(tmp_path / "b"), str(tmp_path / "s"), tmp_path / "in", str(tmp_path / "cp")
    landing.mkdir()
    whole = tmp_path / "all"
    whole.mkdir()
    write_reports(whole)
    counts = ["Sipariş Adedi", "Sipariş Payı", "Müşteri Adedi", "Müşteri Payı"]
    write_csv(whole / "mayis-2026-siparis-dagilim-yas.csv", ["dimension", "Yaş", *counts], [["Yaş", "18-24", 3, "40", 2, "30"]])
    write_csv(whole / "temmuz-2026-satis-raporu.csv", ["Barkod", "x"], [["b1", 1]])
    reports.load_batch(spark, str(whole), batch, "salt", MARKET, slots=2)
    names = sorted(p.name for p in whole.iterdir())
    for part in (names[::2], names[1::2]):
        for name in part:
            shutil.copy(whole / name, landing / name)
        load_new_reports(spark, str(landing), stream, checkpoint, "salt", MARKET, slots=2)
    load_new_reports(spark, str(landing), stream, checkpoint, "salt", MARKET, slots=2)
    one, two = read_tables(spark, batch), read_tables(spark, stream)
    assert set(one) == set(two) == {"products", "sales_monthly", "orders", "order_lines", "distribution", "store_daily", "ops_monthly", "ad_campaigns", "uploads"}
    for name in one:
        plain = [sorted(str(tuple(r)) for r in t[name].drop("uploaded_at").collect()) for t in (one, two)]
        assert plain[0] == plain[1] and plain[0], name
    assert sorted((r["file_name"].rsplit("/", 1)[-1], r["status"]) for r in read_files(spark, batch).collect()) == sorted((r["file_name"].rsplit("/", 1)[-1], r["status"]) for r in read_files(spark, stream).collect())


def test_order_lines_of_replaced_files_stay_with_their_package(spark, tmp_path):
    root, folder = str(tmp_path / "t"), tmp_path / "in"
    folder.mkdir()
    write_csv(folder / "nisan-2026-tum-siparisler.csv", ORDER_HEADER, order_rows(4, 12))
    reports.load_batch(spark, str(folder), root, "salt", MARKET, slots=2)
    moved = [[*r[:2], "05.05.2026 10:00", *r[3:]] for r in order_rows(4, 3, "İade edildi")]
    write_csv(folder / "nisan-2026-tum-siparisler-2.csv", ORDER_HEADER, moved)
    reports.load_batch(spark, str(folder), root, "salt", MARKET, slots=2)
    found = read_tables(spark, root)
    assert found["orders"].count() == found["orders"].select("package_no").distinct().count() == 12
    assert found["orders"].where("stored_month = '2026-05' and status = 'İade edildi'").count() == 3
    apart = found["order_lines"].join(found["orders"].select("package_no", "stored_month"), ["package_no", "stored_month"], "left_anti")
    assert apart.count() == 0 and at_rest.INDEX in Store(spark, root).folders


def test_coverage_of_stored_tables_reads_no_rows(spark, tmp_path):
    from pyspark.sql import functions as F

    from bazaarlens.operators import coverage
    from bazaarlens.sources.tables import read_month_facts

    root, folder, today = str(tmp_path / "t"), tmp_path / "in", dt.date(2026, 6, 20)
    folder.mkdir()
    write_reports(folder)
    reports.load_batch(spark, str(folder), root, "salt", MARKET, slots=2)
    write_csv(folder / "mayis-2026-siparis-dagilim-yas.csv", ["dimension", "Yaş", "Sipariş Adedi", "x", "Müşteri Adedi", "y"], [["Yaş", "18-24", 3, "40", 2, "30"]])
    write_csv(folder / "magaza-raporu-2.csv", STORE_HEADER, [["02-05-2026 00:00", 7], ["09-05-2026 00:00", 7], ["01-06-2026 00:00", 7]])
    reports.load_batch(spark, str(folder), root, "salt", MARKET, slots=2)
    found, month = read_tables(spark, root), F.date_format("period", "yyyy-MM")
    dated = {n: found[n].withColumn("month", month) for n in ("sales_monthly", "distribution", "ops_monthly")}
    want = coverage.coverage_by_month(dated["sales_monthly"], found["orders"], dated["distribution"], found["store_daily"], dated["ops_monthly"], today)
    got = coverage.covered(read_month_facts(spark, root), today)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()} and got.count() > 8
    assert "FileScan" not in got._jdf.queryExecution().toString()


def test_a_load_broadcasts_no_row_per_package(spark, tmp_path, monkeypatch):
    """Stored tables are guessed at a part of their size: nothing that has a row per package may go through the driver."""
    root, plans = str(tmp_path / "t"), []
    plan_of = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    values, write = at_rest._values, Store.write
    monkeypatch.setattr(at_rest, "_values", lambda rows, columns: (plan_of(rows), values(rows, columns))[1])
    monkeypatch.setattr(Store, "write", lambda self, name, rows, replaced=None: (plan_of(rows), write(self, name, rows, replaced))[1])
    for date in ("2026-05-03", "2026-06-03"):
        upsert_tables({"orders": heads(spark, [("P1", date, "a"), ("P2", date, "a")]), "order_lines": lines(spark, [("P1", "x", 1), ("P2", "x", 3)])}, root, 2)
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)
    assert state(spark, root)[1] == [("P1", "x", 1, "2026-06"), ("P2", "x", 3, "2026-06")]
