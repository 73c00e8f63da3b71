"""Landed exports: compressed ones, those dealt to their files before they are texts, and what loading them leaves on disk."""

import gzip
import os

import pytest

from bazaarlens import session
from bazaarlens.plans import queries_ingest
from bazaarlens.sources import raw_fixtures, reports
from bazaarlens.sources.catalog import inspected_files
from bazaarlens.sources.fixtures import Fixture

HEAD = "Paket No,Alıcı,İl,İlçe,Fatura No,Barkod,Adet,Satış Tutarı"
ROWS = ["p1,Ali,X,Y,F1,b1,1,\"1,5\"", "p1,Ali,X,Y,F1,b1,1,\"1,5\"", "p1,Ali,X,Y,F2,b1,1,\"1,5\"", "p1,Ali,X,Y,F1,b1,1,\"1,50\"", "p2,\"a\nb\",X,Y,F1,b1,2,", ",Ali,X,Y,F1,b2,1,3"]
NAME = "rapor-Nisan-2026-tum-siparisler.csv"


def plan(df):
    return df._jdf.queryExecution().toString()


def landed(tmp_path, packed, head=HEAD):
    folder = tmp_path / ("packed" if packed else "plain")
    folder.mkdir()
    data = "\n".join([head, *ROWS, ""]).encode()
    (folder / (NAME + ".gz" * packed)).write_bytes(gzip.compress(data) if packed else data)
    return str(folder)


@pytest.mark.parametrize("head", [HEAD, '﻿"Paket, No","a\nb",c,c', "x" * 300_000 + ",y"])
def test_header_of_a_compressed_export(spark, tmp_path, head):
    plain, packed = (inspected_files(spark, [landed(tmp_path, p, head)], []).first() for p in (False, True))
    assert packed["header"] == plain["header"] and packed["file_name"].endswith(".csv.gz") and packed["digest"] != plain["digest"]


def test_compressed_orders_load_as_plain_ones(spark, tmp_path):
    found = [reports.load_reports(spark, landed(tmp_path, p), "salt", "Pazar") for p in (False, True)]
    for name in ("orders", "order_lines"):
        plain, packed = (sorted(map(str, t[name].collect())) for t in found)
        assert plain == packed and plain
    # of three lines of p1 two differ in a personal column or in their spelling alone; the null package is one, too
    assert {r["package_no"]: float(r["gross"]) for r in found[1]["orders"].collect()} == {"p1": 4.5, "p2": 0.0, None: 3.0}


def test_orders_are_dealt_to_their_files_as_stored(spark, folder, tmp_path):
    export = raw_fixtures.order_export(Fixture(spark, folder))
    logical = export._jdf.queryExecution().optimizedPlan().toString()
    dealt = logical[logical.index("RepartitionByExpression"):]
    assert "date_format" in logical and "date_format" not in dealt and "first" not in logical
    raw_fixtures.land(export, str(tmp_path / "l"), None)
    names = [f for _, _, found in os.walk(tmp_path / "l") for f in found if f.startswith("part-")]
    assert names and all(f.endswith(".csv.gz") for f in names)
    # a folder per month, rows in the order of package and line, a package in one part
    months = [x for x in (tmp_path / "l").iterdir() if x.name.startswith("file=")]
    assert len(months) == export.select("file").distinct().count()
    for month in months[:5]:
        parts = [[(r["Paket No"], r["Stok Kodu"]) for r in spark.read.option("header", "true").csv(str(f)).collect()] for f in month.glob("part-*")]
        assert all(rows == sorted(rows) for rows in parts)
        assert sum(len({p for p, _ in rows}) for rows in parts) == len({p for rows in parts for p, _ in rows})


def test_a_load_removes_its_shuffles_and_keeps_rows_where_they_are(spark, tmp_path, monkeypatch):
    during, write = [], session.materialise
    monkeypatch.setattr(reports, "materialise", lambda df, *a, **b: (during.append((spark.conf.get(session.CLEANUP), plan(df))), write(df, *a, **b))[1])
    before = spark.conf.get(session.CLEANUP, None)
    orders = reports.load_reports(spark, landed(tmp_path, False), "salt", "Pazar")["orders"]
    assert [clean for clean, _ in during] == ["true"] and spark.conf.get(session.CLEANUP, None) == before
    # rows of one package meet in one shuffle
    assert during[0][1].split("== Physical Plan ==")[1].count("Exchange") == 1
    # a file's stamp comes to its rows
    assert "BroadcastHashJoin" in plan(orders) and "SortMergeJoin" not in plan(orders)
    with pytest.raises(ZeroDivisionError), session.shuffles_removed(spark):
        raise ZeroDivisionError
    assert spark.conf.get(session.CLEANUP, None) == before


def test_loaded_orders_come_from_compressed_files(spark, folder):
    loaded = queries_ingest.QUERIES["load_orders"](Fixture(spark, folder))
    headers = Fixture(spark, folder).orders_place.select("package_no", "carrier", "status", "city", "cargo_fee")
    lines = Fixture(spark, folder).raw_lines.select("package_no").distinct()
    same = loaded.select("package_no", "carrier", "status", "city", loaded["cargo_fee"].cast("decimal(10,2)").alias("cargo_fee"))
    assert same.exceptAll(headers.join(lines, "package_no", "left_semi")).count() == 0 and loaded.count() == lines.join(headers, "package_no").count()


def test_files_are_read_in_portions(spark, folder, monkeypatch, tmp_path):
    files = [{"file_name": n, "bytes": b} for n, b in zip("abcde", (5, 5, 1, 30, 2), strict=True)]
    assert [[f["file_name"] for f in p] for p in reports.portions(files, 10)] == [["a", "b"], ["c"], ["d"], ["e"]]
    assert reports.portions([], 10) == [] and reports.portions(files, 100) == [files]
    at = str(tmp_path / "sales")
    raw_fixtures.land(raw_fixtures.sales_export(Fixture(spark, folder)).where("file like '%-2017-%'"), at, ["Barkod"])
    whole, calls = reports.load_reports(spark, at, None, "Pazar")["sales_monthly"], []
    monkeypatch.setattr(reports, "PORTION", 2_000)
    monkeypatch.setattr(reports, "CORE_BYTES", 0)
    monkeypatch.setattr(reports, "materialise", lambda df, *a, **b: (calls.append(1), session.materialise(df, *a, **b))[1])
    parts = reports.load_reports(spark, at, None, "Pazar")["sales_monthly"]
    assert len(calls) > 1 and whole.count() > 0
    assert parts.exceptAll(whole).count() == 0 and whole.exceptAll(parts).count() == 0
