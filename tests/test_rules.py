"""Small frames for the rules that are easy to lose: nulls, zeros, edges, ties, skewed groups."""

import datetime as dt
import itertools
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.functions import parsing, stats
from bazaarlens.functions.names import clean_name, short_name
from bazaarlens.functions.timing import seconds_between
from bazaarlens.operators import baskets, core, coupons, coverage, customers, fulfilment, ingest, kpis, margin, products
from bazaarlens.params import COUPON_PRESETS, Params, Scenario
from bazaarlens.sources import catalog

T0 = dt.datetime(2026, 5, 1, 10, 0)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_locale_numbers(spark):
    texts = ["1.154", "2,17", "1.154,5", "+ 47", "-", "", "abc", None, "NaN", " 12 ", "1,154.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows(df.select(parsing.locale_number(F.col("t")), parsing.locale_number(F.col("t"), "ads")))
    assert [g[0] for g in got] == [1.154, 2.17, 1154.5, 47.0, None, None, None, None, None, 12.0, 1.1545]
    assert [g[1] for g in got][:3] == [1154.0, 2.17, 1154.5] and got[4][1] is None and got[6][1] is None
    with pytest.raises(ValueError):
        parsing.locale_number(F.col("t"), "other")


def test_dates(spark):
    df = spark.createDataFrame([("01.05.2026 09:07", "05-06-2026 00:00", "Nis 2026"), ("31.02.2026 09:00", "x", "Foo 2026"), (None, None, None)], "a string, b string, c string")
    got = rows(df.select(parsing.report_timestamp(F.col("a")), parsing.report_day(F.col("b")), parsing.month_header(F.col("c"))))
    assert got == [(dt.datetime(2026, 5, 1, 9, 7), dt.date(2026, 6, 5), dt.date(2026, 4, 1)), (None, None, None), (None, None, None)]


def test_seconds_do_not_depend_on_the_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = spark.sql("SELECT timestamp_ntz'2026-03-29 01:30:00' a, timestamp_ntz'2026-03-29 03:30:30' b")
        assert rows(df.select(seconds_between(F.col("a"), F.col("b")), seconds_between(F.col("b"), F.col("a")))) == [(7230, -7230)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_file_names(spark):
    names = ["/x/Eylül-2026-Satış-Raporu.xlsx", "a_ustos-tum-siparisler.xlsx", "eyl_l_sipari_-da__l_m.xlsx", "magaza-raporu-2026.09.01.xlsx",
             "ekim-2025-tum-siparisler-1.xlsx", "not-a-report.xlsx", "may_s-sat__-raporu.xlsx", "kasım 2027 tum-siparisler satis-raporu.xlsx", "Kasım-reklam.xlsx"]
    got = {r["file_name"]: (r["report_type"], str(r["period"])) for r in catalog.report_file_catalog(spark.createDataFrame([(n,) for n in names], "file_name string")).collect()}
    assert got == {
        names[0]: ("sales", "2026-09-01"), names[1]: ("orders", "2026-08-01"), names[2]: ("distribution", "2026-09-01"), names[3]: ("store", "None"),
        names[4]: ("orders", "2025-10-01"), names[6]: ("sales", "2026-05-01"), names[7]: ("orders", "2027-11-01"), names[8]: ("ads", "2026-11-01"),
    }


def test_active_files(spark):
    df = spark.createDataFrame([("a", "sales", dt.date(2026, 5, 1), 1), ("b", "sales", dt.date(2026, 5, 1), 2), ("c", "sales", dt.date(2026, 6, 1), 1),
                                ("d", "ads", None, 1), ("e", "ads", None, 5), ("f", "store", None, 1), ("g", "store", None, 2)],
                               "file_name string, report_type string, period date, landed_at int")
    assert [r[0] for r in rows(catalog.active_files(df).select("file_name"), "file_name")] == ["b", "c", "e", "f", "g"]


def packages(spark, data):
    """(package, customer, order_at, net, city, carrier, nth, shipped hours, delivered hours, returned)."""
    full = []
    for i, d in enumerate(data):
        ship = d.get("ship")
        deliv = d.get("deliv")
        at = d.get("at", T0)
        full.append((f"p{i}", f"o{i}", d.get("customer", "c"), at, at + dt.timedelta(hours=ship) if ship is not None else None,
                     at + dt.timedelta(hours=deliv) if deliv is not None else None, Decimal(str(d.get("net", 100))), d.get("city"), d.get("carrier"),
                     d.get("nth"), d.get("returned", False), d.get("cargo"), 1, 1, 1, 1, Decimal("1")))
    df = spark.createDataFrame(full, "package_no string, order_no string, customer string, order_at timestamp_ntz, shipped_at timestamp_ntz, delivered_at timestamp_ntz, "
                                     "net decimal(18,7), city string, carrier string, customer_nth string, returned boolean, cargo_fee decimal(10,2), units bigint, lines bigint, "
                                     "models bigint, cats bigint, commission decimal(18,9)").withColumn("gross", F.col("net")).withColumn("month", F.date_format("order_at", "yyyy-MM"))
    return core.lead_times(core.impute_cargo(df))


EDGES = [0, 99.99, 100, 199.99, 200, 349.99, 350, 590, 599, 600, 100000, 749.99]


def test_value_bins_and_tiers(spark):
    p = packages(spark, [{"net": n} for n in EDGES] + [{"net": 50, "cargo": Decimal("7.5")}])
    bins = {r["bin"]: r["n"] for r in baskets.amount_bins(p).collect()}
    assert bins == {"<100": 3, "100-149": 1, "150-199": 1, "200-249": 1, "250-299": 0, "300-349": 1, "350-399": 1, "400-499": 0, "500-749": 4, "750+": 0}
    hist = {r["bin_no"]: (r["n"], r["tail_mean"]) for r in baskets.net_histogram(p).collect()}
    assert sum(n for n, _ in hist.values()) == p.count() and hist[59][0] == 5 and hist[58][0] == 0
    assert hist[59][1] == pytest.approx((590 + 599 + 600 + 100000 + 749.99) / 5)
    cargo = {float(r["net"]): (float(r["cargo"]), r["cargo_known"]) for r in p.collect()}
    assert cargo[199.99] == (40.99, False) and cargo[200] == (78.99, False) and cargo[350] == (93.05, False) and cargo[50] == (7.5, True)


def test_empty_bins_have_null_means(spark):
    got = {r["bin"]: r["net"] for r in baskets.amount_bins(packages(spark, [{"net": 10}])).collect()}
    assert got["<100"] == 10 and got["750+"] is None and len(got) == 10


def test_unknown_order_label_counts_as_repeat(spark):
    p = packages(spark, [{"nth": "1.Sipariş"}, {"nth": "2.Sipariş"}, {"nth": None}, {"nth": "1.Sipariş"}])
    assert kpis.monthly_order_kpis(p).first()["repeat_share"] == 50.0


def test_order_kpis_match_plain_python(spark):
    rng = random.Random(3)
    data = [{"customer": f"c{rng.randint(0, 9)}", "net": rng.randint(1, 500), "ship": rng.choice([None, 1, 2, 30]), "deliv": rng.choice([None, 50, 90])} for _ in range(101)]
    got = kpis.monthly_order_kpis(packages(spark, data)).first()
    ships = [d["ship"] for d in data if d["ship"] is not None]
    both = [(d["deliv"] - d["ship"]) / 24 for d in data if d["ship"] is not None and d["deliv"] is not None]
    assert (got["pkgs"], got["orders"], got["customers"]) == (101, 101, len({d["customer"] for d in data}))
    assert got["h_to_ship"] == np.median(ships) and got["d_to_deliv"] == pytest.approx(np.median(both), abs=1e-6)


def test_null_groups_are_left_out(spark):
    p = packages(spark, [{"city": None, "carrier": None, "customer": None}, {"city": "A", "carrier": "X Marketplace", "customer": "c"}])
    assert rows(fulfilment.carrier_scorecard(p).select("carrier", "n")) == [("X", 1)]
    assert customers.customers(p).count() == 1


def test_delivery_bins_are_right_closed(spark):
    p = packages(spark, [{"ship": 1, "deliv": 48, "returned": True}, {"ship": 1, "deliv": 49}, {"ship": 0, "deliv": 0}, {"ship": 1, "deliv": 24 * 31}, {}])
    got = {r["bin"]: (r["n"], r["ret"]) for r in fulfilment.returns_by_delivery_time(p).collect()}
    assert got["≤2"] == (1, 100.0) and got["2-3"] == (1, 0.0) and got["7+"] == (0, None) and sum(n for n, _ in got.values()) == 2


def test_gaps_are_whole_days_between_consecutive_packages(spark):
    hours = [0, 20, 30, 9 * 24, 250 * 24]
    p = packages(spark, [{"customer": "a", "at": T0 + dt.timedelta(hours=h)} for h in hours] + [{"customer": "b"}, {"customer": None}])
    gaps = dict(rows(customers.repurchase_gaps(p)))
    assert gaps == {7: 1, 241: 1}
    assert [r["n"] for r in customers.gap_histogram(customers.repurchase_gaps(p)).orderBy("from_day").collect()] == [0, 1, 0, 0, 0, 0]


def test_gaps_against_brute_force(spark):
    rng = random.Random(5)
    data = [{"customer": f"c{rng.randint(0, 3)}", "at": T0 + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 90))} for _ in range(300)]
    want = {}
    for c in {d["customer"] for d in data}:
        times = sorted(d["at"] for d in data if d["customer"] == c)
        for a, b in zip(times, times[1:]):
            if (b - a).days > 0:
                want[(b - a).days] = want.get((b - a).days, 0) + 1
    assert dict(rows(customers.repurchase_gaps(packages(spark, data)))) == want


def sales(spark, data):
    base = {"model_code": "m", "category": "k", "barcode": "b", "month": "2026-04", "gross_sales_qty": 1, "return_qty": 0, "cancel_qty": 0, "net_sales_qty": 1,
            "net_revenue": 0, "gross_revenue": 0, "discount": 0, "commission": 0, "stock": 0, "current_price": 1.0, "name": "n"}
    full = [{**base, **d} for d in data]
    return spark.createDataFrame(full, "model_code string, category string, barcode string, month string, gross_sales_qty bigint, return_qty bigint, cancel_qty bigint, "
                                       "net_sales_qty bigint, net_revenue bigint, gross_revenue bigint, discount bigint, commission bigint, stock bigint, current_price double, name string"
                                 ).withColumn("net_revenue", F.col("net_revenue").cast("decimal(18,7)"))


def test_growth_rules(spark):
    months = Params().months
    cases = {"new": [0, 0, 0, 5, 5, 1], "none": [0, 0, 0, 0, 0, 3], "flat": [4, 4, 4, 4, 4, 4], "fall": [10, 10, 0, 5, 5, 0], "neg": [-4, 0, 0, 2, 2, 0]}
    data = [{"model_code": k, "barcode": k, "month": m, "net_revenue": v} for k, vs in cases.items() for m, v in zip(months, vs)]
    got = {r["model_code"]: r for r in products.model_growth(sales(spark, data), months).collect()}
    assert got["new"]["growth"] == 999 and got["none"]["growth"] == 0 and got["flat"]["growth"] == 0 and got["fall"]["growth"] == -50 and got["neg"]["growth"] == 999
    assert got["flat"]["cv"] == 0 and got["none"]["cv"] is None and got["none"]["months_active"] == 1 and got["neg"]["months_active"] == 2
    assert got["fall"]["cv"] == pytest.approx(np.std([10, 10, 0, 5, 5], ddof=1) / 6, abs=1e-6)


def test_zero_denominators_are_null(spark):
    r = products.model_rollup(sales(spark, [{"gross_sales_qty": 0, "net_sales_qty": 0}])).first()
    assert r["asp"] is None and r["ret_rate"] is None and r["comm_rate"] is None


def test_pareto_breaks_ties_by_code_and_ends_at_100(spark):
    data = [{"model_code": f"m{i:02d}", "barcode": f"m{i:02d}", "net_revenue": v} for i, v in enumerate([5, 5, 5, 10, -3, 0])]
    got = rows(products.pareto(products.model_rollup(sales(spark, data))).select("model_code", "cum"), "cum")
    assert got == [("m03", 40.0), ("m00", 60.0), ("m01", 80.0), ("m02", 100.0)]


def test_running_total_over_many_slices(spark):
    rng = random.Random(1)
    data = [(f"k{i:04d}", Decimal(rng.choice([1, 1, 1, 7, 100]))) for i in range(2000)]
    df = spark.createDataFrame(data, "code string, v decimal(28,7)").repartition(6)
    got = {r["code"]: (r["run"], r["whole"]) for r in stats.running_total(df, [F.desc("v"), F.asc("code")], "v", "run", "whole").collect()}
    run = Decimal(0)
    for code, v in sorted(data, key=lambda t: (-t[1], t[0])):
        run += v
        assert got[code] == (run, sum(v for _, v in data))


@pytest.mark.parametrize("block,min_n", [(256, 1), (3, 1), (3, 4)])
def test_pairs_against_brute_force(spark, block, min_n):
    rng = random.Random(4)
    carts = [rng.sample(range(30), rng.choice([1, 2, 2, 3, 25])) for _ in range(60)]
    want = {}
    for cart in carts:
        for a, b in itertools.combinations(sorted(f"i{x:02d}" for x in cart), 2):
            want[(a, b)] = want.get((a, b), 0) + 1
    lines = spark.createDataFrame([(f"p{i}", f"i{x:02d}") for i, c in enumerate(carts) for x in c], "package_no string, model string")
    got = {(r["a"], r["b"]): r["n"] for r in baskets.pair_counts(baskets.item_packages(lines, "model"), min_n, block).collect()}
    assert got == {k: n for k, n in want.items() if n >= min_n}


def test_allocated_cargo_adds_up(spark):
    lines = spark.createDataFrame([("p0", "a", Decimal(30)), ("p0", "b", Decimal(70)), ("p1", "a", Decimal(0))], "package_no string, model string, net decimal(18,7)").withColumn("commission", F.lit(1))
    packs = packages(spark, [{"net": 100}, {"net": 0}])
    got = {r["model_code"]: r["cargo_alloc"] for r in products.model_cargo(products.model_packages(lines, packs)).collect()}
    assert got == {"a": pytest.approx(40.99 * 0.3, abs=1e-4), "b": pytest.approx(40.99 * 0.7, abs=1e-4)}


def test_names(spark):
    long = "Pembe Saten Kurdele Çok Uzun Bir Ürün Adı Olan Deneme Satırı – Ekstra Hediye Paketi"
    df = spark.createDataFrame([(long,), ("Bebe Mavi, Güpür Şerit - 10 m",), ("Saten (10 m)",)], "n string")
    got = [r[0] for r in rows(df.select(clean_name(short_name(F.col("n")))))]
    assert got == ["Saten Kurdele Çok Uzun Bir Ürün Adı Olan Deneme Satırı"[:48], "Güpür Şerit", "Saten"]


def test_first_known_value_skips_nulls(spark):
    raw = spark.createDataFrame([("p", "b", 1, 2, None, Decimal(1)), ("p", "b", 2, 3, 9.0, Decimal(2)), ("p", "b", 3, 4, 8.0, None)],
                                "package_no string, barcode string, row_no bigint, qty bigint, unit_price double, net decimal(18,7)")
    raw = raw.withColumns({c: F.col("net") for c in ("gross", "discount", "ty_discount")}).withColumn("commission_rate", F.lit(None).cast("decimal(6,2)"))
    r = core.order_line_rollup(raw).first()
    assert (r["qty"], r["unit_price"], r["net"], r["commission_rate"]) == (9, 9.0, 3, None)


def test_keep_last_is_whole_row_and_upsert_overwrites_with_nulls(spark):
    a = spark.createDataFrame([("1", "x", 5), ("2", "y", 6)], "k string, v string, n int")
    b = spark.createDataFrame([("1", None, 7), ("3", "z", 8)], "k string, v string, n int")
    want = [("1", None, 7), ("2", "y", 6), ("3", "z", 8)]
    assert rows(ingest.union_keep_last([("f1", a), ("f2", b)], ["k"]), "k") == want
    once = ingest.upsert(a, b, ["k"])
    assert rows(once, "k") == want and rows(ingest.upsert(once, b, ["k"]), "k") == want


def test_upsert_table_is_idempotent_and_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("2026-05", "a", 1), ("2026-05", "b", 2), ("2026-06", "a", 3)], "month string, k string, v int")
    ingest.upsert_table(path, batch, ["month", "k"], ["month"])
    untouched = sorted(p.name for p in (tmp_path / "t" / "month=2026-06").iterdir())
    change = spark.createDataFrame([("2026-05", "b", None), ("2026-07", "c", 9)], "month string, k string, v int")
    for _ in range(2):
        ingest.upsert_table(path, change, ["month", "k"], ["month"])
    got = rows(spark.read.schema("k string, v int, month string").parquet(path).select("month", "k", "v"), "month", "k")
    assert got == [("2026-05", "a", 1), ("2026-05", "b", None), ("2026-06", "a", 3), ("2026-07", "c", 9)]
    assert sorted(p.name for p in (tmp_path / "t" / "month=2026-06").iterdir()) == untouched
    with pytest.raises(ValueError):
        ingest.upsert_table(path, change, ["k"], ["month"])


def test_customer_code_needs_salt_and_drops_personal_columns(spark):
    import hashlib

    raw = spark.createDataFrame([("  AYŞE   Kaya ", "İzmir", None, "x@y")], "`Alıcı` string, `İl` string, `İlçe` string, `E-Posta` string")
    out = ingest.pseudonymise_customers(raw, "s")
    key = "  AYŞE   Kaya ".lower().strip().replace("   ", " ") + "|" + "İzmir".lower() + "|"
    assert out.columns == ["İl", "İlçe", "customer_hash"] and out.first()["customer_hash"] == hashlib.sha256(("s" + key).encode()).hexdigest()[:24]
    with pytest.raises(ValueError):
        ingest.pseudonymise_customers(raw, "")


def test_whole_number_columns_are_tightened(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.5, None), (None, 3.0, 2.0, None)], "qty double, unit_price double, x double, empty double")
    assert dict(ingest.tighten_integer_columns(df).dtypes) == {"qty": "bigint", "unit_price": "double", "x": "double", "empty": "double"}


def test_coverage(spark):
    today = dt.date(2026, 9, 17)
    one = lambda m: spark.createDataFrame([(m,)], "month string")
    orders = spark.createDataFrame([(dt.datetime(2026, 8, 31, 5),), (dt.datetime(2026, 9, 1, 5),), (dt.datetime(2026, 10, 3),)], "order_at timestamp_ntz")
    store = spark.createDataFrame([(dt.date(2026, 9, d),) for d in (1, 2, 2, 3)], "day date")
    ops = spark.createDataFrame([("2026-08", None), ("2026-07", 1.0)], "month string, value double")
    got = {(r["report"], r["month"]): (r["n"], r["coverage"]) for r in coverage.coverage_by_month(one("2026-08"), orders, one("2026-08"), store, ops, today).collect()}
    assert got == {("sales", "2026-08"): (1, 1.0), ("orders", "2026-08"): (1, 1.0), ("orders", "2026-09"): (1, 0.062), ("orders", "2026-10"): (1, 1.0),
                   ("distribution", "2026-08"): (1, 1.0), ("store", "2026-09"): (3, 0.188), ("ops", "2026-07"): (1, 1.0)}
    first = coverage.coverage_by_month(one("2026-09"), orders, one("2026-09"), store, ops, dt.date(2026, 9, 1))
    assert {r["coverage"] for r in first.where("report in ('orders', 'store') and month = '2026-09'").collect()} == {1.0}


def tier(v):
    return 40.99 if v < 200 else 78.99 if v < 350 else 93.05


@pytest.mark.parametrize("scenario", [Scenario(), Scenario(0.5, 0.2, 6.99, False)])
def test_coupons_against_a_plain_loop(spark, scenario):
    comm, tacos, pk = 0.19, 0.05, 50
    nets = [69, 70, 71, 99, 139, 140, 141, 199, 200, 205, 245, 249, 250, 279, 281, 349, 350, 355, 380, 399, 400, 449, 700]
    aov = sum(nets) / len(nets)
    s = scenario

    def cm(v):
        return v * (1 - s.cost) / (1 + s.vat) - comm * v - tier(v) - s.fee - (tacos * v if s.ads else 0)

    want = []
    for _, t, d, u, st, g in COUPON_PRESETS:
        cost = rev = gain = 0.0
        for v in nets:
            if v >= t:
                k = u / 100 / 5
                cost, rev = cost + k * d, rev - k * d
                gain += k * (-d / (1 + s.vat) + comm * d + (tacos * d if s.ads else 0) - (tier(v - d) - tier(v)))
            elif v >= 0.7 * t:
                k, paid = st / 100 / 5, t + 10 - d
                cost, rev = cost + k * d, rev + k * (paid - v)
                gain += k * (cm(paid) - cm(v) - (s.cost * (t + 10 - v) - s.cost * (paid - v)) / (1 + s.vat))
        extra, paid = g / 100 * pk / 5, max(t, aov) + 10 - d
        extra_cm = cm(paid) - s.cost * d / (1 + s.vat)
        want.append((cost + extra * d, rev + extra * paid, gain + extra * extra_cm, max(0, -gain / extra_cm) if extra_cm > 0 else None))
    rates = spark.createDataFrame([(comm, tacos, aov, pk)], "comm_rate double, tacos double, aov double, pk bigint")
    values = coupons.package_values(packages(spark, [{"net": n} for n in nets]))
    got = rows(coupons.coupon_scenarios(values, rates, s).orderBy("coupon_no").select("cost", "revenue_change", "margin_change", "breakeven_orders"))
    assert got == [tuple(None if x is None else pytest.approx(x, abs=2e-4) for x in w) for w in want]


def test_breakeven_cost_makes_the_margin_zero(spark):
    totals = spark.createDataFrame([(1000.0, 120.0, 150.0, 10)], "net_o double, cargo_o double, comm_o double, pk bigint")
    rates = spark.createDataFrame([(0.15, 0.05, 100.0, 10)], "comm_rate double, tacos double, aov double, pk bigint")
    c = margin.breakeven_cost_ratio(totals, rates, margin.scenario_table(spark, [Scenario(fee=6.99)])).first()["breakeven_cost"]
    again = margin.contribution_margin(totals, rates, margin.scenario_table(spark, [Scenario(cost=c, fee=6.99)])).first()
    assert 0 < c < 1 and again["cm"] == pytest.approx(0, abs=1e-9)


def test_hot_customer_and_hot_package(spark):
    """A third of all rows on one key: results equal the plain counts."""
    n = 3000
    data = [{"customer": "hot" if i % 3 == 0 else f"c{i % 500}", "at": T0 + dt.timedelta(hours=7 * i)} for i in range(n)]
    p = packages(spark, data)
    got = customers.repeat_summary(customers.customers(p)).first()
    assert got["customers"] == len({d["customer"] for d in data})
    gaps = customers.repurchase_gaps(p).agg(F.sum("n")).first()[0]
    want = 0
    for c in {d["customer"] for d in data}:
        t = sorted(d["at"] for d in data if d["customer"] == c)
        want += sum((b - a).days > 0 for a, b in zip(t, t[1:]))
    assert gaps == want


def test_one_row_results_by_group(spark, folder):
    """Per group of `by`, each result is what it is on the group's rows alone."""
    from bazaarlens.operators import ads, inventory, kpis, products as P
    from bazaarlens.sources.fixtures import Fixture

    fx = Fixture(spark, folder)
    sales, packs = (t.withColumn("seller", F.substring(F.col(c), -1, 1).cast("int") % 2) for t, c in ((fx.sales_table, "barcode"), (fx.packs_table, "package_no")))
    ads_rows = fx.ad_totals.withColumn("seller", F.explode(F.array(F.lit(0), F.lit(1))))
    models = spark.createDataFrame([(k % 2, f"m{k}", Decimal(k * k), float(k), "Rising") for k in range(30)], "seller int, model_code string, net_rev decimal(18,7), cum double, segment string")
    by = ("seller",)
    results = {
        "totals": lambda s, p, a, m, by: kpis.totals(s, p, by), "run_rate": lambda s, p, a, m, by: kpis.run_rate(s, fx.params.snapshot, 22, by=by),
        "oos": lambda s, p, a, m, by: inventory.oos_summary(s, fx.params.snapshot, by=by), "lost": lambda s, p, a, m, by: inventory.lost_revenue(s, fx.params.snapshot, by=by),
        "repeat": lambda s, p, a, m, by: customers.repeat_summary(customers.customers(p, by), by), "gaps": lambda s, p, a, m, by: customers.gap_summary(customers.repurchase_gaps(p, by), by),
        "ads": lambda s, p, a, m, by: ads.ad_totals_kpis(a, s, by=by), "concentration": lambda s, p, a, m, by: P.concentration(m, by=by),
    }
    for name, build in results.items():
        grouped = {r["seller"]: r.asDict() for r in build(sales, packs, ads_rows, models, by).collect()}
        for seller in grouped:
            alone = build(*[t.where(F.col("seller") == seller) for t in (sales, packs, ads_rows, models)], ()).first().asDict()
            for k, v in alone.items():
                got = grouped[seller][k]
                assert got == v or float(got) == pytest.approx(float(v)), (name, k)
