"""Expected results of the cleaning, ingestion, key and sink queries, as SQL."""

from __future__ import annotations

from bazaarlens.plans.oracle_base import VIEWS
from bazaarlens.plans.digests import digest_sql
from bazaarlens.plans.oracle_core import D, RATIO, SALES_KPI

T = lambda c, a=None: f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {a or c}"

FILES = """SELECT o_orderkey, o_orderdate, o_orderkey % 8 AS kind, month(o_orderdate) AS m, CASE WHEN o_orderkey % 5 <> 0 THEN year(o_orderdate) + 20 ELSE 2026 END AS y,
 concat(['Ocak','Şubat','Mart','Nisan','may_s','Haziran','Temmuz','Ağustos','eyl_l','Ekim','Kasım','Aralık'][month(o_orderdate)],
 CASE WHEN o_orderkey % 5 <> 0 THEN concat('-', year(o_orderdate) + 20) ELSE '' END, '-',
 ['tum-siparisler','Satış-Raporu','sat__-raporu','siparis-dagilim-raporu','Mağaza-Raporu','operasyon-raporu','urun-reklamlari-raporu','diger-rapor'][o_orderkey % 8 + 1], '.xlsx') AS file_name FROM orders"""
KIND = "['orders','sales','sales','distribution','store','ops','ads'][kind + 1]"

VIEWS.update({
    "fx_files": f"SELECT file_name, {KIND} AS report_type, make_date(y, m, 1) AS period, count(*) AS row_count, max(o_orderdate) AS landed_at FROM ({FILES}) WHERE kind <> 7 GROUP BY ALL",
    "fx_texts": """
SELECT l_orderkey, l_linenumber, l_partkey % 8 AS slot, CAST(l_extendedprice AS DECIMAL(14,2)) AS price, CAST(l_quantity AS INTEGER) AS q FROM lineitem""",
    "fx_spelt": """
SELECT *, CASE slot WHEN 0 THEN replace(replace(replace(format('{:,.2f}', CAST(price AS DOUBLE)), ',', '#'), '.', ','), '#', '.') WHEN 1 THEN replace(CAST(price AS VARCHAR), '.', ',')
 WHEN 2 THEN CAST(price AS VARCHAR) WHEN 3 THEN '+ ' || q WHEN 4 THEN '-' WHEN 5 THEN '' WHEN 6 THEN 'abc' END AS text FROM fx_texts""",
    "fx_export": """
SELECT r.package_no, r.barcode, r.line_no, r.qty, r.gross, r.discount, r.net, r.commission_rate, CASE WHEN r.line_no % 2 = 0 THEN h.carrier END AS carrier, r.line_no * 2 AS desi, h.cargo_fee
FROM (SELECT DISTINCT * FROM fx_raw) r JOIN fx_orders h USING (package_no)""",
    "fx_late": "SELECT package_no, order_at, 'İade edildi' AS status, CAST(NULL AS VARCHAR) AS carrier, city FROM fx_orders WHERE order_key % 3 = 0",
    "fx_fresh": "SELECT 'N' || package_no AS package_no, order_at, status, carrier, city FROM fx_orders WHERE order_key % 3 = 1",
})

MERGED = f"""SELECT package_no, {T('order_at')}, status, carrier, city FROM (SELECT package_no, order_at, status, carrier, city FROM fx_orders WHERE order_key % 3 <> 0
 UNION ALL SELECT * FROM fx_late UNION ALL SELECT * FROM fx_fresh)"""
NUM = "CAST(CASE slot WHEN 3 THEN q WHEN 4 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN NULL WHEN 7 THEN NULL ELSE price END AS DOUBLE)"
JSON = "concat('{', array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN \"{c}\" <> 0 THEN concat('\"{c}\":', \"{c}\") END" for c in ("AF", "AO", "AP", "RF", "RO", "RP")) + "], lambda x: x IS NOT NULL), ','), '}')"

A = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
EXPORTED_TABLES = digest_sql({
    "products": "SELECT barcode, model_code, name, category, current_price FROM fx_products",
    "sales_monthly": "SELECT month, barcode, net_sales_qty, CAST(net_revenue AS DECIMAL(18,7)) AS net_revenue, AF, AO, AP, RF, RO, RP FROM fx_sales",
    "orders": f"SELECT * EXCLUDE (order_key) REPLACE ({A('order_at')}, {A('shipped_at')}, {A('delivered_at')}) FROM fx_orders",
    "order_lines": "SELECT * EXCLUDE (returned) FROM fx_order_lines", "distribution": "SELECT * FROM fx_distribution",
    "ops_monthly": "SELECT *, CAST(round(value * 1000) AS BIGINT) AS value_scaled FROM fx_ops", "store_daily": f"SELECT * REPLACE ({A('day')}) FROM fx_store",
    "ad_campaigns": f"SELECT * REPLACE ({A('started_on')}) FROM fx_ads", "ad_totals": f"SELECT *, {RATIO('revenue', 'spend')} AS roas FROM fx_ad_totals",
    "uploads": f"SELECT file_name, row_count, {A('landed_at').replace('AS landed_at', 'AS uploaded_at')}, report_type, {A('period')} FROM fx_files",
})


def covered() -> str:
    from bazaarlens.plans import oracle_money

    return oracle_money.SQL["coverage_by_month"]


def exported_results() -> str:
    from bazaarlens.plans import oracle_core, oracle_metrics, oracle_money
    from bazaarlens.plans.queries_ingest import EXPORTED

    known = {**oracle_core.SQL, **oracle_metrics.SQL, **oracle_money.SQL}
    return digest_sql({name: known[name] for name in EXPORTED})


LOADED_SALES = f"""SELECT (CAST(left(month, 4) AS INTEGER) + 20) || right(month, 3) || '-01' AS period, barcode, gross_order_qty, cancel_qty, return_qty, net_sales_qty,
 {D('gross_revenue')} AS gross_revenue, {D('net_revenue')} AS net_revenue, {D('CAST(commission AS DECIMAL(18,7))')} AS commission FROM fx_sales"""
SQL = {
    "report_file_catalog": "SELECT file_name, report_type, CAST(period AS VARCHAR) AS period FROM fx_files",
    "parse_locale_numbers": f"SELECT l_orderkey, l_linenumber, text, {NUM} AS report_value, CAST(CASE slot WHEN 0 THEN price WHEN 1 THEN price WHEN 2 THEN price * 100 END AS DOUBLE) AS ads_value FROM fx_spelt",
    "parse_report_dates": """SELECT package_no, CASE WHEN order_key % 11 <> 0 THEN strftime(date_trunc('minute', shipped_at), '%Y-%m-%d %H:%M:%S') END AS shipped_at,
 CASE WHEN order_key % 7 <> 0 THEN strftime(order_at, '%Y-%m-%d') END AS day, strftime(date_trunc('month', order_at), '%Y-%m-%d') AS period FROM fx_orders""",
    "product_dimension_latest": """SELECT barcode, model_code, name, category, CAST(current_price + CAST(right(month, 2) AS INTEGER) AS DOUBLE) AS current_price
 FROM (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY month DESC) AS rn FROM fx_sales_all) WHERE rn = 1""",
    "sales_monthly_fact": f"""SELECT month AS period, barcode, gross_order_qty, cancel_qty, return_qty, net_sales_qty, {D('gross_revenue')} AS gross_revenue, {D('net_revenue')} AS net_revenue,
 {D('commission')} AS commission, {JSON} AS reasons FROM fx_sales""",
    "package_rollup_ingest": f"""SELECT a.package_no, order_no, {T('order_at')}, {T('shipped_at')}, {T('delivered_at')}, a.carrier, status, city, district, customer, customer_nth, age_band, gender,
 {D('h.cargo_fee')} AS cargo_fee, a.desi, a.gross, a.discount, a.ty_discount, a.net, a.commission FROM (SELECT package_no, max(carrier) AS carrier, CAST(min(desi) AS DOUBLE) AS desi,
 {D('sum(gross)')} AS gross, {D('sum(discount)')} AS discount, 0::DOUBLE AS ty_discount, {D('sum(net)')} AS net,
 {D('sum(CAST(net * commission_rate * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(18,9)))')} AS commission FROM fx_export GROUP BY package_no) a JOIN fx_orders h USING (package_no)""",
    "order_line_rollup": f"SELECT package_no, barcode, qty, unit_price, {D('gross')} AS gross, {D('discount')} AS discount, {D('net')} AS net, {D('commission_rate')} AS commission_rate FROM fx_order_lines",
    "pseudonymise_customers": """SELECT package_no, upper(city) AS city, substr(sha256(concat('fixture-salt', CASE order_key % 3 WHEN 0 THEN lower(replace(buyer, '#', ' ')) WHEN 1 THEN lower(replace(buyer, '#', ' ')) ELSE '' END,
 '|', lower(city), '|', CASE WHEN order_key % 7 <> 0 THEN lower(district) ELSE '' END)), 1, 24) AS customer_hash FROM fx_orders""",
    "distribution_long": "SELECT month || '-01' AS period, dimension, bucket, bucket2, orders, customers FROM fx_distribution",
    "store_daily_normalise": f"""SELECT CAST(day AS VARCHAR) AS day, {D('store_views')} AS store_views, {D('followers_gained')} AS followers_gained, {D('followers_lost')} AS followers_lost, {D('visitors')} AS visitors,
 CAST(CAST(follow_rate AS DECIMAL(10,2)) AS DOUBLE) AS follow_rate, {D('store_orders')} AS store_orders, {D('store_revenue')} AS store_revenue FROM fx_store""",
    "ops_unpivot": "SELECT month || '-01' AS period, metric, value FROM fx_ops",
    "ad_campaigns_normalise": f"""SELECT name, status, strftime(started_on, '%Y-%m-%d 09:30:00') AS started_at, {D('total_budget')} AS total_budget, {D('CAST(spent AS DECIMAL(18,2))')} AS spent, {D('clicks')} AS clicks,
 {D('impressions')} AS impressions, {D('direct_sales')} AS direct_sales, {D('direct_revenue')} AS direct_revenue FROM fx_ads""",
    "union_keep_last": MERGED,
    "upsert": MERGED,
    "upsert_table": """SELECT month, barcode, CASE WHEN month BETWEEN '1997-04' AND '1997-09' AND return_qty > 0 THEN 0 ELSE net_sales_qty END AS net_sales_qty, return_qty FROM fx_sales
 UNION ALL SELECT month, 'N' || barcode, net_sales_qty, return_qty FROM fx_sales WHERE month BETWEEN '1997-04' AND '1997-09'""",
    "upload_manifest": "SELECT file_name, report_type, CAST(period AS VARCHAR) AS period, row_count, '1998-08-17 10:00:00' AS uploaded_at FROM fx_files",
    "export_csv": f"""SELECT 'products' AS table_name, count(*) AS n_rows, {D('sum(current_price)')} AS total FROM fx_products UNION ALL SELECT 'sales_monthly', count(*), {D('sum(net_revenue)')} FROM fx_sales
 UNION ALL SELECT 'orders', count(*), {D('sum(cargo_fee)')} FROM fx_orders UNION ALL SELECT 'order_lines', count(*), {D('sum(net)')} FROM fx_order_lines UNION ALL SELECT 'distribution', count(*), {D('sum(orders)')} FROM fx_distribution
 UNION ALL SELECT 'ops_monthly', count(*), {D('sum(round(value * 1000))')} FROM fx_ops UNION ALL SELECT 'store_daily', count(*), {D('sum(store_revenue)')} FROM fx_store UNION ALL SELECT 'ad_campaigns', count(*), {D('sum(spent)')} FROM fx_ads
 UNION ALL SELECT 'ad_totals', count(*), {D('sum(spend)')} FROM fx_ad_totals UNION ALL SELECT 'uploads', count(*), {D('sum(row_count)')} FROM fx_files""",
    "export_csv_whole": EXPORTED_TABLES,
    "export_results_whole": exported_results,
    "export_csv_sales": f"""SELECT month, barcode, net_sales_qty, {D('net_revenue')} AS net_revenue, """ + ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in ("AF", "AO", "AP", "RF", "RO", "RP")) + " FROM fx_sales",
    "load_orders": f"""SELECT h.package_no, carrier, status, city, x.gross, x.discount, x.net, x.commission, {D('cargo_fee')} AS cargo_fee FROM (SELECT package_no,
 {D('sum(gross * n)')} AS gross, {D('sum(discount * n)')} AS discount, {D('sum(net * n)')} AS net, {D('sum(CAST(net * commission_rate * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(18,9)) * n)')} AS commission
 FROM (SELECT *, CASE WHEN CAST(package_no AS BIGINT) % 50 = 1 THEN 2 ELSE 1 END AS n FROM fx_raw) GROUP BY package_no) x JOIN fx_orders h USING (package_no)""",
    "load_refused_newer": LOADED_SALES,
    "load_empty_newer": LOADED_SALES,
    "load_ops_backwards": "SELECT month || '-01' AS period, metric, value FROM fx_ops",
    "coverage_at_rest": covered,
    "upsert_moved_orders": f"""SELECT package_no, {T('moved', 'order_at')}, strftime(moved, '%Y-%m') AS stored_month, n_lines, qty
 FROM (SELECT package_no, CASE WHEN order_key % 3 = 0 THEN order_at + INTERVAL 40 DAY ELSE order_at END AS moved FROM fx_orders)
 JOIN (SELECT package_no, count(*) AS n_lines, CAST(sum(qty) AS BIGINT) AS qty FROM fx_order_lines GROUP BY package_no) USING (package_no)""",
    "load_ops": "SELECT month || '-01' AS period, metric, value FROM fx_ops",
    "load_distribution": "SELECT (CAST(left(month, 4) AS INTEGER) + 20) || right(month, 3) || '-01' AS period, dimension, bucket, bucket2, orders, customers FROM fx_distribution",
    "export_results": f"SELECT month, gross_units, net_units, net_rev, ret_rate FROM ({SALES_KPI})",
    "tighten_integer_columns": "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS qty, l_quantity AS unit_price, l_discount AS share, CAST(NULL AS DOUBLE) AS unknown FROM lineitem",
    "replace_snapshot": f"""SELECT file_name, report_type, {T('landed_at')} FROM (SELECT *, row_number() OVER (PARTITION BY report_type,
 CASE WHEN report_type IN ('sales', 'orders', 'distribution') THEN strftime(period, '%Y-%m') WHEN report_type = 'ads' THEN '' ELSE file_name END ORDER BY landed_at DESC, file_name DESC) AS rn FROM fx_files) WHERE rn = 1""",
    "validate_report": """SELECT 'prices' AS report, '' AS missing_columns, count(*) AS n_rows, 0::BIGINT AS null_keys, count(*) FILTER (slot = 6) AS bad_values, true AS accepted FROM fx_texts
 UNION ALL SELECT 'orders', '', count(*) + count(*) FILTER (CAST(package_no AS BIGINT) % 50 = 0), count(*) FILTER (line_no % 2 = 1) + count(*) FILTER (line_no % 2 = 1 AND CAST(package_no AS BIGINT) % 50 = 0), 0, true FROM fx_raw
 UNION ALL SELECT 'distribution', 'no_such_column', count(*), 0, 0, false FROM fx_distribution UNION ALL SELECT 'store', '', 0, 0, 0, false""",
}
