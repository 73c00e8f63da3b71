"""The fixture views as plain SQL, for checking each Spark result in another engine."""

from __future__ import annotations

import re

VIEWS = {
    "fx_products": """
SELECT CAST(p_partkey AS VARCHAR) AS barcode, concat(p_brand, '/', p_type) AS model_code, p_name AS name, p_type AS category,
       p_brand AS brand, split_part(p_name, ' ', 1) AS color, CAST(p_size AS VARCHAR) AS size,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(18,4)) AS current_price,
       CASE WHEN p_partkey % 20 = 0 THEN 0 ELSE p_size * 10 END AS stock
FROM part""",
    "fx_money": """
SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_quantity AS BIGINT) AS qty,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(18,5)) AS gross,
       CAST(l_discount AS DECIMAL(4,2)) AS drate, CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS DECIMAL(6,2)) AS commission_rate,
       l_returnflag AS flag, l_quantity
FROM lineitem""",
    "fx_raw": """
SELECT CAST(l_orderkey AS VARCHAR) AS package_no, CAST(l_partkey AS VARCHAR) AS barcode, l_linenumber AS line_no, qty,
       CAST(gross AS DOUBLE) / l_quantity AS unit_price, gross, CAST(gross * drate AS DECIMAL(18,7)) AS discount,
       CAST(gross - CAST(gross * drate AS DECIMAL(18,7)) AS DECIMAL(18,7)) AS net, commission_rate, flag, flag = 'R' AS returned
FROM fx_money""",
    "fx_numbered": """
SELECT *, row_number() OVER (PARTITION BY package_no, barcode ORDER BY line_no, gross, discount, commission_rate) AS rn FROM fx_raw""",
    "fx_order_lines": """
SELECT package_no, barcode, CAST(sum(qty) AS BIGINT) AS qty, max(CASE WHEN rn = 1 THEN unit_price END) AS unit_price,
       CAST(sum(gross) AS DECIMAL(18,7)) AS gross, CAST(sum(discount) AS DECIMAL(18,7)) AS discount,
       CAST(0 AS DECIMAL(18,7)) AS ty_discount, CAST(sum(net) AS DECIMAL(18,7)) AS net,
       max(CASE WHEN rn = 1 THEN commission_rate END) AS commission_rate, bool_or(returned) AS returned
FROM fx_numbered GROUP BY package_no, barcode""",
    "fx_firsts": """
SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "fx_orders": """
SELECT CAST(o.o_orderkey AS VARCHAR) AS package_no, o.o_orderkey AS order_key, concat('S', o.o_orderkey) AS order_no, o.o_orderdate AS order_at,
       CASE WHEN o.o_orderkey % 10 <> 0 THEN o.o_orderdate + to_hours(CAST(o.o_orderkey * 37 % 96 AS INTEGER)) END AS shipped_at,
       CASE WHEN o.o_orderkey % 10 <> 0 AND o.o_orderkey % 13 <> 0
            THEN o.o_orderdate + to_hours(CAST(o.o_orderkey * 37 % 96 + o.o_orderkey * 53 % 160 + 12 AS INTEGER)) END AS delivered_at,
       o_orderpriority AS carrier, o_orderstatus AS status, n_name AS city, c_mktsegment AS district, c_name AS buyer,
       CAST(o_custkey AS VARCHAR) AS customer, CASE WHEN f.o_orderkey IS NOT NULL THEN '1.Sipariş' ELSE '2.Sipariş' END AS customer_nth,
       c_mktsegment AS age_band, CASE o_custkey % 3 WHEN 0 THEN 'Kadın' WHEN 1 THEN 'Erkek' END AS gender,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o.o_orderkey % 70 + 20 AS DECIMAL(10,2)) END AS cargo_fee
FROM orders o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN fx_firsts f ON f.o_orderkey = o.o_orderkey""",
    "fx_o": """
SELECT l.*, p.model_code AS model, p.category, CAST(l.net * l.commission_rate * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(18,9)) AS commission
FROM fx_order_lines l JOIN fx_products p USING (barcode)""",
    "fx_pk": """
SELECT package_no, CAST(sum(gross) AS DECIMAL(18,7)) AS gross, CAST(sum(net) AS DECIMAL(18,7)) AS net,
       CAST(sum(discount) AS DECIMAL(18,7)) AS disc, CAST(0 AS DECIMAL(18,7)) AS tydisc, CAST(sum(qty) AS BIGINT) AS units,
       count(DISTINCT barcode) AS lines, count(DISTINCT model) AS models, count(DISTINCT category) AS cats,
       CAST(sum(commission) AS DECIMAL(18,9)) AS commission, bool_or(returned) AS returned
FROM fx_o GROUP BY package_no""",
    "fx_p": """
SELECT h.package_no, h.order_key, h.order_no, strftime(h.order_at, '%Y-%m') AS month, h.order_at, h.shipped_at, h.delivered_at, h.carrier, h.city,
       h.district, h.customer, h.customer_nth, h.age_band, h.gender, h.cargo_fee, k.gross, k.net, k.disc, k.tydisc, k.units, k.lines,
       k.models, k.cats, k.commission, k.returned, h.cargo_fee IS NOT NULL AS cargo_known,
       coalesce(h.cargo_fee, CASE WHEN k.net < 200 THEN 40.99 WHEN k.net < 350 THEN 78.99 ELSE 93.05 END) AS cargo,
       date_diff('second', h.order_at, h.shipped_at) AS s_to_ship, date_diff('second', h.shipped_at, h.delivered_at) AS s_to_deliver,
       date_diff('second', h.order_at, h.delivered_at) AS s_total
FROM fx_orders h JOIN fx_pk k USING (package_no)""",
    "fx_facts": """
SELECT strftime(o_orderdate, '%Y-%m') AS month, r.barcode, r.flag, o_orderstatus AS status, r.qty, r.gross, r.discount, r.net,
       CAST(r.net * r.commission_rate * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(18,9)) AS comm
FROM fx_raw r JOIN orders ON r.package_no = CAST(o_orderkey AS VARCHAR)""",
    "fx_sales": """
SELECT month, barcode, CAST(sum(qty) AS BIGINT) AS gross_order_qty, CAST(sum(qty) AS BIGINT) AS gross_sales_qty,
       CAST(coalesce(sum(qty) FILTER (flag = 'A' AND status = 'O'), 0) AS BIGINT) AS cancel_qty,
       CAST(coalesce(sum(qty) FILTER (flag = 'R'), 0) AS BIGINT) AS return_qty,
       CAST(coalesce(sum(qty) FILTER (NOT (flag = 'R' OR (flag = 'A' AND status = 'O'))), 0) AS BIGINT) AS net_sales_qty,
       sum(gross) AS gross_revenue, sum(discount) AS discount,
       coalesce(sum(net) FILTER (NOT (flag = 'R' OR (flag = 'A' AND status = 'O'))), 0) AS net_revenue, sum(comm) AS commission,
       CAST(coalesce(sum(qty) FILTER (flag = 'A' AND status = 'F'), 0) AS BIGINT) AS "AF",
       CAST(coalesce(sum(qty) FILTER (flag = 'A' AND status = 'O'), 0) AS BIGINT) AS "AO",
       CAST(coalesce(sum(qty) FILTER (flag = 'A' AND status = 'P'), 0) AS BIGINT) AS "AP",
       CAST(coalesce(sum(qty) FILTER (flag = 'R' AND status = 'F'), 0) AS BIGINT) AS "RF",
       CAST(coalesce(sum(qty) FILTER (flag = 'R' AND status = 'O'), 0) AS BIGINT) AS "RO",
       CAST(coalesce(sum(qty) FILTER (flag = 'R' AND status = 'P'), 0) AS BIGINT) AS "RP"
FROM fx_facts GROUP BY month, barcode""",
    "fx_sales_all": """
SELECT s.*, CAST(s.commission AS DOUBLE) / nullif(CAST(s.net_revenue AS DOUBLE), 0) * 100 AS commission_rate,
       CAST(s.net_revenue AS DOUBLE) / nullif(s.net_sales_qty, 0) AS avg_price,
       p.name, p.model_code, p.category, p.color, p.current_price, p.stock
FROM fx_sales s JOIN fx_products p USING (barcode)""",
    "fx_s": "SELECT * FROM fx_sales_all WHERE month BETWEEN '1997-04' AND '1997-09'",
    "fx_dist_rows": """
SELECT month, customer, 'Yaş' AS dimension, age_band AS bucket, '' AS bucket2 FROM fx_p
UNION ALL SELECT month, customer, 'Cinsiyet', coalesce(gender, 'Belirtilmemiş'), '' FROM fx_p
UNION ALL SELECT month, customer, 'Gün ve Saat', CAST(isodow(order_at) - 1 AS VARCHAR),
       concat((order_key % 24) // 3 * 3, '-', (order_key % 24) // 3 * 3 + 3) FROM fx_p
UNION ALL SELECT month, customer, 'Adet Bazlı', CAST(lines AS VARCHAR), '' FROM fx_p
UNION ALL SELECT month, customer, 'Tutar Bazlı', concat(CAST(floor(CAST(net AS DOUBLE) / 250) AS BIGINT) * 250, ' TRY - ',
       CAST(floor(CAST(net AS DOUBLE) / 250) AS BIGINT) * 250 + 250, ' TRY'), '' FROM fx_p
UNION ALL SELECT month, customer, 'Yeni & Mevcut Müşteri', CASE WHEN customer_nth = '1.Sipariş' THEN 'Yeni Müşteri' ELSE 'Mevcut Müşteri' END, '' FROM fx_p
UNION ALL SELECT month, customer, 'Plus', CASE WHEN carrier IN ('1-URGENT', '2-HIGH') THEN 'Plus' ELSE 'Standart' END, '' FROM fx_p""",
    "fx_distribution": """
SELECT month, dimension, bucket, bucket2, count(*) AS orders, count(DISTINCT customer) AS customers
FROM fx_dist_rows GROUP BY month, dimension, bucket, bucket2""",
    "fx_ops_units": """
SELECT month, CAST(sum(qty) AS DOUBLE) AS units, CAST(coalesce(sum(qty) FILTER (flag = 'R'), 0) AS DOUBLE) / sum(qty) * 100 AS returns,
       CAST(coalesce(sum(qty) FILTER (flag = 'R' AND status = 'F'), 0) AS DOUBLE) / sum(qty) * 100 AS defects
FROM fx_facts GROUP BY month""",
    "fx_ops_times": """
SELECT strftime(order_at, '%Y-%m') AS month,
       CAST(sum(date_diff('second', order_at, shipped_at)) AS DOUBLE) / nullif(count(shipped_at) * 3600, 0) AS ship_h,
       CAST(sum(date_diff('second', shipped_at, delivered_at)) AS DOUBLE) / nullif(count(delivered_at) * 3600, 0) AS deliver_h,
       CAST(count(*) FILTER (date_diff('second', order_at, shipped_at) <= 172800) AS DOUBLE) / nullif(count(shipped_at), 0) * 100 AS on_time,
       CAST(count(*) FILTER (date_diff('second', shipped_at, delivered_at) <= 172800) AS DOUBLE) / nullif(count(delivered_at), 0) * 100 AS fast
FROM fx_orders GROUP BY 1""",
    "fx_ops_wide": "SELECT * FROM fx_ops_units JOIN fx_ops_times USING (month)",
    "fx_ops": """
SELECT month, 'Satılan Ürün Adedi' AS metric, units AS value FROM fx_ops_wide
UNION ALL SELECT month, 'İade Oranı', returns FROM fx_ops_wide
UNION ALL SELECT month, 'Kusurlu & Yanlış & Eksik İade Oranı', defects FROM fx_ops_wide
UNION ALL SELECT month, 'Kargoya Teslim Süresi', ship_h FROM fx_ops_wide
UNION ALL SELECT month, 'Müşteriye Teslim Süresi', deliver_h FROM fx_ops_wide
UNION ALL SELECT month, 'Kargoya Zamanında Teslim Oranı', on_time FROM fx_ops_wide
UNION ALL SELECT month, 'Hızlı Teslimatla Oluşan Gönderi Oranı', fast FROM fx_ops_wide""",
    "fx_events": "SELECT CAST(ts AS DATE) AS day, user_id, event_type AS kind, CAST(value AS DECIMAL(12,2)) AS value FROM events",
    "fx_store_base": """
SELECT day, count(*) FILTER (kind = 'view') AS store_views, count(*) FILTER (kind = 'signup') AS followers_gained,
       count(*) FILTER (kind = 'error') AS followers_lost, count(DISTINCT user_id) AS visitors,
       count(DISTINCT user_id) FILTER (kind = 'signup') AS new_visitors, count(*) FILTER (kind = 'purchase') AS store_orders,
       count(*) FILTER (kind IN ('purchase', 'click')) AS total_orders,
       coalesce(sum(value) FILTER (kind = 'purchase'), 0) AS store_revenue,
       coalesce(sum(value) FILTER (kind IN ('purchase', 'click')), 0) AS total_revenue,
       count(DISTINCT user_id) FILTER (kind = 'purchase') AS store_customers,
       count(DISTINCT user_id) FILTER (kind IN ('purchase', 'click')) AS total_customers
FROM fx_events GROUP BY day""",
    "fx_store": """
SELECT *, followers_gained - followers_lost AS followers_total, CAST(followers_gained AS DOUBLE) / nullif(visitors, 0) * 100 AS follow_rate,
       CAST(store_orders AS DOUBLE) / nullif(visitors, 0) * 100 AS customer_rate, store_orders AS store_units, total_orders AS total_units,
       CAST(store_orders AS DOUBLE) / nullif(store_views, 0) * 100 AS store_conversion
FROM fx_store_base""",
    "fx_ads": """
SELECT concat('Kampanya ', user_id % 12) AS name, CASE WHEN (user_id % 12) % 3 = 0 THEN 'Yayında' ELSE 'Durduruldu' END AS status,
       min(day) AS started_on, count(*) FILTER (kind = 'view') AS impressions, count(*) FILTER (kind = 'click') AS clicks,
       count(*) FILTER (kind = 'purchase') AS direct_sales, count(*) FILTER (kind = 'signup') AS indirect_sales,
       sum(value) FILTER (kind = 'purchase') AS direct_revenue, sum(value) FILTER (kind = 'signup') AS indirect_revenue,
       CAST(count(*) FILTER (kind = 'click') AS DECIMAL(18,4)) AS total_budget,
       CAST(count(*) FILTER (kind = 'click') * CAST(0.8 AS DECIMAL(2,1)) AS DECIMAL(18,4)) AS spent
FROM fx_events GROUP BY user_id % 12""",
    "fx_ad_totals": """
SELECT 'panel' AS source, count(*) FILTER (kind = 'view') AS impressions, count(*) FILTER (kind = 'click') AS clicks,
       count(*) FILTER (kind IN ('purchase', 'signup')) AS sales, CAST(sum(value) FILTER (kind IN ('purchase', 'signup')) AS DECIMAL(18,4)) AS revenue,
       CAST(count(*) FILTER (kind = 'click') * CAST(0.88 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS spend FROM fx_events
UNION ALL
SELECT 'meta', count(*), count(*) // 10, count(*) // 100, CAST(sum(value) AS DECIMAL(18,4)), CAST(count(*) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(18,4))
FROM fx_events WHERE kind = 'error'""",
}


def needs(text: str) -> list[str]:
    """Views used by a SQL text, directly or through other views, in definition order."""
    wanted: set[str] = set()
    todo = [text]
    while todo:
        for word in set(re.findall(r"\bfx_\w+", todo.pop())):
            if word in VIEWS and word not in wanted:
                wanted.add(word)
                todo.append(VIEWS[word])
    return [v for v in VIEWS if v in wanted]


def with_views(sql: str) -> str:
    """Prefix a query (which may start with its own WITH) by the views it uses."""
    ctes = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in needs(sql))
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
