"""Expected results of the source, core, monthly and category queries, as SQL."""

D = lambda c: f"CAST({c} AS DOUBLE)"
T = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
RATIO = lambda a, b, s="": f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0){s}"

SALES_COLS = ("month, barcode, name, model_code, category, color, stock, gross_order_qty, gross_sales_qty, cancel_qty, return_qty, net_sales_qty, "
              "CAST(gross_revenue AS DOUBLE) AS gross_revenue, CAST(discount AS DOUBLE) AS discount, CAST(net_revenue AS DOUBLE) AS net_revenue, "
              "CAST(commission AS DOUBLE) AS commission, commission_rate, avg_price, CAST(current_price AS DOUBLE) AS current_price")

MEASURES = """CAST(sum(gross_sales_qty) AS BIGINT) AS gross_sales_qty, CAST(sum(cancel_qty) AS BIGINT) AS cancel_qty,
 CAST(sum(return_qty) AS BIGINT) AS return_qty, CAST(sum(net_sales_qty) AS BIGINT) AS net_sales_qty, CAST(sum(gross_revenue) AS DOUBLE) AS gross_revenue,
 CAST(sum(discount) AS DOUBLE) AS discount, CAST(sum(net_revenue) AS DOUBLE) AS net_revenue, CAST(sum(commission) AS DOUBLE) AS commission"""

MONTHS = ("1997-04", "1997-05", "1997-06", "1997-07", "1997-08", "1997-09")

SALES_KPI = f"""SELECT month, CAST(sum(gross_sales_qty) AS BIGINT) AS gross_units, CAST(sum(cancel_qty) AS BIGINT) AS cancel,
 CAST(sum(return_qty) AS BIGINT) AS ret, CAST(sum(net_sales_qty) AS BIGINT) AS net_units, {D('sum(gross_revenue)')} AS gross_rev,
 {D('sum(discount)')} AS disc, {D('sum(net_revenue)')} AS net_rev, {D('sum(commission)')} AS comm,
 count(*) FILTER (gross_sales_qty > 0) AS skus_sold, {RATIO('sum(cancel_qty)', 'sum(gross_sales_qty)', ' * 100')} AS cancel_rate,
 {RATIO('sum(return_qty)', 'sum(gross_sales_qty)', ' * 100')} AS ret_rate, {RATIO('sum(commission)', 'sum(net_revenue)', ' * 100')} AS comm_rate
 FROM fx_s GROUP BY month"""

ORDER_KPI = f"""SELECT month, count(DISTINCT order_no) AS orders, count(*) AS pkgs, {RATIO('sum(net)', 'count(*)')} AS aov,
 {RATIO('sum(gross)', 'count(*)')} AS aov_gross, {RATIO('sum(units)', 'count(*)')} AS upt, {RATIO('sum(lines)', 'count(*)')} AS lines_per,
 {RATIO('sum(cargo)', 'count(*)')} AS cargo_avg, {RATIO('sum(cargo)', 'sum(net)', ' * 100')} AS cargo_share,
 count(DISTINCT customer) AS customers, {RATIO('count(*) FILTER (lines > 1)', 'count(*)', ' * 100')} AS multi_item,
 round(quantile_cont(s_to_ship, 0.5) / 3600.0, 6) AS h_to_ship, round(quantile_cont(s_to_deliver, 0.5) / 86400.0, 6) AS d_to_deliv,
 {RATIO("count(*) FILTER (customer_nth <> '1.Sipariş')", 'count(*)', ' * 100')} AS repeat_share, {D('sum(net)')} AS order_rev
 FROM fx_p GROUP BY month"""

MIX = """SELECT month,
 CAST(coalesce(sum(orders) FILTER (dimension = 'Yeni & Mevcut Müşteri' AND bucket LIKE 'Yeni%'), 0) AS DOUBLE) / sum(orders) FILTER (dimension = 'Yeni & Mevcut Müşteri') * 100 AS new_share,
 CAST(coalesce(sum(orders) FILTER (dimension = 'Plus' AND bucket LIKE '%Plus%'), 0) AS DOUBLE) / sum(orders) FILTER (dimension = 'Plus') * 100 AS plus_share,
 CAST(coalesce(sum(orders) FILTER (dimension = 'Adet Bazlı' AND bucket = '1'), 0) AS DOUBLE) / sum(orders) FILTER (dimension = 'Adet Bazlı') * 100 AS single_item_share,
 CAST(coalesce(sum(orders) FILTER (dimension = 'Tutar Bazlı' AND bucket LIKE '0 TRY%'), 0) AS DOUBLE) / sum(orders) FILTER (dimension = 'Tutar Bazlı') * 100 AS under250_share,
 CAST(sum(orders) FILTER (dimension = 'Yeni & Mevcut Müşteri') AS BIGINT) AS dist_orders
 FROM fx_distribution GROUP BY month"""

OPS_COLS = {"op_units": "Satılan Ürün Adedi", "op_ret": "İade Oranı", "op_defect": "Kusurlu & Yanlış & Eksik İade Oranı",
            "op_ship_h": "Kargoya Teslim Süresi", "op_deliv_h": "Müşteriye Teslim Süresi",
            "op_ontime": "Kargoya Zamanında Teslim Oranı", "op_fast": "Hızlı Teslimatla Oluşan Gönderi Oranı"}
OPS_MONTH = "SELECT month, " + ", ".join(f"max(value) FILTER (metric = '{m}') AS {c}" for c, m in OPS_COLS.items()) + " FROM fx_ops GROUP BY month"

LINE_COLS = ("package_no, {p}barcode, qty, unit_price, CAST({p}gross AS DOUBLE) AS gross, CAST({p}discount AS DOUBLE) AS discount, "
             "CAST({p}net AS DOUBLE) AS net, CAST({p}commission_rate AS DOUBLE) AS commission_rate")

PACK_COLS = f"""package_no, order_no, month, {T('order_at')}, {T('shipped_at')}, {T('delivered_at')}, carrier, city, customer, customer_nth, age_band, gender,
 CAST(gross AS DOUBLE) AS gross, CAST(net AS DOUBLE) AS net, CAST(disc AS DOUBLE) AS disc, CAST(tydisc AS DOUBLE) AS tydisc, units, lines, models, cats,
 CAST(commission AS DOUBLE) AS commission, returned, CAST(cargo_fee AS DOUBLE) AS cargo_fee"""

SQL = {
    "sales_enriched": f"SELECT {SALES_COLS} FROM fx_s",
    "reasons_wide": 'SELECT month, barcode, CAST("AF" AS DOUBLE) AS "AF", CAST("AO" AS DOUBLE) AS "AO", CAST("AP" AS DOUBLE) AS "AP", '
                    'CAST("RF" AS DOUBLE) AS "RF", CAST("RO" AS DOUBLE) AS "RO", CAST("RP" AS DOUBLE) AS "RP" FROM fx_s',
    "category_month": f"SELECT category, month, {MEASURES} FROM fx_s GROUP BY category, month",
    "order_lines_enriched": f"""SELECT {LINE_COLS.format(p='l.')}, order_no, {T('order_at')}, {T('shipped_at')}, {T('delivered_at')}, carrier, city, customer, customer_nth, strftime(order_at, '%Y-%m') AS month
 FROM fx_order_lines l JOIN fx_orders USING (package_no) WHERE strftime(order_at, '%Y-%m') BETWEEN '1997-04' AND '1997-09'""",
    "distribution_shares": """SELECT month, dimension, bucket, bucket2, orders, customers,
 CAST(orders AS DOUBLE) / greatest(sum(orders) OVER w, 1) * 100 AS order_share, CAST(customers AS DOUBLE) / greatest(sum(customers) OVER w, 1) * 100 AS customer_share
 FROM fx_distribution WINDOW w AS (PARTITION BY month, dimension)""",
    "ops_pivot": """SELECT a.metric, CAST(down AS INTEGER) AS place, b.month, c.value FROM (SELECT DISTINCT metric FROM fx_ops) a CROSS JOIN (SELECT month, row_number() OVER (ORDER BY month) - 1 AS up, row_number() OVER (ORDER BY month DESC) - 1 AS down
 FROM (SELECT DISTINCT month FROM fx_ops)) b LEFT JOIN fx_ops c ON c.metric = a.metric AND c.month = b.month""",
    "store_daily_ratios": f"""SELECT CAST(day AS VARCHAR) AS day, store_views, visitors, followers_gained, followers_lost, store_orders, total_orders, {D('store_revenue')} AS store_revenue,
 {D('total_revenue')} AS total_revenue, {RATIO('store_revenue', 'total_revenue', ' * 100')} AS store_revenue_share,
 {RATIO('store_orders', 'total_orders', ' * 100')} AS store_order_share, {RATIO('store_customers', 'total_customers', ' * 100')} AS store_customer_share FROM fx_store""",
    "ad_campaigns_derived": f"""SELECT name, status, {D('total_budget')} AS total_budget, {D('spent')} AS spent, {D('total_budget - spent')} AS remaining_budget,
 coalesce(direct_sales, 0) + coalesce(indirect_sales, 0) AS total_sales, {D('coalesce(direct_revenue, 0) + coalesce(indirect_revenue, 0)')} AS total_ad_revenue FROM fx_ads""",
    "ad_period_cover": f"""SELECT source, CAST(sum(impressions * k) AS BIGINT) AS impressions, CAST(sum(clicks * k) AS BIGINT) AS clicks, CAST(sum(sales * k) AS BIGINT) AS sales, {D('sum(revenue * k)')} AS revenue, {D('sum(spend * k)')} AS spend,
 {RATIO('sum(revenue * k)', 'sum(spend * k)')} AS roas FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY m) <= 3 THEN 2 ELSE 1 END AS k FROM (
 SELECT date_trunc('week', day) AS m, CASE WHEN kind = 'error' THEN 'meta' ELSE 'panel' END AS source, count(*) FILTER (kind IN ('view', 'error')) AS impressions, count(*) FILTER (kind = 'click') AS clicks,
 count(*) FILTER (kind = 'purchase') AS sales, sum(value) FILTER (kind = 'purchase') AS revenue, count(*) * CAST(0.25 AS DECIMAL(3,2)) AS spend FROM fx_events GROUP BY ALL)) GROUP BY source""",
    "ad_totals_by_source": "SELECT " + ", ".join(
        f"max(CASE WHEN source = '{s}' THEN {c} END) AS {s}_{c}" for s in ("panel", "meta") for c in ("impressions", "clicks", "sales"))
        + ", " + ", ".join(f"CAST(max(CASE WHEN source = '{s}' THEN {c} END) AS DOUBLE) AS {s}_{c}" for s in ("panel", "meta") for c in ("revenue", "spend"))
        + ", " + ", ".join(f"max(CASE WHEN source = '{s}' THEN {RATIO('revenue', 'spend')} END) AS {s}_roas" for s in ("panel", "meta")) + " FROM fx_ad_totals",
    "barcode_master": "SELECT DISTINCT barcode, model_code, category FROM fx_s",
    "lines_model_category": f"""SELECT {LINE_COLS.format(p='l.')}, coalesce(m.model_code, l.barcode) AS model, coalesce(m.category, 'Diğer') AS category,
 {D('CAST(l.net * l.commission_rate * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(18,9))')} AS commission, l.returned
 FROM fx_order_lines l LEFT JOIN (SELECT DISTINCT barcode, model_code, category FROM fx_sales_all) m ON l.barcode = m.barcode""",
    "packages": f"SELECT {PACK_COLS} FROM fx_p",
    "cargo_imputed": f"SELECT package_no, {D('net')} AS net, {D('cargo_fee')} AS cargo_fee, cargo_known, {D('cargo')} AS cargo FROM fx_p",
    "lead_times": "SELECT package_no, s_to_ship, s_to_deliver, s_total, s_to_ship / 3600.0 AS h_to_ship, s_to_deliver / 86400.0 AS d_to_deliv, s_total / 86400.0 AS d_total FROM fx_p",
    "monthly_sales_kpis": SALES_KPI,
    "monthly_order_kpis": ORDER_KPI,
    "monthly_mix_shares": MIX,
    "monthly_ops_join": f"SELECT * FROM ({SALES_KPI}) LEFT JOIN ({ORDER_KPI}) USING (month) LEFT JOIN ({MIX}) USING (month) LEFT JOIN ({OPS_MONTH}) USING (month)",
    "ops_history": """SELECT a.metric, CAST(up AS INTEGER) AS place, b.month, c.value FROM (SELECT DISTINCT metric FROM fx_ops) a CROSS JOIN (SELECT month, row_number() OVER (ORDER BY month) - 1 AS up, row_number() OVER (ORDER BY month DESC) - 1 AS down
 FROM (SELECT DISTINCT month FROM fx_ops)) b LEFT JOIN fx_ops c ON c.metric = a.metric AND c.month = b.month""",
    "totals": f"""SELECT {D('sum(gross_revenue)')} AS gross_rev, {D('sum(net_revenue)')} AS net_rev, CAST(sum(gross_sales_qty) AS BIGINT) AS gross_units,
 CAST(sum(net_sales_qty) AS BIGINT) AS net_units, CAST(sum(return_qty) AS BIGINT) AS ret, CAST(sum(cancel_qty) AS BIGINT) AS cancel, {D('sum(discount)')} AS disc,
 {D('sum(commission)')} AS comm, count(DISTINCT barcode) AS skus, count(DISTINCT model_code) AS models, any_value(pk) AS pk, any_value(units_o) AS units_o,
 any_value(net_o) AS net_o, any_value(cargo_o) AS cargo_o, any_value(comm_o) AS comm_o, any_value(aov_all) AS aov_all
 FROM fx_s, (SELECT count(*) AS pk, CAST(sum(units) AS BIGINT) AS units_o, {D('sum(net)')} AS net_o, {D('sum(cargo)')} AS cargo_o, {D('sum(commission)')} AS comm_o,
 {RATIO('sum(net)', 'count(*)')} AS aov_all FROM fx_p WHERE month BETWEEN '1997-04' AND '1997-09')""",
    "monthly_order_totals": f"SELECT month, count(*) AS pkgs, {D('sum(net)')} AS net, {D('sum(cargo)')} AS cargo, {D('sum(commission)')} AS comm FROM fx_p WHERE month BETWEEN '1997-04' AND '1997-08' GROUP BY month",
    "headline_kpis": f"""SELECT {RATIO('n.net', 'n.n')} AS aov, {RATIO('n.u', 'n.n')} AS upt, {RATIO('s.r', 's.g', ' * 100')} AS return_pct, {RATIO('s.c', 's.g', ' * 100')} AS cancel_pct,
 {RATIO('s.oos', 's.skus', ' * 100')} AS oos_pct, {RATIO('n.cargo', 'n.net', ' * 100')} AS cargo_share, 100 - {RATIO('n.one', 'n.n', ' * 100')} AS multi_model_pct,
 {RATIO('n.low', 'n.n', ' * 100')} AS under200_pct, {RATIO('a.sales', 'a.clicks', ' * 100')} AS ad_cvr, {D('s.snap')} / 22 * 30 AS run_rate,
 ({RATIO('s.m5', 's.m1')} - 1) * 100 AS growth_pct
 FROM (SELECT sum(gross_sales_qty) AS g, sum(return_qty) AS r, sum(cancel_qty) AS c, count(*) FILTER (month = '1997-09') AS skus,
   count(*) FILTER (month = '1997-09' AND stock = 0) AS oos, sum(net_revenue) FILTER (month = '1997-09') AS snap,
   sum(net_revenue) FILTER (month = '1997-04') AS m1, sum(net_revenue) FILTER (month = '1997-08') AS m5 FROM fx_s) s,
 (SELECT count(*) AS n, sum(net) AS net, sum(units) AS u, sum(cargo) AS cargo, count(*) FILTER (models = 1) AS one, count(*) FILTER (net < 200) AS low
   FROM fx_p WHERE month BETWEEN '1997-04' AND '1997-09') n, (SELECT * FROM fx_ad_totals WHERE source = 'panel') a""",
}
