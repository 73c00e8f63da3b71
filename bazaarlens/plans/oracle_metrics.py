"""Expected results of the category, product, stock, customer, calendar, basket and fulfilment queries, as SQL."""

from __future__ import annotations

from bazaarlens.plans.oracle_base import VIEWS
from bazaarlens.plans.oracle_core import D, MONTHS, RATIO
from bazaarlens.operators.products import ACTIONS

WIN = "BETWEEN '1997-04' AND '1997-09'"
COLOUR_RE = "^(red|blue|green|small|large|black|white)[\\s,-]+"

VIEWS.update({
    "fx_wo": f"SELECT l.* FROM fx_o l SEMI JOIN (SELECT package_no FROM fx_p WHERE month {WIN}) w USING (package_no)",
    "fx_wp": f"SELECT * FROM fx_p WHERE month {WIN}",
    "fx_firstcat": "SELECT model_code, category FROM (SELECT model_code, category, row_number() OVER (PARTITION BY model_code ORDER BY month, barcode) AS rn FROM fx_s) WHERE rn = 1",
    "fx_mod": f"""
SELECT model_code, any_value(c.category) AS category, CAST(sum(gross_sales_qty) AS BIGINT) AS gross_units, CAST(sum(net_sales_qty) AS BIGINT) AS net_units,
       CAST(sum(return_qty) AS BIGINT) AS ret, CAST(sum(cancel_qty) AS BIGINT) AS cancel, sum(net_revenue) AS net_rev, sum(gross_revenue) AS gross_rev,
       sum(discount) AS disc, sum(commission) AS comm, count(DISTINCT barcode) AS variants, {RATIO('sum(net_revenue)', 'sum(net_sales_qty)')} AS asp,
       {RATIO('sum(return_qty)', 'sum(gross_sales_qty)', ' * 100')} AS ret_rate, {RATIO('sum(commission)', 'sum(net_revenue)', ' * 100')} AS comm_rate
FROM fx_s JOIN fx_firstcat c USING (model_code) GROUP BY model_code""",
    "fx_mm": "SELECT model_code, " + ", ".join(f"coalesce(sum(net_revenue) FILTER (month = '{m}'), 0) AS r{i}" for i, m in enumerate(MONTHS))
             + ", " + ", ".join(f"CAST(coalesce(sum(net_sales_qty) FILTER (month = '{m}'), 0) AS BIGINT) AS u{i}" for i, m in enumerate(MONTHS))
             + " FROM fx_s GROUP BY model_code",
    "fx_growth0": "SELECT *, (CAST(r0 AS DOUBLE) + CAST(r1 AS DOUBLE)) / 2 AS h1, (CAST(r3 AS DOUBLE) + CAST(r4 AS DOUBLE)) / 2 AS h2, "
                  + " + ".join(f"(r{i} > 0)::INTEGER" for i in range(6)) + " AS months_active FROM fx_mm",
    "fx_growth": """
SELECT model_code, r0, r1, r2, r3, r4, r5, u5 AS snapshot_units, r5 AS snapshot_rev, h1, h2, months_active,
       CASE WHEN h1 > 0 THEN (h2 / h1 - 1) * 100 WHEN h2 > 0 THEN 999.0 ELSE 0.0 END AS growth,
       round((SELECT stddev_samp(v) / nullif(avg(v), 0) FROM (SELECT unnest([r0, r1, r2, r3, r4])::DOUBLE AS v)), 6) AS cv
FROM fx_growth0""",
    "fx_stock": """
SELECT model_code, CAST(sum(stock) AS BIGINT) AS stock, count(*) FILTER (stock = 0) AS oos_var, count(DISTINCT barcode) AS var_now,
       round(quantile_cont(CAST(current_price AS DOUBLE), 0.5), 6) AS price
FROM fx_s WHERE month = '1997-09' GROUP BY model_code""",
    "fx_name0": "SELECT model_code, name, row_number() OVER (PARTITION BY model_code ORDER BY count(*) DESC, name) AS rn FROM fx_s GROUP BY model_code, name",
    "fx_names": f"""
SELECT model_code, name AS full_name, substr(trim(regexp_split_to_array(trim(regexp_replace(name, '{COLOUR_RE}', '')), '[,|(]| - |– ')[1]), 1, 48) AS name
FROM fx_name0 WHERE rn = 1""",
    "fx_mp": "SELECT model, package_no, sum(net) AS line_net, sum(commission) AS line_comm FROM fx_o GROUP BY model, package_no",
    "fx_wmp": "SELECT model, package_no, sum(net) AS line_net, sum(commission) AS line_comm FROM fx_wo GROUP BY model, package_no",
})


def attach(pairs: str) -> str:
    return f"""SELECT model AS model_code, count(*) AS pk, {RATIO('count(*) FILTER (p.models > 1)', 'count(*)', ' * 100')} AS multi,
 {RATIO('count(*) FILTER (p.models = 1)', 'count(*)', ' * 100')} AS solo, {RATIO('sum(p.net)', 'count(*)')} AS aov_with,
 coalesce(sum({D('p.cargo')} * {D('line_net')} / nullif({D('p.net')}, 0)), 0) AS cargo_alloc, sum(line_net) AS orev, sum(line_comm) AS ocomm
 FROM {pairs} JOIN fx_p p USING (package_no) GROUP BY model"""


VIEWS.update({
    "fx_attach": attach("fx_mp"),
    "fx_wattach": attach("fx_wmp"),
    "fx_pareto": f"""
SELECT *, {RATIO('net_rev', 'sum(net_rev) OVER ()', ' * 100')} AS rev_share,
       {RATIO('sum(net_rev) OVER (ORDER BY net_rev DESC, model_code ROWS UNBOUNDED PRECEDING)', 'sum(net_rev) OVER ()', ' * 100')} AS cum
FROM fx_mod WHERE net_rev > 0""",
    "fx_ranked": """
SELECT p.*, g.* EXCLUDE (model_code), CASE WHEN cum <= 50.5 OR rev_share >= 4 THEN 'Hero'
       WHEN cum <= 80 THEN CASE WHEN growth >= 40 AND months_active >= 3 THEN 'Rising' ELSE 'Core' END
       WHEN growth >= 60 AND h2 >= 150 THEN 'Rising' ELSE 'Long Tail' END AS segment
FROM fx_pareto p JOIN fx_growth g USING (model_code)""",
    "fx_models": """
SELECT r.*, s.* EXCLUDE (model_code), n.name, a.* EXCLUDE (model_code), round(a.cargo_alloc / nullif(CAST(a.orev AS DOUBLE), 0) * 100, 6) AS cargo_pct,
       snapshot_units / 22.0::DOUBLE AS daily_units, CAST(stock AS DOUBLE) / nullif(snapshot_units / 22.0::DOUBLE, 0) AS cover_days
FROM fx_ranked r LEFT JOIN fx_stock s USING (model_code) LEFT JOIN fx_names n USING (model_code) LEFT JOIN fx_wattach a USING (model_code)""",
    "fx_cust": """
SELECT customer, count(DISTINCT order_no) AS n, count(*) AS pkgs, sum(net) AS rev, min(order_at) AS first_at, max(order_at) AS last_at
FROM fx_p WHERE customer IS NOT NULL GROUP BY customer""",
    "fx_gaps": """
SELECT CAST(floor(date_diff('second', before, order_at) / 86400.0) AS BIGINT) AS gap FROM
 (SELECT order_at, lag(order_at) OVER (PARTITION BY customer ORDER BY order_at) AS before FROM fx_p) WHERE before IS NOT NULL
 AND floor(date_diff('second', before, order_at) / 86400.0) > 0""",
    "fx_cohort": "SELECT customer, min(month) AS cohort FROM fx_wp GROUP BY customer",
    "fx_items": "SELECT DISTINCT package_no, model AS item FROM fx_o",
    "fx_single": "SELECT item, count(*) AS n FROM fx_items GROUP BY item",
    "fx_pairs": f"""
SELECT x.a, x.b, x.n, x.n / t.c * 100 AS support, x.n / {D('sa.n')} * 100 AS conf_ab, x.n / {D('sb.n')} * 100 AS conf_ba,
       (x.n / t.c) / ((sa.n / t.c) * (sb.n / t.c)) AS lift
FROM (SELECT i.item AS a, j.item AS b, count(*) AS n FROM fx_items i JOIN fx_items j ON i.package_no = j.package_no AND i.item < j.item GROUP BY 1, 2) x
JOIN fx_single sa ON sa.item = x.a JOIN fx_single sb ON sb.item = x.b, (SELECT CAST(count(DISTINCT package_no) AS DOUBLE) AS c FROM fx_o) t
WHERE x.n >= 12""",
    "fx_citems": "SELECT DISTINCT package_no, category AS item FROM fx_o",
    "fx_csingle": "SELECT item, count(*) AS n FROM fx_citems GROUP BY item",
    "fx_multi": "SELECT package_no, model FROM fx_o GROUP BY package_no, model HAVING count(DISTINCT barcode) > 1",
})

BIN_ROWS = "(VALUES (0,'<100',0,100),(1,'100-149',100,150),(2,'150-199',150,200),(3,'200-249',200,250),(4,'250-299',250,300),(5,'300-349',300,350)," \
           "(6,'350-399',350,400),(7,'400-499',400,500),(8,'500-749',500,750),(9,'750+',750,100000)) AS b(bin_no, bin, lo, hi)"

LAST_SNAP = "FROM fx_s WHERE month = '1997-09'"
DAILY = f"({D('net_sales_qty')} / 22)"
COVER = f"({D('stock')} / nullif({DAILY}, 0))"
TABLE = f"""model_code, name, category, segment, {D('net_rev')} AS net_rev, rev_share, cum, net_units, gross_units, asp, price, ret_rate, comm_rate, growth,
 months_active, stock, oos_var, var_now, variants, cover_days, daily_units, pk, multi, aov_with, cargo_pct, solo, {D('disc')} AS disc, cv, {D('snapshot_rev')} AS snapshot_rev"""
ROLE = "CASE WHEN asp >= 180 AND cargo_pct < 21 THEN 'Kâr çapası' WHEN solo >= 80 THEN 'Trafik mıknatısı' WHEN multi >= 35 THEN 'Sepet ortağı' ELSE 'Tamamlayıcı' END"

SQL = {
    "category_summary": f"""SELECT category, CAST(sum(gross_sales_qty) AS BIGINT) AS gross_units, CAST(sum(cancel_qty) AS BIGINT) AS cancel, CAST(sum(return_qty) AS BIGINT) AS ret,
 CAST(sum(net_sales_qty) AS BIGINT) AS net_units, {D('sum(gross_revenue)')} AS gross_rev, {D('sum(discount)')} AS disc, {D('sum(net_revenue)')} AS net_rev,
 {D('sum(commission)')} AS comm, {RATIO('sum(return_qty)', 'sum(gross_sales_qty)', ' * 100')} AS ret_rate, {RATIO('sum(net_revenue)', 'sum(net_sales_qty)')} AS asp,
 {RATIO('sum(commission)', 'sum(net_revenue)', ' * 100')} AS comm_rate, {RATIO('sum(net_revenue)', 'sum(sum(net_revenue)) OVER ()', ' * 100')} AS share FROM fx_s GROUP BY category""",
    "category_month_matrix": "SELECT category, " + ", ".join(f"CAST(coalesce(sum(net_revenue) FILTER (month = '{m}'), 0) AS DOUBLE) AS \"{m}\"" for m in MONTHS) + " FROM fx_s GROUP BY category",
    "category_basket": f"""SELECT c.category, count(p.package_no) AS pkgs, coalesce({RATIO('sum(p.net)', 'count(p.package_no)')}, 0) AS aov_with,
 coalesce({RATIO('count(*) FILTER (p.cats > 1)', 'count(p.package_no)', ' * 100')}, 0) AS cross_cat, coalesce({RATIO('count(*) FILTER (p.net < 200)', 'count(p.package_no)', ' * 100')}, 0) AS under200
 FROM (SELECT DISTINCT category FROM fx_products) c LEFT JOIN (SELECT DISTINCT package_no, category FROM fx_o) x ON x.category = c.category LEFT JOIN fx_p p ON p.package_no = x.package_no GROUP BY c.category""",
    "category_cargo_share": f"""SELECT category, round(a, 4) AS cargo_alloc, {D('o')} AS orev, {D('m')} AS ocomm, round(a / nullif({D('o')}, 0) * 100, 6) AS cargo_pct, {RATIO('m', 'o', ' * 100')} AS comm_pct_o
 FROM (SELECT l.category, sum({D('p.cargo')} * {D('l.net')} / nullif({D('p.net')}, 0)) AS a, sum(l.net) AS o, sum(l.commission) AS m FROM fx_o l JOIN fx_p p USING (package_no) GROUP BY l.category)""",
    "cancel_return_reasons": "SELECT reason, CAST(n AS BIGINT) AS n FROM (UNPIVOT (SELECT " + ", ".join(f'sum("{c}") AS "{c}"' for c in ("AF", "AO", "AP", "RF", "RO", "RP"))
                             + " FROM fx_s) ON COLUMNS(*) INTO NAME reason VALUE n) WHERE n > 0",
    "model_rollup": f"SELECT model_code, category, gross_units, net_units, ret, cancel, {D('net_rev')} AS net_rev, {D('gross_rev')} AS gross_rev, {D('disc')} AS disc, {D('comm')} AS comm, variants, asp, ret_rate, comm_rate FROM fx_mod",
    "model_month_matrix": " UNION ALL ".join(f"SELECT model_code, '{m}' AS month, {D(f'r{i}')} AS net_rev, u{i} AS net_units FROM fx_mm" for i, m in enumerate(MONTHS)),
    "stock_snapshot": "SELECT model_code, stock, oos_var, var_now, price FROM fx_stock",
    "model_display_name": "SELECT n.model_code, n.full_name, CASE WHEN o.b LIKE '%1' THEN concat('Özel ', o.b) ELSE n.name END AS name FROM fx_names n JOIN (SELECT model_code, min(brand) AS b FROM fx_products GROUP BY model_code) o USING (model_code)",
    "model_growth": "SELECT model_code, " + ", ".join(f"{D(f'r{i}')} AS r{i}" for i in range(6)) + f", snapshot_units, {D('snapshot_rev')} AS snapshot_rev, h1, h2, months_active, growth, cv FROM fx_growth",
    "stock_cover": "SELECT model_code, stock, snapshot_units / 22.0::DOUBLE AS daily_units, CAST(stock AS DOUBLE) / nullif(snapshot_units / 22.0::DOUBLE, 0) AS cover_days FROM fx_growth LEFT JOIN fx_stock USING (model_code)",
    "model_attach": "SELECT model_code, pk, multi, aov_with FROM fx_attach",
    "cargo_allocation": f"SELECT model_code, round(cargo_alloc, 4) AS cargo_alloc, {D('orev')} AS orev, {D('ocomm')} AS ocomm, round(cargo_alloc / nullif({D('orev')}, 0) * 100, 6) AS cargo_pct, {RATIO('ocomm', 'orev', ' * 100')} AS comm_pct_o, solo FROM fx_attach",
    "pareto": f"SELECT model_code, {D('net_rev')} AS net_rev, rev_share, cum FROM fx_pareto",
    "product_segments": f"SELECT model_code, {D('net_rev')} AS net_rev, rev_share, cum, growth, months_active, h2, segment FROM fx_ranked",
    "segment_summary": f"""SELECT segment, count(*) AS n, {D('sum(net_rev)')} AS rev, CAST(sum(net_units) AS BIGINT) AS units, round(avg(ret_rate), 6) AS ret, round(avg(multi), 6) AS multi,
 round(avg(cargo_pct), 4) AS cargo, round(quantile_cont(growth, 0.5), 6) AS growth, round(quantile_cont(asp, 0.5), 6) AS asp, {RATIO('sum(net_rev)', 'sum(sum(net_rev)) OVER ()', ' * 100')} AS share FROM fx_models GROUP BY segment""",
    "top_model_trend": "WITH top AS (SELECT model_code FROM fx_pareto ORDER BY net_rev DESC, model_code LIMIT 40) "
                       + " UNION ALL ".join(f"SELECT model_code, '{m}' AS month, {D(f'r{i}')} AS net_rev FROM fx_mm SEMI JOIN top USING (model_code)" for i, m in enumerate(MONTHS)),
    "movers": f"""WITH m AS (SELECT * FROM fx_ranked WHERE net_rev > 1000 AND months_active >= 4)
 SELECT * FROM (SELECT 'up' AS direction, model_code, segment, growth, {D('snapshot_rev')} AS snapshot_rev FROM m ORDER BY growth DESC, model_code LIMIT 6)
 UNION ALL SELECT * FROM (SELECT 'down', model_code, segment, growth, {D('snapshot_rev')} FROM m ORDER BY growth, model_code LIMIT 6)""",
    "product_roles": f"""SELECT model_code, segment, asp, cargo_pct, solo, multi, {ROLE} AS role, CASE segment
 WHEN 'Hero' THEN CASE WHEN {ROLE} = 'Trafik mıknatısı' THEN '{ACTIONS['hero_magnet']}' ELSE '{ACTIONS['hero']}' END WHEN 'Rising' THEN '{ACTIONS['rising']}'
 WHEN 'Core' THEN CASE WHEN {ROLE} = 'Sepet ortağı' THEN '{ACTIONS['core_partner']}' WHEN growth < -30 THEN '{ACTIONS['core_falling']}' ELSE '{ACTIONS['core']}' END
 ELSE CASE WHEN cover_days > 365 THEN '{ACTIONS['tail_overstock']}' WHEN {ROLE} = 'Sepet ortağı' THEN '{ACTIONS['tail_partner']}' ELSE '{ACTIONS['tail']}' END END AS action FROM fx_models""",
    "concentration": f"""WITH o AS (SELECT *, row_number() OVER (ORDER BY net_rev DESC, model_code) AS rk FROM fx_ranked)
 SELECT count(*) AS models, {RATIO('sum(net_rev) FILTER (rk <= 5)', 'sum(net_rev)', ' * 100')} AS top5_share, min(rk) FILTER (cum >= 80) AS models_for_80,
 {RATIO('min(rk) FILTER (cum >= 80)', 'count(*)', ' * 100')} AS models_for_80_pct, max(model_code) FILTER (rk = 1) AS leader, {D('max(net_rev)')} AS leader_rev, count(*) FILTER (segment = 'Rising') AS rising FROM o""",
    "product_catalog": f"SELECT {TABLE} FROM fx_models",
    "oos_summary": f"SELECT count(*) AS skus_now, count(*) FILTER (stock = 0) AS oos_now, count(*) FILTER (stock = 0 AND gross_sales_qty > 0) AS oos_selling, count(*) FILTER ({COVER} < 21) AS low_cover {LAST_SNAP}",
    "sku_presence": "SELECT month, count(DISTINCT barcode) AS skus FROM fx_s GROUP BY month",
    "low_cover_list": f"SELECT barcode, name, coalesce(color, '') AS color, stock, round({DAILY}, 1) AS daily, round({COVER}, 1) AS cover {LAST_SNAP} AND {COVER} < 30 AND net_sales_qty >= 5 ORDER BY {COVER}, barcode LIMIT 15",
    "lost_revenue": f"SELECT count(*) AS items, round(coalesce(sum({DAILY} * avg_price), 0), 4) AS lost_daily {LAST_SNAP} AND stock = 0",
    "lost_revenue_items": f"""SELECT barcode, substr(trim(regexp_split_to_array(trim(regexp_replace(name, '{COLOUR_RE}', '')), '[,|(]| - |– ')[1]), 1, 48) AS name, coalesce(color, '') AS color,
 round({DAILY}, 1) AS daily, avg_price AS asp, {DAILY} * avg_price AS lost_per_day {LAST_SNAP} AND stock = 0""",
    "customers": f"SELECT customer, n, pkgs, {D('rev')} AS rev, strftime(first_at, '%Y-%m-%d %H:%M:%S') AS first_at, strftime(last_at, '%Y-%m-%d %H:%M:%S') AS last_at FROM fx_cust",
    "repeat_summary": f"""SELECT count(*) AS customers, count(*) FILTER (n > 1) AS repeaters, {RATIO('count(*) FILTER (n > 1)', 'count(*)', ' * 100')} AS rpr, {RATIO('sum(n)', 'count(*)')} AS orders_per,
 {RATIO('sum(rev)', 'count(*)')} AS rev_per, {RATIO('sum(rev) FILTER (n > 1)', 'sum(rev)', ' * 100')} AS rev_rep_share,
 any_value(a2) AS aov_rep, any_value(a1) AS aov_one FROM fx_cust,
 (SELECT {RATIO('sum(p.net) FILTER (c.n > 1)', 'count(*) FILTER (c.n > 1)')} AS a2, {RATIO('sum(p.net) FILTER (c.n = 1)', 'count(*) FILTER (c.n = 1)')} AS a1 FROM fx_p p JOIN fx_cust c USING (customer))""",
    "order_count_histogram": "SELECT least(n, 5) AS orders, count(*) AS customers FROM fx_cust GROUP BY 1",
    "order_label_counts": "SELECT customer_nth, count(*) AS pkgs FROM fx_p GROUP BY 1",
    "repurchase_gaps": "SELECT count(*) AS gaps, round(quantile_cont(gap, 0.5), 6) AS gap_median, round(quantile_cont(gap, 0.25), 6) AS gap_p25, round(quantile_cont(gap, 0.75), 6) AS gap_p75 FROM fx_gaps",
    "repurchase_gap_bins": "SELECT a AS from_day, b AS to_day, count(gap) AS n FROM (VALUES (0,7),(7,14),(14,30),(30,60),(60,90),(90,200)) AS e(a, b) LEFT JOIN fx_gaps ON gap >= a AND gap < b GROUP BY a, b",
    "cohort_retention": f"""WITH sizes AS (SELECT cohort, count(*) AS size FROM fx_cohort WHERE cohort <= '1997-07' GROUP BY cohort),
 m(month) AS (VALUES ('1997-04'), ('1997-05'), ('1997-06'), ('1997-07'), ('1997-08'))
 SELECT s.cohort, m.month, CAST(right(m.month, 2) AS INTEGER) - CAST(right(s.cohort, 2) AS INTEGER) AS offset, s.size, count(DISTINCT p.customer) AS buyers,
 {RATIO('count(DISTINCT p.customer)', 's.size', ' * 100')} AS retention FROM sizes s JOIN m ON m.month >= s.cohort
 LEFT JOIN (SELECT p.customer, p.month, c.cohort FROM fx_wp p JOIN fx_cohort c USING (customer)) p ON p.cohort = s.cohort AND p.month = m.month GROUP BY s.cohort, m.month, s.size""",
    "distribution_totals": "SELECT dimension, bucket, bucket2, CAST(sum(orders) AS BIGINT) AS orders FROM fx_distribution WHERE dimension <> 'Yeni & Mevcut Müşteri' GROUP BY ALL",
    "city_top": f"SELECT city, count(*) AS pkgs, {D('sum(net)')} AS rev, {RATIO('sum(net)', 'count(*)')} AS aov, {RATIO('count(*)', '(SELECT count(*) FROM fx_p)', ' * 100')} AS share FROM fx_p GROUP BY city ORDER BY 2 DESC, 1 LIMIT 12",
    "weekday_profile": f"SELECT CAST(isodow(order_at) - 1 AS INTEGER) AS weekday, count(*) AS pkgs, {RATIO('sum(net)', 'count(*)')} AS aov FROM fx_p GROUP BY 1",
    "day_of_month_profile": "SELECT d.dom, count(p.package_no) AS pkgs, CASE WHEN d.dom = 31 THEN count(p.package_no) * (5::DOUBLE / 3) ELSE CAST(count(p.package_no) AS DOUBLE) END AS pkgs_scaled FROM (SELECT CAST(unnest(range(1, 32)) AS INTEGER) AS dom) d LEFT JOIN fx_p p ON day(p.order_at) = d.dom GROUP BY d.dom",
    "daily_sales": f"SELECT strftime(order_at, '%Y-%m-%d') AS day, count(*) AS pkgs, {D('sum(net)')} AS rev FROM fx_p GROUP BY 1",
    "run_rate": f"SELECT {D('sum(net_revenue)')} AS snapshot_rev, {D('sum(net_revenue)')} / 22 * 30 AS run_rate {LAST_SNAP}",
    "amount_bins": f"""SELECT bin_no, bin, count(p.package_no) AS n, {RATIO('sum(cargo)', 'count(p.package_no)')} AS cargo, {RATIO('sum(net)', 'count(p.package_no)')} AS net,
 {RATIO('sum(commission)', 'count(p.package_no)')} AS commission, {RATIO('sum(units)', 'count(p.package_no)')} AS units,
 ({RATIO('sum(cargo)', 'count(p.package_no)')}) / ({RATIO('sum(net)', 'count(p.package_no)')}) * 100 AS cargo_pct,
 ({RATIO('sum(commission)', 'count(p.package_no)')}) / ({RATIO('sum(net)', 'count(p.package_no)')}) * 100 AS comm_pct
 FROM {BIN_ROWS} LEFT JOIN fx_p p ON p.net >= lo AND p.net < hi GROUP BY bin_no, bin""",
    "threshold_cliff": "SELECT " + ", ".join(f"count(*) FILTER (net >= {a} AND net < {b}) AS n_{a}_{b}" for a, b in ((180, 200), (200, 230), (330, 350), (350, 380)))
                       + f", {RATIO('count(*) FILTER (net < 200)', 'count(*)', ' * 100')} AS share_under200, count(*) AS pk, {D('sum(cargo)')} AS cargo_total, {D('sum(net)')} AS rev_total, {D('sum(commission)')} AS comm_total, {RATIO('count(*) FILTER (cargo_known)', 'count(*)', ' * 100')} AS cargo_known_share FROM fx_p",
    "net_histogram": f"""SELECT b.i AS bin_no, b.i * 10 AS from_net, count(p.package_no) AS n, CASE WHEN b.i = 59 THEN {RATIO('sum(net)', 'count(p.package_no)')} END AS tail_mean
 FROM (SELECT CAST(unnest(range(0, 60)) AS INTEGER) AS i) b LEFT JOIN fx_p p ON least(CAST(floor(CAST(p.net AS DOUBLE) / 10) AS INTEGER), 59) = b.i GROUP BY b.i""",
    "basket_size_dists": """SELECT 'units' AS kind, CAST(least(units, 8) AS BIGINT) AS size, count(*) AS n FROM fx_p GROUP BY 2 UNION ALL SELECT 'lines', least(lines, 5), count(*) FROM fx_p GROUP BY 2
 UNION ALL SELECT 'models', least(models, 5), count(*) FROM fx_p GROUP BY 2 UNION ALL SELECT 'line_qty', least(qty, 6), count(*) FROM fx_order_lines GROUP BY 2""",
    "model_pairs": """SELECT x.*, coalesce(ma.name, x.a) AS a_name, coalesce(mb.name, x.b) AS b_name, coalesce(ma.category, '') AS a_category, coalesce(mb.category, '') AS b_category,
 coalesce(ma.segment, '') AS a_segment, coalesce(mb.segment, '') AS b_segment, coalesce(ma.asp, 0) AS a_asp, coalesce(mb.asp, 0) AS b_asp
 FROM (SELECT * FROM fx_pairs ORDER BY n DESC, a, b LIMIT 60) x LEFT JOIN fx_models ma ON ma.model_code = x.a LEFT JOIN fx_models mb ON mb.model_code = x.b""",
    "model_pairs_by_lift": """SELECT x.*, coalesce(ma.name, x.a) AS a_name, coalesce(mb.name, x.b) AS b_name, coalesce(ma.category, '') AS a_category, coalesce(mb.category, '') AS b_category,
 coalesce(ma.segment, '') AS a_segment, coalesce(mb.segment, '') AS b_segment, coalesce(ma.asp, 0) AS a_asp, coalesce(mb.asp, 0) AS b_asp
 FROM (SELECT * FROM fx_pairs WHERE n >= 15 ORDER BY lift DESC, a, b LIMIT 30) x LEFT JOIN fx_models ma ON ma.model_code = x.a LEFT JOIN fx_models mb ON mb.model_code = x.b""",
    "model_pairs_blocked": "SELECT a, b, n FROM fx_pairs",
    "category_pairs": f"""SELECT x.a, x.b, x.n, x.n / {D('sa.n')} * 100 AS conf_ab, x.n / {D('sb.n')} * 100 AS conf_ba, (x.n / t.c) / ((sa.n / t.c) * (sb.n / t.c)) AS lift
 FROM (SELECT i.item AS a, j.item AS b, count(*) AS n FROM fx_citems i JOIN fx_citems j ON i.package_no = j.package_no AND i.item < j.item GROUP BY 1, 2) x
 JOIN fx_csingle sa ON sa.item = x.a JOIN fx_csingle sb ON sb.item = x.b, (SELECT CAST(count(DISTINCT package_no) AS DOUBLE) AS c FROM fx_o) t ORDER BY n DESC, a, b LIMIT 20""",
    "category_single_counts": "SELECT item, n FROM fx_csingle",
    "multicolor": "SELECT (SELECT count(DISTINCT package_no) FROM fx_multi) AS pk_same_model_multi, (SELECT count(DISTINCT package_no) FROM fx_o) AS pk",
    "multicolor_models": f"SELECT x.*, coalesce(n.name, x.model) AS name FROM (SELECT m.model, count(*) AS n, {RATIO('count(*)', 'any_value(s.n)', ' * 100')} AS share FROM fx_multi m JOIN fx_single s ON s.item = m.model GROUP BY m.model ORDER BY 2 DESC, 1 LIMIT 10) x LEFT JOIN fx_names n ON n.model_code = x.model",
    "multiunit_models": f"SELECT x.*, coalesce(n.name, x.model) AS name FROM (SELECT model, {RATIO('sum(qty)', 'count(*)')} AS avg_qty, count(*) AS lines FROM fx_o GROUP BY model HAVING count(*) >= 100 ORDER BY 2 DESC, 1 LIMIT 10) x LEFT JOIN fx_names n ON n.model_code = x.model",
    "pair_advice": "SELECT a, b, n, lift, CASE WHEN lift >= 3 THEN 'Set yap' WHEN lift >= 1.2 THEN 'Çapraz öner' ELSE 'Hacimden kaynaklı: öneri yeterli' END AS advice FROM fx_pairs",
    "fulfilment_summary": f"""SELECT round(quantile_cont(s_to_ship, 0.5) / 3600.0, 6) AS h_ship_med, round(quantile_cont(s_to_ship, 0.9) / 3600.0, 6) AS h_ship_p90, round(quantile_cont(s_to_deliver, 0.5) / 86400.0, 6) AS d_deliv_med,
 round(quantile_cont(s_total, 0.5) / 86400.0, 6) AS d_total_med, round(quantile_cont(s_total, 0.9) / 86400.0, 6) AS d_total_p90, {RATIO('count(*) FILTER (s_to_ship < 86400)', 'count(s_to_ship)', ' * 100')} AS same_day FROM fx_p""",
    "carrier_scorecard": f"""SELECT replace(carrier, ' Marketplace', '') AS carrier, count(*) AS n, {RATIO('sum(cargo)', 'count(*)')} AS cargo, {RATIO('count(*) FILTER (returned)', 'count(*)', ' * 100')} AS ret,
 round(quantile_cont(s_to_ship, 0.5) / 3600.0, 6) AS h, round(quantile_cont(s_to_deliver, 0.5) / 86400.0, 6) AS d FROM fx_p GROUP BY carrier""",
    "returns_by_delivery_time": f"""SELECT bin, count(p.package_no) AS n, {RATIO('count(*) FILTER (p.returned)', 'count(p.package_no)', ' * 100')} AS ret
 FROM (VALUES ('≤2', 0, 2), ('2-3', 2, 3), ('3-4', 3, 4), ('4-5', 4, 5), ('5-7', 5, 7), ('7+', 7, 30)) AS b(bin, lo, hi) LEFT JOIN fx_p p ON p.s_total > lo * 86400 AND p.s_total <= hi * 86400 GROUP BY bin""",
}
