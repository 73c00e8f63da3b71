"""Expected results of the advertising, storefront, margin, coupon and coverage queries, as SQL."""

from __future__ import annotations

from bazaarlens.params import COUPON_PRESETS
from bazaarlens.plans.oracle_base import VIEWS
from bazaarlens.plans.oracle_core import D, MONTHS, RATIO
from bazaarlens.plans.oracle_ingest import FILES
from bazaarlens.plans.oracle_metrics import BIN_ROWS, WIN

TIER = lambda v: f"CASE WHEN {v} < 200 THEN 40.99::DOUBLE WHEN {v} < 350 THEN 78.99::DOUBLE ELSE 93.05::DOUBLE END"
CM = lambda v: (f"({v} * (1 - cost) / (1 + vat) - comm_rate * {v} - {TIER(v)} - fee - CASE WHEN ads THEN tacos ELSE 0 END * {v})")

VIEWS.update({
    "fx_tot": f"SELECT {D('sum(net)')} AS net, {D('sum(cargo)')} AS cargo, {D('sum(commission)')} AS comm, count(*) AS pkgs FROM fx_p WHERE month {WIN}",
    "fx_rates": f"""
SELECT comm / nullif(net, 0) AS comm_rate, (SELECT {D('spend')} FROM fx_ad_totals WHERE source = 'panel') / (SELECT {D('sum(net_revenue)')} FROM fx_s) AS tacos,
       net / pkgs AS aov, pkgs AS pk FROM fx_tot""",
    "fx_one": "SELECT 0 AS scenario, 0.4::DOUBLE AS cost, 0.1::DOUBLE AS vat, 10.99::DOUBLE AS fee, true AS ads",
    "fx_grid": """
SELECT CAST(row_number() OVER (ORDER BY ci, ki, fi, ai) - 1 AS INTEGER) AS scenario, cost, vat, fee, ads FROM (VALUES (0, 0.3::DOUBLE), (1, 0.4::DOUBLE), (2, 0.5::DOUBLE)) a(ci, cost),
 (VALUES (0, 0.1::DOUBLE), (1, 0.2::DOUBLE)) b(ki, vat), (VALUES (0, 6.99::DOUBLE), (1, 10.99::DOUBLE)) c(fi, fee), (VALUES (0, true), (1, false)) d(ai, ads)""",
})


def margins(groups: str, scenarios: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""SELECT {lead}net, cargo, comm, pkgs, scenario, cost, vat, fee, ads, vat_paid, cogs, fees, ad_cost, cm, cm / nullif(net, 0) * 100 AS cm_pct, cm / pkgs AS cm_per_package
 FROM (SELECT *, net - vat_paid - cogs - comm - cargo - fees - ad_cost AS cm FROM (SELECT t.*, s.*, (net - cost * net) * vat / (1 + vat) AS vat_paid, cost * net AS cogs,
 fee * pkgs AS fees, CASE WHEN ads THEN tacos ELSE 0 END * net AS ad_cost FROM {groups} t, fx_rates, {scenarios} s))"""


VIEWS["fx_margin"] = margins("fx_tot", "fx_one")
VIEWS["fx_margins"] = margins("fx_tot", "fx_grid")
VIEWS["fx_bins"] = f"""
SELECT bin_no, bin, count(p.package_no) AS n, {RATIO('sum(net)', 'count(p.package_no)')} AS net
FROM {BIN_ROWS} LEFT JOIN fx_p p ON p.net >= lo AND p.net < hi AND p.month {WIN} GROUP BY bin_no, bin"""
VIEWS["fx_catin"] = f"""
SELECT s.category, s.net_rev, s.comm_pct, b.aov_with, c.cargo_pct FROM
 (SELECT category, {D('sum(net_revenue)')} AS net_rev, {RATIO('sum(commission)', 'sum(net_revenue)', ' * 100')} AS comm_pct FROM fx_s GROUP BY category) s
 LEFT JOIN (SELECT x.category, {RATIO('sum(p.net)', 'count(*)')} AS aov_with FROM (SELECT DISTINCT package_no, category FROM fx_wo) x JOIN fx_p p USING (package_no) GROUP BY 1) b USING (category)
 LEFT JOIN (SELECT l.category, round(sum({D('p.cargo')} * {D('l.net')} / nullif({D('p.net')}, 0)) / {D('sum(l.net)')} * 100, 6) AS cargo_pct FROM fx_wo l JOIN fx_p p USING (package_no) GROUP BY 1) c USING (category)"""
VIEWS["fx_coverage"] = """
SELECT report, month, n, reached_day, round_even(CASE WHEN part IS NULL OR expected = 0 THEN 1 ELSE least(1, part::DOUBLE / expected) END, 3) AS coverage FROM
 (SELECT *, CASE report WHEN 'orders' THEN reached_day WHEN 'store' THEN n END AS part,
  CASE WHEN CAST(month || '-01' AS DATE) > DATE '1998-08-17' THEN 0 WHEN last_day(CAST(month || '-01' AS DATE)) < DATE '1998-08-17' THEN day(last_day(CAST(month || '-01' AS DATE)))
       ELSE date_diff('day', CAST(month || '-01' AS DATE), DATE '1998-08-17') END AS expected
  FROM (SELECT 'sales' AS report, month, count(*) AS n, CAST(NULL AS INTEGER) AS reached_day FROM fx_sales GROUP BY month
   UNION ALL SELECT 'orders', strftime(order_at, '%Y-%m'), count(*), CAST(max(day(order_at)) AS INTEGER) FROM fx_orders GROUP BY 2
   UNION ALL SELECT 'distribution', month, count(*), NULL FROM fx_distribution GROUP BY month
   UNION ALL SELECT 'store', strftime(day, '%Y-%m'), count(DISTINCT day), NULL FROM fx_store GROUP BY 2
   UNION ALL SELECT 'ops', month, count(*), NULL FROM fx_ops WHERE value IS NOT NULL GROUP BY month))"""
VIEWS["fx_cells"] = """
SELECT g.month, g.report, coalesce(c.coverage, 0) AS v FROM
 (SELECT y || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS month, report FROM (SELECT DISTINCT left(month, 4) AS y FROM fx_coverage UNION SELECT '1998') years,
  range(1, 13) AS months(m), (VALUES ('sales'), ('orders'), ('distribution'), ('store'), ('ops')) t(report)) g
 LEFT JOIN fx_coverage c ON c.month = g.month AND c.report = g.report WHERE g.month <= '1998-08'"""
VIEWS["fx_scores"] = """
SELECT month, CAST(sum(CAST(v AS DECIMAL(10,3))) AS DOUBLE) / count(*) AS score, count(*) FILTER (v >= 0.999) AS full_reports FROM fx_cells GROUP BY month"""


def share_margin(comm: str, cargo: str, aov: str) -> str:
    return f"((1 - cost) / (1 + vat) - {comm} / 100 - {cargo} / 100 - CASE WHEN ads THEN tacos ELSE 0 END - fee / {aov})"


def coupons(values: str) -> str:
    presets = ", ".join(f"({i}, '{n}', {t}::DOUBLE, {d}::DOUBLE, {u / 100!r}::DOUBLE, {s / 100!r}::DOUBLE, {g / 100!r}::DOUBLE)"
                        for i, (n, t, d, u, s, g) in enumerate(COUPON_PRESETS))
    return f"""WITH vals AS ({values}), rows AS (SELECT p.*, r.*, o.cost AS c, o.*, w.v, w.n / 5.0::DOUBLE AS n
 FROM (VALUES {presets}) AS p(coupon_no, coupon, t, d, u, s, g), fx_rates r, fx_one o, vals w),
 parts AS (SELECT *, CASE WHEN v >= t THEN u * n * d WHEN v >= 0.7::DOUBLE * t THEN s * n * d ELSE 0 END AS p_cost,
 CASE WHEN v >= t THEN -u * n * d WHEN v >= 0.7::DOUBLE * t THEN s * n * (t + 10 - d - v) ELSE 0 END AS p_rev,
 CASE WHEN v >= t THEN u * n * (-d / (1 + vat) + comm_rate * d + tacos * d - ({TIER('(v - d)')} - {TIER('v')}))
      WHEN v >= 0.7::DOUBLE * t THEN s * n * ({CM('(t + 10 - d)')} - {CM('v')} - (c * (t + 10 - v) - c * (t + 10 - d - v)) / (1 + vat)) ELSE 0 END AS p_cm FROM rows),
 sums AS (SELECT coupon_no, coupon, t, d, g, c, cost, vat, fee, ads, comm_rate, tacos, aov, pk / 5.0::DOUBLE AS per_month, sum(n * v) AS base, sum(n) AS base_n, sum(p_cost) AS s_cost, sum(p_rev) AS s_rev, sum(p_cm) AS s_cm
 FROM parts GROUP BY ALL), ex AS (SELECT *, g * per_month AS en, greatest(t, aov) + 10 - d AS ef FROM sums), fin AS (SELECT *, {CM('ef')} - c * d / (1 + vat) AS ecm FROM ex)
 SELECT coupon_no, coupon, round(s_cost + en * d, 4) AS cost, round(s_rev + en * ef, 4) AS revenue_change, round(s_cm + en * ecm, 4) AS margin_change,
 round((base + s_rev + en * ef) / (base_n + en), 6) AS aov_after, round(ecm, 6) AS extra_margin,
 round(CASE WHEN ecm > 0 THEN greatest(0, -s_cm / ecm) END, 4) AS breakeven_orders, round(CASE WHEN ecm > 0 THEN greatest(0, -s_cm / ecm) / per_month * 100 END, 4) AS breakeven_pct FROM fin"""


FIRST5 = f"(SELECT month, {D('sum(net)')} AS net, {D('sum(cargo)')} AS cargo, {D('sum(commission)')} AS comm, count(*) AS pkgs FROM fx_p WHERE month BETWEEN '{MONTHS[0]}' AND '{MONTHS[4]}' GROUP BY month)"

SQL = {
    "ad_campaign_metrics": f"""SELECT name, status, {D('spent')} AS spent, clicks, impressions, direct_sales, direct_sales + indirect_sales AS total_sales, {D('direct_revenue')} AS direct_revenue,
 {D('direct_revenue + indirect_revenue')} AS total_ad_revenue, {RATIO('spent', 'clicks')} AS cpc, {RATIO('clicks', 'impressions', ' * 100')} AS ctr, {RATIO('direct_revenue', 'spent')} AS direct_roas,
 {RATIO('direct_revenue + indirect_revenue', 'spent')} AS total_roas FROM fx_ads WHERE spent > 0""",
    "ad_totals_kpis": f"""SELECT {RATIO('revenue', 'spend')} AS roas, {RATIO('spend', 'revenue', ' * 100')} AS acos, {RATIO('spend', 's.net_rev', ' * 100')} AS tacos, {RATIO('spend', 'clicks')} AS cpc,
 {RATIO('clicks', 'impressions', ' * 100')} AS ctr, {RATIO('sales', 'clicks', ' * 100')} AS cvr, {RATIO('sales', 's.units', ' * 100')} AS unit_share, {D('spend')} / 5.75::DOUBLE AS monthly_spend
 FROM fx_ad_totals, (SELECT sum(net_revenue) AS net_rev, sum(gross_sales_qty) AS units FROM fx_s) s WHERE source = 'panel'""",
    "unattributed_spend": f"""SELECT {D('p')} AS panel_spend, {D('c')} AS product_spend, {D('m')} AS meta_spend, {D('p - c - m')} AS other_spend FROM
 (SELECT sum(spend) FILTER (source = 'panel') AS p, sum(spend) FILTER (source = 'meta') AS m FROM fx_ad_totals), (SELECT sum(spent) AS c FROM fx_ads WHERE spent > 0)""",
    "store_averages": "SELECT " + ", ".join(f"round(avg({c}), 9) AS {c}" for c in ("store_views", "visitors", "followers_gained", "followers_lost", "follow_rate", "customer_rate", "store_conversion", "store_orders", "total_orders"))
                      + f", round(avg({RATIO('store_revenue', 'total_revenue', ' * 100')}), 9) AS store_revenue_share FROM fx_store",
    "store_funnel": """WITH a AS (SELECT avg(visitors) AS v, avg(store_views) AS w, avg(follow_rate) AS f, avg(customer_rate) AS c FROM fx_store)
 SELECT 0 AS step, 'visitors' AS stage, round(v, 9) AS per_day FROM a UNION ALL SELECT 1, 'views / 3', round(w / 3, 9) FROM a UNION ALL SELECT 2, 'followers', round(v * f / 100, 9) FROM a UNION ALL SELECT 3, 'customers', round(v * c / 100, 9) FROM a""",
    "contribution_margin": "SELECT * FROM fx_margin",
    "monthly_margin": margins(FIRST5, "fx_one", "month"),
    "bin_margin": f"""SELECT scenario, bin_no, bin, n, net, cm, cm / net * 100 AS cm_pct, {RATIO('sum(CASE WHEN cm < 0 THEN n ELSE 0 END) OVER ()', 'pk', ' * 100')} AS loss_share
 FROM (SELECT *, {CM('net')} AS cm FROM fx_bins, fx_rates, fx_one)""",
    "category_margin": f"""SELECT scenario, category, net_rev, comm_pct, cargo_pct, round(r * 100, 4) AS cm_pct, round(r * net_rev, 4) AS cm FROM
 (SELECT *, {share_margin('comm_pct', 'cargo_pct', 'coalesce(nullif(aov_with, 0), aov)')} AS r FROM fx_catin, fx_rates, fx_one WHERE cargo_pct <> 0)""",
    "model_unit_economics": f"""SELECT scenario, model_code, segment, asp, round(r * 100, 4) AS cm_pct, round(r * asp, 4) AS cm_per_unit, round(r * {D('net_rev')}, 4) AS cm FROM
 (SELECT m.*, o.scenario, {share_margin('coalesce(nullif(m.comm_rate, 0), 18.6::DOUBLE)', 'coalesce(nullif(cargo_pct, 0), 24.0::DOUBLE)', 'coalesce(nullif(aov_with, 0), aov)')} AS r
  FROM (SELECT * FROM fx_models ORDER BY net_rev DESC, model_code LIMIT 25) m, fx_rates r, fx_one o)""",
    "breakeven_cost_ratio": "SELECT scenario, vat, fee, ads, greatest(0, least(1, 1 - (comm + cargo + fees + ad_cost) * (1 + vat) / net)) AS breakeven_cost FROM fx_margins",
    "margin_curve": f"""WITH g AS (SELECT CAST(unnest(range(50, 801, 5)) AS INTEGER) AS v), c AS (SELECT scenario, g.v, {CM('g.v::DOUBLE')} AS cm FROM g, fx_rates, fx_grid),
 p AS (SELECT scenario, CAST(floor({D('net')} / 5) AS INTEGER) * 5 AS v, count(*) AS pkgs, count(*) FILTER ({CM(D('net'))} < 0) AS losing FROM fx_p, fx_rates, fx_grid
  WHERE month {WIN} AND net >= 50 AND net < 805 GROUP BY 1, 2)
 SELECT c.scenario, c.v, c.cm, coalesce(p.pkgs, 0) AS pkgs, CAST(p.losing AS DOUBLE) / p.pkgs * 100 AS loss_share FROM c LEFT JOIN p ON p.scenario = c.scenario AND p.v = c.v""",
    "breakeven_basket": f"SELECT scenario, min(CASE WHEN {CM('v')} >= 0 THEN v END) AS breakeven_basket FROM (SELECT 60 + i * 0.5::DOUBLE AS v FROM range(0, 280) t(i)), fx_rates, fx_grid GROUP BY scenario",
    "breakeven_roas": "SELECT scenario, cm_pct, 1 / greatest(0.01::DOUBLE, cm_pct / 100 + tacos) AS breakeven_roas FROM fx_margins, (SELECT tacos FROM fx_rates)",
    "scenario_grid": "SELECT * FROM fx_margins",
    "fee_saving": "SELECT pkgs AS pk, 4.0::DOUBLE * pkgs / 5.0::DOUBLE AS monthly_saving FROM fx_tot",
    "coupon_scenarios": coupons(f"""SELECT CASE WHEN i = 59 THEN coalesce(m, 595) ELSE i * 10.0::DOUBLE + 5 END AS v, n FROM
 (SELECT b.i, count(p.package_no) AS n, CASE WHEN b.i = 59 THEN {RATIO('sum(net)', 'count(p.package_no)')} END AS m FROM range(0, 60) b(i)
  LEFT JOIN fx_p p ON least(CAST(floor({D('p.net')} / 10) AS INTEGER), 59) = b.i AND p.month {WIN} GROUP BY b.i)"""),
    "coupon_scenarios_exact": coupons(f"SELECT {D('net')} AS v, count(*) AS n FROM fx_p WHERE month {WIN} GROUP BY 1"),
    "clv_12m": f"""SELECT aov, op AS orders_per, aov * (1 + (op - 1) * 12 / 5) AS clv_rev, round(aov * (1 + (op - 1) * 12 / 5) * cm_pct / 100, 6) AS clv_margin FROM fx_rates,
 (SELECT CAST(sum(n) AS DOUBLE) / count(*) AS op FROM (SELECT customer, count(DISTINCT order_no) AS n FROM fx_wp GROUP BY customer)), (SELECT cm_pct FROM fx_margin)""",
    "coverage_by_month": "SELECT report, month, n, reached_day, coverage FROM fx_coverage",
    "coverage_month_score": "SELECT month, score, full_reports, CASE WHEN score >= 0.999 THEN 'full' WHEN score > 0 THEN 'partial' ELSE 'missing' END AS label FROM fx_scores",
    "coverage_year_summary": """SELECT year, months, full_months, avg_pct, missing, partial FROM
 (SELECT left(month, 4) AS year, count(*) AS months, count(*) FILTER (score >= 0.999) AS full_months FROM fx_scores GROUP BY 1)
 JOIN (SELECT left(month, 4) AS year, CAST(sum(CAST(v AS DECIMAL(10,3))) AS DOUBLE) / count(*) * 100 AS avg_pct, count(*) FILTER (v = 0) AS missing, count(*) FILTER (v > 0 AND v < 0.999) AS partial FROM fx_cells GROUP BY 1) USING (year)""",
    "last_loads": f"""SELECT strftime(max(loaded), '%Y-%m-%d %H:%M:%S') AS last_upload, strftime(max(loaded) FILTER (kind = 6), '%Y-%m-%d %H:%M:%S') AS last_ads_upload, (SELECT count(*) FROM fx_ads) AS campaigns
 FROM (SELECT file_name, kind, max(o_orderdate) AS loaded FROM ({FILES}) WHERE kind <> 7 GROUP BY 1, 2)""",
}
