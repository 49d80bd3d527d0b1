"""Guide queries (A6 to A8) and marts (R)."""

from __future__ import annotations

import oracles as o
from catalog.base import register, warehouse
from ledgerlake.plans import marts

T = "DECIMAL(38,2)"


def month(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


def ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} <> 0 THEN CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) END"


register("A6_revenue_by_month", o.statement("fct_transactions", f"""
SELECT {month('created_date')} AS month, event_type, count(*) AS events, CAST(sum(amount_usd) AS {T}) AS gross_revenue_usd,
 CAST(sum(signed_net_amount_usd) AS {T}) AS net_revenue_usd
FROM fct_transactions GROUP BY ALL ORDER BY 1 DESC, 2"""))(
    lambda s, d: marts.revenue_by_month(warehouse(s, d).fct_transactions))

register("A7_mrr_by_movement", o.statement("fct_mrr_movements", f"""
SELECT billing_month, movement_type, count(*) AS customers, CAST(sum(mrr_usd) AS {T}) AS mrr_usd,
 CAST(sum(mrr_change_usd) AS {T}) AS mrr_change_usd
FROM fct_mrr_movements GROUP BY ALL ORDER BY 1 DESC, 2"""))(
    lambda s, d: marts.mrr_by_movement(warehouse(s, d).fct_mrr_movements))

register("A8_gold_totals", o.statement("fct_transactions fct_mrr_movements dim_customers", f"""
SELECT 'fct_transactions' AS table_name, count(*) AS rows, CAST(NULL AS {T}) AS total_usd FROM fct_transactions
UNION ALL SELECT 'fct_mrr_movements', count(*), CAST(sum(mrr_usd) AS {T}) FROM fct_mrr_movements
UNION ALL SELECT 'dim_customers_current', count(*), NULL FROM dim_customers WHERE is_current"""))(
    lambda s, d: (lambda w: marts.gold_totals(w.fct_transactions, w.fct_mrr_movements, w.dim_customers))(
        warehouse(s, d)))


def _moved(name: str) -> str:
    return (f"CAST(ifnull(sum(mrr_change_usd) FILTER (movement_type = '{name}'), 0) AS {T}) "
            f"AS {name.lower().replace(' ', '_')}_usd")


_MOVES = ("New", "Expansion", "Contraction", "Churn", "No Change")

register("R1_mrr_summary", o.statement("fct_mrr_movements", f"""
SELECT billing_month, CAST(sum(mrr_usd) AS {T}) AS mrr_usd, CAST(sum(mrr_usd) * 12 AS {T}) AS arr_usd,
 {', '.join(_moved(m) for m in _MOVES)}
FROM fct_mrr_movements GROUP BY ALL"""))(
    lambda s, d: marts.mrr_summary(warehouse(s, d).fct_mrr_movements))

_COUNTED = ", ".join(
    f"count(*) FILTER (movement_type = '{m}') AS {m.lower().replace(' ', '_')}" for m in _MOVES)

register("R1_movement_counts", o.statement("fct_mrr_movements", f"""
SELECT billing_month, {_COUNTED} FROM fct_mrr_movements GROUP BY ALL"""))(
    lambda s, d: marts.movement_counts(warehouse(s, d).fct_mrr_movements))

register("R2_risk_rates", o.statement("fct_charges fct_refunds fct_disputes", f"""
WITH c AS (SELECT {month('created_date')} AS month, count(*) n, sum(amount_usd) usd FROM fct_charges GROUP BY ALL),
 r AS (SELECT {month('created_date')} AS month, count(*) n, sum(amount_usd) usd FROM fct_refunds GROUP BY ALL),
 p AS (SELECT {month('created_date')} AS month, count(*) n, count(*) FILTER (is_won) won,
   count(*) FILTER (is_lost) lost, sum(loss_amount_usd) usd FROM fct_disputes GROUP BY ALL),
 m AS (SELECT month FROM c UNION SELECT month FROM r UNION SELECT month FROM p),
 j AS (SELECT m.month, ifnull(c.n, 0) AS charges, ifnull(r.n, 0) AS refunds, ifnull(p.n, 0) AS disputes,
  ifnull(won, 0) AS won, ifnull(lost, 0) AS lost, CAST(ifnull(c.usd, 0) AS {T}) AS charged_usd,
  CAST(ifnull(r.usd, 0) AS {T}) AS refunded_usd, CAST(ifnull(p.usd, 0) AS {T}) AS loss_usd
  FROM m LEFT JOIN c USING (month) LEFT JOIN r USING (month) LEFT JOIN p USING (month))
SELECT *, {ratio('refunds', 'charges')} AS refund_rate, {ratio('refunded_usd', 'charged_usd')} AS refunded_share,
 {ratio('disputes', 'charges')} AS dispute_rate, {ratio('won', '(won + lost)')} AS dispute_win_rate FROM j"""))(
    lambda s, d: (lambda w: marts.risk_rates(w.charges_daily, w.refunds_daily, w.disputes_daily))(warehouse(s, d)))

register("R3_charge_outcomes", o.statement("fct_charges", f"""
SELECT {month('created_date')} AS month, payment_method_type, card_brand, count(*) AS attempts,
 count(*) FILTER (status = 'succeeded') AS succeeded, count(*) FILTER (is_failed) AS failed,
 {ratio("count(*) FILTER (status = 'succeeded')", 'count(*)')} AS success_rate, CAST(sum(amount_usd) AS {T}) AS amount_usd
FROM fct_charges GROUP BY ALL"""))(
    lambda s, d: marts.charge_outcomes(warehouse(s, d).charges_daily))

register("R3_failure_codes", o.statement("fct_charges", f"""
SELECT failure_code, payment_method_type, count(*) AS charges, CAST(sum(amount_usd) AS {T}) AS amount_usd
FROM fct_charges WHERE is_failed GROUP BY ALL"""))(
    lambda s, d: marts.failure_codes(warehouse(s, d).charges_daily))

register("R4_refund_latency", o.statement("fct_refunds", """
SELECT reason, count(*) AS refunds, CAST(quantile_cont(CAST(days_since_charge AS DOUBLE), 0.5) AS DOUBLE) AS median_days,
 CAST(quantile_cont(CAST(days_since_charge AS DOUBLE), 0.9) AS DOUBLE) AS p90_days, min(days_since_charge) AS min_days,
 max(days_since_charge) AS max_days, count(*) FILTER (days_since_charge < 0) AS before_charge,
 count(*) FILTER (days_since_charge BETWEEN 0 AND 7) AS "0_7_days",
 count(*) FILTER (days_since_charge BETWEEN 8 AND 30) AS "8_30_days",
 count(*) FILTER (days_since_charge BETWEEN 31 AND 90) AS "31_90_days",
 count(*) FILTER (days_since_charge > 90) AS over_90_days
FROM fct_refunds WHERE days_since_charge IS NOT NULL GROUP BY ALL"""))(
    lambda s, d: marts.refund_latency(warehouse(s, d).refunds_daily))

register("R4_dispute_sla", o.statement("fct_disputes", f"""
SELECT outcome_category, count(*) AS disputes, count(*) FILTER (is_overdue) AS overdue,
 count(*) FILTER (has_evidence_submitted) AS with_evidence,
 CAST(quantile_cont(CAST(days_to_evidence_due AS DOUBLE), 0.5) AS DOUBLE) AS median_days_to_due,
 min(days_to_evidence_due) AS min_days_to_due, max(days_to_evidence_due) AS max_days_to_due,
 CAST(sum(amount_usd) AS {T}) AS amount_usd
FROM fct_disputes GROUP BY ALL"""))(
    lambda s, d: marts.dispute_sla(warehouse(s, d).disputes_daily))

register("R5_cash_by_day", o.statement("fct_payouts", f"""
SELECT arrival_date, count(*) AS payouts, CAST(ifnull(sum(amount_usd) FILTER (is_paid), 0) AS {T}) AS net_cash_usd,
 CAST(ifnull(sum(amount_usd) FILTER (is_paid AND is_instant), 0) AS {T}) AS instant_usd,
 CAST(ifnull(sum(amount_usd) FILTER (is_paid AND NOT is_instant), 0) AS {T}) AS standard_usd,
 count(*) FILTER (is_failed) AS failed
FROM fct_payouts GROUP BY ALL"""))(
    lambda s, d: marts.cash_by_day(warehouse(s, d).fct_payouts))

register("R5_transit_days", o.statement("fct_payouts", f"""
SELECT method, transit_days, count(*) AS payouts, CAST(sum(amount_usd) AS {T}) AS amount_usd
FROM fct_payouts GROUP BY ALL"""))(
    lambda s, d: marts.transit_days(warehouse(s, d).fct_payouts))

register("R5_failed_payouts", o.statement("fct_payouts", f"""
SELECT {month('created_date')} AS month, failure_code, currency, count(*) AS payouts, CAST(sum(amount_usd) AS {T}) AS amount_usd
FROM fct_payouts WHERE is_failed GROUP BY ALL"""))(
    lambda s, d: marts.failed_payouts(warehouse(s, d).fct_payouts))

register("R6_customers_by_region", o.statement("dim_customers dim_geography", """
SELECT region, market_tier, count(*) AS customers, count(*) FILTER (delinquent) AS delinquent
FROM dim_customers LEFT JOIN dim_geography ON country_code = upper(trim(billing_country))
WHERE is_current GROUP BY ALL"""))(
    lambda s, d: (lambda w: marts.customers_by_region(w.dim_customers, w.dim_geography))(warehouse(s, d)))

register("R6_mrr_by_region_and_plan", o.statement("fct_mrr_movements dim_customers dim_geography", f"""
SELECT ifnull(region, 'Unknown') AS region, ifnull(market_tier, 'Unknown') AS market_tier, plan_id, billing_month,
 CAST(sum(mrr_usd) AS {T}) AS mrr_usd, count(*) AS customers, count(*) FILTER (movement_type = 'Churn') AS churned
FROM fct_mrr_movements m LEFT JOIN (SELECT * FROM dim_customers WHERE is_current) cu ON cu.customer_id = m.customer_id
 LEFT JOIN dim_geography g ON g.country_code = upper(trim(cu.billing_country))
GROUP BY ALL"""))(
    lambda s, d: (lambda w: marts.mrr_by_region_and_plan(
        w.fct_mrr_movements, w.dim_customers, w.dim_geography))(warehouse(s, d)))

register("R6_mrr_by_pricing_tier", o.statement("fct_mrr_movements dim_plans", f"""
SELECT billing_month, pricing_tier, CAST(sum(mrr_usd) AS {T}) AS mrr_usd, count(*) AS customers
FROM fct_mrr_movements LEFT JOIN
 (SELECT plan_id, arg_max(pricing_tier, monthly_price_usd) AS pricing_tier FROM dim_plans GROUP BY plan_id) USING (plan_id)
GROUP BY ALL"""))(
    lambda s, d: (lambda w: marts.mrr_by_pricing_tier(w.fct_mrr_movements, w.dim_plans))(warehouse(s, d)))

register("R7_masked_customers", o.statement("dim_customers", """
SELECT sha256('pepper:' || sha256('pepper:' || customer_id)) AS customer_hash, created_date, currency,
 sha256('pepper:' || sha256('pepper:' || email)) AS email_hash,
 regexp_extract(email, '@(.*)$', 1) AS email_domain,
 regexp_replace(regexp_replace(regexp_replace(name, '[0-9]', 'n', 'g'), '[A-Z]', 'X', 'g'), '[a-mo-z]', 'x', 'g') AS name_masked,
 phone AS phone_masked, billing_country, left(address_postal_code, 2) AS postal_area, delinquent, balance, tax_exempt,
 valid_from, valid_to, is_current
FROM dim_customers"""))(
    lambda s, d: marts.masked_customers(warehouse(s, d).dim_customers, "pepper"))
