"""DuckDB statements that recompute every registered query from the base tables.

They are written against the documented rules, not generated from the Spark code. Only
the RAW view texts and the constant label tables are shared.
"""

from __future__ import annotations

from adapters import RAW_NEEDS, VIEWS, duckdb_raw
from ledgerlake.plans import labels
from ledgerlake.schemas import RAW

AS_OF_DATE = "DATE '2024-03-01'"
AS_OF_TS = "TIMESTAMP '2024-03-01 00:00:00'"

DUCK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "decimal(12,6)": "DECIMAL(12,6)",
    "decimal(18,2)": "DECIMAL(18,2)", "int": "INTEGER",
}

# name -> (needed names, SELECT)
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: str, sql: str) -> None:
    CTES[name] = (needs.split(), sql.strip())


def statement(needs: str, select: str) -> str:
    """``WITH`` clause for everything ``needs`` depends on, then ``select``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for name in needs.split():
        visit(name)
    if not order:
        return select.strip()
    body = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    select = select.strip()
    if select.startswith("WITH "):  # the statement has a clause of its own: one list of both
        return f"WITH {body},\n{select[len('WITH '):]}"
    return f"WITH {body}\n{select}"


def whole(name: str) -> str:
    return statement(name, f"SELECT * FROM {name}")


# --- RAW: the view plus typed NULLs for the columns it lacks -----------------------------

_VIEW_COLUMNS = {
    "fx_rates": "rate_date from_currency to_currency rate loaded_at ingestion_run_id",
    "customers": "id created currency email name address_country delinquent balance loaded_at ingestion_run_id",
    "charges": "id amount amount_captured amount_refunded status currency created raw_payload loaded_at ingestion_run_id",
    "refunds": "id amount charge currency created status reason failure_reason loaded_at ingestion_run_id",
    "disputes": "id amount charge currency status reason created evidence_details_due_by "
                "evidence_details_has_evidence loaded_at ingestion_run_id",
    "payouts": "id amount currency status method created arrival_date failure_code loaded_at ingestion_run_id",
    "subscriptions": "id customer plan_id loaded_at ingestion_run_id",
    "invoices": "id object account_country amount_due amount_paid amount_remaining created currency customer "
                "customer_email due_date period_end period_start status subscription subtotal tax total "
                "loaded_at ingestion_run_id",
    "invoice_line_items": "id invoice_id amount currency period_start period_end plan_id plan_interval "
                          "plan_interval_count price_id proration type subscription loaded_at ingestion_run_id",
    "balance_transactions": "id source amount fee net currency created available_on type "
                            "reporting_category status loaded_at ingestion_run_id",
}


def _typed_raw(entity: str) -> str:
    have = _VIEW_COLUMNS[entity].split()
    out = []
    for field in RAW[entity].fields:
        kind = DUCK_TYPES[field.dataType.simpleString()]
        if field.name in have:
            out.append(f"CAST({field.name} AS {kind}) AS {field.name}")
        elif field.name == "load_mode":
            out.append("'batch' AS load_mode")
        else:
            out.append(f"CAST(NULL AS {kind}) AS {field.name}")
    return f"SELECT {', '.join(out)} FROM view_{entity}"


for _entity in VIEWS:
    CTES[f"view_{_entity}"] = (
        [f"raw_{n}" for n in RAW_NEEDS[_entity]], duckdb_raw(_entity).strip())
    CTES[f"raw_{_entity}"] = ([f"view_{_entity}"], _typed_raw(_entity))


# --- BRONZE -----------------------------------------------------------------------------

LOADED = "source_file, ingestion_run_id, load_mode, loaded_at"


def at(c: str) -> str:
    return f"make_timestamp({c} * 1000000)"


def on(c: str) -> str:
    return f"CAST(make_timestamp({c} * 1000000) AS DATE)"


cte("brz_fx_rates", "raw_fx_rates", f"""
SELECT rate_date, upper(from_currency) AS from_currency, upper(to_currency) AS to_currency, rate, source, {LOADED}
FROM raw_fx_rates WHERE rate > 0""")

cte("brz_stripe_balance_transactions", "raw_balance_transactions", f"""
SELECT id, amount, fee, net, exchange_rate, {at('created')} AS created_at, {on('created')} AS created_date,
 {at('available_on')} AS available_on_at, lower(currency) AS currency, lower(ifnull(status,'unknown')) AS status,
 lower(ifnull(type,'unknown')) AS event_type, lower(ifnull(reporting_category,'unknown')) AS reporting_category,
 source AS source_id, description, {LOADED}
FROM raw_balance_transactions""")


def js(path: str) -> str:
    return f"json_extract_string(raw_payload, '$.{path}')"


cte("brz_stripe_charges", "raw_charges", f"""
SELECT id, amount, amount_captured, amount_refunded, lower(ifnull(status,'unknown')) AS status,
 ifnull(paid,false) AS paid, ifnull(captured,false) AS captured, ifnull(refunded,false) AS refunded,
 ifnull(disputed,false) AS disputed, lower(ifnull(currency,'usd')) AS currency,
 {at('created')} AS created_at, {on('created')} AS created_date,
 {js('customer')} AS customer_id, {js('invoice')} AS invoice_id, {js('payment_intent')} AS payment_intent_id,
 {js('payment_method')} AS payment_method_id, {js('balance_transaction')} AS balance_transaction_id,
 {js('failure_code')} AS failure_code, {js('failure_message')} AS failure_message,
 {js('description')} AS description, {js('receipt_email')} AS receipt_email, {js('receipt_url')} AS receipt_url,
 {js('statement_descriptor')} AS statement_descriptor,
 lower(ifnull({js('payment_method_details.type')},'unknown')) AS payment_method_type,
 lower(ifnull({js('payment_method_details.card.brand')},'unknown')) AS card_brand,
 lower(ifnull({js('payment_method_details.card.funding')},'unknown')) AS card_funding,
 upper(ifnull({js('payment_method_details.card.country')},'UNKNOWN')) AS card_country,
 {js('payment_method_details.card.last4')} AS card_last4,
 CAST({js('payment_method_details.card.exp_month')} AS BIGINT) AS card_exp_month,
 CAST({js('payment_method_details.card.exp_year')} AS BIGINT) AS card_exp_year, {LOADED}
FROM raw_charges""")

cte("brz_stripe_customers", "raw_customers", f"""
SELECT id, {at('created')} AS created_at, {on('created')} AS created_date, lower(ifnull(currency,'usd')) AS currency,
 description, lower(email) AS email, name, phone, upper(ifnull(address_country,'UNKNOWN')) AS billing_country,
 address_city, address_line1, address_postal_code, delinquent, balance, lower(ifnull(tax_exempt,'none')) AS tax_exempt,
 {LOADED}
FROM raw_customers""")

cte("brz_stripe_disputes", "raw_disputes", f"""
SELECT id, amount, lower(ifnull(currency,'usd')) AS currency, lower(ifnull(status,'unknown')) AS status,
 lower(ifnull(reason,'unknown')) AS reason, ifnull(lower(status)='won',false) AS is_won,
 ifnull(lower(status)='lost',false) AS is_lost, ifnull(is_charge_refundable,false) AS is_charge_refundable,
 {at('created')} AS created_at, {on('created')} AS created_date,
 {at('evidence_details_due_by')} AS evidence_due_at, {on('evidence_details_due_by')} AS evidence_due_date,
 ifnull(evidence_details_has_evidence,false) AS has_evidence_submitted, charge AS charge_id,
 payment_intent AS payment_intent_id, balance_transaction AS balance_transaction_id, {LOADED}
FROM raw_disputes""")

cte("brz_stripe_invoice_line_items", "raw_invoice_line_items", f"""
SELECT id, invoice_id, amount, lower(currency) AS currency, description,
 {at('period_start')} AS period_start_at, {at('period_end')} AS period_end_at,
 {on('period_start')} AS period_start_date, {on('period_end')} AS period_end_date, plan_id,
 lower(ifnull(plan_interval,'unknown')) AS plan_interval, plan_interval_count, plan_amount, price_id, proration,
 quantity, subscription, subscription_item, lower(ifnull(type,'unknown')) AS line_item_type, {LOADED}
FROM raw_invoice_line_items""")

cte("brz_stripe_payouts", "raw_payouts", f"""
SELECT id, amount, lower(ifnull(currency,'usd')) AS currency, lower(ifnull(status,'unknown')) AS status,
 lower(ifnull(type,'bank_account')) AS payout_type, lower(ifnull(method,'standard')) AS method,
 ifnull(automatic,true) AS automatic, {at('created')} AS created_at, {on('created')} AS created_date,
 {at('arrival_date')} AS arrival_at, {on('arrival_date')} AS arrival_date, destination AS destination_id,
 balance_transaction AS balance_transaction_id, failure_code, failure_message,
 failure_balance_transaction AS failure_balance_transaction_id, description, statement_descriptor, source_type, {LOADED}
FROM raw_payouts""")

cte("brz_stripe_refunds", "raw_refunds", f"""
SELECT id, amount, lower(ifnull(currency,'usd')) AS currency, lower(ifnull(status,'unknown')) AS status,
 {at('created')} AS created_at, {on('created')} AS created_date, charge AS charge_id,
 payment_intent AS payment_intent_id, balance_transaction AS balance_transaction_id,
 lower(ifnull(reason,'requested_by_customer')) AS reason, description, receipt_number,
 failure_balance_transaction AS failure_balance_transaction_id, lower(failure_reason) AS failure_reason, {LOADED}
FROM raw_refunds""")


# --- SILVER -----------------------------------------------------------------------------

cte("fx", "brz_fx_rates", """
SELECT from_currency, rate_date, CAST(arg_max(rate, (loaded_at, ingestion_run_id)) AS DECIMAL(12,6)) AS rate
FROM brz_fx_rates WHERE to_currency = 'USD' GROUP BY ALL""")


def latest(table: str, key: str = "id") -> str:
    return (f"(SELECT * FROM {table} QUALIFY row_number() OVER "
            f"(PARTITION BY {key} ORDER BY loaded_at DESC, ingestion_run_id DESC) = 1)")


def units(cents: str) -> str:
    return f"CAST(round(CAST({cents} AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2))"


def usd(cents: str, rate: str = "usd_rate") -> str:
    return (f"CAST(round(CAST({cents} AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)) * {rate}, 2) "
            f"AS DECIMAL(18,2))")


ONE = "CAST(1 AS DECIMAL(12,6))"


def priced(table: str, day: str = "created_date", currency: str = "upper(t.currency)") -> str:
    return (f"(SELECT t.*, ifnull(fx.rate, {ONE}) AS usd_rate FROM {latest(table)} t "
            f"LEFT JOIN fx ON fx.from_currency = {currency} AND fx.rate_date = t.{day})")


TAIL = "ingestion_run_id, load_mode, loaded_at"

cte("stg_charges", "brz_stripe_charges fx", f"""
SELECT id AS charge_id, customer_id, invoice_id, payment_intent_id, payment_method_id, balance_transaction_id,
 status, paid, captured, refunded, currency, {units('amount')} AS amount, {units('amount_captured')} AS amount_captured,
 {units('amount_refunded')} AS amount_refunded, {units('(amount-amount_refunded)')} AS net_amount, usd_rate,
 {usd('amount')} AS amount_usd, {usd('amount_captured')} AS amount_captured_usd,
 {usd('amount_refunded')} AS amount_refunded_usd, {usd('(amount-amount_refunded)')} AS net_amount_usd,
 payment_method_type, card_brand, card_funding, card_country, card_last4, card_exp_month, card_exp_year,
 failure_code, failure_message, failure_code IS NOT NULL AS is_failed, created_at, created_date,
 description, receipt_url, statement_descriptor, {TAIL}
FROM {priced('brz_stripe_charges')}""")


def neg(x: str) -> str:
    return f"CAST(-{x} AS DECIMAL(18,2))"


cte("stg_refunds", "brz_stripe_refunds fx", f"""
SELECT id AS refund_id, charge_id, payment_intent_id, balance_transaction_id, status, reason,
 status = 'succeeded' AS is_successful, currency, {units('amount')} AS amount, {neg(units('amount'))} AS signed_amount,
 usd_rate, {usd('amount')} AS amount_usd, {neg(usd('amount'))} AS signed_amount_usd,
 failure_balance_transaction_id, failure_reason, failure_reason IS NOT NULL AS is_failed, created_at, created_date,
 description, receipt_number, {TAIL}
FROM {priced('brz_stripe_refunds')}""")

cte("stg_disputes", "brz_stripe_disputes fx", f"""
SELECT id AS dispute_id, charge_id, payment_intent_id, balance_transaction_id, status, reason, is_won, is_lost,
 is_charge_refundable, has_evidence_submitted,
 CASE WHEN status = 'won' THEN 'Won' WHEN status = 'lost' THEN 'Lost' WHEN status = 'charge_refunded' THEN 'Charge Refunded'
  WHEN starts_with(status, 'warning') THEN 'Warning' WHEN status = 'needs_response' OR status = 'under_review' THEN 'In Progress'
  ELSE 'Unknown' END AS outcome_category,
 currency, {units('amount')} AS amount, {neg(units('amount'))} AS signed_amount, usd_rate,
 {usd('amount')} AS amount_usd, {neg(usd('amount'))} AS signed_amount_usd, evidence_due_at, evidence_due_date,
 CAST(evidence_due_date - created_date AS BIGINT) AS days_to_evidence_due,
 ifnull(evidence_due_date < {AS_OF_DATE} AND (status = 'needs_response' OR status = 'warning_needs_response'), false) AS is_overdue,
 created_at, created_date, {TAIL}
FROM {priced('brz_stripe_disputes')}""")

cte("stg_payouts", "brz_stripe_payouts fx", f"""
SELECT id AS payout_id, balance_transaction_id, destination_id, status, payout_type, method, automatic, source_type,
 status = 'paid' AS is_paid, status = 'failed' AS is_failed, status = 'canceled' AS is_canceled,
 method = 'instant' AS is_instant, currency, {units('amount')} AS amount, usd_rate, {usd('amount')} AS amount_usd,
 created_at, created_date, arrival_at, arrival_date, CAST(arrival_date - created_date AS BIGINT) AS transit_days,
 failure_code, failure_message, failure_balance_transaction_id, description, statement_descriptor, {TAIL}
FROM {priced('brz_stripe_payouts')}""")


def half_away(numerator: str, denominator: int) -> str:
    """Exact integer division to two decimals, half away from zero; the numerator carries six decimals."""
    n = f"CAST({numerator} AS HUGEINT)"
    return (f"CAST(sign({n}) * ((2 * abs({n}) + {denominator}) // (2 * {denominator})) AS DECIMAL(38,0)) "
            f"* CAST(0.01 AS DECIMAL(3,2))")


def mrr(rate: str, daily: bool = True) -> str:
    # amount * rate * 10^6 / (12 * 10^6) cents for year
    million = f"(CAST(amount AS HUGEINT) * CAST(CAST({rate} AS DECIMAL(38,6)) * 1000000 AS HUGEINT))"
    thousandth = f"({million} * 4333)"
    return f"""CAST(CASE plan_interval WHEN 'year' THEN {half_away(million, 12_000_000)}
  WHEN 'week' THEN {half_away(thousandth, 1_000_000_000)}
  WHEN 'day' THEN {half_away(f'({million} * {30 if daily else 1})', 1_000_000)}
  ELSE {half_away(million, 1_000_000)} END AS DECIMAL(18,2))"""


def line_items(daily_usd: bool) -> str:
    return f"""
SELECT id AS line_item_id, invoice_id, subscription, subscription_item, plan_id, price_id, plan_interval,
 plan_interval_count, period_start_date, period_end_date, currency, proration, quantity, line_item_type,
 line_item_type = 'subscription' AND proration IS NOT TRUE AS is_recurring, {units('amount')} AS amount,
 {mrr('1')} AS mrr_amount, usd_rate, {mrr('usd_rate', daily_usd)} AS mrr_amount_usd, {TAIL}
FROM {priced('brz_stripe_invoice_line_items', 'period_start_date')}"""


cte("stg_invoice_line_items", "brz_stripe_invoice_line_items fx", line_items(True))
cte("stg_invoice_line_items_unscaled", "brz_stripe_invoice_line_items fx", line_items(False))


def ledger(currency: str) -> str:
    outgoing = "event_type IN ('refund', 'dispute', 'adjustment')"
    return f"""
SELECT id AS transaction_id, source_id, event_type, reporting_category, status, currency, created_at, created_date,
 available_on_at, {units('amount')} AS amount, {units('fee')} AS fee, {units('net')} AS net_amount, usd_rate,
 {usd('amount')} AS amount_usd, {usd('fee')} AS fee_usd, {usd('net')} AS net_amount_usd,
 CAST(CASE WHEN {outgoing} THEN -abs({units('net')}) ELSE {units('net')} END AS DECIMAL(18,2)) AS signed_net_amount,
 CAST(CASE WHEN {outgoing} THEN -abs({usd('net')}) ELSE {usd('net')} END AS DECIMAL(18,2)) AS signed_net_amount_usd,
 description, {TAIL}
FROM {priced('brz_stripe_balance_transactions', currency=currency)}"""


cte("stg_finance_ledger_events", "brz_stripe_balance_transactions fx", ledger("upper(t.currency)"))
cte("stg_finance_ledger_events_case", "brz_stripe_balance_transactions fx", ledger("t.currency"))

HISTORY_COLUMNS = ("created_at, created_date, currency, email, name, phone, billing_country, address_city, "
                   "address_postal_code, delinquent, balance, tax_exempt")


def history(source: str) -> str:
    return f"""
SELECT md5(id || '-' || strftime(loaded_at, '%Y-%m-%d %H:%M:%S.%f')) AS customer_key, id AS customer_id,
 {HISTORY_COLUMNS}, loaded_at AS valid_from,
 ifnull(lead(loaded_at) OVER w, TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
 lead(loaded_at) OVER w IS NULL AS is_current, {TAIL}
FROM {source} WINDOW w AS (PARTITION BY id ORDER BY loaded_at)"""


cte("stg_customers_history", "brz_stripe_customers", history(latest("brz_stripe_customers", "id, loaded_at")))


# --- GOLD -------------------------------------------------------------------------------

NULL_KEY = "_dbt_utils_surrogate_key_null_"


def key(*cols: str) -> str:
    parts = [f"ifnull(CAST({c} AS VARCHAR), '{NULL_KEY}')" for c in cols]
    return f"md5(concat_ws('-', {', '.join(parts)}))"


def quoted(value: object) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    return "'" + str(value).replace("'", "''") + "'"


def translated(col: str, values: dict, default: str) -> str:
    arms = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in values.items())
    return f"CASE {col} {arms} ELSE {default} END"


cte("dim_customers", "stg_customers_history", f"""
SELECT customer_key, customer_id, {HISTORY_COLUMNS}, valid_from, valid_to, is_current FROM stg_customers_history""")


def calendar(days: str) -> str:
    return f"""
SELECT d AS date_day, {key('d')} AS date_key, CAST(year(d) AS INTEGER) AS calendar_year,
 CAST(month(d) AS INTEGER) AS calendar_month, CAST(day(d) AS INTEGER) AS calendar_day,
 CAST(dayofweek(d) AS INTEGER) AS day_of_week, left(dayname(d), 3) AS day_name,
 CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(quarter(d) AS INTEGER) AS calendar_quarter,
 CAST(year(d - INTERVAL 6 MONTH) AS INTEGER) AS fiscal_year,
 CAST((month(d) + 5) % 12 + 1 AS INTEGER) AS fiscal_month,
 CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
 day(d) = 1 AS is_month_start, d = last_day(d) AS is_month_end, isodow(d) >= 6 AS is_weekend
FROM ({days})"""


cte("dim_dates", "", calendar(
    "SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d"))
cte("active_days", "raw_charges", f"""
SELECT CAST(unnest(generate_series(min({on('created')}), max({on('created')}), INTERVAL 1 DAY)) AS DATE) AS d FROM raw_charges""")
cte("dim_dates_active", "active_days", calendar("SELECT d FROM active_days"))

_REGIONS = {c: r for r, cs in labels.CURRENCY_REGIONS.items() for c in cs}
cte("dim_currencies", "brz_fx_rates", f"""
WITH last_rate AS (SELECT from_currency AS code, rate, rate_date FROM brz_fx_rates WHERE to_currency = 'USD'
  QUALIFY row_number() OVER (PARTITION BY from_currency ORDER BY rate_date DESC, loaded_at DESC, ingestion_run_id DESC) = 1),
 members AS (SELECT * FROM last_rate UNION ALL SELECT 'USD', {ONE}, {AS_OF_DATE}
  WHERE NOT EXISTS (SELECT 1 FROM last_rate WHERE code = 'USD'))
SELECT md5(code) AS currency_key, code AS currency_code,
 {translated('code', labels.CURRENCY_NAMES, "code || ' (Unknown)'")} AS currency_name,
 {translated('code', labels.CURRENCY_SYMBOLS, 'code')} AS currency_symbol,
 {translated('code', _REGIONS, "'Other'")} AS region, code = 'USD' AS is_base_currency,
 CAST(rate AS DECIMAL(12,6)) AS latest_usd_rate, rate_date AS latest_rate_date
FROM members""")


def country(i: int, default: str) -> str:
    return translated("code", {k: v[i] for k, v in labels.COUNTRIES.items()}, default)


cte("dim_geography", "stg_customers_history", f"""
SELECT md5(code) AS geography_key, code AS country_code, {country(0, "code || ' (Unknown)'")} AS country_name,
 {country(1, "'Other'")} AS region, {country(2, "'Other'")} AS sub_region, {country(3, "'Tier 3'")} AS market_tier,
 {AS_OF_TS} AS dbt_updated_at
FROM (SELECT DISTINCT upper(trim(billing_country)) AS code FROM stg_customers_history
      WHERE is_current AND billing_country <> '')""")


def event(i: int, default: str) -> str:
    return translated("event_type", {k: v[i] for k, v in labels.PAYMENT_EVENTS.items()}, default)


cte("dim_payment_category", "stg_finance_ledger_events", f"""
SELECT {key('event_type', 'reporting_category')} AS payment_category_key, event_type, reporting_category,
 {event(0, "upper(left(event_type,1)) || substr(event_type,2)")} AS event_label,
 {event(1, "'Other'")} AS financial_category, {event(2, "'Neutral'")} AS sign_convention,
 {event(3, 'false')} AS affects_revenue, {event(4, 'false')} AS affects_cash, {AS_OF_TS} AS dbt_updated_at
FROM (SELECT event_type, reporting_category FROM stg_finance_ledger_events
      WHERE event_type IS NOT NULL GROUP BY ALL)""")

cte("dim_plans", "stg_invoice_line_items", f"""
SELECT {key('plan_id', 'price_id')} AS plan_key, plan_id, price_id, plan_interval, plan_interval_count,
 upper(currency) AS currency,
 CASE WHEN plan_interval = 'week' THEN 'Weekly' WHEN plan_interval = 'day' THEN 'Daily'
  ELSE ifnull({translated("plan_interval || plan_interval_count",
                          {f"{u}{n}": v for (u, n), v in labels.BILLING_CADENCES.items()}, "NULL")},
              plan_interval || ' x' || plan_interval_count) END AS billing_cadence,
 CASE WHEN mrr_amount_usd >= 1000 OR mrr_amount_usd IS NULL THEN 'Enterprise' WHEN mrr_amount_usd >= 200 THEN 'Professional'
  WHEN mrr_amount_usd >= 50 THEN 'Growth' ELSE 'Starter' END AS pricing_tier,
 plan_interval = 'year' AS is_annual, mrr_amount_usd AS monthly_price_usd,
 CAST(mrr_amount_usd * 12 AS DECIMAL(18,2)) AS annual_price_usd
FROM (SELECT * FROM stg_invoice_line_items WHERE is_recurring AND plan_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY plan_id, price_id
        ORDER BY loaded_at DESC, ingestion_run_id DESC, line_item_id DESC) = 1)""")

CUSTOMER_JOIN = "LEFT JOIN (SELECT customer_id, customer_key FROM dim_customers WHERE is_current) cu ON cu.customer_id = "
CREATED_JOIN = "LEFT JOIN dim_dates dd ON dd.date_day = f.created_date"
CURRENCY_JOIN = "LEFT JOIN dim_currencies cc ON cc.currency_code = upper(f.currency)"

cte("fct_charges", "stg_charges dim_customers dim_dates dim_currencies", f"""
SELECT f.* EXCLUDE (payment_method_id, card_exp_month, card_exp_year, statement_descriptor, load_mode),
 cu.customer_key, dd.date_key AS created_date_key, cc.currency_key
FROM stg_charges f {CUSTOMER_JOIN} f.customer_id {CREATED_JOIN} {CURRENCY_JOIN}""")

cte("fct_refunds", "stg_refunds stg_charges dim_customers dim_dates dim_currencies", f"""
SELECT f.* EXCLUDE (payment_intent_id, failure_balance_transaction_id, load_mode), c.customer_id,
 CAST(f.created_date - c.created_date AS BIGINT) AS days_since_charge,
 cu.customer_key, dd.date_key AS created_date_key, cc.currency_key
FROM stg_refunds f LEFT JOIN stg_charges c ON c.charge_id = f.charge_id
 {CUSTOMER_JOIN} c.customer_id {CREATED_JOIN} {CURRENCY_JOIN}""")

cte("fct_disputes", "stg_disputes stg_charges dim_customers dim_dates dim_currencies", f"""
SELECT f.* EXCLUDE (payment_intent_id, load_mode), c.customer_id,
 CAST(f.created_date - c.created_date AS BIGINT) AS days_since_charge,
 CAST(CASE WHEN is_lost THEN f.amount_usd ELSE 0 END AS DECIMAL(18,2)) AS loss_amount_usd,
 cu.customer_key, dd.date_key AS created_date_key, cc.currency_key
FROM stg_disputes f LEFT JOIN stg_charges c ON c.charge_id = f.charge_id
 {CUSTOMER_JOIN} c.customer_id {CREATED_JOIN} {CURRENCY_JOIN}""")

cte("fct_payouts", "stg_payouts dim_dates dim_currencies", f"""
SELECT f.* EXCLUDE (failure_balance_transaction_id, load_mode), dd.date_key AS created_date_key,
 ad.date_key AS arrival_date_key, cc.currency_key
FROM stg_payouts f {CREATED_JOIN} LEFT JOIN dim_dates ad ON ad.date_day = f.arrival_date {CURRENCY_JOIN}""")

cte("fct_transactions_direct", "stg_finance_ledger_events dim_customers dim_dates", f"""
SELECT f.*, cu.customer_key, dd.date_key FROM stg_finance_ledger_events f {CUSTOMER_JOIN} f.source_id {CREATED_JOIN}""")

cte("fct_transactions", "stg_finance_ledger_events stg_charges stg_refunds stg_disputes dim_customers dim_dates", f"""
SELECT f.*, ifnull(cu.customer_key, via.customer_key) AS customer_key, dd.date_key
FROM stg_finance_ledger_events f {CUSTOMER_JOIN} f.source_id
 LEFT JOIN stg_refunds r ON r.refund_id = f.source_id
 LEFT JOIN stg_disputes p ON p.dispute_id = f.source_id
 LEFT JOIN stg_charges c ON c.charge_id = coalesce(r.charge_id, p.charge_id, f.source_id)
 LEFT JOIN (SELECT customer_id, customer_key FROM dim_customers WHERE is_current) via ON via.customer_id = c.customer_id
 {CREATED_JOIN}""")

cte("recurring", "stg_invoice_line_items", """
SELECT subscription, plan_id, CAST(date_trunc('month', period_start_date) AS DATE) AS billing_month,
 CAST(sum(mrr_amount_usd) AS DECIMAL(28,2)) AS mrr_usd
FROM stg_invoice_line_items WHERE is_recurring AND mrr_amount_usd IS NOT NULL GROUP BY ALL""")

cte("subscription_customers", "raw_subscriptions", f"""
SELECT id AS subscription_id, customer AS customer_id FROM {latest('raw_subscriptions')}""")

cte("monthly_mrr", "recurring subscription_customers", """
SELECT ifnull(s.customer_id, r.subscription) AS customer_id, r.plan_id, billing_month,
 CAST(sum(mrr_usd) AS DECIMAL(18,2)) AS mrr_usd
FROM recurring r LEFT JOIN subscription_customers s ON s.subscription_id = r.subscription GROUP BY ALL""")

cte("fct_mrr_movements", "monthly_mrr", f"""
WITH l AS (SELECT *, lag(mrr_usd) OVER (PARTITION BY customer_id, plan_id ORDER BY billing_month) AS prior_mrr_usd FROM monthly_mrr)
SELECT {key('customer_id', 'plan_id', 'billing_month')} AS mrr_key, customer_id, plan_id, billing_month, mrr_usd,
 prior_mrr_usd, CAST(mrr_usd - ifnull(prior_mrr_usd, 0) AS DECIMAL(18,2)) AS mrr_change_usd,
 CASE WHEN prior_mrr_usd IS NULL THEN 'New' WHEN prior_mrr_usd > 0 AND mrr_usd = 0 THEN 'Churn'
  WHEN mrr_usd > prior_mrr_usd THEN 'Expansion' WHEN mrr_usd > 0 AND mrr_usd < prior_mrr_usd THEN 'Contraction'
  ELSE 'No Change' END AS movement_type, {AS_OF_TS} AS dbt_updated_at
FROM l""")
