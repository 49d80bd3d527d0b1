"""Bronze, Silver and Gold on small literal frames."""

from decimal import Decimal as D

import pytest
from conftest import day, epoch, plan, ts

from ledgerlake.operators.fx import daily_rates, rate_lookup
from ledgerlake.plans import bronze, gold, silver
from ledgerlake.plans.warehouse import Warehouse

LOAD = {"loaded_at": ts("2024-02-01"), "ingestion_run_id": "r1"}
AS_OF = ts("2024-03-01")


@pytest.fixture
def rates(raw):
    rows = [
        ("2024-01-10", "EUR", "1.1", 1), ("2024-01-10", "eur", "1.2", 2), ("2024-01-11", "EUR", "0", 3),
        ("2024-01-11", "EUR", None, 3), ("2024-01-10", "gbp", "123.499995", 1),
    ]
    return rate_lookup(daily_rates(bronze.brz_fx_rates(raw("fx_rates", [
        {"rate_date": day(d), "from_currency": c, "to_currency": "usd", "rate": None if r is None else D(r),
         "loaded_at": ts(f"2024-02-0{n}"), "ingestion_run_id": "r1"} for d, c, r, n in rows]))))


def charge(**kw):
    return {"id": "ch_1", "amount": 1000, "amount_captured": 1000, "amount_refunded": 0,
            "created": epoch("2024-01-10T12:00:00"), **LOAD, **kw}


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_bronze_defaults(raw):
    c = bronze.brz_stripe_charges(raw("charges", [charge()])).first()
    assert (c.status, c.currency, c.paid, c.disputed) == ("unknown", "usd", False, False)
    assert (c.payment_method_type, c.card_country, c.card_exp_year, c.customer_id) == (
        "unknown", "UNKNOWN", None, None)
    r = bronze.brz_stripe_refunds(raw("refunds", [{"id": "re", **LOAD}])).first()
    assert (r.reason, r.status, r.currency, r.created_date) == ("requested_by_customer", "unknown", "usd", None)
    p = bronze.brz_stripe_payouts(raw("payouts", [{"id": "po", **LOAD}])).first()
    assert (p.method, p.payout_type, p.automatic) == ("standard", "bank_account", True)
    u = bronze.brz_stripe_customers(raw("customers", [{"id": "cu", "email": "A@B.C", **LOAD}])).first()
    assert (u.billing_country, u.tax_exempt, u.email) == ("UNKNOWN", "none", "a@b.c")
    d = bronze.brz_stripe_disputes(raw("disputes", [{"id": "dp", "status": "WON", **LOAD}])).first()
    assert (d.is_won, d.is_lost, d.has_evidence_submitted, d.reason) == (True, False, False, "unknown")


@pytest.mark.parametrize("payload, want", [
    ('{"customer":"cus_1","payment_method_details":{"type":"Card","card":{"brand":"Visa","country":"us","exp_year":2030}}}',
     ("cus_1", "card", "visa", "US", 2030)),
    ('{"customer":"cus_1","payment_method_details":{"type":"iban"}}', ("cus_1", "iban", "unknown", "UNKNOWN", None)),
    ('{"customer":null,"payment_method_details":null}', (None, "unknown", "unknown", "UNKNOWN", None)),
    ('{"customer":"cus_1","payment_method_details":{"card":{"exp_year":"2031"}}}',
     ("cus_1", "unknown", "unknown", "UNKNOWN", 2031)),
    ("{broken", (None, "unknown", "unknown", "UNKNOWN", None)),
    (None, (None, "unknown", "unknown", "UNKNOWN", None)),
])
def test_charge_payload(raw, payload, want):
    c = bronze.brz_stripe_charges(raw("charges", [charge(raw_payload=payload)])).first()
    assert (c.customer_id, c.payment_method_type, c.card_brand, c.card_country, c.card_exp_year) == want


def test_charge_payload_is_parsed_once(spark, raw, folder):
    raw("charges", [charge()]).write.parquet(folder)
    text = plan(bronze.brz_stripe_charges(spark.read.parquet(folder)))
    assert text.count("from_json(") == 1 and "Python" not in text


def test_charges(raw, rates):
    rows = [
        charge(id="late", currency="EUR", amount=2000, loaded_at=ts("2024-02-02")),
        charge(id="late", currency="EUR"),
        charge(id="cent", currency="GBP", amount=1, amount_captured=1),
        charge(id="no_rate", currency="EUR", created=epoch("2024-01-11T00:00:00")),
        charge(id="plain", amount_refunded=250, raw_payload='{"failure_code":"declined"}'),
    ]
    got = by(silver.stg_charges(bronze.brz_stripe_charges(raw("charges", rows)), rates), "charge_id")
    assert (got["late"]["usd_rate"], got["late"]["amount_usd"]) == (D("1.2"), D("24.00"))
    assert got["cent"]["amount_usd"] == D("1.23")
    assert (got["no_rate"]["usd_rate"], got["no_rate"]["amount_usd"]) == (D(1), D("10.00"))
    assert (got["plain"]["net_amount"], got["plain"]["is_failed"]) == (D("7.50"), True)
    assert len(got) == 4


@pytest.mark.parametrize("status, outcome", [
    ("won", "Won"), ("LOST", "Lost"), ("charge_refunded", "Charge Refunded"), ("warning_closed", "Warning"),
    ("warning_needs_response", "Warning"), ("needs_response", "In Progress"), ("under_review", "In Progress"),
    ("other", "Unknown"), (None, "Unknown"),
])
def test_dispute_outcomes(raw, rates, status, outcome):
    row = {"id": "dp", "amount": 100, "status": status, "created": epoch("2024-01-10T00:00:00"), **LOAD}
    got = silver.stg_disputes(bronze.brz_stripe_disputes(raw("disputes", [row])), rates, AS_OF.date()).first()
    assert got.outcome_category == outcome and got.signed_amount == D("-1.00")


@pytest.mark.parametrize("due, status, overdue", [
    ("2024-02-29", "needs_response", True), ("2024-03-01", "needs_response", False),
    ("2024-03-02", "needs_response", False), ("2024-02-29", "won", False),
    ("2024-02-29", "warning_needs_response", True), (None, "needs_response", False),
])
def test_dispute_deadline(raw, rates, due, status, overdue):
    row = {"id": "dp", "amount": 1, "status": status, "created": epoch("2024-02-01T00:00:00"),
           "evidence_details_due_by": epoch(f"{due}T00:00:00") if due else None, **LOAD}
    got = silver.stg_disputes(bronze.brz_stripe_disputes(raw("disputes", [row])), rates, AS_OF.date()).first()
    assert got.is_overdue is overdue
    assert got.days_to_evidence_due == ((day(due) - day("2024-02-01")).days if due else None)


def test_ledger_signs_and_currency(raw, rates):
    rows = [{"id": k, "type": k, "amount": n, "fee": 10, "net": n, "currency": "eur",
             "created": epoch("2024-01-10T00:00:00"), **LOAD}
            for k, n in (("charge", 500), ("Refund", 500), ("dispute", -500), ("payout", -500))]
    brz = bronze.brz_stripe_balance_transactions(raw("balance_transactions", rows))
    got = by(silver.stg_finance_ledger_events(brz, rates), "transaction_id")
    assert {k: v["signed_net_amount_usd"] for k, v in got.items()} == {
        "charge": D("6.00"), "Refund": D("-6.00"), "dispute": D("-6.00"), "payout": D("-6.00")}
    kept = by(silver.stg_finance_ledger_events(brz, rates, match_currency_case=True), "transaction_id")
    assert {v["usd_rate"] for v in kept.values()} == {D(1)}


def customer(id_, at, country, run="r1"):
    return {"id": id_, "address_country": country, "loaded_at": ts(at), "ingestion_run_id": run}


CUSTOMERS = [customer("one", "2024-01-01", "us"),
             customer("three", "2024-01-01", "us"), customer("three", "2024-01-02", "us"),
             customer("three", "2024-01-03T12:00:00", "de"),
             customer("twice", "2024-01-01", "us"), customer("twice", "2024-01-01", "gb", run="r2")]


def spans(df):
    return sorted((r.customer_id, str(r.valid_from), str(r.valid_to), r.is_current, r.billing_country)
                  for r in df.collect())


def test_customer_history(raw):
    got = silver.stg_customers_history(bronze.brz_stripe_customers(raw("customers", CUSTOMERS)))
    assert spans(got) == [
        ("one", "2024-01-01 00:00:00", "9999-12-31 00:00:00", True, "US"),
        ("three", "2024-01-01 00:00:00", "2024-01-02 00:00:00", False, "US"),
        ("three", "2024-01-02 00:00:00", "2024-01-03 12:00:00", False, "US"),
        ("three", "2024-01-03 12:00:00", "9999-12-31 00:00:00", True, "DE"),
        ("twice", "2024-01-01 00:00:00", "9999-12-31 00:00:00", True, "GB")]
    assert got.select("customer_key").distinct().count() == 5


def test_customer_history_changes_only(raw):
    got = silver.stg_customers_history(
        bronze.brz_stripe_customers(raw("customers", CUSTOMERS)), changes_only=True)
    assert [s for s in spans(got) if s[0] == "three"] == [
        ("three", "2024-01-01 00:00:00", "2024-01-03 12:00:00", False, "US"),
        ("three", "2024-01-03 12:00:00", "9999-12-31 00:00:00", True, "DE")]


def test_customer_history_in_steps(raw):
    """Existing rows of touched customers are closed; the others are left out."""
    first = silver.stg_customers_history(bronze.brz_stripe_customers(raw("customers", CUSTOMERS[:3])))
    step = silver.stg_customers_history(
        bronze.brz_stripe_customers(raw("customers", CUSTOMERS[3:4])), existing=first)
    whole = silver.stg_customers_history(bronze.brz_stripe_customers(raw("customers", CUSTOMERS[:4])))
    assert spans(step) == [s for s in spans(whole) if s[0] == "three"] and len(spans(step)) == 3


def line(id_, month, amount, sub="s1", plan_="p1", interval="month", count=1, **kw):
    return {"id": id_, "amount": amount, "period_start": epoch(f"{month}-05T00:00:00"), "plan_id": plan_,
            "plan_interval": interval, "plan_interval_count": count, "subscription": sub,
            "type": "subscription", "currency": "usd", **LOAD, **kw}


def lines(raw, rates, rows):
    return silver.stg_invoice_line_items(
        bronze.brz_stripe_invoice_line_items(raw("invoice_line_items", rows)), rates)


def test_line_flags(raw, rates):
    got = by(lines(raw, rates, [
        line("a", "2024-01", 100), line("b", "2024-01", 100, proration=True), line("c", "2024-01", 100, proration=False),
        line("d", "2024-01", 100, type="invoiceitem")]), "line_item_id")
    assert {k: v["is_recurring"] for k, v in got.items()} == {"a": True, "b": False, "c": True, "d": False}


def test_mrr_movements(raw, rates):
    series = [("01", 1000), ("02", 2000), ("03", 1500), ("04", 0), ("05", 0), ("06", 500), ("09", 500), ("10", -100)]
    rows = [line(f"l{m}", f"2024-{m}", n) for m, n in series]
    subs = raw("subscriptions", [{"id": "s1", "customer": "old", **LOAD},
                                 {"id": "s1", "customer": "cus", **LOAD, "loaded_at": ts("2024-02-02")}])
    got = gold.fct_mrr_movements(lines(raw, rates, rows), subs, AS_OF).orderBy("billing_month").collect()
    assert [r.movement_type for r in got] == [
        "New", "Expansion", "Contraction", "Churn", "No Change", "Expansion", "No Change", "No Change"]
    assert [str(r.mrr_change_usd) for r in got] == [
        "10.00", "10.00", "-5.00", "-15.00", "0.00", "5.00", "0.00", "-6.00"]
    assert {r.customer_id for r in got} == {"cus"}


def test_mrr_sums_subscriptions_of_a_customer(raw, rates):
    rows = [line("a", "2024-01", 1000), line("b", "2024-01", 500, sub="s2"), line("c", "2024-02", 700, sub="s2"),
            line("d", "2024-01", 900, sub="unknown")]
    subs = raw("subscriptions", [{"id": s, "customer": "cus", **LOAD} for s in ("s1", "s2")])
    got = gold.fct_mrr_movements(lines(raw, rates, rows), subs, AS_OF).collect()
    assert sorted((r.customer_id, str(r.billing_month), str(r.mrr_usd), r.movement_type) for r in got) == [
        ("cus", "2024-01-01", "15.00", "New"), ("cus", "2024-02-01", "7.00", "Contraction"),
        ("unknown", "2024-01-01", "9.00", "New")]


def test_plans_take_the_latest_line(raw, rates):
    got = gold.dim_plans(lines(raw, rates, [
        line("a", "2024-01", 4000), line("b", "2024-01", 25000, loaded_at=ts("2024-02-09")),
        line("c", "2024-01", 120000, plan_="p2", interval="year", price_id="x")]))
    rows = by(got, "plan_id")
    assert (rows["p1"]["pricing_tier"], rows["p1"]["annual_price_usd"]) == ("Professional", D("3000.00"))
    assert (rows["p2"]["billing_cadence"], rows["p2"]["is_annual"], rows["p2"]["monthly_price_usd"]) == (
        "Annual", True, D("100.00"))


@pytest.mark.parametrize("with_usd", [True, False])
def test_currencies_always_hold_usd(raw, with_usd):
    rows = [("XYZ", "2.5")] + ([("usd", "1")] if with_usd else [])
    brz = bronze.brz_fx_rates(raw("fx_rates", [
        {"rate_date": day("2024-01-10"), "from_currency": c, "to_currency": "USD", "rate": D(r), **LOAD}
        for c, r in rows]))
    got = by(gold.dim_currencies(brz, AS_OF.date()), "currency_code")
    assert set(got) == {"USD", "XYZ"}
    assert (got["XYZ"]["currency_name"], got["XYZ"]["region"]) == ("XYZ (Unknown)", "Other")
    assert (got["USD"]["latest_usd_rate"], got["USD"]["is_base_currency"]) == (D(1), True)
    assert str(got["USD"]["latest_rate_date"]) == ("2024-01-10" if with_usd else "2024-03-01")


def test_refund_of_unknown_charge(spark, raw, rates):
    refunds = silver.stg_refunds(bronze.brz_stripe_refunds(raw("refunds", [
        {"id": "a", "charge": "ch_1", "amount": 100, "created": epoch("2024-01-13T00:00:00"), **LOAD},
        {"id": "b", "charge": "nope", "amount": 100, "created": epoch("2024-01-13T00:00:00"), **LOAD},
        {"id": "c", "charge": None, "amount": 100, "created": epoch("2024-01-13T00:00:00"), **LOAD}])), rates)
    charges = silver.stg_charges(bronze.brz_stripe_charges(raw("charges", [
        charge(raw_payload='{"customer":"one"}')])), rates)
    history = silver.stg_customers_history(bronze.brz_stripe_customers(raw("customers", CUSTOMERS)))
    dates = gold.date_lookup(gold.dim_dates(spark))
    currencies = gold.currency_lookup(gold.dim_currencies(
        bronze.brz_fx_rates(raw("fx_rates", [{"rate_date": day("2024-01-10"), "from_currency": "EUR",
                                              "rate": D("1.1"), **LOAD}])), AS_OF.date()))
    got = by(gold.fct_refunds(refunds, charges, gold.dim_customers(history), dates, currencies), "refund_id")
    assert (got["a"]["customer_id"], got["a"]["days_since_charge"]) == ("one", 3)
    assert got["a"]["customer_key"] and got["a"]["created_date_key"] and got["a"]["currency_key"]
    assert [got[k]["customer_key"] for k in "bc"] == [None, None]


def test_ledger_source_resolution(spark, raw, rates):
    rows = [{"id": f"t{i}", "source": s, "amount": 1, "fee": 0, "net": 1, "currency": "usd", "type": "charge",
             "created": epoch("2024-01-10T00:00:00"), **LOAD}
            for i, s in enumerate(["one", "ch_1", "re_1", "dp_1", "zzz", None])]
    ledger = silver.stg_finance_ledger_events(
        bronze.brz_stripe_balance_transactions(raw("balance_transactions", rows)), rates)
    charges = silver.stg_charges(bronze.brz_stripe_charges(raw("charges", [
        charge(raw_payload='{"customer":"one"}')])), rates)
    refunds = silver.stg_refunds(bronze.brz_stripe_refunds(raw("refunds", [{"id": "re_1", "charge": "ch_1", **LOAD}])), rates)
    disputes = silver.stg_disputes(bronze.brz_stripe_disputes(raw("disputes", [
        {"id": "dp_1", "charge": "ch_1", **LOAD}])), rates, AS_OF.date())
    customers = gold.dim_customers(silver.stg_customers_history(
        bronze.brz_stripe_customers(raw("customers", CUSTOMERS))))
    dates = gold.date_lookup(gold.dim_dates(spark))
    direct = by(gold.fct_transactions(ledger, customers, dates), "transaction_id")
    assert [k for k, v in sorted(direct.items()) if v["customer_key"]] == ["t0"]
    resolved = by(gold.fct_transactions(
        ledger, customers, dates, gold.source_customers(charges, refunds, disputes)), "transaction_id")
    assert len(resolved) == 6
    assert [k for k, v in sorted(resolved.items()) if v["customer_key"]] == ["t0", "t1", "t2", "t3"]
    assert len({resolved[k]["customer_key"] for k in ("t0", "t1", "t2", "t3")}) == 1


def test_unknown_event_type_gets_a_readable_label(spark):
    ledger = spark.createDataFrame([("late_fee", "fee"), ("payout", None)], "event_type string, reporting_category string")
    got = by(gold.dim_payment_category(ledger, AS_OF), "event_type")
    assert (got["late_fee"]["event_label"], got["late_fee"]["financial_category"]) == ("Late Fee", "Other")
    assert (got["payout"]["sign_convention"], got["payout"]["affects_cash"]) == ("Negative", True)


def test_tables_read_twice_are_stored_once(spark, raw):
    rows = {
        "balance_transactions": [{"id": f"t{i}", "type": kind, "amount": 100, "fee": 1, "net": 99, "currency": "EUR",
                                  "created": epoch("2024-01-10"), **LOAD}
                                 for i, kind in enumerate(["charge", "charge", "payout", None])],
        "fx_rates": [{"rate_date": day("2024-01-10"), "from_currency": "EUR", "to_currency": "usd", "rate": D("1.1"), **LOAD}]}
    w = Warehouse(spark, lambda entity: raw(entity, rows[entity]), AS_OF)
    shared = w.storing({"stg_finance_ledger_events": ("transaction_id", "event_type", "reporting_category", "amount_usd")})
    assert "Window" in plan(w.dim_payment_category)
    read = plan(shared.dim_payment_category)
    assert "Window" not in read and "FileScan parquet" in read
    assert sorted(map(str, shared.dim_payment_category.collect())) == sorted(map(str, w.dim_payment_category.collect()))
    kept = shared.stg_finance_ledger_events
    assert sorted(map(str, kept.collect())) == sorted(map(str, w.stg_finance_ledger_events.select(*kept.columns).collect()))
