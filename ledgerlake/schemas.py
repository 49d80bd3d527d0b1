"""Declared schemas of the RAW entities and the AUDIT tables."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(12,6)": T.DecimalType(12, 6),
    "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(5,2)": T.DecimalType(5, 2),
}


def struct(ddl: str, required: tuple[str, ...] = ()) -> T.StructType:
    """A schema from Spark DDL, read without a session. ``required`` columns may not be NULL."""
    fields = []
    for column in re.split(r",\s+", ddl.strip()):
        name, kind = column.split()
        meta = {"required": True} if name in required else {}
        fields.append(T.StructField(name, _TYPES[kind], True, meta))
    return T.StructType(fields)


# The columns of every source, as they arrive.
LOAD_COLUMNS = "source_file string, ingestion_run_id string, load_mode string, loaded_at timestamp_ntz"

_RAW = {
    "balance_transactions": """
        id string, object string, amount bigint, available_on bigint, created bigint, currency string,
        description string, exchange_rate double, fee bigint, net bigint, reporting_category string,
        source string, status string, type string""",
    "charges": """
        id string, object string, amount bigint, amount_captured bigint, amount_refunded bigint,
        captured boolean, created bigint, currency string, customer string, description string,
        disputed boolean, failure_code string, failure_message string, invoice string, paid boolean,
        payment_intent string, receipt_email string, refunded boolean, status string,
        payment_method string, balance_transaction string, receipt_url string,
        statement_descriptor string, payment_method_details_type string,
        payment_method_details_card_brand string, payment_method_details_card_funding string,
        payment_method_details_card_country string, payment_method_details_card_last4 string,
        payment_method_details_card_exp_month bigint, payment_method_details_card_exp_year bigint""",
    "refunds": """
        id string, object string, amount bigint, charge string, created bigint, currency string,
        payment_intent string, reason string, status string, balance_transaction string,
        description string, receipt_number string, failure_balance_transaction string,
        failure_reason string""",
    "disputes": """
        id string, object string, amount bigint, charge string, created bigint, currency string,
        evidence_due_by bigint, is_charge_refundable boolean, reason string, status string,
        payment_intent string, balance_transaction string, evidence_details_due_by bigint,
        evidence_details_has_evidence boolean""",
    "payouts": """
        id string, object string, amount bigint, arrival_date bigint, created bigint, currency string,
        description string, failure_code string, failure_message string, method string,
        source_type string, status string, type string, automatic boolean, destination string,
        balance_transaction string, statement_descriptor string, failure_balance_transaction string""",
    "customers": """
        id string, object string, created bigint, currency string, description string, email string,
        name string, phone string, address_city string, address_country string, address_line1 string,
        address_postal_code string, delinquent boolean, balance bigint, tax_exempt string""",
    "subscriptions": """
        id string, object string, customer string, created bigint, current_period_start bigint,
        current_period_end bigint, cancel_at bigint, canceled_at bigint, ended_at bigint,
        start_date bigint, status string, plan_id string, plan_interval string,
        plan_interval_count bigint, plan_amount bigint, plan_currency string, quantity bigint""",
    "invoices": """
        id string, object string, account_country string, amount_due bigint, amount_paid bigint,
        amount_remaining bigint, created bigint, currency string, customer string, customer_email string,
        due_date bigint, period_end bigint, period_start bigint, status string, subscription string,
        subtotal bigint, tax bigint, total bigint""",
    "invoice_line_items": """
        id string, object string, invoice_id string, amount bigint, currency string, description string,
        discountable boolean, invoice_item string, period_start bigint, period_end bigint,
        plan_id string, plan_interval string, plan_interval_count bigint, plan_amount bigint,
        price_id string, proration boolean, quantity bigint, subscription string,
        subscription_item string, type string""",
    "prices": """
        id string, object string, active boolean, billing_scheme string, created bigint, currency string,
        product string, recurring_interval string, recurring_interval_count bigint, type string,
        unit_amount bigint""",
    "products": """
        id string, object string, active boolean, created bigint, description string, name string,
        updated bigint""",
}

RAW: dict[str, T.StructType] = {
    entity: struct(f"{spec}, raw_payload string, {LOAD_COLUMNS}", required=("id",))
    for entity, spec in _RAW.items()
}
RAW["fx_rates"] = struct(
    f"rate_date date, from_currency string, to_currency string, rate decimal(12,6), source string, {LOAD_COLUMNS}",
    required=("rate_date", "from_currency"),
)

# Value that replaces a NULL or absent column on load.
RAW_DEFAULTS = {"load_mode": "batch", "to_currency": "USD"}

# Entities that may have nothing to load on a given day.
OPTIONAL_ENTITIES = ("refunds", "disputes", "payouts")

# Entities landed by every daily run.
DAILY_ENTITIES = (
    "balance_transactions", "charges", "refunds", "disputes", "payouts", "customers",
    "subscriptions", "invoices", "invoice_line_items", "fx_rates",
)

# The columns of the audit tables.
AUDIT: dict[str, T.StructType] = {
    "ingestion_control": struct(
        """source_name string, entity_name string, load_strategy string,
        last_successful_watermark timestamp_ntz, last_successful_cursor string,
        last_successful_run_id string, last_run_status string, updated_at timestamp_ntz""",
        required=("source_name", "entity_name", "load_strategy"),
    ),
    "pipeline_runs": struct(
        """run_id string, dag_id string, task_id string, status string, started_at timestamp_ntz,
        finished_at timestamp_ntz, duration_sec bigint, row_count bigint, error_message string,
        extra_metadata string, logged_at timestamp_ntz""",
        required=("run_id",),
    ),
    "failed_files": struct(
        """id string, file_path string, source string, entity string, error_type string,
        error_message string, failed_at timestamp_ntz, resolved_at timestamp_ntz, resolved_by string,
        run_id string""",
        required=("file_path",),
    ),
    "reconciliation_results": struct(
        """id string, run_id string, check_name string, layer_from string, layer_to string,
        expected_value decimal(18,2), actual_value decimal(18,2), delta decimal(18,2),
        tolerance_pct decimal(5,2), status string, checked_at timestamp_ntz""",
        required=("run_id", "check_name"),
    ),
    "dbt_test_results": struct(
        """run_id string, test_name string, model_name string, column_name string, status string,
        failure_count bigint, generated_at timestamp_ntz, logged_at timestamp_ntz""",
    ),
}

# How each entity is loaded and from where its watermark starts.
WATERMARK_START = "2020-01-01 00:00:00"
LOAD_STRATEGIES = {
    ("stripe", "balance_transactions"): "timestamp_watermark",
    ("stripe", "charges"): "timestamp_watermark",
    ("stripe", "refunds"): "timestamp_watermark",
    ("stripe", "disputes"): "timestamp_watermark",
    ("stripe", "payouts"): "timestamp_watermark",
    ("stripe", "customers"): "timestamp_watermark",
    ("stripe", "subscriptions"): "timestamp_watermark",
    ("stripe", "invoices"): "timestamp_watermark",
    ("stripe", "invoice_line_items"): "timestamp_watermark",
    ("stripe", "prices"): "full_snapshot",
    ("stripe", "products"): "full_snapshot",
    ("fx", "rates"): "full_snapshot",
}
