"""RAW-shaped views over the benchmark tables, one SQL text for Spark and DuckDB.

Tokens: ``<orders>`` a base table, ``<NTZ>`` the zone-free timestamp type,
``<EPOCH:c>`` Unix seconds of a timestamp column.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators.align import align_to_schema
from ledgerlake.schemas import RAW
from ledgerlake.session import configure

BASE_TABLES = ("customer", "orders", "lineitem", "events")

VIEWS: dict[str, str] = {}

VIEWS["fx_rates"] = """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS rate_date FROM <orders>
           UNION SELECT CAST(ts AS DATE) FROM <events>),
 n AS (SELECT rate_date, CAST(year(rate_date)*372+month(rate_date)*31+day(rate_date) AS BIGINT) AS k FROM d),
 c AS (SELECT 'EUR' AS cc, 1050000 AS base, 3 AS drp UNION ALL SELECT 'gbp',1250000,5
       UNION ALL SELECT 'CAD',740000,7 UNION ALL SELECT 'JPY',6800,11 UNION ALL SELECT 'USD',1000000,1000)
SELECT rate_date, cc AS from_currency, 'usd' AS to_currency,
 CAST(CAST(base + CASE WHEN cc='USD' THEN 0 ELSE (k % 97) * 13 END AS DECIMAL(12,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(12,6)) AS rate,
 CAST('2024-02-01 00:00:00' AS <NTZ>) AS loaded_at, 'run-1' AS ingestion_run_id
FROM n CROSS JOIN c WHERE k % (drp*10) <> 1
UNION ALL
SELECT rate_date, cc, 'USD', CAST(CAST(base + 500 + (k % 97) * 13 AS DECIMAL(12,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(12,6)),
 CAST('2024-02-02 00:00:00' AS <NTZ>), 'run-2'
FROM n CROSS JOIN c WHERE k % 4 = 0 AND cc <> 'USD'
UNION ALL
SELECT rate_date, cc, 'USD', CAST(0 AS DECIMAL(12,6)), CAST('2024-02-03 00:00:00' AS <NTZ>), 'run-3'
FROM n CROSS JOIN c WHERE k % 31 = 0
"""

VIEWS["customers"] = """
WITH v AS (SELECT c.*, 1 AS ld FROM <customer> c UNION ALL SELECT c.*, 2 AS ld FROM <customer> c WHERE c_custkey%3=0
           UNION ALL SELECT c.*, 3 AS ld FROM <customer> c WHERE c_custkey%9=0)
SELECT 'cus_'||CAST(c_custkey AS STRING) AS id, CAST(788918400 + c_custkey%1000*86400 AS BIGINT) AS created,
 CASE WHEN c_custkey%4=0 THEN NULL ELSE 'USD' END AS currency,
 'C'||CAST(c_custkey AS STRING)||'@Example.com' AS email, c_name AS name,
 CASE (c_nationkey+ld)%25 WHEN 0 THEN 'us' WHEN 1 THEN 'GB' WHEN 2 THEN 'CA' WHEN 3 THEN 'AU' WHEN 4 THEN 'DE'
  WHEN 5 THEN 'FR' WHEN 6 THEN 'IN' WHEN 7 THEN 'JP' WHEN 8 THEN 'SG' WHEN 9 THEN 'NL' WHEN 10 THEN 'SE' WHEN 11 THEN 'NO'
  WHEN 12 THEN 'CH' WHEN 13 THEN 'IE' WHEN 14 THEN 'NZ' WHEN 15 THEN 'BR' WHEN 16 THEN 'MX' WHEN 17 THEN 'ES' WHEN 18 THEN 'IT'
  WHEN 19 THEN 'PL' WHEN 20 THEN 'HK' WHEN 21 THEN 'IL' WHEN 22 THEN 'ZA' WHEN 23 THEN 'XX' ELSE NULL END AS address_country,
 c_acctbal < 0 AS delinquent, CAST(ROUND(c_acctbal*100) AS BIGINT) AS balance,
 CASE ld WHEN 1 THEN CAST('2024-02-01 00:00:00' AS <NTZ>) WHEN 2 THEN CAST('2024-02-02 00:00:00' AS <NTZ>)
  ELSE CAST('2024-02-03 00:00:00' AS <NTZ>) END AS loaded_at,
 'run-'||CAST(ld AS STRING) AS ingestion_run_id
FROM v
"""

VIEWS["charges"] = """
WITH b AS (SELECT o_orderkey k, CAST(ROUND(o_totalprice*100) AS BIGINT) amt, <EPOCH:o_orderdate> created,
            o_orderstatus st, c_custkey ck, c_nationkey nk, o_orderpriority pr
           FROM <orders> JOIN <customer> ON o_custkey=c_custkey),
 l AS (SELECT b.*, 1 AS ld FROM b UNION ALL SELECT b.*, 2 AS ld FROM b WHERE k % 7 = 0)
SELECT 'ch_'||CAST(k AS STRING) AS id, amt AS amount,
 CASE WHEN st='P' THEN 0 ELSE amt END AS amount_captured,
 CASE WHEN k%10=0 THEN amt WHEN k%10=1 THEN amt - amt%100 ELSE 0 END AS amount_refunded,
 CASE WHEN ld=2 THEN 'succeeded' WHEN k%97=0 THEN NULL WHEN st='F' THEN 'Succeeded' WHEN st='O' THEN 'pending' ELSE 'FAILED' END AS status,
 CASE nk%6 WHEN 0 THEN 'usd' WHEN 1 THEN 'EUR' WHEN 2 THEN 'gbp' WHEN 3 THEN 'cad' WHEN 4 THEN 'jpy' ELSE NULL END AS currency,
 created,
 '{"customer":"cus_'||CAST(ck AS STRING)||'"'||CASE WHEN st='P' AND ld=1 THEN ',"failure_code":"card_declined"' ELSE '' END||
 ',"payment_method_details":{"type":"Card","card":{"brand":"'||CASE WHEN k%2=0 THEN 'Visa' ELSE 'Amex' END||'","country":"us","exp_year":'||CAST(2024+k%5 AS STRING)||'}}}' AS raw_payload,
 CASE WHEN ld=2 THEN CAST('2024-02-05 00:00:00' AS <NTZ>) WHEN k%3=0 THEN CAST('2024-02-01 00:00:00' AS <NTZ>)
  ELSE CAST('2024-02-02 00:00:00' AS <NTZ>) END AS loaded_at,
 'run-'||CAST(ld AS STRING) AS ingestion_run_id
FROM l
"""

VIEWS["refunds"] = """
WITH b AS (SELECT l_orderkey ok, l_linenumber ln, l_partkey pk, l_suppkey sk,
            CAST(ROUND(l_extendedprice*100) AS BIGINT) amt, <EPOCH:l_shipdate> created
           FROM <lineitem> WHERE l_returnflag='R')
SELECT 're_'||CAST(ok AS STRING)||'_'||CAST(ln AS STRING)||'_'||CAST(pk AS STRING)||'_'||CAST(sk AS STRING) AS id,
 MAX(amt) AS amount, 'ch_'||CAST(ok AS STRING) AS charge,
 CASE WHEN pk%5=0 THEN 'EUR' WHEN pk%5=1 THEN NULL ELSE 'usd' END AS currency, MAX(created) AS created,
 CASE pk%4 WHEN 0 THEN 'pending' WHEN 1 THEN 'failed' ELSE 'succeeded' END AS status,
 CASE pk%5 WHEN 0 THEN 'duplicate' WHEN 1 THEN 'Fraudulent' WHEN 2 THEN NULL ELSE 'requested_by_customer' END AS reason,
 CASE WHEN pk%4=1 THEN 'LOST_OR_STOLEN_CARD' ELSE NULL END AS failure_reason,
 CAST('2024-02-01 00:00:00' AS <NTZ>) AS loaded_at, 'run-1' AS ingestion_run_id
FROM b GROUP BY ok, ln, pk, sk
"""

VIEWS["disputes"] = """
SELECT 'dp_'||CAST(o_orderkey AS STRING) AS id, CAST(ROUND(o_totalprice*100) AS BIGINT) AS amount,
 'ch_'||CAST(o_orderkey AS STRING) AS charge, 'usd' AS currency,
 CASE (o_orderkey-3)%160 WHEN 0 THEN 'won' WHEN 20 THEN 'LOST' WHEN 40 THEN 'charge_refunded' WHEN 60 THEN 'warning_closed'
  WHEN 80 THEN 'warning_needs_response' WHEN 100 THEN 'needs_response' WHEN 120 THEN 'under_review' ELSE NULL END AS status,
 CASE WHEN o_custkey%3=0 THEN NULL ELSE 'fraudulent' END AS reason,
 <EPOCH:o_orderdate>+86400*(o_orderkey%60) AS created,
 <EPOCH:o_orderdate>+86400*(o_orderkey%60+7+o_custkey%14) AS evidence_details_due_by,
 o_custkey%2=0 AS evidence_details_has_evidence,
 CAST('2024-02-01 00:00:00' AS <NTZ>) AS loaded_at, 'run-1' AS ingestion_run_id
FROM <orders> WHERE o_orderkey%20=3
"""

VIEWS["payouts"] = """
SELECT 'po_'||CAST(event_id AS STRING) AS id, CAST(ROUND(value*100) AS BIGINT) AS amount,
 CASE WHEN event_id%3=0 THEN 'EUR' ELSE 'usd' END AS currency,
 CASE event_id%5 WHEN 0 THEN 'pending' WHEN 1 THEN 'failed' WHEN 2 THEN 'Canceled' ELSE 'paid' END AS status,
 CASE WHEN event_id%4=0 THEN 'instant' WHEN event_id%4=1 THEN NULL ELSE 'standard' END AS method,
 <EPOCH:ts> AS created, <EPOCH:ts>+86400*(event_id%6) AS arrival_date,
 CASE WHEN event_id%5=1 THEN 'account_closed' ELSE NULL END AS failure_code,
 CAST('2024-02-01 00:00:00' AS <NTZ>) AS loaded_at, 'run-1' AS ingestion_run_id
FROM <events> WHERE event_type='purchase'
"""

VIEWS["subscriptions"] = """
WITH v AS (SELECT c_custkey k, 1 AS ld FROM <customer> WHERE c_custkey%10<>0
           UNION ALL SELECT c_custkey, 2 FROM <customer> WHERE c_custkey%10=5)
SELECT 'sub_'||CAST(k AS STRING) AS id, 'cus_'||CAST(k - k%8 AS STRING) AS customer, 'plan_'||CAST(k%4 AS STRING) AS plan_id,
 CASE ld WHEN 1 THEN CAST('2024-02-01 00:00:00' AS <NTZ>) ELSE CAST('2024-02-02 00:00:00' AS <NTZ>) END AS loaded_at,
 'run-'||CAST(ld AS STRING) AS ingestion_run_id
FROM v
"""

VIEWS["invoice_line_items"] = """
SELECT 'il_'||CAST(o_orderkey AS STRING) AS id, 'in_'||CAST(o_orderkey AS STRING) AS invoice_id,
 CASE WHEN o_orderkey%6=0 THEN CAST(0 AS BIGINT) ELSE CAST(ROUND(o_totalprice) AS BIGINT) END AS amount,
 CASE o_custkey%3 WHEN 0 THEN 'usd' WHEN 1 THEN 'EUR' ELSE 'gbp' END AS currency,
 <EPOCH:o_orderdate> AS period_start, <EPOCH:o_orderdate>+86400*30 AS period_end,
 'plan_'||CAST(o_custkey%4 AS STRING) AS plan_id,
 CASE o_custkey%4 WHEN 0 THEN 'Month' WHEN 1 THEN 'year' WHEN 2 THEN 'week' ELSE 'day' END AS plan_interval,
 CASE WHEN o_custkey%8=0 THEN 3 ELSE 1 END AS plan_interval_count,
 CASE WHEN o_custkey%5=0 THEN NULL ELSE 'price_'||CAST(o_custkey%4 AS STRING) END AS price_id,
 CASE WHEN o_orderkey%11=0 THEN TRUE WHEN o_orderkey%11=1 THEN NULL ELSE FALSE END AS proration,
 CASE WHEN o_orderkey%13=0 THEN 'invoiceitem' ELSE 'Subscription' END AS type,
 'sub_'||CAST(o_custkey AS STRING) AS subscription,
 CAST('2024-02-01 00:00:00' AS <NTZ>) AS loaded_at, 'run-1' AS ingestion_run_id
FROM <orders>
"""

VIEWS["invoices"] = """
SELECT 'in_'||CAST(o_orderkey AS STRING) AS id, 'invoice' AS object, CASE WHEN o_custkey%2=0 THEN 'US' ELSE 'GB' END AS account_country,
 CAST(ROUND(o_totalprice) AS BIGINT) AS amount_due,
 CASE WHEN o_orderstatus='F' THEN CAST(ROUND(o_totalprice) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS amount_paid,
 CASE WHEN o_orderstatus='F' THEN CAST(0 AS BIGINT) ELSE CAST(ROUND(o_totalprice) AS BIGINT) END AS amount_remaining,
 <EPOCH:o_orderdate> AS created, CASE o_custkey%3 WHEN 0 THEN 'usd' WHEN 1 THEN 'EUR' ELSE 'gbp' END AS currency,
 'cus_'||CAST(o_custkey AS STRING) AS customer,
 CASE WHEN o_custkey%4=0 THEN NULL ELSE 'C'||CAST(o_custkey AS STRING)||'@Example.com' END AS customer_email,
 CASE WHEN o_orderkey%5=0 THEN NULL ELSE <EPOCH:o_orderdate>+86400*14 END AS due_date,
 <EPOCH:o_orderdate>+86400*30 AS period_end, <EPOCH:o_orderdate> AS period_start,
 CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'open' ELSE NULL END AS status,
 'sub_'||CAST(o_custkey AS STRING) AS subscription, CAST(ROUND(o_totalprice) AS BIGINT) AS subtotal,
 CAST(o_orderkey%7 AS BIGINT) AS tax, CAST(ROUND(o_totalprice) AS BIGINT) + o_orderkey%7 AS total,
 CAST('2024-02-01 00:00:00' AS <NTZ>) AS loaded_at, 'run-1' AS ingestion_run_id
FROM <orders>
"""

VIEWS["balance_transactions"] = """
WITH u AS (SELECT 'txn_'||CAST(o_orderkey AS STRING) id, 'ch_'||CAST(o_orderkey AS STRING) source,
            CAST(ROUND(o_totalprice*100) AS BIGINT) amount, 'EUR' currency, <EPOCH:o_orderdate> created,
            'charge' type, 'charge' rc, o_orderkey k FROM <orders>
 UNION ALL SELECT 'txn_'||id, id, -amount, COALESCE(currency,'usd'), created, 'Refund', 'refund', amount FROM <raw_refunds>
 UNION ALL SELECT 'txn_'||id, id, -amount, currency, created, 'adjustment', 'dispute', amount FROM <raw_disputes>
 UNION ALL SELECT 'txn_'||id, id, amount, currency, created, 'payout', NULL, amount FROM <raw_payouts>)
SELECT id, source, amount, amount%100 AS fee, amount-amount%100 AS net, currency, created, created+172800 AS available_on,
 type, rc AS reporting_category, CASE WHEN k%9=0 THEN NULL ELSE 'Available' END AS status,
 CAST('2024-02-01 00:00:00' AS <NTZ>) AS loaded_at, 'run-1' AS ingestion_run_id FROM u
UNION ALL
SELECT id, source, amount, amount%100, amount-amount%100, currency, created, created+172800, type, rc, 'available',
 CAST('2024-02-04 00:00:00' AS <NTZ>), 'run-2' FROM u WHERE k%8=0
"""

_CURRENCIES = """array(
 named_struct('cc', 'EUR', 'base', 1050000, 'drp', 3), named_struct('cc', 'gbp', 'base', 1250000, 'drp', 5),
 named_struct('cc', 'CAD', 'base', 740000, 'drp', 7), named_struct('cc', 'JPY', 'base', 6800, 'drp', 11),
 named_struct('cc', 'USD', 'base', 1000000, 'drp', 1000))"""

_RAW_REF = re.compile(r"<raw_(\w+)>")
_EPOCH = re.compile(r"<EPOCH:(\w+)>")
_BASE = re.compile(rf"<({'|'.join(BASE_TABLES)})>")


def _with_raw_inlined(sql: str) -> str:
    return _RAW_REF.sub(lambda m: f"(SELECT * FROM ({VIEWS[m.group(1)]}))", sql)


def spark_raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The RAW-shaped view of ``entity`` over the tables in ``sf_dir``, in its declared schema."""
    return align_to_schema(spark_view(spark, sf_dir, entity), RAW[entity])


def spark_view(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The view exactly as its SQL defines it."""
    configure(spark)
    tag = hashlib.md5(sf_dir.encode()).hexdigest()[:8]

    def view(match: re.Match) -> str:
        name = f"ll_{match.group(1)}_{tag}"
        if not spark.catalog.tableExists(name):
            spark.read.parquet(f"{sf_dir}/{match.group(1)}.parquet").createOrReplaceTempView(name)
        return name

    sql = _with_raw_inlined(VIEWS[entity]).replace("<NTZ>", "TIMESTAMP_NTZ")
    # Five constant rows per day need no join.
    sql = sql.replace("n CROSS JOIN c", f"(SELECT *, inline({_CURRENCIES}) FROM n)")
    sql = _EPOCH.sub(lambda m: f"unix_timestamp({m.group(1)})", sql)
    return spark.sql(_BASE.sub(view, sql))


def duckdb_raw(entity: str) -> str:
    """The same view as DuckDB SQL over views named like the base tables."""
    sql = _RAW_REF.sub(lambda m: f"raw_{m.group(1)}", VIEWS[entity]).replace("<NTZ>", "TIMESTAMP")
    sql = _EPOCH.sub(lambda m: f"CAST(floor(epoch({m.group(1)})) AS BIGINT)", sql)
    return _BASE.sub(lambda m: m.group(1), sql)


# RAW views another RAW view reads.
RAW_NEEDS = {
    entity: sorted(set(_RAW_REF.findall(sql))) for entity, sql in VIEWS.items()
}
