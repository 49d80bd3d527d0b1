"""Money, text, time and key expressions against values worked out by hand."""

from decimal import Decimal as D

import pytest
from conftest import day, ts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions import columns as c
from ledgerlake.functions import money as m
from ledgerlake.plans import gold, labels


def one(spark, **exprs):
    return spark.range(1).select(*(e.alias(n) for n, e in exprs.items())).first().asDict()


@pytest.mark.parametrize("cents, rate, want", [
    (1, "123.499995", "1.23"), (1, "0.5", "0.01"), (-1, "0.5", "-0.01"), (5, "0.1", "0.01"),
    (12345, "1", "123.45"), (0, "2", "0.00"), (999_999_999_999, "1.234567", "12345669999.99"),
])
def test_converted_once(spark, cents, rate, want):
    got = one(spark, x=m.from_cents_at(F.lit(cents), F.lit(D(rate))))
    assert got["x"] == D(want)


@pytest.mark.parametrize("interval, want, want_eur", [
    ("month", "100.00", "110.00"), ("year", "8.33", "9.17"), ("week", "433.30", "476.63"),
    ("day", "3000.00", "3300.00"), ("unknown", "100.00", "110.00"),
])
def test_monthly(spark, interval, want, want_eur):
    got = one(spark, x=m.monthly(F.lit(10000), F.lit(interval)),
              y=m.monthly(F.lit(10000), F.lit(interval), F.lit(D("1.1"))))
    assert got == {"x": D(want), "y": D(want_eur)}


def test_monthly_options(spark):
    got = one(spark, daily=m.monthly(F.lit(10000), F.lit("day"), F.lit(D("1.1")), scale_daily=False),
              quarter=m.monthly(F.lit(30000), F.lit("month"), interval_count=F.lit(3)))
    assert got == {"daily": D("110.00"), "quarter": D("100.00")}


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**9)), min_size=50, max_size=200))
def test_exact_against_integers(spark, pairs):
    """cents * rate / 12 and cents * rate, rounded half away from zero with plain integers."""
    def rounded(n, d):
        return D((2 * abs(n) + d) // (2 * d) * (1 if n >= 0 else -1)) / 100

    df = spark.createDataFrame([(a, D(r) / 10**6) for a, r in pairs], "cents long, rate decimal(12,6)")
    got = df.select(m.from_cents_at(F.col("cents"), F.col("rate")),
                    m.monthly(F.col("cents"), F.lit("year"), F.col("rate")),
                    m.monthly(F.col("cents"), F.lit("week"), F.col("rate"))).collect()
    want = [(rounded(a * r, 10**6), rounded(a * r, 12 * 10**6), rounded(a * r * 4333, 10**9)) for a, r in pairs]
    assert [tuple(g) for g in got] == want


@pytest.mark.parametrize("text, want", [
    ("2024-06-30", (2023, 12)), ("2024-07-01", (2024, 1)), ("2024-02-29", (2023, 8)), ("2024-12-31", (2024, 6)),
])
def test_fiscal(spark, text, want):
    d = F.lit(day(text))
    got = one(spark, y=c.fiscal_year(d, 7), m=c.fiscal_month(d, 7))
    assert (got["y"], got["m"]) == want


def test_calendar_default_range(spark):
    dates = gold.dim_dates(spark)
    assert dates.count() == 4748
    rows = {str(r["date_day"]): r for r in dates.filter(
        "date_day IN (DATE'2024-02-29', DATE'2024-06-01', DATE'2024-06-02')").collect()}
    leap = rows["2024-02-29"]
    assert leap["is_month_end"] and str(leap["month_end_date"]) == "2024-02-29" and leap["day_name"] == "Thu"
    assert (rows["2024-06-01"]["day_of_week"], rows["2024-06-02"]["day_of_week"]) == (6, 0)
    assert rows["2024-06-01"]["is_weekend"] and rows["2024-06-02"]["is_weekend"] and not leap["is_weekend"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_times_ignore_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = one(spark, t=c.epoch_timestamp(F.lit(1700000000)).cast("string"),
                  d=c.epoch_date(F.lit(1700000000)).cast("string"),
                  back=c.epoch_seconds(c.epoch_timestamp(F.lit(1700000000))),
                  parsed=F.expr(c.parse_utc("'2024-02-01T10:00:00+02:00'")).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == {"t": "2023-11-14 22:13:20", "d": "2023-11-14", "back": 1700000000,
                   "parsed": "2024-02-01 08:00:00"}


def test_surrogate_key(spark):
    import hashlib
    got = one(spark, k=c.surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit(day("2024-01-02"))),
              t=c.surrogate_key(F.lit("a"), c.key_text(F.lit(ts("2024-01-02 03:04:05")).cast("timestamp_ntz"))))
    assert got["k"] == hashlib.md5(f"a-{c.KEY_NULL}-2024-01-02".encode()).hexdigest()
    assert got["t"] == hashlib.md5(b"a-2024-01-02 03:04:05.000000").hexdigest()


@pytest.mark.parametrize("mrr, tier", [
    ("49.99", "Starter"), ("50", "Growth"), ("199.99", "Growth"), ("200", "Professional"),
    ("999.99", "Professional"), ("1000", "Enterprise"), (None, "Enterprise"),
])
def test_tier_edges(spark, mrr, tier):
    value = F.lit(None if mrr is None else D(mrr)).cast("decimal(18,2)")
    assert one(spark, x=c.banded(value, labels.PRICING_TIERS, labels.TOP_PRICING_TIER))["x"] == tier


@pytest.mark.parametrize("unit, n, want", [
    ("month", 1, "Monthly"), ("month", 3, "Quarterly"), ("month", 6, "Semi-Annual"), ("year", 1, "Annual"),
    ("week", 5, "Weekly"), ("day", None, "Daily"), ("year", 2, "year x2"), ("month", None, None),
])
def test_cadence(spark, unit, n, want):
    assert one(spark, x=gold.billing_cadence(F.lit(unit), F.lit(n).cast("long")))["x"] == want


@pytest.mark.parametrize("a, b, want", [(100, 95, 5.0), (100, 102, 2.0), (0, 5, None), (None, 1, None)])
def test_percent_apart(spark, a, b, want):
    assert one(spark, x=c.percent_apart(F.lit(a).cast("long"), F.lit(b).cast("long")))["x"] == want


def test_title_case(spark):
    assert one(spark, x=c.title_case(F.lit("late_payment_fee")))["x"] == "Late Payment Fee"
