"""Names and groupings attached to codes by the dimensions."""

from __future__ import annotations

CURRENCY_NAMES = {
    "USD": "US Dollar",
    "EUR": "Euro",
    "GBP": "British Pound",
    "CAD": "Canadian Dollar",
    "AUD": "Australian Dollar",
    "JPY": "Japanese Yen",
    "INR": "Indian Rupee",
    "SGD": "Singapore Dollar",
    "CHF": "Swiss Franc",
    "SEK": "Swedish Krona",
    "NOK": "Norwegian Krone",
    "DKK": "Danish Krone",
    "NZD": "New Zealand Dollar",
    "HKD": "Hong Kong Dollar",
    "MXN": "Mexican Peso",
    "BRL": "Brazilian Real",
}

CURRENCY_SYMBOLS = {"USD": "$", "EUR": "€", "GBP": "£", "JPY": "¥", "INR": "₹"}

CURRENCY_REGIONS = {
    "Americas": ["USD", "CAD", "MXN", "BRL"],
    "EMEA": ["EUR", "GBP", "CHF", "SEK", "NOK", "DKK"],
    "APAC": ["JPY", "AUD", "NZD", "SGD", "HKD", "INR"],
}

# code: (name, region, sub-region, market tier)
COUNTRIES = {
    "US": ("United States", "Americas", "North America", "Tier 1"),
    "GB": ("United Kingdom", "EMEA", "Northern Europe", "Tier 1"),
    "CA": ("Canada", "Americas", "North America", "Tier 1"),
    "AU": ("Australia", "APAC", "Oceania", "Tier 1"),
    "DE": ("Germany", "EMEA", "Western Europe", "Tier 1"),
    "FR": ("France", "EMEA", "Western Europe", "Tier 1"),
    "IN": ("India", "APAC", "South Asia", "Tier 2"),
    "JP": ("Japan", "APAC", "East Asia", "Tier 1"),
    "SG": ("Singapore", "APAC", "Southeast Asia", "Tier 2"),
    "NL": ("Netherlands", "EMEA", "Western Europe", "Tier 2"),
    "SE": ("Sweden", "EMEA", "Northern Europe", "Tier 2"),
    "NO": ("Norway", "EMEA", "Northern Europe", "Tier 3"),
    "CH": ("Switzerland", "EMEA", "Western Europe", "Tier 2"),
    "IE": ("Ireland", "EMEA", "Northern Europe", "Tier 2"),
    "NZ": ("New Zealand", "APAC", "Oceania", "Tier 3"),
    "BR": ("Brazil", "Americas", "Latin America", "Tier 2"),
    "MX": ("Mexico", "Americas", "Latin America", "Tier 3"),
    "ES": ("Spain", "EMEA", "Southern Europe", "Tier 3"),
    "IT": ("Italy", "EMEA", "Southern Europe", "Tier 3"),
    "PL": ("Poland", "EMEA", "Eastern Europe", "Tier 3"),
    "HK": ("Hong Kong", "APAC", "East Asia", "Tier 3"),
    "IL": ("Israel", "EMEA", "Middle East", "Tier 3"),
    "ZA": ("South Africa", "EMEA", "Africa", "Tier 3"),
    "AE": ("United Arab Emirates", "EMEA", "Middle East", "Tier 3"),
}

# event type: (label, financial category, sign convention, affects revenue, affects cash)
PAYMENT_EVENTS = {
    "charge": ("Payment Received", "Revenue", "Positive", True, False),
    "refund": ("Refund Issued", "Contra-Revenue", "Negative", True, False),
    "dispute": ("Dispute / Chargeback", "Contra-Revenue", "Negative", True, False),
    "payout": ("Bank Payout", "Cash Movement", "Negative", False, True),
    "transfer": ("Internal Transfer", "Cash Movement", "Neutral", False, True),
    "adjustment": ("Balance Adjustment", "Adjustment", "Negative", True, False),
    "payment": ("Payment", "Other", "Neutral", False, False),
}

# (interval, count): cadence; week and day whatever the count
BILLING_CADENCES = {
    ("month", 1): "Monthly",
    ("month", 3): "Quarterly",
    ("month", 6): "Semi-Annual",
    ("year", 1): "Annual",
}
BILLING_CADENCES_ANY_COUNT = {"week": "Weekly", "day": "Daily"}

# monthly USD below the limit: tier
PRICING_TIERS = [(50, "Starter"), (200, "Growth"), (1000, "Professional")]
TOP_PRICING_TIER = "Enterprise"

MOVEMENT_TYPES = ["New", "Expansion", "Contraction", "Churn", "No Change"]
