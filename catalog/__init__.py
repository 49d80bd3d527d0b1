"""The registered queries, by operator id."""

from catalog import expressions, increments, models, quality, relational, reports, storage  # noqa: F401
from catalog.base import AS_OF, CALENDAR_START, QUERIES, raw, warehouse  # noqa: F401
