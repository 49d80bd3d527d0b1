"""Gold facts by change propagation.

A fact remembers, for each source, the last load it has taken. From there on, the keys that new
loads brought are known; the facts that hang on them are found by joins on few columns: facts of
a charge that changed, of a customer whose current version did, of a currency that had no key so
far. Their rows are computed again from the Silver rows of these keys alone, and swapped for the old
ones in the key buckets they fall into. No other bucket is written.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlake.operators.lookup import Lookup, measured_bytes, noted, semi_join, width
from ledgerlake.plans import gold
from ledgerlake.session import materialize, observed
from ledgerlake.sources import files
from ledgerlake.sources.tables import COMPRESSION

# Fact -> its key, and the entities whose loads change it.
FACTS = {
    "fct_transactions": ("transaction_id", ("balance_transactions", "charges", "refunds", "disputes", "customers")),
    "fct_charges": ("charge_id", ("charges", "customers")),
    "fct_refunds": ("refund_id", ("refunds", "charges", "customers")),
    "fct_disputes": ("dispute_id", ("disputes", "charges", "customers")),
    "fct_payouts": ("payout_id", ("payouts",)),
    "fct_mrr_movements": ("customer_id", ("invoice_line_items", "subscriptions")),
}


class Sources:
    """What the facts are built from: Silver tables, dimensions, and what changed since a load.

    ``silver(name)`` gives a keyed table, ``since(entity, load)`` the rows of the loads after it or None,
    ``versions(entity)`` all rows ever loaded; ``customers`` is the customer dimension.
    Sets of keys, and rows that several queries read, are written once below ``scratch``.
    """

    def __init__(self, silver: Callable, since: Callable[[str, int], DataFrame | None],
                 versions: Callable[[str], DataFrame], customers: DataFrame, dates: Lookup, currencies: Lookup,
                 resolve_sources: bool, as_of: dt.datetime, scratch: str):
        self.silver, self._since, self.versions = silver, since, versions
        self.customers, self.dates, self.currencies = customers, dates, currencies
        self.resolve_sources, self.as_of, self.scratch = resolve_sources, as_of, scratch
        self._changed: dict[tuple[str, int], DataFrame | None] = {}
        self._paths: dict[DataFrame, str] = {}
        self._lock = Lock()

    def changed(self, entity: str, load: int) -> DataFrame | None:
        """The ids that the loads after ``load`` brought, or None."""
        with self._lock:
            if (entity, load) not in self._changed:
                rows = self._since(entity, load)
                self._changed[entity, load] = None if rows is None else self.ids([rows.select("id")], "id")
            return self._changed[entity, load]

    def ids(self, frames: Iterable[DataFrame | None], name: str) -> DataFrame | None:
        """One column of different keys, written, from the first columns of the frames that there are."""
        found = [f.select(F.col(f.columns[0]).alias(name)) for f in frames if f is not None]
        if not found:
            return None
        keys, seen = reduce(DataFrame.unionByName, found).distinct(), Observation()
        keys = keys.observe(seen, F.sum(width(keys)).alias("bytes"))
        return noted(self.written(keys), observed(seen, {"bytes": 0})["bytes"] or 0)

    def written(self, rows: DataFrame) -> DataFrame:
        """The rows, worked out once for all that is made of them."""
        path = f"{self.scratch}/{uuid.uuid4().hex}"
        found = materialize(rows, path, compression=COMPRESSION)
        self._paths[found] = path
        return found

    def drop(self, rows: DataFrame) -> None:
        """Delete what ``written`` wrote."""
        files.remove(rows.sparkSession, self._paths.pop(rows))


def _hanging(stored: DataFrame, key: str, column: str, changed: DataFrame | None) -> DataFrame | None:
    """Keys of the stored facts whose ``column`` is among the changed ones. NULL hangs on nothing."""
    if changed is None:
        return None
    facts = stored.filter(F.col(column).isNotNull())
    return semi_join(facts.select(key, column), changed, {column: changed.columns[0]}, different=True).select(key)


def _unnamed(stored: DataFrame, key: str, currencies: Lookup) -> DataFrame:
    """Keys of facts without a currency key whose currency has one by now."""
    lacking = stored.filter(F.col("currency_key").isNull() & F.col("currency").isNotNull()).select(key, "currency")
    found = currencies.attach(lacking, {"currency_code": F.upper("currency")}, {"currency_key": "_now"})
    return found.filter(F.col("_now").isNotNull()).select(key)


def _customers(sources: Sources, *holders: DataFrame) -> DataFrame:
    """The dimension rows of the customers that the frames name."""
    return semi_join(sources.customers.filter("is_current"), sources.ids(holders, "customer_id"),
                     {"customer_id": "customer_id"}, different=True)


def _charge_facts(sources: Sources, name: str, affected: DataFrame) -> DataFrame:
    """Rows of the charge, refund, dispute and payout facts for the affected keys."""
    entity = name.removeprefix("fct_")
    rows = sources.silver(f"stg_{entity}").rows_of(affected, different=True)
    if entity == "payouts":
        return gold.fct_payouts(rows, sources.dates, sources.currencies)
    if entity == "charges":
        return gold.fct_charges(rows, _customers(sources, rows.select("customer_id")), sources.dates, sources.currencies)
    charges = sources.silver("stg_charges").rows_of(sources.ids([rows.select("charge_id")], "charge_id"), different=True)
    model = {"refunds": gold.fct_refunds, "disputes": gold.fct_disputes}[entity]
    return model(rows, charges, _customers(sources, charges.select("customer_id")), sources.dates, sources.currencies)


def _transactions(sources: Sources, affected: DataFrame) -> DataFrame:
    ledger = sources.silver("stg_finance_ledger_events").rows_of(affected, different=True)
    wanted = sources.ids([ledger.select("source_id")], "source_id")
    if not sources.resolve_sources:
        return gold.fct_transactions(ledger, _customers(sources, wanted), sources.dates)

    def named(entity: str, ids: DataFrame, *columns: str) -> DataFrame:
        key = FACTS[f"fct_{entity}"][0]
        keys = noted(ids.select(F.col(ids.columns[0]).alias(key)), measured_bytes(ids))
        rows = sources.silver(f"stg_{entity}").rows_of(keys, different=True)
        return sources.written(rows.select(*dict.fromkeys((key, *columns))))

    refunds, disputes = named("refunds", wanted, "charge_id"), named("disputes", wanted, "charge_id")
    charges = named("charges", sources.ids([wanted, refunds.select("charge_id"), disputes.select("charge_id")], "id"), "customer_id")
    resolved = gold.source_customers(charges, refunds, disputes, unique=False)
    customers = _customers(sources, wanted, charges.select("customer_id"))
    return gold.fct_transactions(ledger, customers, sources.dates, resolved)


def _movements(sources: Sources, changed: dict[str, DataFrame | None]) -> tuple[DataFrame, DataFrame] | None:
    """Customers whose recurring revenue may have changed, and all their rows."""
    lines, subscriptions = changed["invoice_line_items"], changed["subscriptions"]
    # A line counted for the subscription that any of its versions names, a subscription for
    # each of its owners, and for itself where it has none.
    moved = None if lines is None else semi_join(
        sources.versions("invoice_line_items").select("subscription", "id"), lines, {"id": "id"}, different=True)
    touched = sources.ids([moved, subscriptions], "subscription")
    if touched is None:
        return None
    every = sources.versions("subscriptions")
    owners = semi_join(every.select("customer", "id"), touched, {"id": "subscription"}, different=True)
    customers = sources.ids([owners, touched], "customer_id")
    latest = gold.subscription_customers(every)
    owned = semi_join(latest, customers, {"customer_id": "customer_id"}, different=True).select("subscription_id")
    wanted = sources.ids([owned, customers], "subscription")
    rows = gold.fct_mrr_movements(
        semi_join(sources.silver("stg_invoice_line_items").read(), wanted, {"subscription": "subscription"},
                  different=True),
        semi_join(every, wanted, {"id": "subscription"}, different=True), sources.as_of)
    return customers, semi_join(rows, customers, {"customer_id": "customer_id"}, different=True)


def changes(sources: Sources, name: str, stored: DataFrame, taken: Callable[[str], int]) -> tuple[DataFrame, DataFrame] | None:
    """The keys of a fact whose rows may have changed since the loads ``taken``, and their rows now.

    None if no source of the fact changed.
    """
    key, entities = FACTS[name]
    changed = {entity: sources.changed(entity, taken(entity)) for entity in entities}
    if name == "fct_mrr_movements":
        return _movements(sources, changed)
    customers = changed.get("customers")
    own = "balance_transactions" if name == "fct_transactions" else name.removeprefix("fct_")
    affected = [changed[own]]
    if name == "fct_transactions":
        facts = {e: (FACTS[f"fct_{e}"][0], sources.silver(f"stg_{e}").read()) for e in ("charges", "refunds", "disputes")}
        ids = [changed[e] for e in ("charges", "refunds", "disputes", "customers")]
        if sources.resolve_sources:
            of_customers = _hanging(facts["charges"][1], "charge_id", "customer_id", customers)
            parents = sources.ids([changed["charges"], of_customers], "id")
            ids += [of_customers, *(_hanging(facts[e][1], facts[e][0], "charge_id", parents) for e in ("refunds", "disputes"))]
        affected.append(_hanging(stored, key, "source_id", sources.ids(ids, "id")))
    else:
        if "charges" in entities and own != "charges":
            affected.append(_hanging(stored, key, "charge_id", changed["charges"]))
        if customers is not None:
            affected.append(_hanging(stored, key, "customer_id", customers))
        affected.append(_unnamed(stored, key, sources.currencies))
    keys = sources.ids(affected, key)
    if keys is None:
        return None
    rows = _transactions(sources, keys) if name == "fct_transactions" else _charge_facts(sources, name, keys)
    return keys, rows
