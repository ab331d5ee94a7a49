"""Silver: normalise, keep the latest version, reconcile returns, convert to the base currency."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import ORDERS, RETURNS, HealthContract
from plumbline.functions.columns import code, to_cents
from plumbline.operators import versions
from plumbline.operators.joins import Lookup, Stored, join_stored, join_unique, lookup

# Status codes of returns; the quarantine reasons below are fixed as well.
ACCEPTED = "ACCEPTED"
ORPHAN = "ORPHAN"
ORDER_EXCLUDED = "ORDER_EXCLUDED"
QUARANTINED = "QUARANTINED"


def first_match(rules: Sequence[tuple[str, Column]]) -> Column:
    """Code of the first rule that holds, else NULL. A NULL condition does not hold."""
    return F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in rules])


def _not_positive(amount: Column, floor: str = "0") -> Column:
    return amount.isNull() | (amount <= F.lit(floor).cast("decimal(12,2)"))


# ---------------------------------------------------------------- orders

_ORDER_ORDER = (*ORDERS.newest_first, *ORDERS.tie_breakers)
_RETURN_ORDER = (*RETURNS.newest_first, *RETURNS.tie_breakers)

# What the contract declares of a feed, and where it came from.
ORDER_VERSION_COLUMNS = (*ORDERS.column_names, "source_system")
RETURN_COLUMNS = (*RETURNS.column_names, "source_system")


def normalise_orders(orders: DataFrame, contract: HealthContract) -> DataFrame:
    """Clean codes and the quarantine reason of every order event."""
    cleaned = orders.select(*ORDER_VERSION_COLUMNS).withColumns(
        {c: code(F.col(c)) for c in ("region_code", "category_code", "currency_code")}
    )
    rules = (
        ("TEST_TRANSACTION", F.col("customer_segment") == contract.test_segment),
        (
            "INVALID_AMOUNT",
            _not_positive(F.col("gross_amount"), contract.invalid_amount_at_or_below),
        ),
    )
    return cleaned.withColumn("quarantine_reason", first_match(rules))


def order_versions(
    orders: DataFrame, contract: HealthContract, hot: Sequence[Any] = ()
) -> DataFrame:
    """Every order event with its version rank (1 = latest), for audit."""
    events = normalise_orders(orders, contract)
    return versions.rank_versions(events, "order_id", _ORDER_ORDER, hot)


def latest_orders(orders: DataFrame, contract: HealthContract) -> DataFrame:
    """The latest version of every order, quarantined ones included."""
    return versions.latest(normalise_orders(orders, contract), "order_id", _ORDER_ORDER)


def latest_orders_by_max(orders: DataFrame, contract: HealthContract) -> DataFrame:
    return versions.latest_by_max(normalise_orders(orders, contract), "order_id", _ORDER_ORDER)


def governed_orders(latest: DataFrame) -> DataFrame:
    """Latest versions that no quarantine rule excludes, with the UTC order date."""
    day = F.to_date("order_timestamp_utc").alias("order_date")
    columns = [c for name in ORDER_VERSION_COLUMNS for c in ([name, day] if name == "order_timestamp_utc" else [name])]
    return latest.filter(F.col("quarantine_reason").isNull()).select(*columns)


# ---------------------------------------------------------------- returns


def latest_returns(returns: DataFrame) -> DataFrame:
    return versions.latest(returns.select(*RETURN_COLUMNS), "return_id", _RETURN_ORDER)


def reconcile_returns(
    returns: DataFrame, latest: DataFrame, hot_orders: Sequence[Any] = ()
) -> DataFrame:
    """Latest returns with a reconciliation status against the latest order versions."""
    facts = _order_facts(latest)
    return _judged(join_unique(latest_returns(returns), facts, "order_id", "left", hot_orders))


def reconcile_stored(returns: Stored, latest: DataFrame) -> DataFrame:
    """The same from latest returns and latest orders that lie in the same buckets."""
    return _judged(join_stored(returns, _order_facts(latest)))


def _order_facts(latest: DataFrame) -> DataFrame:
    return latest.select(
        "order_id",
        F.col("quarantine_reason").alias("_order_reason"),
        F.col("currency_code").alias("_order_currency"),
        F.lit(True).alias("_known"),
    )


def _judged(matched: DataFrame) -> DataFrame:
    """Status and reason are separate rules: a return of an excluded order can carry a reason
    without being quarantined.
    """
    currency = code(F.col("currency_code"))
    unknown = F.col("_known").isNull()
    bad_amount = _not_positive(F.col("return_amount"))
    mismatch = currency != F.col("_order_currency")
    status = first_match(
        (
            (ORPHAN, unknown),
            (ORDER_EXCLUDED, F.col("_order_reason").isNotNull()),
            (QUARANTINED, bad_amount | mismatch),
            (ACCEPTED, F.lit(True)),
        )
    )
    reasons = (("INVALID_RETURN_AMOUNT", bad_amount), ("RETURN_CURRENCY_MISMATCH", mismatch))
    reason = F.when(~unknown, first_match(reasons))
    return matched.select(
        *[currency.alias(c) if c == "currency_code" else F.col(c) for c in RETURN_COLUMNS],
        status.alias("reconciliation_status"),
        reason.alias("quarantine_reason"),
    )


# ---------------------------------------------------------------- quarantine


def quarantine(latest: DataFrame, reconciled: DataFrame, run_id: str) -> DataFrame:
    """Excluded orders and returns in one shape."""

    def rows(df: DataFrame, entity: str, key: str) -> DataFrame:
        return df.select(
            F.lit(entity).alias("source_entity"),
            F.col(key).alias("record_key"),
            "quarantine_reason",
            "source_system",
            "ingested_at",
            F.lit(run_id).alias("pipeline_run_id"),
        )

    orders = latest.filter(F.col("quarantine_reason").isNotNull())
    returns = reconciled.filter(F.col("reconciliation_status") == QUARANTINED)
    return rows(orders, "orders", "order_id").unionByName(rows(returns, "returns", "return_id"))


# ---------------------------------------------------------------- pricing


def accepted_returns(reconciled: DataFrame) -> DataFrame:
    """Accepted return amount and count per order: at most one row per order."""
    return (
        reconciled.filter(F.col("reconciliation_status") == ACCEPTED)
        .groupBy("order_id")
        .agg(
            F.sum("return_amount").cast("decimal(18,2)").alias("accepted_return_amount"),
            F.count(F.lit(1)).alias("return_count"),
        )
    )


def base_rates(rates: DataFrame, contract: HealthContract) -> DataFrame:
    """Rates to the reporting currency, keyed by order currency and order date."""
    return rates.filter(F.col("to_currency") == contract.reporting_currency).select(
        F.col("from_currency").alias("currency_code"),
        F.col("rate_date").alias("order_date"),
        "rate",
    )


def price_sales(
    governed: DataFrame, reconciled: DataFrame, rates: Lookup, contract: HealthContract
) -> DataFrame:
    """One priced row per governed order; the rate of the exact order date or NULL."""
    return _priced(governed.join(accepted_returns(reconciled), "order_id", "left"), rates, contract)


def price_stored(
    governed: DataFrame, reconciled: Stored, rates: Lookup, contract: HealthContract
) -> DataFrame:
    """The same from tables in the same buckets: returns are added up and joined where they lie.

    Returns of hot orders are added up across tasks; their few sums are broadcast.
    """
    added = reconciled.opposite(accepted_returns(reconciled.cold))
    amounts = governed.join(added, "order_id", "left")
    if reconciled.keys:
        few = accepted_returns(reconciled.hot).select(
            "order_id",
            F.col("accepted_return_amount").alias("_hot_amount"),
            F.col("return_count").alias("_hot_count"),
        )
        amounts = amounts.join(F.broadcast(few), "order_id", "left").select(
            *governed.columns,
            F.coalesce("_hot_amount", "accepted_return_amount").alias("accepted_return_amount"),
            F.coalesce("_hot_count", "return_count").alias("return_count"),
        )
    return _priced(amounts, rates, contract)


def _priced(amounts: DataFrame, rates: Lookup, contract: HealthContract) -> DataFrame:
    none = {"accepted_return_amount": "decimal(18,2)", "return_count": "bigint"}
    amounts = amounts.withColumns(
        {name: F.coalesce(name, F.lit(0).cast(kind)) for name, kind in none.items()}
    )
    priced = lookup(
        amounts, rates.map(base_rates(rates.frame, contract)), ["currency_code", "order_date"]
    )
    rate = F.when(
        F.col("currency_code") == contract.reporting_currency, F.lit(1).cast("decimal(10,6)")
    ).otherwise(F.col("rate"))
    return priced.withColumn("fx_rate_to_cad", rate).select(
        "order_id",
        "event_id",
        "order_date",
        "region_code",
        "category_code",
        "currency_code",
        "gross_amount",
        "accepted_return_amount",
        "return_count",
        "fx_rate_to_cad",
        to_cents(F.col("gross_amount"), F.col("fx_rate_to_cad")).alias("gross_revenue_cad"),
        to_cents(F.col("accepted_return_amount"), F.col("fx_rate_to_cad")).alias("returns_cad"),
        "source_system",
        "source_updated_at",
    )
