"""Contract-driven quality checks: observe, evaluate against the contract, roll up to health.

Every check contributes rows (check_name, value) that add up to its observed value, so all
checks come out of one plan with one aggregate per table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.contracts import BLOCKING, HealthContract
from plumbline.functions.columns import REASON_SEPARATOR, age_minutes, counted, utc
from plumbline.operators.joins import Lookup, lookup
from plumbline.operators.silver import ORPHAN, QUARANTINED

PASS, FAIL, WARN = "PASS", "FAIL", "WARN"

RESULT_COLUMNS = (
    "pipeline_run_id",
    "check_name",
    "severity",
    "observed_value",
    "threshold",
    "status",
    "detail",
    "evaluated_at_utc",
)


@dataclass(frozen=True)
class SilverTables:
    """What the checks read: landed feeds, Silver tables and checked reference data."""

    bronze_orders: DataFrame
    bronze_returns: DataFrame
    latest_orders: DataFrame  # latest versions, quarantined ones included
    governed_orders: DataFrame
    returns: DataFrame  # reconciled
    sales: DataFrame  # priced
    regions: Lookup
    categories: Lookup


@dataclass(frozen=True)
class Measured:
    """What tasks counted while they wrote the tables, so that no table is read for it again."""

    newest_order: int | None  # microseconds since 1970
    newest_return: int | None
    order_events: int
    latest_orders: int


# ---------------------------------------------------------------- observations


def _count(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0).cast("bigint"))


def _contributions(one_row: DataFrame, **values: Column) -> DataFrame:
    """One aggregate row to (check_name, value) rows."""
    pairs = [
        F.struct(F.lit(name).alias("check_name"), value.cast("bigint").alias("value"))
        for name, value in values.items()
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def freshness(feed: DataFrame, as_of: datetime | str, check: str) -> DataFrame:
    newest = feed.agg(F.max("ingested_at").alias("newest"))
    return _contributions(newest, **{check: age_minutes(F.col("newest"), utc(as_of))})


def unsupported(currency: Column, contract: HealthContract) -> Column:
    return currency.isNull() | ~currency.isin(*contract.accepted_currencies)


def superseded_events(bronze_orders: DataFrame, latest_orders: DataFrame) -> DataFrame:
    """Events minus latest versions: all other ranks."""
    events = bronze_orders.agg(F.count(F.lit(1)).alias("n"))
    kept = latest_orders.agg(F.count(F.lit(1)).alias("n"))
    return _contributions(events, DUPLICATES_RESOLVED=F.col("n")).unionByName(
        _contributions(kept, DUPLICATES_RESOLVED=-F.col("n"))
    )


def measured_checks(
    spark: SparkSession, measured: Measured, as_of: datetime | str
) -> DataFrame:
    """Freshness and superseded events from what the writes measured: one row, no scan."""

    def age(micros: int | None) -> Column:
        return age_minutes(F.timestamp_micros(F.lit(micros).cast("bigint")), utc(as_of))

    return _contributions(
        spark.range(1),
        ORDERS_FRESHNESS=age(measured.newest_order),
        RETURNS_FRESHNESS=age(measured.newest_return),
        DUPLICATES_RESOLVED=F.lit(measured.order_events - measured.latest_orders),
    )


def order_checks(
    latest_orders: DataFrame, regions: Lookup, categories: Lookup, contract: HealthContract
) -> DataFrame:
    """Required keys, currencies and quarantined orders, over the latest versions."""
    known_regions = regions.frame.select(
        "region_code", F.lit(True).alias("_region")
    ).dropDuplicates(["region_code"])
    known_categories = categories.frame.select(
        "category_code", F.lit(True).alias("_category")
    ).dropDuplicates(["category_code"])
    flagged = lookup(latest_orders, regions.map(known_regions), "region_code")
    flagged = lookup(flagged, categories.map(known_categories), "category_code")
    missing = (
        F.col("order_id").isNull() | F.col("_region").isNull() | F.col("_category").isNull()
    )
    totals = flagged.agg(
        _count(missing).alias("missing"),
        _count(unsupported(F.col("currency_code"), contract)).alias("unsupported"),
        _count(F.col("quarantine_reason").isNotNull()).alias("quarantined"),
    )
    return _contributions(
        totals,
        MISSING_REQUIRED_KEYS=F.col("missing"),
        UNSUPPORTED_CURRENCY=F.col("unsupported"),
        QUARANTINED_ROWS=F.col("quarantined"),
    )


def return_checks(reconciled: DataFrame, contract: HealthContract) -> DataFrame:
    """Duplicate return ids, orphans, currencies and quarantined returns."""
    status = F.col("reconciliation_status")
    per_key = reconciled.groupBy("return_id").agg(
        F.count(F.lit(1)).alias("rows"),
        _count(status == ORPHAN).alias("orphans"),
        _count(status == QUARANTINED).alias("quarantined"),
        _count(unsupported(F.col("currency_code"), contract)).alias("unsupported"),
    )
    totals = per_key.agg(
        _count(F.col("rows") > 1).alias("duplicates"),
        F.coalesce(F.sum("orphans"), F.lit(0)).alias("orphans"),
        F.coalesce(F.sum("quarantined"), F.lit(0)).alias("quarantined"),
        F.coalesce(F.sum("unsupported"), F.lit(0)).alias("unsupported"),
    )
    return _contributions(
        totals,
        DUPLICATE_BUSINESS_KEYS=F.col("duplicates"),
        ORPHAN_RETURNS=F.col("orphans"),
        UNSUPPORTED_CURRENCY=F.col("unsupported"),
        QUARANTINED_ROWS=F.col("quarantined"),
    )


def sales_checks(sales: DataFrame, contract: HealthContract) -> DataFrame:
    """Duplicate order ids and accepted-currency rows without a rate."""
    no_rate = F.col("fx_rate_to_cad").isNull() & F.col("currency_code").isin(
        *contract.accepted_currencies
    )
    per_key = sales.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("rows"), _count(no_rate).alias("no_rate")
    )
    totals = per_key.agg(
        _count(F.col("rows") > 1).alias("duplicates"),
        F.coalesce(F.sum("no_rate"), F.lit(0)).alias("no_rate"),
    )
    return _contributions(
        totals, DUPLICATE_BUSINESS_KEYS=F.col("duplicates"), MISSING_FX=F.col("no_rate")
    )


def return_rate(sales: DataFrame) -> DataFrame:
    """Highest category return percentage, rounded to whole percent per category."""
    by_category = (
        sales.filter(F.col("gross_revenue_cad").isNotNull())
        .groupBy("category_code")
        .agg(F.sum("returns_cad").alias("returned"), F.sum("gross_revenue_cad").alias("gross"))
    )
    gross = F.nullif(F.col("gross"), F.lit(0).cast("decimal(28,2)"))
    rate = F.round(F.lit(100) * F.col("returned") / gross, 0)
    highest = by_category.agg(F.max(rate).alias("rate"))
    return _contributions(highest, HIGH_RETURN_RATE=F.coalesce(F.col("rate"), F.lit(0)))


def daily_volumes(governed_orders: DataFrame) -> DataFrame:
    """Orders per category and day with the category's mean over its active days."""
    daily = governed_orders.groupBy("category_code", "order_date").agg(
        F.count(F.lit(1)).alias("daily_orders")
    )
    mean = F.avg("daily_orders").over(Window.partitionBy("category_code"))
    return daily.withColumn("average_daily_orders", mean)


def volume_anomaly(governed_orders: DataFrame, contract: HealthContract) -> DataFrame:
    limit = F.col("average_daily_orders") * contract.volume_anomaly_factor
    days = daily_volumes(governed_orders).agg(_count(F.col("daily_orders") > limit).alias("days"))
    return _contributions(days, VOLUME_ANOMALY=F.col("days"))


def observe(
    tables: SilverTables,
    contract: HealthContract,
    as_of: datetime | str,
    measured: Measured | None = None,
) -> DataFrame:
    """Observed value of every check, one row per check."""
    if measured is None:
        feeds = [
            freshness(tables.bronze_orders, as_of, "ORDERS_FRESHNESS"),
            freshness(tables.bronze_returns, as_of, "RETURNS_FRESHNESS"),
            superseded_events(tables.bronze_orders, tables.latest_orders),
        ]
    else:
        feeds = [measured_checks(tables.sales.sparkSession, measured, as_of)]
    parts = [
        *feeds,
        order_checks(tables.latest_orders, tables.regions, tables.categories, contract),
        return_checks(tables.returns, contract),
        sales_checks(tables.sales, contract),
        return_rate(tables.sales),
        volume_anomaly(tables.governed_orders, contract),
    ]
    return total(reduce(DataFrame.unionByName, parts))


def total(contributions: DataFrame) -> DataFrame:
    return contributions.groupBy("check_name").agg(F.sum("value").alias("observed_value"))


# ---------------------------------------------------------------- evaluation


def check_frame(spark: SparkSession, contract: HealthContract) -> DataFrame:
    """The contract's checks in order (at most eleven rows) with their limits."""
    limits = {
        "ORDERS_FRESHNESS": (contract.orders_freshness_sla_minutes, "minutes"),
        "RETURNS_FRESHNESS": (contract.returns_freshness_sla_minutes, "minutes"),
        "HIGH_RETURN_RATE": (contract.max_category_return_rate_pct, "percent"),
    }
    rows = [
        (seq, c.name, c.severity, *limits.get(c.name, (0, None)))
        for seq, c in enumerate(contract.checks)
    ]
    return spark.createDataFrame(
        rows, "seq INT, check_name STRING, severity STRING, allowed BIGINT, unit STRING"
    )


def _details(contract: HealthContract, n: Column, breached: Column) -> Column:
    """Human text per check. The wording of every check."""
    accepted = ", ".join(contract.accepted_currencies)
    factor = contract.volume_anomaly_factor

    def either(bad: Column, good: str | Column) -> Column:
        return F.when(breached, bad).otherwise(F.lit(good) if isinstance(good, str) else good)

    def age(feed: str, sla: int) -> Column:
        minutes = F.format_string("%,d", n)
        stale = F.concat(
            F.lit(f"the {feed} feed is stale (last extract "),
            minutes,
            F.lit(f" minutes old; SLA {sla} minutes)"),
        )
        fresh = F.concat(
            F.lit(f"the {feed} extract is "), minutes, F.lit(f" minutes old (SLA {sla} minutes)")
        )
        return F.when(n.isNull(), F.lit(f"no {feed} extract has been ingested")).otherwise(
            either(stale, fresh)
        )

    texts = {
        "ORDERS_FRESHNESS": age("orders", contract.orders_freshness_sla_minutes),
        "RETURNS_FRESHNESS": age("returns", contract.returns_freshness_sla_minutes),
        "DUPLICATE_BUSINESS_KEYS": either(
            F.concat(
                counted(n, "business key remains", "business keys remain"),
                F.lit(" duplicated after Silver processing"),
            ),
            "no duplicate business keys after Silver processing",
        ),
        "MISSING_FX": either(
            F.concat(
                F.lit("currency conversion coverage is incomplete ("),
                counted(n, "order has", "orders have"),
                F.lit(" no transaction-date FX rate)"),
            ),
            f"every non-{contract.reporting_currency} order has a transaction-date FX rate",
        ),
        "ORPHAN_RETURNS": either(
            F.concat(
                counted(n, "return references", "returns reference"),
                F.lit(" an unknown order (referential integrity violation)"),
            ),
            "every return references a known order",
        ),
        "MISSING_REQUIRED_KEYS": either(
            F.concat(
                counted(n, "row has", "rows have"), F.lit(" missing or unknown required keys")
            ),
            "all required keys are present and known",
        ),
        "UNSUPPORTED_CURRENCY": either(
            F.concat(
                counted(n, "row uses", "rows use"), F.lit(f" a currency outside {accepted}")
            ),
            f"all rows use an accepted currency ({accepted})",
        ),
        "DUPLICATES_RESOLVED": either(
            F.concat(
                counted(n, "duplicate order event was", "duplicate order events were"),
                F.lit(" detected and discarded by the deduplication policy"),
            ),
            "no duplicate order events detected",
        ),
        "QUARANTINED_ROWS": either(
            F.concat(
                counted(n, "row was", "rows were"), F.lit(" quarantined by contract rules")
            ),
            "no rows quarantined",
        ),
        "HIGH_RETURN_RATE": F.concat(
            F.lit("the highest category return rate is "),
            n.cast("string"),
            F.lit(f"% (warning above {contract.max_category_return_rate_pct}%)"),
        ),
        "VOLUME_ANOMALY": either(
            F.concat(
                counted(n, "category day exceeds", "category days exceed"),
                F.lit(f" {factor}x the average daily volume"),
            ),
            f"no category day exceeds {factor}x the average daily volume",
        ),
    }
    return F.coalesce(
        *[F.when(F.col("check_name") == name, text) for name, text in texts.items()]
    )


def evaluate(observed: DataFrame, contract: HealthContract) -> DataFrame:
    """Threshold, status and detail of every declared check, in contract order (``seq``)."""
    spark = observed.sparkSession
    timed = F.col("check_name").isin("ORDERS_FRESHNESS", "RETURNS_FRESHNESS")
    value = F.when(timed, F.col("observed_value")).otherwise(
        F.coalesce("observed_value", F.lit(0))
    )
    breached = F.coalesce(F.col("observed_value") > F.col("allowed"), F.lit(True))
    threshold = F.when(
        F.col("unit").isNotNull(), F.format_string("<= %d %s", F.col("allowed"), F.col("unit"))
    ).otherwise("= 0")
    status = (
        F.when(~breached, PASS).when(F.col("severity") == BLOCKING, FAIL).otherwise(WARN)
    )
    return (
        check_frame(spark, contract)
        .join(observed, "check_name", "left")
        .withColumn("observed_value", value)
        .select(
            "seq",
            "check_name",
            "severity",
            "observed_value",
            threshold.alias("threshold"),
            status.alias("status"),
            _details(contract, F.col("observed_value"), breached).alias("detail"),
        )
    )


def run_checks(
    tables: SilverTables,
    contract: HealthContract,
    as_of: datetime | str,
    measured: Measured | None = None,
) -> DataFrame:
    return evaluate(observe(tables, contract, as_of, measured), contract)


# ---------------------------------------------------------------- roll-up


def summarise(results: DataFrame) -> DataFrame:
    """One health row: BLOCKED if any check failed, reasons in contract order, counters."""

    def reasons(status: str) -> Column:
        listed = F.expr(
            f"listagg(CASE WHEN status = '{status}' THEN concat(check_name, ': ', detail) END, "
            f"'{REASON_SEPARATOR}') WITHIN GROUP (ORDER BY seq)"
        )
        return F.coalesce(listed, F.lit(""))

    def observed(name: str) -> Column:
        return F.max(F.when(F.col("check_name") == name, F.col("observed_value")))

    def counter(*names: str) -> Column:
        zero = F.lit(0).cast("bigint")
        return reduce(Column.__add__, [F.coalesce(observed(n), zero) for n in names])

    blocked = F.count_if(F.col("status") == FAIL) > 0
    return results.agg(
        F.when(blocked, "BLOCKED").otherwise("READY").alias("status"),
        reasons(FAIL).alias("blocking_reasons"),
        reasons(WARN).alias("warning_reasons"),
        observed("ORDERS_FRESHNESS").alias("orders_freshness_minutes"),
        observed("RETURNS_FRESHNESS").alias("returns_freshness_minutes"),
        # The older feed; a feed without an extract has no age.
        F.greatest(observed("ORDERS_FRESHNESS"), observed("RETURNS_FRESHNESS")).alias(
            "freshness_minutes"
        ),
        counter("DUPLICATES_RESOLVED", "DUPLICATE_BUSINESS_KEYS").alias("duplicate_count"),
        counter("MISSING_FX").alias("missing_fx_count"),
        counter("ORPHAN_RETURNS").alias("orphan_return_count"),
        counter("MISSING_REQUIRED_KEYS").alias("missing_key_count"),
        counter("UNSUPPORTED_CURRENCY").alias("unsupported_currency_count"),
        counter("QUARANTINED_ROWS").alias("quarantined_rows"),
    )
