"""Gold: conformed dimensions, the two facts, and publish-or-withhold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import CALENDAR, CATEGORIES, FX_RATES, REGIONS, RETURNS, HealthContract
from plumbline.functions.columns import money
from plumbline.operators.joins import Lookup, lookup

FACT_SALES_COLUMNS = (
    "order_key",
    "date_key",
    "region_key",
    "category_key",
    "gross_revenue_cad",
    "returns_cad",
    "net_revenue_cad",
    "original_currency",
    "gross_amount_original_currency",
    "applied_fx_rate",
    "return_count",
    "pipeline_run_id",
    "order_source_system",
    "order_source_event_id",
    "order_source_updated_at",
    "returns_source_system",
    "fx_source_system",
)


def dim_date(calendar: DataFrame) -> DataFrame:
    return calendar.select(*CALENDAR.column_names)


def dim_region(regions: DataFrame) -> DataFrame:
    return regions.select(*REGIONS.column_names)


def dim_category(categories: DataFrame) -> DataFrame:
    return categories.select(*CATEGORIES.column_names)


def fact_sales(
    sales: DataFrame,
    dates: Lookup,
    regions: Lookup,
    categories: Lookup,
    contract: HealthContract,
    run_id: str,
) -> DataFrame:
    """Priced sales with dimension keys and lineage.

    Rows without a dimension match are dropped. ``sales_month`` is the storage partition.
    """
    return with_lineage(keyed_sales(sales, dates, regions, categories), contract, run_id)


def keyed_sales(
    sales: DataFrame, dates: Lookup, regions: Lookup, categories: Lookup
) -> DataFrame:
    """The fact's columns that are looked up or taken over, one by one from the priced sales."""
    days = dates.map(
        dates.frame.select(
            F.col("calendar_date").alias("order_date"),
            "date_key",
            F.col("year_month").alias("sales_month"),
        )
    )
    keyed = lookup(sales, days, "order_date", "inner")
    keyed = lookup(
        keyed,
        regions.map(regions.frame.select("region_code", "region_key")),
        "region_code",
        "inner",
    )
    keyed = lookup(
        keyed,
        categories.map(categories.frame.select("category_code", "category_key")),
        "category_code",
        "inner",
    )
    return keyed.select(
        F.col("order_id").alias("order_key"),
        "date_key",
        "region_key",
        "category_key",
        "gross_revenue_cad",
        "returns_cad",
        F.col("currency_code").alias("original_currency"),
        F.col("gross_amount").alias("gross_amount_original_currency"),
        F.col("fx_rate_to_cad").alias("applied_fx_rate"),
        "return_count",
        F.col("source_system").alias("order_source_system"),
        F.col("event_id").alias("order_source_event_id"),
        F.col("source_updated_at").alias("order_source_updated_at"),
        "sales_month",
    )


def with_lineage(keyed: DataFrame, contract: HealthContract, run_id: str) -> DataFrame:
    """The whole fact: what follows from a row's own columns is added."""
    base = contract.reporting_currency
    made = {
        "net_revenue_cad": money(F.col("gross_revenue_cad") - F.col("returns_cad")),
        "pipeline_run_id": F.lit(run_id),
        "returns_source_system": F.when(F.col("return_count") > 0, F.lit(RETURNS.source_system)),
        "fx_source_system": F.when(F.col("original_currency") == base, F.lit(f"none ({base})")).otherwise(
            F.lit(FX_RATES.source_system)
        ),
    }
    return keyed.withColumns(made).select(*FACT_SALES_COLUMNS, "sales_month")


def fact_targets(
    targets: DataFrame, dates: Lookup, regions: Lookup, categories: Lookup, run_id: str
) -> DataFrame:
    """Monthly targets on the date key of day 1."""
    first_days = dates.map(
        dates.frame.filter(F.col("day_of_month") == 1).select(
            F.col("year_month").alias("target_month"), "date_key"
        )
    )
    keyed = lookup(targets, first_days, "target_month", "inner")
    keyed = lookup(
        keyed,
        regions.map(regions.frame.select("region_code", "region_key")),
        "region_code",
        "inner",
    )
    keyed = lookup(
        keyed,
        categories.map(categories.frame.select("category_code", "category_key")),
        "category_code",
        "inner",
    )
    return keyed.select(
        "date_key",
        "region_key",
        "category_key",
        "target_month",
        "target_cad",
        "approved_by_role",
        "approved_at_utc",
        "source_system",
        F.lit(run_id).alias("pipeline_run_id"),
    )


def publish_or_withhold(fact: DataFrame, ready: bool) -> DataFrame:
    """The fact itself when the product is READY, else its schema without rows."""
    return fact if ready else fact.filter(F.lit(False))
