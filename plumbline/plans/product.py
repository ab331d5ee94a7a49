"""What serving reads: one consistent snapshot of the product's tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import (
    CALENDAR,
    CATEGORIES,
    ORDERS,
    REGIONS,
    TARGETS,
    FeedContract,
    HealthContract,
)
from plumbline.sources.store import HEALTH, RUNS, TableStore

_LINEAGE = ", source_system STRING, source_file STRING"
# Columns of the published facts and the quarantine table.
FACT_SALES = (
    "order_key STRING, date_key INT, region_key INT, category_key INT, "
    "gross_revenue_cad DECIMAL(18,2), returns_cad DECIMAL(18,2), net_revenue_cad DECIMAL(18,2), "
    "original_currency STRING, gross_amount_original_currency DECIMAL(12,2), "
    "applied_fx_rate DECIMAL(10,6), return_count BIGINT, pipeline_run_id STRING, "
    "order_source_system STRING, order_source_event_id STRING, "
    "order_source_updated_at TIMESTAMP, returns_source_system STRING, fx_source_system STRING, "
    "sales_month STRING"
)
FACT_TARGETS = (
    "date_key INT, region_key INT, category_key INT, target_month STRING, "
    "target_cad DECIMAL(18,2), approved_by_role STRING, approved_at_utc TIMESTAMP, "
    "source_system STRING, pipeline_run_id STRING"
)
QUARANTINE = (
    "source_entity STRING, record_key STRING, quarantine_reason STRING, source_system STRING, "
    "ingested_at TIMESTAMP, pipeline_run_id STRING"
)


@dataclass(frozen=True)
class Question:
    """One region and month, asked of the raw and the governed path."""

    region_code: str
    month: str  # yyyy-MM


@dataclass(frozen=True)
class Product:
    name: str
    health: DataFrame  # at most one row: the latest record of the product
    status: str | None  # its status, read once when the snapshot was opened
    runs: DataFrame
    quality_results: DataFrame
    quarantine: DataFrame
    bronze_orders: DataFrame
    bronze_targets: DataFrame
    dim_date: DataFrame
    dim_region: DataFrame
    dim_category: DataFrame
    fact_sales: DataFrame
    fact_targets: DataFrame


def _landed(feed: FeedContract) -> str:
    extra = ", source_file STRING" if "source_system" in feed.column_names else _LINEAGE
    return ", ".join(f"{c.name} {c.type}" for c in feed.columns) + extra


# Landed orders lie in a folder for each month of their order time.
LANDED_ORDERS = _landed(ORDERS) + ", order_month STRING"


def open_product(
    store: TableStore, contract: HealthContract, history: str = "default"
) -> Product:
    """Open the tables of the latest finished run; facts only while the product is READY.

    One small health read on the driver decides which files are opened, so a product that is
    not READY never scans a fact table, and all queries of a snapshot share one run id.
    """
    health = store.current(HEALTH, history).filter(
        F.col("data_product") == contract.data_product
    )
    row = health.select("status", "pipeline_run_id").first()
    status = None if row is None else row["status"]
    runs = store.current(RUNS, history)
    if status in ("READY", "BLOCKED"):
        run_id = row["pipeline_run_id"]
    else:
        # RUNNING or FAILED: landed data is that of the last finished run, as after a rollback.
        finished = runs.filter(F.col("status").isin("READY", "BLOCKED"))
        run_id = finished.agg(F.max_by("pipeline_run_id", "completed_at_utc")).first()[0]
    if run_id is not None and store.manifest(run_id) is None:
        run_id = None  # swept, or never completed
    published = run_id if status == "READY" else None
    return Product(
        name=contract.data_product,
        health=health,
        status=status,
        runs=runs,
        quality_results=store.quality_results(None if row is None else row["pipeline_run_id"]),
        quarantine=store.read("silver_quarantine", run_id, QUARANTINE),
        bronze_orders=store.read("bronze_orders", run_id, LANDED_ORDERS),
        bronze_targets=store.read("bronze_targets", run_id, _landed(TARGETS)),
        dim_date=store.read("gold_dim_date", run_id, CALENDAR.schema),
        dim_region=store.read("gold_dim_region", run_id, REGIONS.schema),
        dim_category=store.read("gold_dim_category", run_id, CATEGORIES.schema),
        fact_sales=store.read("gold_fact_sales", published, FACT_SALES),
        fact_targets=store.read("gold_fact_targets", published, FACT_TARGETS),
    )
