"""The build job: land, refine, check, publish or withhold, record."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.contracts import ORDERS, RETURNS, FeedContract, HealthContract
from plumbline.functions.columns import utc
from plumbline.operators import quality, silver, star
from plumbline.operators.joins import HASHED_ROWS, Lookup, Stored, hot_keys, is_one_of
from plumbline.sources.feeds import FeedSet
from plumbline.sources.store import HEALTH, QUALITY_RESULTS, RUNS, TableStore, schema_of, write_settings

BATCHES = ("broken", "repaired")
# Records of extracts that do not fit their contract; written only for reads that keep them.
REJECTS = "bronze_rejects"


class BuildFailed(RuntimeError):
    """The job itself failed, as opposed to finishing BLOCKED."""


class ProductBlocked(RuntimeError):
    """The job finished and a blocking check failed."""


@dataclass(frozen=True)
class BuildResult:
    run_id: str
    status: str
    health: dict[str, Any]


def wall_clock() -> datetime:
    return datetime.now(timezone.utc)


def new_run_id(started: datetime, batch: str) -> str:
    return f"run-{started:%Y%m%dT%H%M%SZ}-{batch}-{uuid.uuid4().hex[:6]}"


def _naive(moment: datetime) -> datetime:
    """Records are stored in UTC by a UTC session."""
    if moment.tzinfo is None:
        return moment
    return moment.astimezone(timezone.utc).replace(tzinfo=None)


def together(*steps: Callable[[], Any]) -> list[Any]:
    """Run independent Spark actions at the same time; results in the given order."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        # The caller's job group and scheduler pool hold for the steps too.
        started = [pool.submit(inheritable_thread_target(step)) for step in steps]
        return [running.result() for running in started]


def land(store: TableStore, feeds: FeedSet, run_id: str) -> dict[str, DataFrame]:
    """Bronze: every feed as received, counted while it is written.

    Orders lie in a folder for each month, so a question about one reads no other; they are sorted by
    region there. Orders that come dealt out by their id are stored as they come, in buckets, and are
    ranked without another shuffle; a month's file of one part holds some ten thousand rows, which are
    not sorted.
    """
    arrivals = {
        "rows": F.count(F.lit(1)),
        "newest_micros": F.unix_micros(F.max("ingested_at")),
    }

    def save(feed: FeedContract, df: DataFrame) -> DataFrame:
        if feed is ORDERS:
            dated = df.withColumn("order_month", F.date_format("order_timestamp_utc", "yyyy-MM"))
            write = partial(store.write, sort_by=["region_code"])
            if feeds.dealt:
                write = partial(store.write_bucketed, key="order_id", buckets=feeds.dealt)
            stored = write(
                dated,
                feed.table,
                run_id,
                partition_by=["order_month"],
                measures=arrivals,
            )
            return stored.drop("order_month")
        return store.write(df, feed.table, run_id, measures=arrivals if feed is RETURNS else None)

    names = [feed.table for feed, _ in feeds.items()]
    writes = [partial(save, feed, df) for feed, df in feeds.items()]
    if feeds.rejects is not None:
        names.append(REJECTS)
        rows = {"rows": F.count(F.lit(1))}
        writes.append(partial(store.write, feeds.rejects, REJECTS, run_id, measures=rows))
    return dict(zip(names, together(*writes), strict=True))


def check_references(tables: dict[str, DataFrame]) -> dict[str, Lookup]:
    """Count the reference tables once; only those that fit are broadcast."""
    return Lookup.checked(
        {
            "dates": tables["ref_calendar"],
            "regions": tables["ref_regions"],
            "categories": tables["ref_categories"],
            "rates": tables["bronze_fx_rates"],
        }
    )


def refine(
    store: TableStore,
    tables: dict[str, DataFrame],
    contract: HealthContract,
    run_id: str,
    dealt: int | None = None,
) -> tuple[dict[str, DataFrame], dict[str, Lookup]]:
    """Silver tables and dimensions of one run, written and read back in order.

    Orders that came dealt out have no id with a large share and lie in its buckets already, so their
    keys are not counted again.
    """
    orders, returns = tables["bronze_orders"], tables["bronze_returns"]
    hot_events, hot_returns, refs = together(
        lambda: [] if dealt else hot_keys(orders, "order_id")["order_id"],
        lambda: hot_keys(returns, "order_id")["order_id"],
        lambda: check_references(tables),
    )

    def save(name: str, df: DataFrame) -> Callable[[], DataFrame]:
        return partial(store.write, df, name, run_id)

    def co_located(name: str, df: DataFrame, **options: Any) -> Callable[[], DataFrame]:
        return partial(store.write_bucketed, df, name, run_id, "order_id", **options)

    ranked = silver.order_versions(orders, contract, hot_events)
    current = silver.latest_returns(returns).withColumn(
        "hot_order", is_one_of(F.col("order_id"), hot_returns)
    )
    # Everything that meets on the order id is stored in its buckets, so it is dealt out once.
    versions, stored_returns = together(
        co_located(
            "silver_order_versions",
            ranked.withColumn("is_latest", F.col("version_rank") == 1),
            partition_by=["is_latest"],
            measures={"latest": F.count_if("is_latest")},
        ),
        co_located("silver_latest_returns", current, partition_by=["hot_order"], spread=True),
    )
    latest = versions.filter("is_latest").drop("version_rank", "is_latest")
    # Buckets of unique orders bound those of returns added up by order as well.
    unique = store.measured("silver_order_versions", run_id)["latest"]
    hashed = unique <= HASHED_ROWS * store.buckets
    by_order = Stored.split(stored_returns, "hot_order", "order_id", hot_returns, hashed)
    flagged = silver.reconcile_stored(by_order, latest).withColumn(
        "hot_order", is_one_of(F.col("order_id"), hot_returns)
    )
    governed, judged = together(
        co_located("silver_orders", silver.governed_orders(latest)),
        co_located("silver_returns", flagged, partition_by=["hot_order"]),
    )
    reconciled = Stored.split(judged, "hot_order", "order_id", hot_returns, hashed)
    sales, *_ = together(
        co_located(
            "silver_reconciled_sales",
            silver.price_stored(governed, reconciled, refs["rates"], contract),
            measures={"rows": F.count(F.lit(1))},
        ),
        save("silver_quarantine", silver.quarantine(latest, reconciled.all_rows, run_id)),
        save("gold_dim_date", star.dim_date(tables["ref_calendar"])),
        save("gold_dim_region", star.dim_region(tables["ref_regions"])),
        save("gold_dim_category", star.dim_category(tables["ref_categories"])),
    )
    silver_tables = {
        "silver_order_versions": versions,
        "latest_orders": latest,
        "silver_orders": governed,
        "silver_returns": reconciled.all_rows,
        "silver_reconciled_sales": sales,
    }
    return {**tables, **silver_tables}, refs


def publish_facts(
    store: TableStore,
    tables: dict[str, DataFrame],
    refs: dict[str, Lookup],
    contract: HealthContract,
    run_id: str,
    ready: bool,
) -> list[Callable[[], DataFrame]]:
    """The two fact writes; without rows unless READY."""
    dims = (refs["dates"], refs["regions"], refs["categories"])
    sales = star.keyed_sales(tables["silver_reconciled_sales"], *dims)
    targets = star.fact_targets(tables["bronze_targets"], *dims, run_id)
    sales = star.publish_or_withhold(sales, ready)
    targets = star.publish_or_withhold(targets, ready)
    # A withheld fact is stored as an unpartitioned, empty file that keeps the columns.
    partitions = ("sales_month",) if ready else ()
    return [
        partial(
            store.write,
            sales,
            "gold_fact_sales",
            run_id,
            partitions,
            finish=partial(star.with_lineage, contract=contract, run_id=run_id),
        ),
        partial(store.write, targets, "gold_fact_targets", run_id),
    ]


def layer_counts(store: TableStore, run_id: str) -> dict[str, int]:
    """Rows per layer, as the writing tasks counted them."""
    tables = {
        "bronze_order_rows": "bronze_orders",
        "bronze_return_rows": "bronze_returns",
        "silver_sales_rows": "silver_reconciled_sales",
    }
    return {column: store.measured(t, run_id)["rows"] for column, t in tables.items()}


class RunRecorder:
    """States of one run. What is known so far goes to the run and the health events, each taking
    the columns that its table declares.
    """

    def __init__(
        self, store: TableStore, history: str, clock: Callable[[], datetime], **known: Any
    ) -> None:
        self._store, self._history, self._clock = store, history, clock
        self._timer, self.known = time.perf_counter(), known

    def __call__(self, seq: int, **fields: Any) -> dict[str, Any]:
        now = _naive(self._clock())
        self.known.update(fields, evaluated_at_utc=now)
        if fields["status"] == "READY":
            self.known["last_successful_refresh_utc"] = now
        if seq:
            took = int((time.perf_counter() - self._timer) * 1000)
            self.known.update(completed_at_utc=now, duration_ms=took)
        rows = {
            table: {name: self.known.get(name) for name in schema_of(table).names}
            for table in (RUNS, HEALTH)
        }
        append = self._store.append_event
        together(*[partial(append, t, row, self._history, seq, now) for t, row in rows.items()])
        return rows[HEALTH]

    @contextmanager
    def recording_failure(self) -> Iterator[None]:
        """A step that fails is on record as FAILED before its error is passed on."""
        try:
            yield
        except Exception as exc:
            # Fixed value: how a failed step is told.
            reason = f"PIPELINE_ERROR: {type(exc).__name__}: {exc}"
            self(1, status="FAILED", failure_reasons=reason, blocking_reasons=reason)
            raise BuildFailed(reason) from exc


def build_tables(
    store: TableStore,
    feeds: FeedSet,
    contract: HealthContract,
    as_of: datetime | str,
    run_id: str,
    evaluated_at: datetime,
) -> dict[str, Any]:
    """Write all tables of a run and return the roll-up of its checks with the rows per layer."""
    tables, refs = refine(store, land(store, feeds, run_id), contract, run_id, feeds.dealt)
    checked = quality.SilverTables(
        bronze_orders=tables["bronze_orders"],
        bronze_returns=tables["bronze_returns"],
        latest_orders=tables["latest_orders"],
        governed_orders=tables["silver_orders"],
        returns=tables["silver_returns"],
        sales=tables["silver_reconciled_sales"],
        regions=refs["regions"],
        categories=refs["categories"],
    )
    arrived = {t: store.measured(t, run_id) for t in ("bronze_orders", "bronze_returns")}
    measured = quality.Measured(
        newest_order=arrived["bronze_orders"]["newest_micros"],
        newest_return=arrived["bronze_returns"]["newest_micros"],
        order_events=arrived["bronze_orders"]["rows"],
        latest_orders=store.measured("silver_order_versions", run_id)["latest"],
    )
    results = quality.run_checks(checked, contract, as_of, measured)
    stored = store.write(
        results.select(
            F.lit(run_id).alias("pipeline_run_id"),
            *results.columns,
            utc(evaluated_at).alias("evaluated_at_utc"),
        ),
        QUALITY_RESULTS,
        run_id,
    )
    summary = quality.summarise(stored).first().asDict()
    together(
        *publish_facts(store, tables, refs, contract, run_id, summary["status"] == "READY")
    )
    return {**summary, **layer_counts(store, run_id), "failure_reasons": summary["blocking_reasons"]}


def run_build(
    spark: SparkSession,
    load: Callable[[], FeedSet],
    store: TableStore,
    contract: HealthContract,
    batch: str,
    as_of: datetime | str,
    *,
    history: str = "default",
    run_id: str | None = None,
    clock: Callable[[], datetime] = wall_clock,
    raise_when_blocked: bool = False,
    keep_runs: int | None = None,
) -> BuildResult:
    """Run the whole build once. ``as_of`` is the business clock, ``clock`` the wall clock.

    RUNNING is recorded before any work. A failing step is recorded as FAILED and raised. A new
    ``history`` label starts a fresh run history. With ``keep_runs``, tables of older runs go.
    """
    if batch not in BATCHES:
        raise ValueError(f"batch must be one of {BATCHES}, not {batch!r}")
    started = clock()
    run_id = run_id or new_run_id(started, batch)
    store.create_if_missing()
    business = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    record = RunRecorder(
        store,
        history,
        clock,
        pipeline_run_id=run_id,
        scenario_mode=batch,
        started_at_utc=_naive(started),
        as_of_utc=_naive(business),
        data_product=contract.data_product,
        data_contract_version=contract.version,
        freshness_sla_minutes=contract.returns_freshness_sla_minutes,
        last_successful_refresh_utc=store.last_success(history),
    )
    record(0, status="RUNNING")
    with record.recording_failure(), write_settings(spark):
        outcome = build_tables(store, load(), contract, as_of, run_id, clock())
        # From here on the run can be opened; the events decide whether it is.
        store.commit(run_id, f"{_naive(started).isoformat()} {run_id}")
    status = outcome["status"]
    final = record(1, **outcome)
    if keep_runs is not None:
        under_way = store.current(RUNS, history).filter("status = 'RUNNING'").select("pipeline_run_id")
        store.sweep(keep_runs, [r[0] for r in under_way.collect()])
    if raise_when_blocked and status != "READY":
        raise ProductBlocked(
            f"data product {contract.data_product} is {status} (run {run_id}): "
            f"{outcome['blocking_reasons']}"
        )
    return BuildResult(run_id, status, final)
