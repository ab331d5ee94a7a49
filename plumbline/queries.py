"""The registered queries: every operator and answer over a directory of trade tables.

A callable takes (session, directory). Silver, check and audit queries are lazy plans over the
feeds; serving queries read a published build of the same directory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.contracts import FX_RATES, ORDERS, RETURNS, MetricContract
from plumbline.functions.columns import cad, money, pct
from plumbline.operators import audits, quality, scans, silver, star
from plumbline.operators.joins import Lookup, busiest_keys
from plumbline.plans import measures as m
from plumbline.plans import narration, serving
from plumbline.plans.build import BuildResult, run_build
from plumbline.plans.product import Product, Question, open_product
from plumbline.session import prepare
from plumbline.sources.calendar import calendar_between
from plumbline.sources.feeds import FeedSet, read_extracts, snapshot_at, write_extracts
from plumbline.sources.store import TableStore, latest_events
from plumbline.sources.trade import (
    AS_OF,
    CONTRACT,
    MONTH,
    REGION,
    TradeFeeds,
)

QUESTION = Question(REGION, MONTH)
# A cell with categories below their targets.
MONTH_BELOW = "2001-08"
QUESTION_BELOW = Question(REGION, MONTH_BELOW)
REGION_NAME = REGION.title()
WATERMARK = "1999-06-30 00:00:00"
ALLOCATION_FACTOR = "1.015"
VOLUME_FACTOR_STRICT = 2
# Caller patterns that occur in the text tables; explicit classes instead of word boundaries.
CALLER_PATTERNS = {
    "hex token": r'token\s*=\s*"[0-9a-f]{40}"',
    "mail address": r"[0-9A-Za-z_.]+@[0-9A-Za-z_.]+\.[0-9A-Za-z_]+",
    "ip address": r"(^|[^0-9A-Za-z])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+($|[^0-9A-Za-z])",
}
CALLER_LITERALS = {
    "hex token": ("token",),
    "mail address": ("@",),
    "ip address": tuple(f".{digit}" for digit in range(10)),
}
MARKUP_PATTERNS = {
    "script": r"(?i)<script[^>]*>",
    "tracking call": r"track\([0-9]+\)",
    "query link": r"href=\"[^\"]*\?[^\"]*\"",
}
MARKUP_LITERALS = {
    "script": ("<script",),
    "tracking call": ("track(",),
    "query link": ('href="',),
}


def run_id(variant: str) -> str:
    return f"run-20011105T000000Z-{variant}-000000"


class Trade:
    """Lazy frames of one directory and variant, each planned at most once per query."""

    def __init__(self, spark: SparkSession, directory: str, variant: str) -> None:
        self.spark = prepare(spark)
        self.variant = variant
        self.feeds = TradeFeeds(spark, directory, variant)

    @cached_property
    def orders(self) -> DataFrame:
        return self.feeds.orders()

    @cached_property
    def returns(self) -> DataFrame:
        return self.feeds.returns()

    @cached_property
    def latest(self) -> DataFrame:
        return silver.latest_orders(self.orders, CONTRACT)

    @cached_property
    def governed(self) -> DataFrame:
        return silver.governed_orders(self.latest)

    @cached_property
    def reconciled(self) -> DataFrame:
        return silver.reconcile_returns(self.returns, self.latest, self.feeds.hot_order_ids())

    @cached_property
    def references(self) -> dict[str, Lookup]:
        return self.feeds.references

    @cached_property
    def sales(self) -> DataFrame:
        return silver.price_sales(
            self.governed, self.reconciled, self.references["rates"], CONTRACT
        )

    def fact_sales(self, fits: bool | None = None) -> DataFrame:
        """The fact; ``fits`` overrides whether the references are small enough for a broadcast."""
        refs = self.references
        sales = self.sales
        if fits is not None:
            refs = {name: Lookup(ref.frame, fits) for name, ref in refs.items()}
            sales = silver.price_sales(self.governed, self.reconciled, refs["rates"], CONTRACT)
        return star.fact_sales(
            sales, refs["dates"], refs["regions"], refs["categories"], CONTRACT, run_id(self.variant)
        ).drop("sales_month")


# Frames are lazy plans: they are described once per session, and hold no data.
_TRADES: dict[tuple[str, str, str], Trade] = {}


def trade(spark: SparkSession, directory: str, variant: str) -> Trade:
    prepare(spark)
    key = (spark.sparkContext.applicationId, directory, variant)
    if key not in _TRADES:
        _TRADES[key] = Trade(spark, directory, variant)
    return _TRADES[key]


_PUBLISHED: dict[tuple[str, str, str], TableStore] = {}


def build(
    spark: SparkSession,
    directory: str,
    variant: str,
    purpose: str,
    load: Callable[[], FeedSet] | None = None,
) -> tuple[TableStore, BuildResult]:
    """One complete build into the product folder of a directory, variant and purpose.

    The folder is named, not new each time: a later build replaces the run, and older runs go.
    """
    prepare(spark)
    mark = hashlib.md5(directory.encode()).hexdigest()[:12]
    store = TableStore(spark, f"{TableStore(spark).root}-products/{purpose}-{variant}-{mark}")
    result = run_build(
        spark,
        load or trade(spark, directory, variant).feeds.feed_set,
        store,
        CONTRACT,
        variant,
        AS_OF,
        run_id=run_id(variant),
        clock=lambda: datetime.fromisoformat(AS_OF),
        keep_runs=2,
    )
    return store, result


def published(spark: SparkSession, directory: str, variant: str = "repaired") -> Product:
    """The published product of a directory, built once per session."""
    prepare(spark)
    key = (spark.sparkContext.applicationId, directory, variant)
    if key not in _PUBLISHED:
        _PUBLISHED[key] = build(spark, directory, variant, "served")[0]
    return open_product(_PUBLISHED[key], CONTRACT)


# ---------------------------------------------------------------- Silver and Gold


def _repaired(fn: Callable[[Trade], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, directory: fn(trade(spark, directory, "repaired"))


def _broken(fn: Callable[[Trade], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, directory: fn(trade(spark, directory, "broken"))


def _malformed(fn: Callable[[Trade], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, directory: fn(trade(spark, directory, "malformed"))


def _served(
    fn: Callable[[Product], DataFrame], variant: str = "repaired"
) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, directory: fn(published(spark, directory, variant))


# Keys that the *_split queries treat as hot, whatever their share.
FORCED_HOT_KEYS = 40


def order_versions(t: Trade) -> DataFrame:
    return silver.order_versions(t.orders, CONTRACT, t.feeds.hot_order_ids())


def _busiest_orders(t: Trade) -> list[str | None]:
    return [
        None if key is None else str(key)
        for key in busiest_keys(t.feeds.table("lineitem"), "l_orderkey", FORCED_HOT_KEYS)
    ]


def order_versions_split(t: Trade) -> DataFrame:
    """The same ranks with the busiest orders taken through the path for hot keys."""
    return silver.order_versions(t.orders, CONTRACT, _busiest_orders(t))


def returns_reconciled_split(t: Trade) -> DataFrame:
    """The same reconciliation with the busiest orders joined by the path for hot keys."""
    reconciled = silver.reconcile_returns(t.returns, t.latest, _busiest_orders(t))
    return reconciled.drop("source_system", "return_reason")


def orders_latest(t: Trade) -> DataFrame:
    return t.governed.drop("source_system")


def orders_latest_maxby(t: Trade) -> DataFrame:
    latest = silver.latest_orders_by_max(t.orders, CONTRACT)
    return silver.governed_orders(latest).drop("source_system")


def returns_reconciled(t: Trade) -> DataFrame:
    return t.reconciled.drop("source_system", "return_reason")


def return_status_counts(t: Trade) -> DataFrame:
    return t.reconciled.groupBy("reconciliation_status", "quarantine_reason").agg(
        F.count(F.lit(1)).alias("returns")
    )


def quarantine(t: Trade) -> DataFrame:
    return silver.quarantine(t.latest, t.reconciled, run_id(t.variant))


def reconciled_sales(t: Trade) -> DataFrame:
    return t.sales.drop("source_system")


def fact_targets(t: Trade) -> DataFrame:
    refs = t.references
    return star.fact_targets(
        t.feeds.targets(), refs["dates"], refs["regions"], refs["categories"], run_id(t.variant)
    ).drop("approved_by_role", "approved_at_utc", "source_system")


def dimensions(t: Trade) -> DataFrame:
    """Region and category dimensions in one list."""

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.lit(name).alias("dimension"),
            F.col(f"{name}_key").alias("key"),
            F.col(f"{name}_code").alias("code"),
            F.col(f"{name}_name").alias("name"),
        )

    refs = t.references
    return rows(star.dim_region(refs["regions"].frame), "region").unionByName(
        rows(star.dim_category(refs["categories"].frame), "category")
    )


# ---------------------------------------------------------------- checks


def _check(contributions: DataFrame, *names: str) -> DataFrame:
    return quality.total(contributions).filter(F.col("check_name").isin(*names))


def check_freshness(t: Trade) -> DataFrame:
    both = quality.freshness(t.orders, AS_OF, "ORDERS_FRESHNESS").unionByName(
        quality.freshness(t.returns, AS_OF, "RETURNS_FRESHNESS")
    )
    return quality.total(both)


def check_duplicate_keys(t: Trade) -> DataFrame:
    both = quality.sales_checks(t.sales, CONTRACT).unionByName(
        quality.return_checks(t.reconciled, CONTRACT)
    )
    return _check(both, "DUPLICATE_BUSINESS_KEYS")


def check_missing_fx(t: Trade) -> DataFrame:
    return _check(quality.sales_checks(t.sales, CONTRACT), "MISSING_FX")


def check_orphans(t: Trade) -> DataFrame:
    return _check(quality.return_checks(t.reconciled, CONTRACT), "ORPHAN_RETURNS")


def _order_checks(t: Trade) -> DataFrame:
    refs = t.references
    return quality.order_checks(t.latest, refs["regions"], refs["categories"], CONTRACT)


def check_missing_keys(t: Trade) -> DataFrame:
    return _check(_order_checks(t), "MISSING_REQUIRED_KEYS")


def check_currency(t: Trade) -> DataFrame:
    both = _order_checks(t).unionByName(quality.return_checks(t.reconciled, CONTRACT))
    return _check(both, "UNSUPPORTED_CURRENCY")


def check_resolved(t: Trade) -> DataFrame:
    return quality.total(quality.superseded_events(t.orders, t.latest))


def check_quarantined(t: Trade) -> DataFrame:
    both = _order_checks(t).unionByName(quality.return_checks(t.reconciled, CONTRACT))
    return _check(both, "QUARANTINED_ROWS")


def check_return_rate(t: Trade) -> DataFrame:
    return quality.total(quality.return_rate(t.sales))


def check_volume(t: Trade) -> DataFrame:
    return quality.total(quality.volume_anomaly(t.governed, CONTRACT))


def daily_volumes(t: Trade) -> DataFrame:
    mean = F.round(F.col("average_daily_orders").cast("decimal(18,6)"), 4)
    return quality.daily_volumes(t.governed).select(
        "category_code",
        "order_date",
        "daily_orders",
        mean.cast("decimal(18,4)").alias("average_daily_orders"),
    )


def quality_evaluated(t: Trade) -> DataFrame:
    """All checks observed in one plan and judged by the contract."""
    tables = quality.SilverTables(
        bronze_orders=t.orders,
        bronze_returns=t.returns,
        latest_orders=t.latest,
        governed_orders=t.governed,
        returns=t.reconciled,
        sales=t.sales,
        regions=t.references["regions"],
        categories=t.references["categories"],
    )
    judged = quality.evaluate(quality.observe(tables, CONTRACT, AS_OF), CONTRACT)
    return judged.select("check_name", "severity", "observed_value", "threshold", "status", "detail")


def quality_strict(spark: SparkSession, directory: str) -> DataFrame:
    """The stored observations judged again under stricter limits, without a new scan."""
    product = published(spark, directory, "repaired")
    strict = CONTRACT.with_values(max_category_return_rate_pct=2, orders_freshness_sla_minutes=10)
    observed = product.quality_results.select("check_name", "observed_value")
    return quality.evaluate(observed, strict).drop("seq")


# ---------------------------------------------------------------- serving


def health(product: Product) -> DataFrame:
    return serving.platform_health(product)


def pipeline_evidence(product: Product) -> DataFrame:
    return serving.pipeline_evidence(product).drop("duration_ms")


def pipeline_build(spark: SparkSession, directory: str) -> DataFrame:
    """A complete new build; its run record without the measured duration."""
    store, _ = build(spark, directory, "repaired", "rebuilt")
    return open_product(store, CONTRACT).runs.drop("duration_ms")


def pipeline_build_csv(spark: SparkSession, directory: str) -> DataFrame:
    """The same build from CSV extracts of the feeds, malformed records kept apart."""
    prepare(spark)
    mark = hashlib.md5(directory.encode()).hexdigest()[:12]
    extracts = f"{TableStore(spark).root}-extracts/{mark}"
    write_extracts(trade(spark, directory, "repaired").feeds.feed_set(), extracts, "repaired")
    store, _ = build(
        spark,
        directory,
        "repaired",
        "extracted",
        lambda: read_extracts(spark, extracts, "repaired", keep_rejects=True),
    )
    return open_product(store, CONTRACT).runs.drop("duration_ms")


def withheld_fact(product: Product) -> DataFrame:
    return product.fact_sales.drop("sales_month")


def raw_facts(product: Product) -> DataFrame:
    return serving.raw_facts(serving.raw_answer(product, QUESTION))


def raw_categories(product: Product) -> DataFrame:
    return serving.raw_categories(serving.raw_answer(product, QUESTION))


def raw_governance(product: Product) -> DataFrame:
    return serving.raw_governance(raw_facts(product))


def governed_facts(product: Product) -> DataFrame:
    return serving.governed_facts(product, QUESTION)


def outcome_comparison(spark: SparkSession, directory: str) -> DataFrame:
    """Raw answer, refusal while broken, answer when repaired."""
    bad, good = published(spark, directory, "broken"), published(spark, directory)
    return (
        serving.outcome_raw(raw_facts(bad), "raw")
        .unionByName(serving.outcome_governed(bad, QUESTION, "governed, broken feeds"))
        .unionByName(serving.outcome_governed(good, QUESTION, "governed, repaired feeds"))
    )


def comparison_series(product: Product) -> DataFrame:
    return serving.comparison_series(raw_facts(product), governed_facts(product))


def narration_rows(product: Product) -> DataFrame:
    raw = narration.narrate_raw(raw_facts(product), QUESTION, REGION_NAME)
    return raw.unionByName(
        narration.narrate_governed(governed_facts(product), QUESTION, REGION_NAME)
    )


def narration_refused(product: Product) -> DataFrame:
    return narration.narrate_refusal(serving.refusal_message(product))


def money_text(t: Trade) -> DataFrame:
    """Text forms of every category's naive total against its target share."""
    totals = t.orders.groupBy("region_code", "category_code").agg(
        money(F.sum("gross_amount")).alias("total"),
        money(F.sum(F.when(F.col("currency_code") == "USD", -F.col("gross_amount")))).alias("usd"),
    )
    share = (F.lit(100) * F.col("usd") / F.col("total")).cast("decimal(9,2)")
    return totals.select(
        "region_code",
        "category_code",
        cad(F.col("total")).alias("total_text"),
        cad(F.col("usd"), signed=True).alias("usd_text"),
        pct(share).alias("share_text"),
    )


def largest_negative_by_cell(product: Product) -> DataFrame:
    """Region-months with a category below target, and that category."""
    return m.largest_negative_category(product, ["region", "month"], {})


def measures_by_region_month(product: Product) -> DataFrame:
    return m.measures(product, ["region", "month"])


def measures_one_month(product: Product) -> DataFrame:
    """One month by region and category; reads that month of the fact only."""
    return m.measures(product, ["region", "category"], {"month": [MONTH]})


def measures_by_category(product: Product) -> DataFrame:
    return m.measures(product, ["category"], {"region": [REGION]})


# ---------------------------------------------------------------- audits


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return trade(spark, directory, "repaired").feeds.table(name)


def secret_scan(spark: SparkSession, directory: str) -> DataFrame:
    documents = _table(spark, directory, "documents")
    return scans.scan_patterns(
        documents,
        "doc_id",
        "text",
        {**scans.SECRET_PATTERNS, **CALLER_PATTERNS},
        {**scans.SECRET_LITERALS, **CALLER_LITERALS},
    )


def pattern_scan(spark: SparkSession, directory: str) -> DataFrame:
    pages = _table(spark, directory, "pages")
    return scans.scan_patterns(pages, "page_id", "html", MARKUP_PATTERNS, MARKUP_LITERALS)


def grounded_numbers(spark: SparkSession, directory: str) -> DataFrame:
    """Numbers in a page's URL that its HTML does not contain."""
    pages = _table(spark, directory, "pages")
    checked = scans.ungrounded_numbers(pages, "url", "html")
    return checked.select(
        "page_id",
        F.size("ungrounded").cast("bigint").alias("unknown"),
        F.array_join("ungrounded", " ").alias("numbers"),
    )


def table_diff(spark: SparkSession, directory: str) -> DataFrame:
    """Returns of both variants, compared by return id; the delivery time is ignored."""
    left = trade(spark, directory, "broken").returns.drop("ingested_at")
    right = trade(spark, directory, "repaired").returns.drop("ingested_at")
    return audits.table_diff(left, right, ["return_id"])


def row_differences(spark: SparkSession, directory: str) -> DataFrame:
    """Order events of both variants, compared over all columns."""
    left = trade(spark, directory, "broken").orders
    right = trade(spark, directory, "repaired").orders
    return audits.row_differences(left, right)


# The given tables and the number that is summed of each.
MANIFEST = {
    "benchmark": "item_id",
    "conversations": "turn",
    "customer": "c_acctbal",
    "documents": "n_chars",
    "embeddings": "label",
    "events": "value",
    "labels": "quality",
    "lineitem": "l_extendedprice",
    "nation": "n_regionkey",
    "orders": "o_totalprice",
    "pages": "page_id",
    "part": "p_retailprice",
    "region": "r_regionkey",
    "supplier": "s_acctbal",
}


def _manifest(spark: SparkSession, directory: str) -> DataFrame:
    tables = {name: _table(spark, directory, name) for name in MANIFEST}
    return audits.table_manifest(tables, MANIFEST)


def table_manifest(spark: SparkSession, directory: str) -> DataFrame:
    return _manifest(spark, directory).drop("content_hash")


def table_manifest_hash(spark: SparkSession, directory: str) -> DataFrame:
    return _manifest(spark, directory)


def dual_net_check(t: Trade) -> DataFrame:
    return audits.dual_net_check(
        t.sales, t.orders, t.returns, t.references["rates"], CONTRACT
    )


def naive_totals(t: Trade) -> DataFrame:
    return audits.naive_totals(t.orders)


def batch_invariants(t: Trade) -> DataFrame:
    return audits.batch_invariants(
        t.orders,
        t.returns,
        t.latest,
        t.governed,
        t.reconciled,
        t.sales,
        t.references["rates"].frame,
        t.feeds.targets(),
        CONTRACT,
        AS_OF,
        REGION,
        MONTH,
    )


def fx_gap_days(t: Trade) -> DataFrame:
    return audits.rate_gaps(t.governed, t.references["rates"].frame, CONTRACT)


def fx_gap_ranges(t: Trade) -> DataFrame:
    return audits.rate_gap_ranges(t.governed, t.references["rates"].frame, CONTRACT)


def facts_json(product: Product) -> DataFrame:
    """The raw facts with categories and driver, through JSON text and back, a row for each category."""
    raw = serving.raw_answer(product, QUESTION)
    driver = ["driver_code", "driver_name", "driver_variance_cad"]
    facts = narration.with_categories(serving.raw_facts(raw), serving.raw_categories(raw), driver)
    read = narration.read_facts(narration.facts_json(facts, "raw"), facts.schema)
    return read.select(
        "revenue",
        "variance_pct",
        "latest_orders_ingested_at_utc",
        F.col("driver.driver_code").alias("driver_code"),
        F.col("driver.driver_variance_cad").alias("driver_variance_cad"),
        F.inline("categories"),
    )


def health_report(product: Product) -> DataFrame:
    """The typed health report; reasons one below the other."""
    report = serving.health_report(product)
    return report.withColumns({c: F.array_join(c, "\n") for c in ("blocking_reasons", "warning_reasons")})


def run_list(product: Product) -> DataFrame:
    runs = serving.run_list(product).drop("duration_ms")
    return runs.withColumns({c: F.array_join(c, "\n") for c in ("failure_reasons", "warning_reasons")})


def conformance(t: Trade) -> DataFrame:
    return audits.contract_conformance(ORDERS, t.orders, t.references, CONTRACT).unionByName(
        audits.unknown_dates(t.governed, t.references["dates"])
    )


def conformance_returns(t: Trade) -> DataFrame:
    return audits.contract_conformance(
        RETURNS, t.returns, t.references, CONTRACT, {"orders": t.orders}
    )


def conformance_rates(t: Trade) -> DataFrame:
    return audits.contract_conformance(FX_RATES, t.feeds.fx_rates(), t.references, CONTRACT)


def unknown_order_ids(t: Trade) -> DataFrame:
    return audits.unknown_keys(t.returns, "order_id", t.orders, "order_id")


def target_allocation(t: Trade) -> DataFrame:
    net = t.sales.groupBy("region_code", "category_code").agg(
        money(F.sum(F.col("gross_revenue_cad") - F.col("returns_cad"))).alias("net_cad")
    )
    return audits.allocate_targets(net, ALLOCATION_FACTOR)


def feed_at_watermark(t: Trade) -> DataFrame:
    return snapshot_at(t.returns, WATERMARK).select(
        "return_id", "order_id", "return_amount", "source_updated_at", "ingested_at"
    )


def run_history_latest(spark: SparkSession, directory: str) -> DataFrame:
    """Latest event per key over the events table, as the run records are read."""
    events = _table(spark, directory, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return latest_events(
        events, "user_id", ["user_id", "event_id", "ts", "event_type"], ["ts", "event_id"]
    )


def date_dimension_query(spark: SparkSession, directory: str) -> DataFrame:
    """Calendar over the range of order dates."""
    day = F.to_date("o_orderdate")
    return calendar_between(
        _table(spark, directory, "orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    )


def contract_metadata(spark: SparkSession, directory: str) -> DataFrame:
    """Checks of the contract joined to what the published build observed for them."""
    product = published(spark, directory)
    flat = CONTRACT.key_value_frame(spark, MetricContract())
    names = flat.filter(F.col("key").startswith("severity.")).select(
        F.substring_index("key", ".", -1).alias("check_name"), "value"
    )
    return names.join(product.quality_results, "check_name").select(
        "check_name", F.col("value").alias("severity"), "observed_value"
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    question = QUESTION
    return {
        "order_versions": _repaired(order_versions),
        "orders_latest": _repaired(orders_latest),
        "orders_latest_maxby": _repaired(orders_latest_maxby),
        "returns_reconciled_b": _broken(returns_reconciled),
        "return_status_counts_b": _broken(return_status_counts),
        "return_status_counts": _repaired(return_status_counts),
        "quarantine_b": _broken(quarantine),
        "reconciled_sales": _repaired(reconciled_sales),
        "reconciled_sales_b": _broken(reconciled_sales),
        "date_dimension": date_dimension_query,
        "dimensions": _repaired(dimensions),
        "fact_sales": _repaired(Trade.fact_sales),
        "fact_sales_unbroadcast": _repaired(lambda t: t.fact_sales(fits=False)),
        "order_versions_split": _repaired(order_versions_split),
        "returns_reconciled_split": _broken(returns_reconciled_split),
        "measures_one_month": _served(measures_one_month),
        "fact_targets": _repaired(fact_targets),
        "fx_gap_days_b": _broken(fx_gap_days),
        "fx_gap_ranges_b": _broken(fx_gap_ranges),
        "facts_json": _served(facts_json),
        "health_report_b": _served(health_report, "broken"),
        "run_list_b": _served(run_list, "broken"),
        "measures_cube": _served(m.measure_cube),
        "check_freshness_b": _broken(check_freshness),
        "check_duplicate_keys": _repaired(check_duplicate_keys),
        "check_missing_fx_b": _broken(check_missing_fx),
        "check_orphans_b": _broken(check_orphans),
        "check_missing_keys_b": _broken(check_missing_keys),
        "check_currency_b": _broken(check_currency),
        "check_resolved": _repaired(check_resolved),
        "check_quarantined": _repaired(check_quarantined),
        "check_return_rate": _repaired(check_return_rate),
        "check_volume": _repaired(check_volume),
        "daily_volumes": _repaired(daily_volumes),
        "quality_results": _served(serving.quality_results),
        "quality_results_b": _served(serving.quality_results, "broken"),
        "quality_strict": quality_strict,
        "health": _served(health),
        "health_b": _served(health, "broken"),
        "contract_metadata": contract_metadata,
        "pipeline_build": pipeline_build,
        "pipeline_build_csv": pipeline_build_csv,
        "pipeline_evidence_b": _served(pipeline_evidence, "broken"),
        "quarantined_rows": _served(serving.quarantined_rows),
        "withheld_fact_b": _served(withheld_fact, "broken"),
        "published_fact": _served(withheld_fact),
        "raw_answer": _served(lambda p: serving.raw_answer(p, question)),
        "raw_facts": _served(raw_facts),
        "raw_categories": _served(raw_categories),
        "raw_governance": _served(raw_governance),
        "governed_answer": _served(lambda p: serving.governed_answer(p, question)),
        "governed_answer_b": _served(lambda p: serving.governed_answer(p, question), "broken"),
        "governed_facts": _served(governed_facts),
        "category_variance": _served(lambda p: serving.category_variance(p, question)),
        "largest_negative": _served(lambda p: serving.largest_negative(p, question)),
        "largest_negative_by_cell": _served(largest_negative_by_cell),
        "largest_negative_below": _served(lambda p: serving.largest_negative(p, QUESTION_BELOW)),
        "category_variance_below": _served(lambda p: serving.category_variance(p, QUESTION_BELOW)),
        "source_lineage": _served(lambda p: serving.source_lineage(p, question)),
        "lineage_systems": _served(lambda p: serving.lineage_systems(p, question)),
        "governed_or_refusal": _served(lambda p: serving.ask_governed(p, question)),
        "governed_or_refusal_b": _served(lambda p: serving.ask_governed(p, question), "broken"),
        "outcome_comparison": outcome_comparison,
        "comparison_series": _served(comparison_series),
        "run_history_latest": run_history_latest,
        "measures_by_region_month": _served(measures_by_region_month),
        "measures_by_category": _served(measures_by_category),
        "measures_total": _served(m.measures),
        "measures_trusted_b": _served(m.measures, "broken"),
        "narration_rows": _served(narration_rows),
        "narration_refused_b": _served(narration_refused, "broken"),
        "money_text": _repaired(money_text),
        "secret_scan": secret_scan,
        "pattern_scan": pattern_scan,
        "grounded_numbers": grounded_numbers,
        "table_diff": table_diff,
        "row_differences": row_differences,
        "table_manifest": table_manifest,
        "table_manifest_hash": table_manifest_hash,
        "dual_net_check": _repaired(dual_net_check),
        "naive_totals": _repaired(naive_totals),
        "batch_invariants_b": _broken(batch_invariants),
        "conformance_b": _broken(conformance),
        "conformance_c": _malformed(conformance),
        "conformance_returns_b": _broken(conformance_returns),
        "conformance_rates_c": _malformed(conformance_rates),
        "unknown_order_ids_b": _broken(unknown_order_ids),
        "check_duplicate_keys_c": _malformed(check_duplicate_keys),
        "check_missing_keys_c": _malformed(check_missing_keys),
        "quality_evaluated_c": _malformed(quality_evaluated),
        "target_allocation": _repaired(target_allocation),
        "feed_at_watermark": _repaired(feed_at_watermark),
    }
