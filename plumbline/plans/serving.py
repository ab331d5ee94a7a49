"""Serving queries: the raw answer, and governed answers behind the health gate.

The gate is part of every governed plan: facts are joined to the READY health record of their
own run, so without such a record no figure comes out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.contracts import MetricContract
from plumbline.functions.columns import (
    REASON_SEPARATOR,
    cad,
    money,
    pct,
    percent_of,
    reason_texts,
    sentence_list,
    split_reasons,
)
from plumbline.plans.product import Product, Question

NO_RETURN = "no return"
BEAT, MISSED = "Beat target", "Missed target"
WITHHELD = "withheld"


# ---------------------------------------------------------------- raw path


def raw_answer(product: Product, question: Question) -> DataFrame:
    """Ungoverned sums per category, wrong on purpose.

    Reads landed events with codes as received: replays count twice, currencies are mixed and
    returns are ignored.
    """
    start = F.lit(f"{question.month}-01").cast("timestamp")
    after = F.add_months(start.cast("date"), 1).cast("timestamp")
    # The month names the one folder that is read; the times are those of the question's rule.
    events = product.bronze_orders.filter(
        (F.col("order_month") == question.month)
        & (F.col("region_code") == question.region_code)
        & (F.col("order_timestamp_utc") >= start)
        & (F.col("order_timestamp_utc") < after)
    )
    by_category = events.groupBy("category_code").agg(
        F.count(F.lit(1)).alias("order_rows"),
        F.count_if(F.col("currency_code") != "CAD").alias("non_cad_rows"),
        F.sum("gross_amount").alias("revenue"),
        F.max("ingested_at").alias("latest_ingested_at"),
    )
    names = product.dim_category.select("category_code", "category_name")
    goals = product.bronze_targets.filter(
        (F.col("target_month") == question.month)
        & (F.col("region_code") == question.region_code)
    ).select("category_code", "target_cad")
    # Sums come first, so the joins see one row per category. Repeated category or target rows
    # repeat the category's events, as joining the events themselves would.
    joined = by_category.join(names, "category_code").join(goals, "category_code")
    return (
        joined.groupBy("category_code", "category_name", "target_cad")
        .agg(
            F.sum("order_rows").alias("order_rows"),
            F.sum("non_cad_rows").alias("non_cad_rows"),
            F.sum("revenue").cast("decimal(18,2)").alias("revenue"),
            F.max("latest_ingested_at").alias("latest_ingested_at"),
        )
        .orderBy("category_code")
    )


def raw_facts(raw: DataFrame) -> DataFrame:
    """One row of totals, verdict and driver over the raw category rows."""
    variance = money(F.col("revenue") - F.col("target_cad"))
    rows = raw.withColumn("variance_cad", variance)
    driver = F.struct("category_code", "category_name", "variance_cad")
    totals = rows.agg(
        money(F.sum("revenue")).alias("revenue"),
        money(F.sum("target_cad")).alias("target_cad"),
        F.sum("order_rows").alias("rows_scanned"),
        F.sum("non_cad_rows").alias("non_cad_rows"),
        F.max("latest_ingested_at").alias("latest_orders_ingested_at_utc"),
        F.min_by(driver, F.struct(-F.col("variance_cad"), F.col("category_code"))).alias("best"),
        F.min_by(driver, F.struct(F.col("variance_cad"), F.col("category_code"))).alias("worst"),
        F.count(F.lit(1)).alias("_n"),
    ).filter("_n > 0")
    beat = F.col("revenue") > F.col("target_cad")
    chosen = F.when(beat, F.col("best")).otherwise(F.col("worst"))
    gap = money(F.col("revenue") - F.col("target_cad"))
    return totals.select(
        "revenue",
        "target_cad",
        gap.alias("variance_cad"),
        percent_of(gap, F.col("target_cad"), "decimal(18,2)").alias("variance_pct"),
        beat.alias("beat_target"),
        chosen["category_code"].alias("driver_code"),
        chosen["category_name"].alias("driver_name"),
        chosen["variance_cad"].alias("driver_variance_cad"),
        "rows_scanned",
        "non_cad_rows",
        F.when(F.col("non_cad_rows") > 0, "CAD, USD").otherwise("CAD").alias("currencies_summed"),
        "latest_orders_ingested_at_utc",
    )


def raw_categories(raw: DataFrame) -> DataFrame:
    """Raw categories, largest variance first."""
    variance = money(F.col("revenue") - F.col("target_cad")).alias("variance_cad")
    return raw.select(
        "category_code",
        "category_name",
        F.col("revenue").alias("actual_cad"),
        "target_cad",
        variance,
    ).orderBy(F.desc("variance_cad"), "category_code")


def raw_governance(facts: DataFrame) -> DataFrame:
    """What the raw answer did not do, as (aspect, note) rows. Fixed values."""
    rows = {
        "Approved metric definition": F.lit(
            "none: 'revenue' is whatever SUM(gross_amount) returns"
        ),
        "Currency handling": F.concat(
            F.lit("none: "), F.col("non_cad_rows"), F.lit(" non-CAD rows summed as if CAD")
        ),
        "Deduplication": F.lit("none: raw landing rows read directly"),
        "Returns": F.lit("not consulted"),
        "Freshness check": F.lit("none"),
        "Data-product health gate": F.lit("none"),
        "Lineage / run id": F.lit("none"),
    }
    notes = [F.struct(F.lit(k).alias("aspect"), v.alias("note")) for k, v in rows.items()]
    return facts.select(F.inline(F.array(*notes)))


# ---------------------------------------------------------------- health and evidence


def platform_health(product: Product) -> DataFrame:
    return product.health


def health_report(product: Product) -> DataFrame:
    """The health record with empty counters as 0 and reasons as arrays."""
    counters = (
        "freshness_sla_minutes",
        "duplicate_count",
        "missing_fx_count",
        "orphan_return_count",
        "missing_key_count",
        "unsupported_currency_count",
        "quarantined_rows",
    )
    zero = F.lit(0).cast("bigint")
    return product.health.withColumns(
        {
            **{c: F.coalesce(F.col(c), zero) for c in counters},
            "blocking_reasons": split_reasons(F.col("blocking_reasons")),
            "warning_reasons": split_reasons(F.col("warning_reasons")),
        }
    )


def pipeline_evidence(product: Product) -> DataFrame:
    """All runs, newest first."""
    return product.runs.orderBy(F.desc("started_at_utc"), F.desc("pipeline_run_id"))


def run_list(product: Product) -> DataFrame:
    """Runs with empty counters as 0 and reasons as arrays."""
    counters = (
        "bronze_order_rows",
        "bronze_return_rows",
        "silver_sales_rows",
        "quarantined_rows",
        "duplicate_count",
        "missing_fx_count",
        "orphan_return_count",
        "duration_ms",
    )
    zero = F.lit(0).cast("bigint")
    return pipeline_evidence(product).withColumns(
        {
            **{c: F.coalesce(F.col(c), zero) for c in counters},
            "failure_reasons": split_reasons(F.col("failure_reasons")),
            "warning_reasons": split_reasons(F.col("warning_reasons")),
        }
    )


def quality_results(product: Product) -> DataFrame:
    """Check results of the run behind the current health record, problems first."""
    return (
        product.quality_results.orderBy(
            F.when(F.col("severity") == "BLOCKING", 0).otherwise(1),
            F.when(F.col("status") == "PASS", 1).otherwise(0),
            "check_name",
        )
        .select("check_name", "severity", "status", "observed_value", "threshold", "detail")
    )


def quarantined_rows(product: Product) -> DataFrame:
    return product.quarantine.select(
        "source_entity", "record_key", "quarantine_reason", "source_system", "pipeline_run_id"
    ).orderBy(F.asc_nulls_last("source_entity"), F.asc_nulls_last("record_key"))


# ---------------------------------------------------------------- governed path


def ready_record(product: Product) -> DataFrame:
    """The READY health record, or nothing. At most one row by construction."""
    return product.health.filter(F.col("status") == "READY")


def _region_keys(product: Product, question: Question) -> DataFrame:
    return product.dim_region.filter(F.col("region_code") == question.region_code).select(
        "region_key"
    )


def _month_days(product: Product, question: Question) -> DataFrame:
    return product.dim_date.filter(F.col("year_month") == question.month).select("date_key")


def _sales_cells(product: Product, question: Question) -> DataFrame:
    """Fact rows of the question. The month is a partition filter of the fact."""
    return product.fact_sales.filter(F.col("sales_month") == question.month).join(
        _region_keys(product, question), "region_key", "left_semi"
    )


def _target_cells(product: Product, question: Question) -> DataFrame:
    return product.fact_targets.join(
        _region_keys(product, question), "region_key", "left_semi"
    ).join(_month_days(product, question), "date_key", "left_semi")


def governed_answer(product: Product, question: Question) -> DataFrame:
    """Totals, target, variance and evidence; no row unless READY."""
    ready = ready_record(product).select(
        "status", "pipeline_run_id", "last_successful_refresh_utc", "data_contract_version"
    )
    actual = (
        _sales_cells(product, question)
        .groupBy("pipeline_run_id")
        .agg(
            money(F.sum("net_revenue_cad")).alias("net_revenue_cad"),
            money(F.sum("gross_revenue_cad")).alias("gross_revenue_cad"),
            money(F.sum("returns_cad")).alias("returns_cad"),
            F.count(F.lit(1)).alias("governed_orders"),
        )
    )
    target = (
        _target_cells(product, question)
        .groupBy("pipeline_run_id")
        .agg(money(F.sum("target_cad")).alias("target_cad"))
    )
    gap = money(F.col("net_revenue_cad") - F.col("target_cad"))
    return (
        ready.join(actual, "pipeline_run_id", "left")
        .join(target, "pipeline_run_id", "left")
        .select(
            "net_revenue_cad",
            "gross_revenue_cad",
            "returns_cad",
            "target_cad",
            gap.alias("variance_cad"),
            percent_of(gap, F.col("target_cad")).alias("variance_pct"),
            F.coalesce("governed_orders", F.lit(0).cast("bigint")).alias("governed_orders"),
            "status",
            "pipeline_run_id",
            "last_successful_refresh_utc",
            "data_contract_version",
        )
    )


def category_variance(product: Product, question: Question) -> DataFrame:
    """Categories with a target, most negative variance first; no rows unless READY."""
    ready = ready_record(product).select("pipeline_run_id")
    actual = (
        _sales_cells(product, question)
        .groupBy("category_key")
        .agg(money(F.sum("net_revenue_cad")).alias("net_revenue_cad"))
    )
    target = (
        _target_cells(product, question)
        .join(F.broadcast(ready), "pipeline_run_id", "left_semi")
        .groupBy("category_key")
        .agg(money(F.sum("target_cad")).alias("target_cad"))
    )
    names = product.dim_category.select("category_key", "category_code", "category_name")
    net = F.coalesce("net_revenue_cad", F.lit(0).cast("decimal(18,2)"))
    return (
        target.join(names, "category_key")
        .join(actual, "category_key", "left")
        .select(
            "category_code",
            "category_name",
            net.alias("net_revenue_cad"),
            "target_cad",
            money(net - F.col("target_cad")).alias("variance_cad"),
        )
        .orderBy(F.asc_nulls_last("variance_cad"), "category_code")
    )


def largest_negative(product: Product, question: Question) -> DataFrame:
    """The category furthest below its target; no row if none is below."""
    return category_variance(product, question).filter("variance_cad < 0").limit(1)


def source_lineage(product: Product, question: Question) -> DataFrame:
    """Source systems behind the answer's fact rows."""
    returns = F.coalesce("returns_source_system", F.lit(NO_RETURN))
    return (
        _sales_cells(product, question)
        .groupBy(
            "order_source_system", returns.alias("returns_source_system"), "fx_source_system"
        )
        .agg(
            F.count(F.lit(1)).alias("fact_rows"),
            F.min("pipeline_run_id").alias("pipeline_run_id"),
        )
        .orderBy(
            F.desc("fact_rows"),
            "order_source_system",
            "returns_source_system",
            "fx_source_system",
        )
    )


def lineage_systems(product: Product, question: Question) -> DataFrame:
    """Distinct contributing systems in name order, placeholders left out."""
    systems = F.array("order_source_system", "returns_source_system", "fx_source_system")
    system = F.col("source_system")
    return (
        source_lineage(product, question)
        .select(F.explode(systems).alias("source_system"))
        .filter((system != NO_RETURN) & ~system.startswith("none ("))
        .distinct()
        .orderBy("source_system")
    )


def governed_facts(
    product: Product, question: Question, metric: MetricContract = MetricContract()
) -> DataFrame:
    """The whole governed answer in one row, from one scan of the fact.

    Sales are aggregated to (category, sources) cells first. Totals cover all cells; the
    categories are those with a target. No row unless READY.
    """
    ready = ready_record(product).select(
        "status", "pipeline_run_id", "last_successful_refresh_utc", "data_contract_version"
    )
    systems = F.array_compact(
        F.array("order_source_system", "returns_source_system", "fx_source_system")
    )
    actual = (
        _sales_cells(product, question)
        .groupBy(
            "pipeline_run_id",
            "category_key",
            "order_source_system",
            "returns_source_system",
            "fx_source_system",
        )
        .agg(
            F.sum("net_revenue_cad").alias("net"),
            F.sum("gross_revenue_cad").alias("gross"),
            F.sum("returns_cad").alias("returned"),
            F.count(F.lit(1)).alias("orders"),
        )
        .groupBy("pipeline_run_id", "category_key")
        .agg(
            F.sum("net").alias("net"),
            F.sum("gross").alias("gross"),
            F.sum("returned").alias("returned"),
            F.sum("orders").alias("orders"),
            F.flatten(F.collect_set(systems)).alias("systems"),
        )
    )
    target = (
        _target_cells(product, question)
        .groupBy("pipeline_run_id", "category_key")
        .agg(F.sum("target_cad").alias("target"))
    )
    names = product.dim_category.select("category_key", "category_code", "category_name")
    scored = (
        actual.join(target, ["pipeline_run_id", "category_key"], "full")
        .join(names, "category_key", "left")
        .withColumn(
            "gap", money(F.coalesce("net", F.lit(0).cast("decimal(18,2)")) - F.col("target"))
        )
    )
    below = F.col("gap") < 0
    worst = F.min_by(
        F.when(below, F.struct("category_code", "category_name", F.col("gap"))),
        F.when(below, F.struct("gap", "category_code")),
    )
    totals = scored.groupBy("pipeline_run_id").agg(
        money(F.sum("net")).alias("net_revenue_cad"),
        money(F.sum("gross")).alias("gross_revenue_cad"),
        money(F.sum("returned")).alias("returns_cad"),
        money(F.sum("target")).alias("target_cad"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("governed_orders"),
        F.count("target").alias("category_count"),
        worst.alias("worst"),
        # A few systems per category.
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("systems")))).alias("systems"),
    )
    gap = money(F.col("net_revenue_cad") - F.col("target_cad"))
    real = F.filter("systems", lambda s: ~s.startswith("none ("))
    return ready.join(totals, "pipeline_run_id", "left").select(
        "net_revenue_cad",
        "gross_revenue_cad",
        "returns_cad",
        "target_cad",
        gap.alias("variance_cad"),
        percent_of(gap, F.col("target_cad")).alias("variance_pct"),
        (F.col("net_revenue_cad") > F.col("target_cad")).alias("beat_target"),
        F.coalesce("governed_orders", F.lit(0).cast("bigint")).alias("governed_orders"),
        F.coalesce("category_count", F.lit(0).cast("bigint")).alias("category_count"),
        F.col("worst.category_code").alias("worst_code"),
        F.col("worst.category_name").alias("worst_name"),
        F.col("worst.gap").alias("worst_variance_cad"),
        F.array_join(real, REASON_SEPARATOR).alias("source_lineage"),
        F.lit(metric.metric).alias("metric_name"),
        F.lit(metric.display_name).alias("metric_display_name"),
        F.lit(metric.definition).alias("metric_definition"),
        F.lit(metric.version).alias("metric_version"),
        "status",
        "pipeline_run_id",
        "last_successful_refresh_utc",
        "data_contract_version",
    )


# ---------------------------------------------------------------- refusal


def refusal_message(product: Product, extra: Column | None = None) -> DataFrame:
    """One refusal row with its reasons, also when no health record exists."""
    known = product.health.select(
        "data_product", "status", "pipeline_run_id", "blocking_reasons", "warning_reasons"
    )
    missing = "NO_HEALTH_RECORD: no data-product health record exists"
    if product.status is None:
        known = product.health.sparkSession.createDataFrame(
            [(product.name, "UNKNOWN", "none", missing, "")], known.schema
        )
    reasons = reason_texts(split_reasons(F.col("blocking_reasons")))
    if extra is not None:
        reasons = F.concat(reasons, F.array_compact(F.array(extra)))
    fallback = F.array(
        F.concat(F.lit("the data product status is "), F.col("status"), F.lit(", not READY"))
    )
    found = reason_texts(split_reasons(F.col("warning_reasons")))
    message = F.concat(
        F.lit("I cannot provide a reliable answer because "),
        sentence_list(F.col("reasons")),
        F.lit(". Data product "),
        F.col("data_product"),
        F.lit(" is "),
        F.col("status"),
        F.lit("; no business figure is served until every blocking check passes."),
        F.when(
            F.size("found") > 0,
            F.concat(F.lit(" Non-blocking findings: "), sentence_list(F.col("found")), F.lit(".")),
        ).otherwise(""),
    )
    return (
        known.withColumn("reasons", reasons)
        .withColumn("reasons", F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(fallback))
        .withColumn("found", found)
        .select("data_product", "status", "pipeline_run_id", "reasons", message.alias("message"))
    )


NOT_SERVED = "the governed query returned no READY rows"


def ask_governed(product: Product, question: Question) -> DataFrame:
    """One row: the governed figures, or a refusal with its reasons.

    A product that is not READY is refused from the health record alone. A READY product
    without figures for the question is refused with that reason.
    """
    figures = ("net_revenue_cad", "target_cad", "variance_cad")
    if product.status != "READY":
        return refusal_message(product).select(
            F.lit("REFUSAL").alias("kind"),
            "status",
            "pipeline_run_id",
            F.size("reasons").cast("bigint").alias("reason_count"),
            "message",
            *[F.lit(None).cast("decimal(18,2)").alias(c) for c in figures],
        )
    refusal = refusal_message(product, F.lit(NOT_SERVED)).select(
        "pipeline_run_id", "reasons", F.col("message").alias("refusal")
    )
    served = F.col("net_revenue_cad").isNotNull()
    return (
        governed_answer(product, question)
        .join(refusal, "pipeline_run_id")
        .select(
            F.when(served, "ANSWER").otherwise("REFUSAL").alias("kind"),
            "status",
            "pipeline_run_id",
            F.when(served, 0).otherwise(F.size("reasons")).cast("bigint").alias("reason_count"),
            F.when(~served, F.col("refusal")).alias("message"),
            *[F.when(served, F.col(c)).alias(c) for c in figures],
        )
    )


# ---------------------------------------------------------------- comparison


def _change(amount: Column, percent: Column) -> Column:
    return F.concat(cad(amount, signed=True), F.lit(" ("), pct(percent), F.lit(")"))


def outcome_raw(facts: DataFrame, label: str) -> DataFrame:
    return facts.select(
        F.lit(label).alias("path"),
        F.when(F.col("beat_target"), BEAT).otherwise(MISSED).alias("answer"),
        cad(F.col("revenue")).alias("figure"),
        _change(F.col("variance_cad"), F.col("variance_pct")).alias("variance"),
        F.concat("driver_name", F.lit(" (driver)")).alias("category"),
        F.lit("none").alias("evidence"),
    )


def outcome_governed(product: Product, question: Question, label: str) -> DataFrame:
    if product.status != "READY":
        return refusal_message(product).select(
            F.lit(label).alias("path"),
            F.lit("Refused").alias("answer"),
            *[F.lit(WITHHELD).alias(c) for c in ("figure", "variance", "category")],
            F.concat_ws(" · ", "status", "pipeline_run_id").alias("evidence"),
        )
    worst = F.concat("worst_name", F.lit(" (largest negative)"))
    return (
        governed_facts(product, question)
        .filter(F.col("net_revenue_cad").isNotNull())
        .select(
            F.lit(label).alias("path"),
            F.when(F.col("beat_target"), BEAT).otherwise(MISSED).alias("answer"),
            cad(F.col("net_revenue_cad")).alias("figure"),
            _change(F.col("variance_cad"), F.col("variance_pct")).alias("variance"),
            F.coalesce(worst, F.lit("none")).alias("category"),
            F.concat_ws(" · ", "status", "pipeline_run_id").alias("evidence"),
        )
    )


def comparison_series(raw: DataFrame, governed: DataFrame) -> DataFrame:
    """Raw, target and governed figures as (measure, cad) rows.

    The governed figure is missing unless the product is READY.
    """

    def point(name: str, column: str) -> Column:
        return F.struct(F.lit(name).alias("measure"), F.col(column).alias("cad"))

    points = F.array(point("Naive raw revenue", "revenue"), point("Target", "target_cad"))
    first = raw.select(F.inline(points))
    last = governed.filter(F.col("net_revenue_cad").isNotNull()).select(
        F.lit("Governed net revenue").alias("measure"), F.col("net_revenue_cad").alias("cad")
    )
    return first.unionByName(last)
