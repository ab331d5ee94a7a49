"""Sentences and JSON facts over answers that are already computed. No figure is derived here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import cad, format_utc, pct
from plumbline.plans.product import Question

# Labels of the two kinds of text.
TEMPLATE_LABEL = "Deterministic conference fallback — no live LLM"
REFUSAL_LABEL = "Deterministic refusal — enforced in data-access code; no model consulted"


def _verdict(region: Column) -> Column:
    beat = F.concat(F.lit("Yes. "), region, F.lit(" beat"))
    missed = F.concat(F.lit("No. "), region, F.lit(" missed"))
    return F.when(F.col("beat_target"), beat).otherwise(missed)


def _month(question: Question) -> Column:
    return F.date_format(F.lit(f"{question.month}-01").cast("date"), "MMMM yyyy")


def _against_target(actual: str) -> list[Column]:
    return [
        cad(F.col(actual)),
        F.lit(" against a target of "),
        cad(F.col("target_cad")),
        F.lit(", a variance of "),
        cad(F.col("variance_cad"), signed=True),
        F.lit(" ("),
        pct(F.col("variance_pct")),
        F.lit("). "),
    ]


def narrate_raw(facts: DataFrame, question: Question, region_name: str) -> DataFrame:
    text = F.concat(
        _verdict(F.lit(region_name)),
        F.lit(" its "),
        _month(question),
        F.lit(" revenue target: revenue was "),
        *_against_target("revenue"),
        F.col("driver_name"),
        F.lit(" drove the result, finishing "),
        cad(F.col("driver_variance_cad"), signed=True),
        F.lit(" versus its category target."),
    )
    return facts.select(
        F.lit("raw").alias("path"), text.alias("text"), F.lit(TEMPLATE_LABEL).alias("label")
    )


def narrate_governed(facts: DataFrame, question: Question, region_name: str) -> DataFrame:
    worst = F.concat(
        F.col("worst_name"),
        F.lit(" was the largest negative contributor at "),
        cad(F.col("worst_variance_cad"), signed=True),
        F.lit(" versus its category target. "),
    )
    text = F.concat(
        _verdict(F.lit(region_name)),
        F.lit(" its "),
        _month(question),
        F.lit(" target. "),
        F.col("metric_display_name"),
        F.lit(" was "),
        *_against_target("net_revenue_cad"),
        F.coalesce(worst, F.lit("No category finished below its target. ")),
        F.lit("Evidence: pipeline run "),
        F.col("pipeline_run_id"),
        F.lit(", refreshed "),
        format_utc(F.col("last_successful_refresh_utc")),
        F.lit(", data contract "),
        F.col("data_contract_version"),
        F.lit(", status "),
        F.col("status"),
        F.lit("."),
    )
    return facts.filter(F.col("net_revenue_cad").isNotNull()).select(
        F.lit("governed").alias("path"), text.alias("text"), F.lit(TEMPLATE_LABEL).alias("label")
    )


def narrate_refusal(refusal: DataFrame) -> DataFrame:
    """A refusal is told in its own words."""
    return refusal.select(
        F.lit("governed").alias("path"),
        F.col("message").alias("text"),
        F.lit(REFUSAL_LABEL).alias("label"),
    )


def _told(column: Column, kind: T.DataType) -> Column:
    """A value as it stands in JSON: decimals as text, times in ISO form, structures field by field."""
    if isinstance(kind, T.StructType):
        return F.struct(*[_told(column[f.name], f.dataType).alias(f.name) for f in kind])
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _told(x, kind.elementType))
    if isinstance(kind, T.DecimalType):
        return column.cast("string")
    if isinstance(kind, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return column


def facts_json(facts: DataFrame, path: str) -> DataFrame:
    """Every fact of a row as JSON text: nested ones nested, empty ones kept."""
    shown = [_told(F.col(f.name), f.dataType).alias(f.name) for f in facts.schema]
    shown.append(F.lit(path).alias("answer_path"))
    return facts.select(
        F.to_json(F.struct(*shown), {"ignoreNullFields": "false"}).alias("facts")
    )


def with_categories(facts: DataFrame, categories: DataFrame, driver: Sequence[str]) -> DataFrame:
    """The facts' one row with its categories as an array and its driver as a structure.

    ``driver`` names the facts' columns that move into the structure. A question has at most one row
    for each category of the dimension.
    """
    row = F.struct(*categories.columns)
    listed = categories.agg(F.array_sort(F.collect_list(row)).alias("categories"))
    rest = [c for c in facts.columns if c not in driver]
    nested = facts.select(*rest, F.struct(*driver).alias("driver"))
    return nested.crossJoin(F.broadcast(listed))  # one row beside one row


def read_facts(told: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON facts back as typed columns, nested ones included."""
    return told.select(F.from_json("facts", schema).alias("f")).select("f.*")


