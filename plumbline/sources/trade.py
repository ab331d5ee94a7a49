"""The product's feeds as views over a trade schema (lineitem, orders, customer, part, ...).

Lines that were not returned are order events (one order is replayed once per line), returned
lines are the returns feed. Three variants exist: ``broken`` (stale returns, rate gaps, an
unaccepted currency, orphan returns), ``malformed`` (events without an order id, a region that no
reference knows, days with two rates, orphan returns) and ``repaired``.
"""

from __future__ import annotations

from functools import cached_property
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.contracts import (
    CALENDAR,
    CATEGORIES,
    FX_RATES,
    ORDERS,
    REGIONS,
    RETURNS,
    TARGETS,
    HealthContract,
)
from plumbline.functions.columns import utc
from plumbline.operators.joins import (
    HASHED_ROWS,
    LOOKUP_ROW_LIMIT,
    Lookup,
    hot_keys,
    join_unique,
    lookup,
)
from plumbline.sources.calendar import calendar_between
from plumbline.sources.feeds import FeedSet, stamp_lineage

AS_OF = "2001-11-05 00:00:00"
REGION = "AMERICA"
MONTH = "1998-05"
ORDERS_AGE_MINUTES = 30
RETURNS_AGE_MINUTES = {"broken": 3600, "malformed": 45, "repaired": 45}
MISSING_RATE_DAYS = (20, 21)
# Of the malformed variant: a day of every month with two rates, a nation whose region is unknown, and
# which order ids are lost on their first lines.
TWICE_RATED_DAY = 10
UNKNOWN_REGION, UNKNOWN_NATION = "ATLANTIS", 7
LOST_ID_EVERY = 50
# Lines of one part of orders that are dealt out by their id: what a task sorts in memory at most, and
# what is worth a task (and files of its own for every month).
LINES_PER_PART, LEAST_LINES_PER_PART = 1_000_000, 100_000

# Contract values of the trade variant; all other values are the defaults.
CONTRACT = HealthContract(test_segment="MACHINERY", invalid_amount_at_or_below="1000")

# Skewed keys of a directory, measured once per session. They steer joins, not results.
_HOT: dict[tuple[str, str], dict[str, list[Any]]] = {}
# Schemas read from the parquet footers, once per session.
_SCHEMAS: dict[tuple[str, str], StructType] = {}


def _currency(nation: Column, variant: str) -> Column:
    third = "EUR" if variant == "broken" else "USD"
    slot = nation % 4
    return (
        F.when(slot == 2, F.lit("USD")).when(slot == 3, F.lit(third)).otherwise(F.lit("CAD"))
    )


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


class TradeFeeds:
    def __init__(self, spark: SparkSession, directory: str, variant: str = "repaired") -> None:
        if variant not in RETURNS_AGE_MINUTES:
            raise ValueError(f"variant must be broken, malformed or repaired, not {variant!r}")
        self.spark = spark
        self.directory = directory.rstrip("/")
        self.variant = variant
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._open(name)
        return self._frames[name]

    def _open(self, name: str) -> DataFrame:
        path = f"{self.directory}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[key]).parquet(path)

    def hot(self, column: str) -> list[Any]:
        """Hot keys of a foreign key column of lineitem or orders."""
        key = (self.spark.sparkContext.applicationId, self.directory)
        if key not in _HOT:
            lines = ("l_orderkey", "l_partkey", "l_suppkey")
            _HOT[key] = {
                **hot_keys(self.table("lineitem"), *lines),
                **hot_keys(self.table("orders"), "o_custkey"),
            }
        return _HOT[key][column]

    def hot_order_ids(self) -> list[str | None]:
        """The same keys in the order_id form of the feeds."""
        keys = [None if v is None else str(v) for v in self.hot("l_orderkey")]
        # Lost ids are one key, whatever the order keys are.
        return [*keys, None] if self.variant == "malformed" and None not in keys else keys

    # ---------------------------------------------------------------- reference data

    @cached_property
    def references(self) -> dict[str, Lookup]:
        """Reference frames with checked sizes."""
        counted = {
            "dates": self.calendar(),
            "rates": self.fx_rates(),
            "nations": self._nations(),
            "regions": self.regions(),
            "categories": self.categories(),
        }
        sizes = Lookup.sizes(counted)
        return {
            name: Lookup(df, sizes[name] <= LOOKUP_ROW_LIMIT) for name, df in counted.items()
        }

    def _nations(self) -> DataFrame:
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region_code"))
        )

    def days(self) -> DataFrame:
        """Every day of the whole months from the first to the last order."""
        day = F.to_date("o_orderdate")
        bounds = self.table("orders").agg(
            F.trunc(F.min(day), "month").alias("first"), F.last_day(F.max(day)).alias("last")
        )
        return calendar_between(bounds)

    def calendar(self) -> DataFrame:
        return stamp_lineage(self.days(), CALENDAR, "calendar")

    def regions(self) -> DataFrame:
        region = self.table("region").select(
            F.col("r_regionkey").alias("region_key"),
            F.col("r_name").alias("region_code"),
            F.initcap("r_name").alias("region_name"),
            F.col("r_name").alias("country_code"),
        )
        return stamp_lineage(region, REGIONS, "region")

    def categories(self) -> DataFrame:
        """Distinct part types numbered in name order."""
        types = self.table("part").select(F.col("p_type").alias("category_code")).distinct()
        # The distinct type names are a short list; one window numbers them.
        number = F.row_number().over(Window.orderBy("category_code"))
        category = types.select(
            number.alias("category_key"),
            "category_code",
            F.initcap("category_code").alias("category_name"),
        )
        return stamp_lineage(category, CATEGORIES, "part")

    def fx_rates(self) -> DataFrame:
        """One made-up USD rate per calendar day, a function of the day of the year."""
        days = self.days()
        if self.variant == "broken":
            days = days.filter(~F.col("day_of_month").isin(*MISSING_RATE_DAYS))
        step = (F.dayofyear("calendar_date") * 13) % 80
        if self.variant == "malformed":
            twice = F.when(F.col("day_of_month") == TWICE_RATED_DAY, F.array(F.lit(0), F.lit(10)))
            days = days.withColumn("_more", F.explode(F.coalesce(twice, F.array(F.lit(0)))))
            step = step + F.col("_more")
        rates = days.select(
            F.col("calendar_date").alias("rate_date"),
            F.lit("USD").alias("from_currency"),
            F.lit("CAD").alias("to_currency"),
            (F.lit("1.300000").cast("decimal(10,6)") + step.cast("decimal(4,0)") / F.lit(1000))
            .cast("decimal(10,6)")
            .alias("rate"),
            F.col("calendar_date").cast("timestamp").alias("published_at_utc"),
            utc(AS_OF).alias("ingested_at"),
        )
        return stamp_lineage(rates, FX_RATES, "fx_rates")

    def targets(self) -> DataFrame:
        months = (
            self.days()
            .filter("day_of_month = 1")
            .select(F.col("year_month").alias("target_month"))
        )
        # Months x regions x categories: every factor is a small reference list.
        refs = self.references
        grid = months.withColumn("_all", F.lit(1))
        for name, keep in (("regions", "region"), ("categories", "category")):
            side = refs[name].frame.select(
                f"{keep}_key", f"{keep}_code", F.lit(1).alias("_all")
            )
            grid = lookup(grid, refs[name].map(side), "_all", "inner")
        amount = 10000 + 500 * F.col("region_key") + 100 * F.col("category_key")
        return grid.select(
            "target_month",
            "region_code",
            "category_code",
            amount.cast("decimal(18,2)").alias("target_cad"),
            F.lit("Finance").alias("approved_by_role"),
            utc("1994-12-15 14:00:00").alias("approved_at_utc"),
            F.lit(TARGETS.source_system).alias("source_system"),
            F.lit("targets").alias("source_file"),
        )

    # ---------------------------------------------------------------- transactions

    def parts_by_id(self) -> int | None:
        """Into how many parts a build deals orders out by their id; none if an id has a large share.

        It divides the session's number of shuffle partitions, so a part holds whole buckets of the
        tables that are stored in as many.
        """
        if self.variant == "malformed" or self.hot_order_ids():
            return None
        most = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        lines, cores = self.table("lineitem").count(), self.spark.sparkContext.defaultParallelism
        least = max(2, min(cores, lines // LEAST_LINES_PER_PART), -(-lines // LINES_PER_PART))
        return next((n for n in range(least, most) if most % n == 0), most)

    def orders(self, dealt: int | None = None) -> DataFrame:
        """Order events; with ``dealt`` in so many parts by the order id, which no other join undoes."""
        customers = lookup(
            self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
            self.references["nations"],
            "c_nationkey",
            "inner",
        ).withColumnRenamed("c_custkey", "o_custkey")
        headers = join_unique(
            self.table("orders").select(
                "o_orderkey", "o_custkey", "o_orderdate"
            ),
            customers,
            "o_custkey",
            "inner",
            self.hot("o_custkey"),
        ).withColumnRenamed("o_orderkey", "l_orderkey")
        lines = (
            self.table("lineitem")
            .filter(F.col("l_returnflag") != "R")
            .select(
                "l_orderkey",
                "l_linenumber",
                "l_partkey",
                "l_suppkey",
                "l_linestatus",
                "l_extendedprice",
                "l_shipdate",
            )
        )
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
        event_id = F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"
        )
        typed = join_unique(lines, parts, "l_partkey", "inner", self.hot("l_partkey"))
        if dealt:
            # Both sides are dealt out by the id as it is stored, so the join keeps that layout.
            by_id = F.col("l_orderkey").cast("string")
            left = typed.withColumn("order_id", by_id).repartition(dealt, "order_id")
            # Texts are made behind the shuffle. Without an expression between them, the planner puts a
            # shuffle of its own number of partitions in the place of this one.
            left = left.withColumn("event_id", event_id)
            right = headers.select(by_id.alias("order_id"), *headers.columns).drop("l_orderkey")
            right = right.repartition(dealt, "order_id")
            if self.table("orders").count() <= HASHED_ROWS * dealt:
                right = right.hint("shuffle_hash")
            events = left.join(right, "order_id")
            order_id = F.col("order_id")
        else:
            events = join_unique(typed, headers, "l_orderkey", "inner", self.hot("l_orderkey"))
            events = events.withColumn("event_id", event_id)
            order_id = F.col("l_orderkey").cast("string")
        region = F.col("region_code")
        if self.variant == "malformed":
            lost = (F.col("l_linenumber") == 1) & (F.col("l_orderkey") % LOST_ID_EVERY == 0)
            order_id = F.when(~lost, order_id)
            region = F.when(F.col("c_nationkey") == UNKNOWN_NATION, UNKNOWN_REGION).otherwise(region)
        feed = events.select(
            order_id.alias("order_id"),
            "event_id",
            F.col("l_linenumber").alias("event_version"),
            F.col("o_orderdate").cast("timestamp").alias("order_timestamp_utc"),
            region.alias("region_code"),
            F.col("p_type").alias("category_code"),
            _currency(F.col("c_nationkey"), self.variant).alias("currency_code"),
            _money("l_extendedprice").alias("gross_amount"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.col("l_shipdate").cast("timestamp").alias("source_updated_at"),
            (utc(AS_OF) - F.expr(f"INTERVAL {ORDERS_AGE_MINUTES} MINUTES")).alias("ingested_at"),
        )
        return stamp_lineage(feed, ORDERS, "lineitem")

    def returns(self) -> DataFrame:
        lines = (
            self.table("lineitem")
            .filter(F.col("l_returnflag") == "R")
            .select(
                "l_orderkey",
                "l_linenumber",
                "l_partkey",
                "l_suppkey",
                "l_extendedprice",
                "l_discount",
                "l_shipdate",
            )
        )
        if self.variant == "repaired":
            # Orders that exist in the orders feed.
            known = (
                self.table("lineitem")
                .filter(F.col("l_returnflag") != "R")
                .select("l_orderkey")
                .distinct()
            )
            lines = join_unique(lines, known, "l_orderkey", "semi", self.hot("l_orderkey"))
        suppliers = self.table("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
        )
        rows = join_unique(lines, suppliers, "l_suppkey", "inner", self.hot("l_suppkey"))
        amount = F.round(_money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)"), 2)
        age = RETURNS_AGE_MINUTES[self.variant]
        part = F.lpad(F.col("l_partkey").cast("string"), 20, "0")
        supplier = F.lpad(F.col("l_suppkey").cast("string"), 20, "0")
        feed = rows.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("return_id"),
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_shipdate").cast("timestamp").alias("return_timestamp_utc"),
            amount.cast("decimal(12,2)").alias("return_amount"),
            _currency(F.col("s_nationkey"), self.variant).alias("currency_code"),
            F.concat_ws("/", part, supplier).alias("return_reason"),
            F.col("l_shipdate").cast("timestamp").alias("source_updated_at"),
            (utc(AS_OF) - F.expr(f"INTERVAL {age} MINUTES")).alias("ingested_at"),
        )
        return stamp_lineage(feed, RETURNS, "lineitem")

    @cached_property
    def _feed_set(self) -> FeedSet:
        dealt = self.parts_by_id()
        return FeedSet(
            dealt=dealt,
            orders=self.orders(dealt),
            returns=self.returns(),
            fx_rates=self.references["rates"].frame,
            targets=self.targets(),
            regions=self.references["regions"].frame,
            categories=self.references["categories"].frame,
            calendar=self.references["dates"].frame,
        )

    def feed_set(self) -> FeedSet:
        return self._feed_set
