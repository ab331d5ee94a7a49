"""Table audits: diff, manifest, second-route totals, invariants, coverage, conformance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import FeedContract, HealthContract
from plumbline.functions.columns import age_minutes, code, money, to_cents, utc
from plumbline.operators import silver
from plumbline.operators.joins import Lookup, lookup

LEFT_ONLY, RIGHT_ONLY, CHANGED = "left_only", "right_only", "changed"


# ---------------------------------------------------------------- table diff


def row_differences(left: DataFrame, right: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows whose number of copies differs, with the surplus on each side.

    One aggregate over both tables with map-side sums, so copies are counted before a shuffle.
    """
    columns = [c for c in left.columns if c not in ignore]
    both = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    surplus = both.groupBy(*columns).agg(F.sum("_side").alias("_surplus"))
    zero = F.lit(0).cast("bigint")
    return surplus.filter("_surplus <> 0").select(
        *columns,
        F.greatest("_surplus", zero).alias("left_surplus"),
        F.greatest(-F.col("_surplus"), zero).alias("right_surplus"),
    )


def table_diff(
    left: DataFrame, right: DataFrame, key: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """Status per differing key: only left, only right, or changed."""
    rows = row_differences(left, right, ignore)
    on_left, on_right = F.sum("left_surplus"), F.sum("right_surplus")
    status = (
        F.when((on_left > 0) & (on_right > 0), CHANGED)
        .when(on_left > 0, LEFT_ONLY)
        .otherwise(RIGHT_ONLY)
    )
    return rows.groupBy(*key).agg(
        status.alias("difference"),
        on_left.alias("left_rows"),
        on_right.alias("right_rows"),
    )


def same_rows(left: DataFrame, right: DataFrame, ignore: Sequence[str] = ()) -> bool:
    """Row-for-row equality; looks for one difference only."""
    return row_differences(left, right, ignore).limit(1).count() == 0


# ---------------------------------------------------------------- manifest


# Leading hexadecimal digits of a row's md5 that count in the content hash.
HASH_DIGITS = 15


def value_text(name: str, kind: T.DataType) -> Column:
    """Text form of a value that any engine can make.

    NULL is ``\\N``; fractions are whole millionths, half up; times are microseconds since 1970;
    lists are their values between commas.
    """

    def millionths(value: Column) -> Column:
        return F.floor(value.cast("double") * 1e6 + 0.5).cast("bigint").cast("string")

    column = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        text = millionths(column)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.unix_micros(column.cast("timestamp")).cast("string")
    elif isinstance(kind, T.ArrayType):
        text = F.array_join(F.transform(column, millionths), ",")
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("\\N"))


def row_text(df: DataFrame) -> Column:
    """The values of a row in column order, separated by unit separators."""
    return F.concat_ws("\x1f", *[value_text(f.name, f.dataType) for f in df.schema.fields])


def table_manifest(tables: Mapping[str, DataFrame], sums: Mapping[str, str]) -> DataFrame:
    """Row count, an exact sum and an order-free content hash per table.

    ``sums`` names one numeric column per table; its sum is kept in cents.
    """

    def one(name: str, df: DataFrame) -> DataFrame:
        digest = F.substring(F.md5(row_text(df)), 1, HASH_DIGITS)
        # The decimal holds the sum of more than 10^19 such numbers.
        row_hash = F.conv(digest, 16, 10).cast("decimal(20,0)")
        cents = F.round(F.col(sums[name]).cast("decimal(18,4)") * 100, 0)
        return df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(cents), F.lit(0)).cast("decimal(38,0)").alias("cents"),
            F.coalesce(F.sum(row_hash), F.lit(0)).cast("decimal(38,0)").alias("content_hash"),
        ).select(F.lit(name).alias("table_name"), "rows", "cents", "content_hash")

    return reduce(DataFrame.unionByName, [one(n, df) for n, df in tables.items()])


# ---------------------------------------------------------------- second route


def net_by_second_route(
    orders: DataFrame, returns: DataFrame, rates: Lookup, contract: HealthContract
) -> DataFrame:
    """Net revenue by region and category without the Silver tables.

    Latest events come from an aggregate, and orders and returns of one order id and currency
    meet in one grouping instead of a join.
    """
    latest = silver.latest_orders_by_max(orders, contract).filter(
        F.col("quarantine_reason").isNull()
    )
    priced = lookup(
        latest.withColumn("order_date", F.to_date("order_timestamp_utc")),
        rates.map(silver.base_rates(rates.frame, contract)),
        ["currency_code", "order_date"],
    )
    rate = F.when(
        F.col("currency_code") == contract.reporting_currency, F.lit(1).cast("decimal(10,6)")
    ).otherwise(F.col("rate"))
    head = F.struct("region_code", "category_code", "gross_amount", rate.alias("rate"))
    order_rows = priced.select(
        "order_id",
        "currency_code",
        head.alias("head"),
        F.lit(None).cast("decimal(12,2)").alias("amount"),
    )
    return_rows = (
        silver.latest_returns(returns)
        .filter("return_amount > 0")
        .select(
            "order_id",
            code(F.col("currency_code")).alias("currency_code"),
            F.lit(None).cast(order_rows.schema["head"].dataType).alias("head"),
            F.col("return_amount").alias("amount"),
        )
    )
    # An order meets exactly the returns in its own currency; all of them are summed map-side.
    grouped = (
        order_rows.unionByName(return_rows)
        .filter(F.col("order_id").isNotNull())
        .groupBy("order_id", "currency_code")
        .agg(
            F.max_by("head", F.col("head").isNotNull()).alias("head"),
            F.coalesce(F.sum("amount"), F.lit(0).cast("decimal(22,2)")).alias("returned"),
        )
        .filter(F.col("head").isNotNull())
    )
    net = to_cents(F.col("head.gross_amount"), F.col("head.rate")) - to_cents(
        F.col("returned"), F.col("head.rate")
    )
    return grouped.groupBy(
        F.col("head.region_code").alias("region_code"),
        F.col("head.category_code").alias("category_code"),
    ).agg(money(F.sum(net)).alias("net_second_route_cad"))


def dual_net_check(
    sales: DataFrame,
    orders: DataFrame,
    returns: DataFrame,
    rates: Lookup,
    contract: HealthContract,
) -> DataFrame:
    """Net revenue by region and category from both routes, and whether they agree."""
    first = sales.groupBy("region_code", "category_code").agg(
        money(F.sum(F.col("gross_revenue_cad") - F.col("returns_cad"))).alias("net_cad")
    )
    second = net_by_second_route(orders, returns, rates, contract)
    return first.join(second, ["region_code", "category_code"], "full").withColumn(
        "agree", F.col("net_cad").eqNullSafe(F.col("net_second_route_cad"))
    )


def naive_totals(orders: DataFrame) -> DataFrame:
    """What an ungoverned sum reports: every event, any currency, no returns."""
    return orders.groupBy("region_code", "category_code").agg(
        money(F.sum("gross_amount")).alias("naive_cad")
    )


# ---------------------------------------------------------------- coverage and invariants


def rate_gaps(transactions: DataFrame, rates: DataFrame, contract: HealthContract) -> DataFrame:
    """(date, currency) pairs with accepted-currency transactions but no rate."""
    foreign = [c for c in contract.accepted_currencies if c != contract.reporting_currency]
    used = (
        transactions.filter(F.col("currency_code").isin(foreign))
        .groupBy("order_date", "currency_code")
        .agg(F.count(F.lit(1)).alias("transactions"))
    )
    known = silver.base_rates(rates, contract).select("order_date", "currency_code")
    return used.join(known, ["order_date", "currency_code"], "left_anti")


def rate_gap_ranges(transactions: DataFrame, rates: DataFrame, contract: HealthContract) -> DataFrame:
    """Runs of consecutive days that need a rate and have none: one row for each run and currency.

    Days are numbered after they were added up to one row a day, so a run's size does not depend on
    how many transactions it has.
    """
    days = rate_gaps(transactions, rates, contract)
    number = F.row_number().over(Window.partitionBy("currency_code").orderBy("order_date"))
    # Within a run the date moves with the number, so their difference names the run.
    run = F.date_sub(F.col("order_date"), number)
    return (
        days.withColumn("_run", run)
        .groupBy("currency_code", "_run")
        .agg(
            F.min("order_date").alias("first_day"),
            F.max("order_date").alias("last_day"),
            F.count(F.lit(1)).alias("days"),
            F.sum("transactions").alias("transactions"),
        )
        .drop("_run")
    )


def batch_invariants(
    orders: DataFrame,
    returns: DataFrame,
    latest: DataFrame,
    governed: DataFrame,
    reconciled: DataFrame,
    sales: DataFrame,
    rates: DataFrame,
    targets: DataFrame,
    contract: HealthContract,
    as_of: datetime | str,
    region: str,
    month: str,
) -> DataFrame:
    """Named facts about one batch as (check_name, holds, value) rows."""

    def row(df: DataFrame, name: str, value: Column, holds: Column) -> DataFrame:
        return df.select(
            F.lit(name).alias("check_name"),
            holds.alias("holds"),
            value.cast("decimal(18,2)").alias("value"),
        )

    sla = contract.returns_freshness_sla_minutes
    per_order = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    duplicated = per_order.agg(F.count_if(F.col("n") > 1).alias("n"))
    age = returns.agg(F.max("ingested_at").alias("newest")).select(
        age_minutes(F.col("newest"), utc(as_of)).alias("n")
    )
    orphans = reconciled.agg(
        F.count_if(F.col("reconciliation_status") == silver.ORPHAN).alias("n")
    )
    gaps = rate_gaps(governed, rates, contract).agg(
        F.coalesce(F.sum("transactions"), F.lit(0)).alias("n")
    )
    in_scope = F.date_format("order_timestamp_utc", "yyyy-MM") == month
    zero = F.lit(0).cast("decimal(18,2)")
    naive = orders.filter((F.col("region_code") == region) & in_scope).agg(
        F.coalesce(F.sum("gross_amount"), zero).alias("naive"), F.lit(1).alias("_all")
    )
    goal = targets.filter(
        (F.col("region_code") == region) & (F.col("target_month") == month)
    ).agg(F.coalesce(F.sum("target_cad"), zero).alias("target"), F.lit(1).alias("_all"))
    net = sales.filter(
        (F.col("region_code") == region) & (F.date_format("order_date", "yyyy-MM") == month)
    ).agg(
        F.coalesce(F.sum(F.col("gross_revenue_cad") - F.col("returns_cad")), zero).alias("net"),
        F.lit(1).alias("_all"),
    )
    totals = naive.join(goal, "_all").join(net, "_all")
    return reduce(
        DataFrame.unionByName,
        [
            row(duplicated, "orders_with_replays", F.col("n"), F.col("n") > 0),
            row(
                age,
                "returns_age_within_sla",
                F.col("n"),
                F.coalesce(F.col("n") <= sla, F.lit(False)),
            ),
            row(orphans, "no_orphan_returns", F.col("n"), F.col("n") == 0),
            row(gaps, "every_date_has_a_rate", F.col("n"), F.col("n") == 0),
            row(
                totals,
                "naive_above_target",
                F.col("naive") - F.col("target"),
                F.col("naive") > F.col("target"),
            ),
            row(
                totals,
                "target_above_governed",
                F.col("target") - F.col("net"),
                F.col("target") > F.col("net"),
            ),
        ],
    )


# ---------------------------------------------------------------- conformance


def contract_conformance(
    feed: FeedContract,
    df: DataFrame,
    references: Mapping[str, Lookup],
    contract: HealthContract,
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Violations per rule of a feed contract, all from one pass plus one count for each large key.

    Rules: required columns present, declared types, known references, accepted currencies, and
    (for feeds with one row per key) a unique business key. ``parents`` are feeds too large for a
    lookup; references to them are counted by ``unknown_keys``.
    """
    flagged, rules, parents, large = df, {}, parents or {}, []
    for column in feed.columns:
        if column.required:
            rules[f"required.{column.name}"] = F.col(column.name).isNull()
        actual = df.schema[column.name].dataType
        wanted = feed.schema[column.name].dataType
        if actual != wanted:
            rules[f"type.{column.name}"] = F.lit(True)
        if column.references:
            name, target = column.references.split(".")
            if name in parents:
                lost = unknown_keys(df, column.name, parents[name], target)
                lost = lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("violations"))
                large.append(lost.select(F.lit(f"reference.{column.name}").alias("rule"), "violations"))
                continue
            mark = f"_known_{column.name}"
            known = references[name].frame.select(
                F.col(target).alias(column.name), F.lit(True).alias(mark)
            ).dropDuplicates([column.name])
            flagged = lookup(flagged, references[name].map(known), column.name)
            rules[f"reference.{column.name}"] = (
                F.col(column.name).isNotNull() & F.col(mark).isNull()
            )
        if column.name == "currency_code":
            rules["accepted.currency_code"] = F.col("currency_code").isNotNull() & ~F.col(
                "currency_code"
            ).isin(*contract.accepted_currencies)
    counts = [F.count_if(rule).alias(name) for name, rule in rules.items()]
    pairs = [
        F.struct(F.lit(name).alias("rule"), F.col(f"`{name}`").alias("violations"))
        for name in rules
    ]
    found = flagged.agg(*counts).select(F.inline(F.array(*pairs)))
    found = reduce(DataFrame.unionByName, large, found)
    if not feed.newest_first and feed.business_key:
        per_key = df.groupBy(*feed.business_key).agg(F.count(F.lit(1)).alias("n"))
        unique = per_key.agg(F.count_if(F.col("n") > 1).alias("violations"))
        found = found.unionByName(unique.select(F.lit("unique_key").alias("rule"), "violations"))
    return found.select(F.lit(feed.name).alias("feed"), "rule", "violations")


def unknown_keys(child: DataFrame, key: str, parent: DataFrame, target: str) -> DataFrame:
    """(key, rows): keys of ``child`` that ``parent`` does not hold, with their rows; NULL is no key.

    Both sides shrink to one row per key in the tasks that read them, so a key with any share of the
    rows, known or not, moves as one row a task; what is left for the anti join is keys only.
    """
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.filter(F.col(target).isNotNull()).select(F.col(target).alias(key)).distinct()
    return counted.join(known, key, "left_anti")


def unknown_dates(governed: DataFrame, calendar: Lookup) -> DataFrame:
    """Governed orders outside the calendar, which the sales fact leaves out."""
    days = calendar.frame.select(
        F.col("calendar_date").alias("order_date"), F.lit(True).alias("_day")
    ).dropDuplicates(["order_date"])
    marked = lookup(governed, calendar.map(days), "order_date")
    return marked.agg(F.count_if(F.col("_day").isNull()).alias("violations")).select(
        F.lit("orders").alias("feed"), F.lit("UNKNOWN_DATE").alias("rule"), "violations"
    )


# ---------------------------------------------------------------- targets


def allocate_targets(actual: DataFrame, factor: str = "1.000", step: int = 100) -> DataFrame:
    """Split every region's target over its categories by share of net revenue.

    ``actual`` has one row per region and category. The region target is its total times
    ``factor``, rounded to thousands. Shares are rounded half up to ``step``; the region's first
    category takes the remainder, so the parts always add up.
    """
    region = Window.partitionBy("region_code")
    scaled = F.col("_total") * F.lit(factor).cast("decimal(6,3)")
    whole = F.nullif(F.col("_total").cast("double"), F.lit(0.0))
    part = F.col("_goal").cast("double") * F.col("net_cad").cast("double") / whole / step
    rounded = (F.round(part) * step).cast("decimal(18,2)")
    head_part = F.lit(0).cast("decimal(18,2)")
    rest = F.col("_goal") - F.sum("_part").over(region)
    return (
        actual.withColumn("_total", money(F.sum("net_cad").over(region)))
        .withColumn("_first", F.min("category_code").over(region) == F.col("category_code"))
        .withColumn("_goal", money(F.round(scaled, -3)))
        .withColumn("_part", F.when(F.col("_first"), head_part).otherwise(rounded))
        .select(
            "region_code",
            "category_code",
            money(F.when(F.col("_first"), rest).otherwise(F.col("_part"))).alias("target_cad"),
        )
    )
