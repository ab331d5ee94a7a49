"""Semantic measures over the star at any grain.

The grain is a subset of region, month, category and day; filters restrict the dimensions. Both
facts are aggregated on their own and meet on the group keys, so neither multiplies the other.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import money
from plumbline.plans.product import Product

# Grain name -> (dimension, its key, the shown column)
GRAINS = {
    "region": ("dim_region", "region_key", "region_code"),
    "month": ("dim_date", "date_key", "year_month"),
    "day": ("dim_date", "date_key", "calendar_date"),
    "category": ("dim_category", "category_key", "category_code"),
}


def _with_labels(
    fact: DataFrame, product: Product, names: Iterable[str], filters: Mapping[str, Sequence]
) -> DataFrame:
    """Join the dimensions that are shown or filtered; a filter keeps only its values."""
    wanted: dict[tuple[str, str], list[str]] = {}
    for name in dict.fromkeys([*names, *filters]):
        dim, key, column = GRAINS[name]
        wanted.setdefault((dim, key), []).append(column)
    for (dim, key), columns in wanted.items():
        side = getattr(product, dim).select(key, *columns)
        for name, values in filters.items():
            if GRAINS[name][0] == dim:
                side = side.filter(F.col(GRAINS[name][2]).isin(*values))
                if name in ("month", "day") and "sales_month" in fact.columns:
                    # The fact is stored by month: other months are not read.
                    months = sorted({str(v)[:7] for v in values})
                    fact = fact.filter(F.col("sales_month").isin(*months))
        fact = fact.join(side, key)
    return fact


def _by_grain(
    product: Product, names: Sequence[str], filters: Mapping[str, Sequence]
) -> DataFrame:
    """Sums of both facts per group."""
    keys = [GRAINS[name][2] for name in names]
    sales = (
        _with_labels(product.fact_sales, product, names, filters)
        .groupBy(*keys)
        .agg(
            money(F.sum("gross_revenue_cad")).alias("gross_revenue_cad"),
            money(F.sum("returns_cad")).alias("returns_cad"),
            money(F.sum("net_revenue_cad")).alias("net_revenue_cad"),
        )
    )
    goals = (
        _with_labels(product.fact_targets, product, names, filters)
        .groupBy(*keys)
        .agg(money(F.sum("target_cad")).alias("revenue_target_cad"))
    )
    if not keys:
        # One row each; a constant key keeps it an ordinary join.
        one = F.lit(1).alias("_all")
        return (
            sales.select(one, "*").join(goals.select(one, "*"), "_all", "full").drop("_all")
        )
    return sales.join(goals, keys, "full")


def variance(net: str = "net_revenue_cad", target: str = "revenue_target_cad") -> Column:
    """Net minus target; a missing side counts as zero, two missing sides stay missing."""
    zero = F.lit(0).cast("decimal(18,2)")
    gap = money(F.coalesce(F.col(net), zero) - F.coalesce(F.col(target), zero))
    return F.when(F.col(net).isNotNull() | F.col(target).isNotNull(), gap)


def largest_negative_category(
    product: Product, names: Sequence[str], filters: Mapping[str, Sequence]
) -> DataFrame:
    """Name of the category with the most negative variance per group; the last name of a tie."""
    keys = [GRAINS[name][2] for name in names]
    inner = [*names, "category"] if "category" not in names else list(names)
    labels = product.dim_category.select("category_code", "category_name")
    scored = (
        _by_grain(product, inner, filters)
        .withColumn("_gap", variance())
        .filter("_gap < 0")
        .join(labels, "category_code")
    )
    worst = F.max_by("category_name", F.struct(-F.col("_gap"), F.col("category_name")))
    return scored.groupBy(*keys).agg(worst.alias("largest_negative_category"))


def status_measures(product: Product) -> DataFrame:
    """Latest refresh, product status and trust. One row, whatever the filters are."""
    single = F.count_distinct("status") == 1
    status = F.when(single, F.first("status", ignorenulls=True)).otherwise("UNKNOWN")
    return product.health.agg(
        F.max("last_successful_refresh_utc").alias("latest_refresh_utc"),
        status.alias("data_product_status"),
    ).withColumn("data_is_trusted", F.col("data_product_status") == "READY")


def measures(
    product: Product,
    by: Sequence[str] = (),
    filters: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """All measures, one row per group."""
    filters = filters or {}
    unknown = [n for n in [*by, *filters] if n not in GRAINS]
    if unknown:
        raise ValueError(f"unknown grain {unknown}; choose from {sorted(GRAINS)}")
    keys = [GRAINS[name][2] for name in by]
    base = _by_grain(product, by, filters)
    worst = largest_negative_category(product, by, filters)
    one = F.lit(1).alias("_all")
    if keys:
        joined = base.join(worst, keys, "left")
    else:
        joined = base.select(one, "*").join(worst.select(one, "*"), "_all", "left").drop("_all")
    # The status row is a global aggregate: exactly one row.
    joined = joined.select(one, "*").join(
        F.broadcast(status_measures(product).select(one, "*")), "_all"
    )
    gap = variance()
    share = gap / F.nullif(F.col("revenue_target_cad"), F.lit(0).cast("decimal(18,2)"))
    return joined.select(
        *keys,
        "gross_revenue_cad",
        "returns_cad",
        "net_revenue_cad",
        "revenue_target_cad",
        gap.alias("variance_to_target_cad"),
        share.cast("decimal(18,6)").alias("variance_to_target_pct"),
        "largest_negative_category",
        "latest_refresh_utc",
        "data_product_status",
        "data_is_trusted",
        F.when(F.col("data_is_trusted"), F.col("net_revenue_cad")).alias(
            "net_revenue_cad_trusted"
        ),
    )


CUBE_GRAINS = ("region", "month", "category")


def measure_cube(product: Product) -> DataFrame:
    """All measures at every grain of region, month and category, from one pass over each fact.

    Both facts are added up once at the finest grain and meet there; all coarser grains, the total
    included, are grouping sets of those cells. ``grain`` names the columns that a row stands for;
    rolled up columns are NULL. The worst category of a group is found among the group's own
    category rows of the same result.
    """
    keys = [GRAINS[name][2] for name in CUBE_GRAINS]
    figures = ("gross_revenue_cad", "returns_cad", "net_revenue_cad", "revenue_target_cad")
    cells = _by_grain(product, CUBE_GRAINS, {})
    rolled = {k: F.col(f"_rolled_{k}") for k in keys}
    sums = cells.cube(*keys).agg(
        *[money(F.sum(c)).alias(c) for c in figures],
        *[F.grouping(k).cast("int").alias(f"_rolled_{k}") for k in keys],
    )
    names = product.dim_category.select("category_code", "category_name")
    scored = sums.join(names, "category_code", "left").withColumn("_gap", variance())
    category = rolled["category_code"] == 0
    below = category & (F.col("_gap") < 0)
    group = [c for k in keys if k != "category_code" for c in (rolled[k], F.col(k))]
    worst = F.max_by(
        F.when(below, F.col("category_name")),
        F.when(below, F.struct(-F.col("_gap"), F.col("category_name"))),
    ).over(Window.partitionBy(*group))
    own = F.when(below, F.col("category_name"))
    scored = scored.withColumn("_worst", worst).crossJoin(
        F.broadcast(status_measures(product))  # a global aggregate: exactly one row
    )
    share = F.col("_gap") / F.nullif(F.col("revenue_target_cad"), F.lit(0).cast("decimal(18,2)"))
    shown = F.array_compact(F.array(*[F.when(rolled[k] == 0, F.lit(k)) for k in keys]))
    return scored.select(
        F.array_join(shown, ",").alias("grain"),
        *keys,
        *figures,
        F.col("_gap").alias("variance_to_target_cad"),
        share.cast("decimal(18,6)").alias("variance_to_target_pct"),
        F.when(category, own).otherwise(F.col("_worst")).alias("largest_negative_category"),
        "latest_refresh_utc",
        "data_product_status",
        "data_is_trusted",
        F.when(F.col("data_is_trusted"), F.col("net_revenue_cad")).alias(
            "net_revenue_cad_trusted"
        ),
    )
