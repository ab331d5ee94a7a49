"""Latest version of each business key, by three routes, and the full audit ranking."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.joins import is_one_of

# Copies of one event are written out in blocks of this many rows.
COPY_BLOCK = 100_000


def newest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def latest(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first in descending ``order``; NULL keys form one group.

    The rank filter sits on the window, so Spark keeps at most one row per key on the map side
    before it shuffles. A key with a third of all rows therefore costs one row per map task.
    """
    window = Window.partitionBy(key).orderBy(*newest_first(order))
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    )


def latest_by_max(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Second route to ``latest``: one partial aggregate, no window.

    ``max_by`` skips NULL orders and structs with NULL fields sort first, which equals
    descending order with NULLs last.
    """
    payload = F.struct(*[F.col(c) for c in df.columns])
    best = F.max_by(payload, F.struct(*order)).alias("_best")
    return df.groupBy(F.col(key).alias("_key")).agg(best).select("_best.*")


def rank_versions(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    hot: Sequence[Any] = (),
    rank: str = "version_rank",
) -> DataFrame:
    """All rows with their rank inside the key, newest first.

    Ordinary keys use one window. Keys in ``hot`` are too large for one task and are ranked by
    ``_rank_large``.
    """
    window = Window.partitionBy(key).orderBy(*newest_first(order))
    if not hot:
        return df.withColumn(rank, F.row_number().over(window).cast("bigint"))
    is_hot = is_one_of(F.col(key), hot)
    position = F.row_number().over(window).cast("bigint")
    small = df.filter(~is_hot).withColumn(rank, position)
    return small.unionByName(_rank_large(df.filter(is_hot), key, order, rank))


def _rank_large(df: DataFrame, key: str, order: Sequence[str], rank: str) -> DataFrame:
    """Rank keys of any size without bringing one key into one task.

    1. Copies of a row collapse into one row with a count (partial aggregate).
    2. Distinct rows are range partitioned by the full order, so a key spans many slices. The
       slice number is fixed by a checkpoint and survives lost executors.
    3. A row's first rank = rows of the key in earlier slices + rows before it in its slice.
    4. Copies are written out again, block by block.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in df.columns if c != key and c not in order]
    total = [F.col(key).asc_nulls_first(), *newest_first([*order, *rest])]
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    sliced = (
        distinct.repartitionByRange(slices, *total)
        .withColumn("_slice", F.spark_partition_id())
        .checkpoint()
    )
    sizes = sliced.groupBy(F.col(key).alias("_k"), "_slice").agg(
        F.sum("_copies").alias("_size")
    )
    earlier = Window.partitionBy("_k").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        "_k",
        F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
    )
    inside = (
        Window.partitionBy("_slice", key)
        .orderBy(*newest_first([*order, *rest]))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    placed = (
        sliced.withColumn("_before", before)
        # Ranges are contiguous, so there are fewer pairs than slices plus hot keys.
        .join(
            F.broadcast(offsets),
            F.col(key).eqNullSafe(F.col("_k")) & (F.col("_slice") == F.col("_s")),
        )
        .withColumn("_first", F.col("_offset") + F.col("_before"))
        .drop("_k", "_s", "_offset", "_before", "_slice")
    )
    blocks = placed.withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPY_BLOCK)))
    )
    start = F.col("_block") * COPY_BLOCK
    end = F.least(F.col("_copies"), start + COPY_BLOCK) - 1
    return (
        blocks.repartition(slices, "_first", "_block")
        .withColumn("_copy", F.explode(F.sequence(start, end)))
        .select(*df.columns, (F.col("_first") + F.col("_copy") + 1).alias(rank))
    )
