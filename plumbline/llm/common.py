"""What several operators share: words, shared folders, written intermediates, distributed prefix sums."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.session import checkpoint_dir, prepare

#: Fixed value: what separates words in every contract of this package.
GAP = r"[\x20\x09-\x0D]+"
#: A frame is broadcast by hand only if its measured bytes stay within this.
BROADCAST_BYTES = 32 << 20


def shipped(module: str) -> None:
    """Send the module's functions to executors with each job, so they need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of words; NULL counts as an empty text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and every executor can read and write."""
    prepare(spark)
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: a cut of the lineage that outlives executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table of ``written`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._llm_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, *columns: str, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the values of the text or array columns, with 64 bytes a row, stay within ``limit``."""
    size = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in columns), F.lit(64))
    total = df.agg(F.sum(size.cast("bigint")).alias("n")).first()["n"]
    return (total or 0) <= limit


def prefix_sums(
    df: DataFrame, value: str, order: list[Column], by: list[str], out: str, partitions: int | None = None
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all earlier rows of the same ``by`` group.

    Rows are range partitioned by group and order, so one group may span many tasks; each task
    sums its own rows and adds what the group holds in earlier partitions. The per-partition
    totals have one row for each partition and group in it. ``order`` must be total (equal rows
    are exchangeable), and ``value`` not null.
    """
    keys = [F.col(c) for c in by]
    ordered = df.repartitionByRange(partitions, *keys, *order) if partitions else df.repartitionByRange(*keys, *order)
    parts = written(ordered.withColumn("_part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = parts.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    totals = parts.groupBy("_part", *keys).agg(F.sum(value).alias("_sum"))
    # One row for each partition and group: a group's row count here is bounded by the partitions.
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)],
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"),
    )
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(offsets, same, "inner")
    return joined.select(*df.columns, (F.col("_base") + F.col("_local")).alias(out))


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small frame of constants, made inside the plan."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def joined_small(left: DataFrame, right: DataFrame, on, how: str, fits: bool) -> DataFrame:
    """A join whose right side is broadcast only where its measured size allows it (``small``)."""
    return left.join(F.broadcast(right) if fits else right, on, how)
