"""Source feeds: typed CSV extracts with lineage, and snapshots of a feed at a point in time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.contracts import FEEDS, FeedContract
from plumbline.functions.columns import utc


class MissingExtract(FileNotFoundError):
    """A declared source extract does not exist."""


@dataclass(frozen=True)
class FeedSet:
    """The seven inputs of one build, each with lineage columns."""

    orders: DataFrame
    returns: DataFrame
    fx_rates: DataFrame
    targets: DataFrame
    regions: DataFrame
    categories: DataFrame
    calendar: DataFrame
    #: Records of the extracts that do not fit their declared types: feed, record, source_file.
    rejects: DataFrame | None = None
    #: Parts into which the orders are dealt out by their id, where no id has a large share of them.
    dealt: int | None = None

    def items(self) -> list[tuple[FeedContract, DataFrame]]:
        return [(feed, getattr(self, feed.name)) for feed in FEEDS]


def stamp_lineage(df: DataFrame, feed: FeedContract, source_file: str | None = None) -> DataFrame:
    """Add ``source_system`` unless the feed has one, and the file each row came from."""
    if "source_system" not in df.columns:
        df = df.withColumn("source_system", F.lit(feed.source_system))
    name = F.lit(source_file) if source_file else F.col("_metadata.file_path")
    return df.withColumn("source_file", name)


_REJECTED = "_rejected_record"


def _scan_extract(
    spark: SparkSession, feed: FeedContract, root: str, relative: str, keep_rejects: bool
) -> DataFrame:
    reader = spark.read.option("header", True).option("enforceSchema", False)
    schema = feed.schema
    if keep_rejects:
        # Every column is parsed whatever is selected, so a record is judged as a whole.
        reader = reader.option("mode", "PERMISSIVE").option("columnPruning", False)
        reader = reader.option("columnNameOfCorruptRecord", _REJECTED)
        schema = T.StructType([*schema.fields, T.StructField(_REJECTED, T.StringType())])
    else:
        reader = reader.option("mode", "FAILFAST")
    try:
        return reader.schema(schema).csv(f"{root.rstrip('/')}/{relative}")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise MissingExtract(f"missing source extract {root}/{relative}") from exc


def read_extract(spark: SparkSession, feed: FeedContract, root: str, batch: str = "") -> DataFrame:
    """Typed scan of one CSV extract.

    A malformed value or a reordered header fails the read, a missing file raises
    ``MissingExtract``.
    """
    relative = feed.path.format(batch=batch)
    return stamp_lineage(_scan_extract(spark, feed, root, relative, False), feed, relative)


def read_extracts(
    spark: SparkSession, root: str, batch: str, keep_rejects: bool = False
) -> FeedSet:
    """All extracts of a batch. ``keep_rejects``: malformed records become rows of ``rejects``
    instead of failing the read; all other records go on.
    """
    if not keep_rejects:
        return FeedSet(**{feed.name: read_extract(spark, feed, root, batch) for feed in FEEDS})
    good, bad = {}, None
    for feed in FEEDS:
        relative = feed.path.format(batch=batch)
        scanned = _scan_extract(spark, feed, root, relative, True)
        accepted = scanned.filter(F.col(_REJECTED).isNull()).drop(_REJECTED)
        good[feed.name] = stamp_lineage(accepted, feed, relative)
        # All columns are named, so that a reader cannot leave the parsing out.
        width = F.size(F.array(*[F.col(c).cast("string") for c in feed.column_names]))
        rejected = scanned.filter(F.col(_REJECTED).isNotNull() & (width > 0)).select(
            F.lit(feed.name).alias("feed"),
            F.col(_REJECTED).alias("record"),
            F.lit(relative).alias("source_file"),
        )
        bad = rejected if bad is None else bad.unionByName(rejected)
    return FeedSet(**good, rejects=bad)


def write_extracts(feeds: FeedSet, root: str, batch: str) -> None:
    """The feeds as CSV extracts below ``root``, in as many compressed files as tasks hold rows."""
    for feed, df in feeds.items():
        # A feed may carry its lineage as declared columns; other lineage is stamped when read.
        path = f"{root.rstrip('/')}/{feed.path.format(batch=batch)}"
        writer = df.select(*feed.column_names).write.mode("overwrite").option("header", True)
        writer.option("compression", "gzip").csv(path)


def snapshot_at(feed: DataFrame, watermark: datetime | str) -> DataFrame:
    """The rows a replication stopped at ``watermark`` would have delivered, restamped."""
    moment = utc(watermark)
    return feed.filter(F.col("source_updated_at") <= moment).withColumn("ingested_at", moment)
