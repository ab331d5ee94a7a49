"""Run-partitioned parquet tables and append-only run and health events.

Every build writes its tables under its own run id, so a rerun replaces only its own files and
a half-written run is never visible: readers follow the latest health event to a run, and open it only
if its manifest, put in place by one rename after all tables are complete, names it. Records are never
updated in place; the current state is the latest event per key. Events are appended one file each and
folded into a base from time to time; one pointer file says which base counts and what it covers.

Tables that meet on one key are stored in buckets of that key, so later joins and groupings on it read
them as they lie. The session's catalog knows them by a name derived from their path.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import checkpoint_dir

# Names and columns of the observability tables.
QUALITY_RESULTS = "silver_quality_results"
HEALTH = "gold_data_product_health"
RUNS = "gold_pipeline_runs"
SCHEMAS = {
    QUALITY_RESULTS: (
        "pipeline_run_id STRING, check_name STRING, severity STRING, observed_value BIGINT, "
        "threshold STRING, status STRING, detail STRING, evaluated_at_utc TIMESTAMP"
    ),
    HEALTH: (
        "data_product STRING, status STRING, data_contract_version STRING, "
        "scenario_mode STRING, as_of_utc TIMESTAMP, orders_freshness_minutes BIGINT, "
        "returns_freshness_minutes BIGINT, freshness_sla_minutes BIGINT, "
        "duplicate_count BIGINT, missing_fx_count BIGINT, orphan_return_count BIGINT, "
        "missing_key_count BIGINT, unsupported_currency_count BIGINT, quarantined_rows BIGINT, "
        "blocking_reasons STRING, warning_reasons STRING, pipeline_run_id STRING, "
        "last_successful_refresh_utc TIMESTAMP, evaluated_at_utc TIMESTAMP"
    ),
    RUNS: (
        "pipeline_run_id STRING, scenario_mode STRING, started_at_utc TIMESTAMP, "
        "completed_at_utc TIMESTAMP, status STRING, bronze_order_rows BIGINT, "
        "bronze_return_rows BIGINT, silver_sales_rows BIGINT, quarantined_rows BIGINT, "
        "duplicate_count BIGINT, missing_fx_count BIGINT, orphan_return_count BIGINT, "
        "freshness_minutes BIGINT, data_contract_version STRING, failure_reasons STRING, "
        "warning_reasons STRING, duration_ms BIGINT"
    ),
}
# Tables are written once and read several times; this codec takes about a third less than the default.
# Its lowest level made no larger files than the default one, in less time.
COMPRESSION, LEVEL = "zstd", "1"
# Columns with nearly as many values as rows: a dictionary of theirs is built, found too large and dropped.
NEARLY_UNIQUE = (
    "order_id order_key event_id order_source_event_id return_id record_key return_reason gross_amount "
    "gross_amount_original_currency gross_revenue_cad net_revenue_cad return_amount"
).split()
# Texts that are the same in nearly all rows. Their smallest and largest value in a file tell nothing, nor do
# those of ids, which are dealt out by hash: no file could be skipped by them, so they are not kept.
NEARLY_CONSTANT = (
    "source_system source_file pipeline_run_id order_source_system returns_source_system fx_source_system"
).split()
WRITE_OPTIONS = {
    "compression": COMPRESSION,
    "parquet.compression.codec.zstd.level": LEVEL,
    **{f"parquet.enable.dictionary#{column}": "false" for column in NEARLY_UNIQUE},
    **{
        f"parquet.column.statistics.enabled#{column}": "false"
        for column in [*NEARLY_UNIQUE, *NEARLY_CONSTANT]
    },
}
# Timestamps as plain integers instead of the wider, older form, for the time of a build.
WRITE_SETTINGS = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}
EVENT_KEYS = {HEALTH: "data_product", RUNS: "pipeline_run_id"}
_EVENT_COLUMNS = "history STRING, event_seq BIGINT, recorded_at_utc TIMESTAMP"


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


def record_rows(spark: SparkSession, schema: T.StructType, records: list[dict]) -> DataFrame:
    """Python records as a typed frame; missing fields are NULL."""
    rows = [tuple(record.get(name) for name in schema.names) for record in records]
    return spark.createDataFrame(rows, schema)


class TableStore:
    """Tables of one data product below ``root``.

    The default root is a folder below ``spark.checkpoint.dir``, which all executors share; a product
    that is to outlive a job names its own. ``buckets`` is by default the session's number of shuffle
    partitions: a bucket should fit one task.
    """

    def __init__(
        self, spark: SparkSession, root: str | None = None, buckets: int | None = None
    ) -> None:
        if root is None:
            shared = checkpoint_dir(spark)
            if not shared:
                raise ValueError("give a root or set spark.checkpoint.dir")
            root = f"{shared.rstrip('/')}/plumbline"
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._layouts: dict[str, dict[str, dict[str, Any]]] = {}

    # ---------------------------------------------------------------- run tables

    def path(self, table: str, run_id: str) -> str:
        return f"{self.root}/runs/{run_id}/{table}"

    def write(
        self,
        df: DataFrame,
        table: str,
        run_id: str,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        measures: Mapping[str, Column] | None = None,
        finish: Callable[[DataFrame], DataFrame] = lambda df: df,
    ) -> DataFrame:
        """Create or replace the table of one run and return it as stored.

        Partitioned tables are rebalanced first: even files, and a partition value with many
        rows is split over several tasks. ``measures`` are aggregates that the writing tasks take
        along (``measured``); a task that is run again counts once. ``finish`` adds what follows from
        a row's own columns, behind the shuffle, so that it is not moved.
        """
        if partition_by:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        df = finish(df)
        columns = df.columns
        if sort_by:
            df = df.sortWithinPartitions(*partition_by, *sort_by)
        df, observed = self._observed(df, measures)
        writer = df.write.mode("overwrite").options(**WRITE_OPTIONS)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(table, run_id))
        self._note(run_id, table, df, observed, partition_by=list(partition_by))
        return self.spark.read.schema(df.schema).parquet(self.path(table, run_id)).select(*columns)

    def write_bucketed(
        self,
        df: DataFrame,
        table: str,
        run_id: str,
        key: str,
        partition_by: Sequence[str] = (),
        spread: bool = False,
        measures: Mapping[str, Column] | None = None,
        buckets: int | None = None,
        sort_by: Sequence[str] = (),
    ) -> DataFrame:
        """Like ``write``, in buckets of ``key``: rows of one key value are in one bucket.

        ``buckets`` is by default the store's number. Rows keep their order within a file unless ``sort_by``
        names another: joins and groupings do not use the order of a bucket's rows.

        ``spread`` deals the rows out by the key first; a bucket that is much larger than others is
        then written by several tasks. Without it the rows' own distribution is kept, which should
        follow the key already, else every task writes a file for every bucket.
        """
        columns = df.columns
        if spread:
            df = df.hint("rebalance", F.col(key))
        df, observed = self._observed(df, measures)
        path = self.path(table, run_id)
        writer = df.write.mode("overwrite").format("parquet").option("path", path)
        writer = writer.options(**WRITE_OPTIONS)
        count, order = buckets or self.buckets, list(sort_by)
        writer = writer.bucketBy(count, key)
        if order:
            writer = writer.sortBy(*order)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        name = _catalog_name(path)
        writer.saveAsTable(name)
        layout = {"partition_by": list(partition_by), "key": key, "buckets": count, "sort_by": order}
        self._note(run_id, table, df, observed, **layout)
        return self.spark.table(name).select(*columns)

    def read_bucketed(self, table: str, run_id: str) -> DataFrame:
        """A bucketed table of a committed run, in any session: its layout stands in the manifest."""
        layout = self.manifest(run_id)["tables"][table]
        path, split = self.path(table, run_id), layout["partition_by"]
        order = layout.get("sort_by", [layout["key"]])
        ordered = f"SORTED BY ({', '.join(order)}) " if order else ""
        name = _catalog_name(path)
        if not self.spark.catalog.tableExists(name):
            parts = f"PARTITIONED BY ({', '.join(split)}) " if split else ""
            self.spark.sql(
                f"CREATE TABLE {name} ({layout['schema']}) USING parquet {parts}"
                f"CLUSTERED BY ({layout['key']}) {ordered}"
                f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
            )
            if split:
                self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return self.spark.table(name)

    def _observed(
        self, df: DataFrame, measures: Mapping[str, Column] | None
    ) -> tuple[DataFrame, Observation | None]:
        # The aggregates stand right below the write, in the stage whose tasks count once only.
        if not measures:
            return df, None
        watch = Observation(uuid.uuid4().hex)
        return df.observe(watch, *[c.alias(name) for name, c in measures.items()]), watch

    def _note(
        self, run_id: str, table: str, df: DataFrame, watch: Observation | None, **layout: Any
    ) -> None:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        measured = {} if watch is None else dict(watch.get)
        entry = {"schema": ddl, "measured": measured, **layout}
        self._layouts.setdefault(run_id, {})[table] = entry

    def measured(self, table: str, run_id: str) -> dict[str, Any]:
        """What the writing tasks measured of a table of this store's own run."""
        return self._layouts[run_id][table]["measured"]

    # ---------------------------------------------------------------- manifests and retention

    def _files(self) -> tuple[Any, Any]:
        """The store's file system and a maker of paths in it."""
        make = self.spark._jvm.org.apache.hadoop.fs.Path
        return make(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), make

    def put_text(self, relative: str, text: str) -> None:
        """A small file that appears complete or not at all: written beside, then renamed over."""
        files, make = self._files()
        target = make(f"{self.root}/{relative}")
        made = make(f"{self.root}/{relative}.{uuid.uuid4().hex}.tmp")
        out = files.create(made, True)
        out.write(bytearray(text.encode()))
        out.close()
        jvm = self.spark._jvm
        over = self.spark.sparkContext._gateway.new_array(
            getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1
        )
        over[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            target.toUri() if target.isAbsolute() and target.toUri().getScheme() else files.getUri(),
            self.spark._jsc.hadoopConfiguration(),
        )
        context.rename(made, target, over)

    def get_text(self, relative: str) -> str | None:
        files, make = self._files()
        path = make(f"{self.root}/{relative}")
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def commit(self, run_id: str, seq: str) -> None:
        """Name the run and its tables in a manifest. ``seq`` orders runs, the later the greater."""
        manifest = {"run_id": run_id, "seq": seq, "tables": self._layouts.get(run_id, {})}
        self.put_text(f"manifests/{run_id}.json", json.dumps(manifest, default=str))

    def manifest(self, run_id: str) -> dict[str, Any] | None:
        text = self.get_text(f"manifests/{run_id}.json")
        return None if text is None else json.loads(text)

    def committed(self) -> list[str]:
        """Run ids that have a manifest, the newest first."""
        files, make = self._files()
        folder = make(f"{self.root}/manifests")
        if not files.exists(folder):
            return []
        names = [str(x.getPath().getName()) for x in files.listStatus(folder)]
        found = [self.manifest(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        return [m["run_id"] for m in sorted(found, key=lambda m: m["seq"], reverse=True)]

    def sweep(self, keep: int, also: Sequence[str] = ()) -> list[str]:
        """Remove all run folders but those of the ``keep`` newest manifests and of ``also``; returns what went.

        ``also`` names runs that are under way. The manifest goes first, so a sweep that is interrupted
        leaves an unnamed folder, never a named run without its files.
        """
        files, make = self._files()
        marked = {*self.committed()[:keep], *also}
        folder = make(f"{self.root}/runs")
        if not files.exists(folder):
            return []
        gone = []
        for run_id in sorted(str(x.getPath().getName()) for x in files.listStatus(folder)):
            if run_id in marked:
                continue
            manifest = self.manifest(run_id) or {"tables": {}}
            files.delete(make(f"{self.root}/manifests/{run_id}.json"), True)
            for table, layout in manifest["tables"].items():
                if "key" in layout:
                    self.spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(self.path(table, run_id))}")
            files.delete(make(f"{self.root}/runs/{run_id}"), True)
            gone.append(run_id)
        return gone

    def read(
        self, table: str, run_id: str | None, schema: T.StructType | str | None = None
    ) -> DataFrame | None:
        """The table of one run. Without the run or its files: empty if a schema is given."""
        empty = None if schema is None else self.spark.createDataFrame([], schema)
        if run_id is None:
            return empty
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.parquet(self.path(table, run_id))
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty

    def quality_results(self, run_id: str | None) -> DataFrame:
        """Check results of one run, from its own folder."""
        return self.read(QUALITY_RESULTS, run_id, schema_of(QUALITY_RESULTS))

    # ---------------------------------------------------------------- events

    def create_if_missing(self) -> None:
        """Empty event tables with their declared columns, where they do not exist yet."""
        for table in EVENT_KEYS:
            schema = T.StructType.fromDDL(f"{SCHEMAS[table]}, {_EVENT_COLUMNS}")
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(
                f"{self.root}/events/{table}"
            )

    def append_event(
        self, table: str, record: dict[str, Any], history: str, seq: int, recorded_at: Any
    ) -> None:
        schema = T.StructType.fromDDL(f"{SCHEMAS[table]}, {_EVENT_COLUMNS}")
        event = {**record, "history": history, "event_seq": seq, "recorded_at_utc": recorded_at}
        record_rows(self.spark, schema, [event]).coalesce(1).write.mode("append").parquet(
            f"{self.root}/events/{table}"
        )

    def event_files(self, table: str) -> list[str]:
        """The files that hold the events: those of the base, if any, and the tail behind it."""
        files, make = self._files()
        pointer = json.loads(self.get_text(f"events/{table}-base.json") or '{"base": null, "covers": []}')
        covered = set(pointer["covers"])

        def listed(path: str) -> list[str]:
            folder = make(path)
            found = files.listStatus(folder) if files.exists(folder) else []
            names = [(str(x.getPath().getName()), x.getPath().toString()) for x in found]
            return [full for name, full in sorted(names) if name.startswith("part-") and name not in covered]

        base = [] if pointer["base"] is None else listed(f"{self.root}/{pointer['base']}")
        return base + listed(f"{self.root}/events/{table}")

    def compact_events(self, table: str) -> int:
        """Fold all events into one base file; returns how many files it replaced.

        The base is complete before the pointer names it, and readers skip what the pointer covers, so
        no event is lost or read twice at any time; covered files are removed last. One writer at a time.
        """
        files, make = self._files()
        old = self.event_files(table)
        if len(old) < 2:
            return 0
        base = f"events/{table}-base-{uuid.uuid4().hex}"
        schema = T.StructType.fromDDL(f"{SCHEMAS[table]}, {_EVENT_COLUMNS}")
        events = self.spark.read.schema(schema).parquet(*old)
        events.coalesce(1).write.parquet(f"{self.root}/{base}")
        names = [path.rsplit("/", 1)[1] for path in old]
        self.put_text(f"events/{table}-base.json", json.dumps({"base": base, "covers": names}))
        for path in old:
            files.delete(make(path), False)
        return len(old)

    def events(self, table: str, history: str) -> DataFrame:
        schema = T.StructType.fromDDL(f"{SCHEMAS[table]}, {_EVENT_COLUMNS}")
        found = self.event_files(table)
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*found).filter(F.col("history") == history)

    def current(self, table: str, history: str) -> DataFrame:
        """Latest event per key with the declared columns only."""
        return latest_events(
            self.events(table, history),
            EVENT_KEYS[table],
            schema_of(table).names,
            ("recorded_at_utc", "event_seq", "pipeline_run_id"),
        )

    def last_success(self, history: str) -> Any:
        """Completion time of the newest READY run."""
        runs = self.current(RUNS, history).filter(F.col("status") == "READY")
        return runs.agg(F.max("completed_at_utc")).first()[0]


@contextmanager
def write_settings(spark: SparkSession) -> Iterator[None]:
    """``WRITE_SETTINGS`` for the time of a build; the session's own values come back afterwards."""
    before = {name: spark.conf.get(name) for name in WRITE_SETTINGS}
    for name, value in WRITE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _catalog_name(path: str) -> str:
    return f"plumbline_{hashlib.md5(path.encode()).hexdigest()}"


def latest_events(
    events: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The newest event of every key. Partial aggregation keeps one event per key and task."""
    row = F.struct(*[F.col(name) for name in columns])
    newest = F.max_by(row, F.struct(*order)).alias("_row")
    return events.groupBy(F.col(key).alias("_key")).agg(newest).select("_row.*")
