"""Stored tables: buckets, measures of the writing tasks, manifests, retention, event bases."""

from __future__ import annotations

import glob
import os
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from conftest import multiset
from pyspark.sql import functions as F

from plumbline.operators import silver, star
from plumbline.operators.audits import same_rows
from plumbline.operators.joins import Stored, busiest_keys
from plumbline.plans import build, serving
from plumbline.plans.product import Question, open_product
from plumbline.sources.store import RUNS, TableStore
from plumbline.sources.trade import AS_OF, CONTRACT, MONTH, REGION, TradeFeeds


def run(spark, directory, store, variant="repaired", **options):
    feeds = TradeFeeds(spark, directory, variant)
    return build.run_build(spark, feeds.feed_set, store, CONTRACT, variant, AS_OF, **options)


@pytest.fixture(scope="module")
def built(spark, trade_dir, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("product")))
    return store, run(spark, trade_dir, store, run_id="first").run_id


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_returns(store, table, run_id, hot=()):
    return Stored.split(store.read_bucketed(table, run_id), "hot_order", "order_id", hot)


def test_joins_and_groupings_on_the_order_id_need_no_exchange(spark, trade_dir, built, no_broadcast):
    # Another store object, as in another session: layouts come from the manifest.
    store, run_id = TableStore(spark, built[0].root), built[1]
    latest = store.read_bucketed("silver_order_versions", run_id).filter("is_latest")
    returns = stored_returns(store, "silver_latest_returns", run_id)
    reconciled = silver.reconcile_stored(returns, latest)
    assert "Exchange" not in plan(reconciled) and "Bucketed: true" in plan(reconciled)
    refs = TradeFeeds(spark, trade_dir).references
    judged = stored_returns(store, "silver_returns", run_id)
    governed = store.read_bucketed("silver_orders", run_id)
    priced = silver.price_stored(governed, judged, refs["rates"], CONTRACT)
    assert "hashpartitioning(order_id" not in plan(priced) and "Bucketed: true" in plan(priced)
    per_order = store.read_bucketed("silver_reconciled_sales", run_id).groupBy("order_id").count()
    assert "Exchange" not in plan(per_order)
    # Only files of latest versions are read.
    assert "is_latest=false" not in plan(latest)


def test_hot_orders_are_kept_apart_with_equal_results(spark, trade_dir, built, tmp_path, monkeypatch):
    hot = [str(k) for k in busiest_keys(spark.read.parquet(f"{trade_dir}/lineitem.parquet"), "l_orderkey", 25)]
    monkeypatch.setattr(build, "hot_keys", lambda df, *columns: {c: hot for c in columns})
    store = TableStore(spark, str(tmp_path))
    run(spark, trade_dir, store, run_id="first")
    assert os.path.isdir(f"{tmp_path}/runs/first/silver_returns/hot_order=true")
    for table in ("silver_returns", "silver_reconciled_sales", "silver_orders", "gold_fact_sales", "silver_order_versions"):
        left, right = built[0].read(table, "first"), store.read(table, "first")
        assert same_rows(left, right, ["hot_order"]), table


def test_writing_tasks_count(built):
    store, run_id = built
    orders = store.read("bronze_orders", run_id)
    measured = store.measured("bronze_orders", run_id)
    assert measured["rows"] == orders.count()
    assert measured["newest_micros"] == orders.agg(F.unix_micros(F.max("ingested_at"))).first()[0]
    latest = store.read("silver_order_versions", run_id).filter("is_latest = 'true'").count()
    assert store.measured("silver_order_versions", run_id)["latest"] == latest
    assert store.measured("silver_reconciled_sales", run_id)["rows"] == store.read("silver_orders", run_id).count()


def test_raw_answer_reads_one_month(built):
    product = open_product(built[0], CONTRACT)
    answer = plan(serving.raw_answer(product, Question(REGION, MONTH)))
    assert f"(order_month" in answer and "PartitionFilters: [isnotnull(order_month" in answer
    landed = product.bronze_orders.filter(F.col("order_month") == MONTH)
    files = {r[0] for r in landed.select("_metadata.file_path").distinct().collect()}
    assert files and all(f"order_month={MONTH}" in f for f in files)
    every = product.bronze_orders.select("_metadata.file_path").distinct().count()
    assert len(files) * 20 < every


def test_a_run_without_a_manifest_is_never_opened(spark, trade_dir, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))

    def crash(self, run_id, seq):
        raise OSError("lost before the rename")

    with monkeypatch.context() as m:
        m.setattr(TableStore, "commit", crash)
        with pytest.raises(build.BuildFailed, match="lost before the rename"):
            run(spark, trade_dir, store, run_id="half")
    product = open_product(store, CONTRACT)
    assert product.status == "FAILED" and product.fact_sales.count() == 0
    # Even a forged READY event does not open it.
    record = {**product.health.first().asDict(), "status": "READY"}
    store.append_event("gold_data_product_health", record, "default", 2, datetime(2030, 1, 1))
    assert open_product(store, CONTRACT).fact_sales.count() == 0
    assert not [f for f in os.listdir(tmp_path) if f == "manifests"]


def test_old_runs_go_by_number(spark, trade_dir, tmp_path):
    store = TableStore(spark, str(tmp_path))
    clock = iter(datetime(2026, 1, 1) + timedelta(minutes=k) for k in range(1000))
    for name in ("a", "b", "c"):
        run(spark, trade_dir, store, run_id=name, clock=lambda: next(clock), keep_runs=2)
    os.makedirs(tmp_path / "runs" / "orphan")
    assert store.committed() == ["c", "b"]
    assert sorted(os.listdir(tmp_path / "runs")) == ["b", "c", "orphan"]
    assert store.sweep(1, also=["orphan"]) == ["b"] and store.sweep(1) == ["orphan"]
    product = open_product(store, CONTRACT)
    assert product.fact_sales.count() > 0 and product.runs.count() == 3


def test_ten_thousand_events_are_read_from_two_files(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.create_if_missing()
    row = {"pipeline_run_id": "x", "status": "READY"}
    store.append_event(RUNS, row, "h", 0, datetime(2026, 1, 1))
    one = spark.read.parquet(f"{tmp_path}/events/{RUNS}")
    many = spark.range(10_000).repartition(50).crossJoin(F.broadcast(one.limit(1)))
    many = many.withColumn("pipeline_run_id", F.concat(F.lit("r"), F.col("id") % 100)).withColumn("event_seq", F.col("id"))
    many.select(one.columns).write.mode("append").parquet(f"{tmp_path}/events/{RUNS}")
    before = multiset(store.current(RUNS, "h"))
    assert len(store.event_files(RUNS)) > 50
    assert store.compact_events(RUNS) > 50 and len(store.event_files(RUNS)) == 1
    assert multiset(store.current(RUNS, "h")) == before and store.events(RUNS, "h").count() == 10_001
    store.append_event(RUNS, {**row, "status": "BLOCKED"}, "h", 5, datetime(2026, 1, 2))
    assert len(store.event_files(RUNS)) == 2
    assert store.current(RUNS, "h").filter("pipeline_run_id = 'x'").first()["status"] == "BLOCKED"
    assert store.compact_events(RUNS) == 2 and store.events(RUNS, "h").count() == 10_002
    assert store.compact_events(RUNS) == 0


def test_an_interrupted_compaction_neither_loses_nor_repeats(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    for k in range(3):
        store.append_event(RUNS, {"pipeline_run_id": f"r{k}"}, "h", k, datetime(2026, 1, 1))
    real, calls = TableStore.put_text, []

    def lost(self, relative, text):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(TableStore, "put_text", lost)
        with pytest.raises(OSError):
            store.compact_events(RUNS)
    assert store.events(RUNS, "h").count() == 3
    # The pointer is put, covered files are still there.
    monkeypatch.setattr(TableStore, "put_text", lambda self, relative, text: (real(self, relative, text), calls.append(1), (_ for _ in ()).throw(OSError("lost"))))
    with pytest.raises(OSError):
        store.compact_events(RUNS)
    assert calls and store.events(RUNS, "h").count() == 3


def test_dealt_orders_are_ranked_without_an_exchange(spark, trade_dir, built, no_broadcast):
    feeds = TradeFeeds(spark, trade_dir)
    parts = feeds.parts_by_id()
    assert parts and built[0].buckets % parts == 0
    assert built[0].manifest("first")["tables"]["bronze_orders"]["buckets"] == parts
    # The last join keeps the parts, so landing is no shuffle of its own.
    orders = feeds.orders(parts)
    assert "hashpartitioning(order_id#" in plan(orders) and orders.rdd.getNumPartitions() == parts
    assert same_rows(orders, feeds.orders())
    landed = TableStore(spark, built[0].root).read_bucketed("bronze_orders", "first")
    ranked = silver.order_versions(landed, CONTRACT)
    assert "Exchange" not in plan(ranked) and "Bucketed: true" in plan(ranked)
    assert same_rows(ranked, silver.order_versions(feeds.orders(), CONTRACT))


def test_orders_with_a_busy_id_are_not_dealt_out(spark, trade_dir, tmp_path, monkeypatch):
    feeds = TradeFeeds(spark, trade_dir)
    monkeypatch.setattr(feeds, "hot_order_ids", lambda: ["7"])
    assert feeds.parts_by_id() is None and feeds.feed_set().dealt is None
    assert TradeFeeds(spark, trade_dir, "malformed").parts_by_id() is None
    store = TableStore(spark, str(tmp_path))
    build.run_build(spark, feeds.feed_set, store, CONTRACT, "repaired", AS_OF, run_id="first")
    assert "key" not in store.manifest("first")["tables"]["bronze_orders"]


def test_texts_of_the_fact_are_made_behind_its_shuffle(spark, trade_dir, built):
    fact = built[0].read("gold_fact_sales", "first")
    sales = TableStore(spark, built[0].root).read_bucketed("silver_reconciled_sales", "first")
    refs = TradeFeeds(spark, trade_dir).references
    dims = (refs["dates"], refs["regions"], refs["categories"])
    assert "pipeline_run_id" not in star.keyed_sales(sales, *dims).columns
    assert same_rows(fact, star.fact_sales(sales, *dims, CONTRACT, "first"))
    # The codec of every stored table.
    names = {f.rsplit("/", 1)[1] for f in fact.inputFiles()}
    assert names and all(n.endswith(".zstd.parquet") for n in names)


def test_a_build_writes_no_dictionaries_of_nearly_unique_columns(spark, trade_dir, built):
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    for table, unique, time in (
        ("bronze_orders", "event_id", "order_timestamp_utc"),
        ("silver_order_versions", "order_id", "source_updated_at"),
        ("gold_fact_sales", "order_key", "order_source_updated_at"),
    ):
        found = glob.glob(f"{built[0].path(table, 'first')}/**/*.parquet", recursive=True)
        group = pq.ParquetFile(found[0]).metadata.row_group(0)
        columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
        assert not [e for e in columns[unique].encodings if "DICTIONARY" in e]
        assert [e for e in columns["source_system" if "source_system" in columns else "original_currency"].encodings if "DICTIONARY" in e]
        assert columns[time].physical_type == "INT64"
    # The session's own setting is back.
    assert before == spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"


def test_joins_of_small_buckets_sort_neither_side(spark, trade_dir, built, no_broadcast, monkeypatch):
    feeds = TradeFeeds(spark, trade_dir)
    hashed = feeds.orders(feeds.parts_by_id())
    assert "ShuffledHashJoin" in plan(hashed)
    monkeypatch.setattr("plumbline.sources.trade.HASHED_ROWS", 1)
    sorted_ = feeds.orders(feeds.parts_by_id())
    assert "ShuffledHashJoin" not in plan(sorted_) and same_rows(hashed, sorted_)
    store = TableStore(spark, built[0].root)
    returns = store.read_bucketed("silver_latest_returns", "first")
    latest = store.read_bucketed("silver_order_versions", "first").filter("is_latest")
    both = [
        silver.reconcile_stored(Stored.split(returns, "hot_order", "order_id", [], h), latest)
        for h in (True, False)
    ]
    assert "Sort" not in plan(both[0]) and "SortMergeJoin" in plan(both[1]) and same_rows(*both)


def test_only_keys_that_were_not_dealt_out_are_counted_in_a_build(spark, trade_dir, built, tmp_path, monkeypatch):
    counted = []

    def no_hot(df, *columns):
        counted.append((columns, "event_id" in df.columns))
        return {c: [] for c in columns}

    monkeypatch.setattr(build, "hot_keys", no_hot)
    run(spark, trade_dir, TableStore(spark, f"{tmp_path}/dealt"), run_id="first")
    assert counted == [(("order_id",), False)]
    feeds = TradeFeeds(spark, trade_dir)
    monkeypatch.setattr(feeds, "hot_order_ids", lambda: ["7"])
    store = TableStore(spark, f"{tmp_path}/not")
    build.run_build(spark, feeds.feed_set, store, CONTRACT, "repaired", AS_OF, run_id="first")
    assert sorted(counted[1:]) == [(("order_id",), False), (("order_id",), True)]
    assert same_rows(built[0].read("gold_fact_sales", "first"), store.read("gold_fact_sales", "first"))


def test_a_build_keeps_statistics_only_where_they_can_skip_a_file(built):
    for table, without, kept in (
        ("bronze_orders", {"order_id", "event_id", "source_system"}, "region_code"),
        ("gold_fact_sales", {"order_key", "pipeline_run_id"}, "date_key"),
    ):
        found = glob.glob(f"{built[0].path(table, 'first')}/**/*.parquet", recursive=True)
        group = pq.ParquetFile(found[0]).metadata.row_group(0)
        columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
        assert not [c for c in without if columns[c].statistics and columns[c].statistics.has_min_max]
        assert columns[kept].statistics.has_min_max
