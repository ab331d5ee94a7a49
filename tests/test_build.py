"""The build job, its records, and serving behind the health gate."""

from __future__ import annotations

import itertools
import re
from datetime import datetime, timedelta

import pytest
from conftest import dec, multiset
from pyspark.sql import functions as F

from plumbline.contracts import FX_RATES
from plumbline.operators.audits import same_rows
from plumbline.plans import measures, narration, serving
from plumbline.plans.build import BuildFailed, ProductBlocked, run_build
from plumbline.plans.product import Question, open_product
from plumbline.sources.feeds import MissingExtract
from plumbline.sources.store import HEALTH, RUNS, TableStore
from plumbline.sources.trade import AS_OF, CONTRACT, MONTH, REGION, TradeFeeds

QUESTION = Question(REGION, MONTH)


def ticking(start="2026-01-01 00:00:00"):
    ticks = (datetime.fromisoformat(start) + timedelta(seconds=i) for i in itertools.count())
    return lambda: next(ticks)


@pytest.fixture(scope="module")
def clock():
    return ticking()


def make(spark, directory, store, variant, clock, **options):
    feeds = TradeFeeds(spark, directory, variant)
    return run_build(
        spark, feeds.feed_set, store, CONTRACT, variant, AS_OF, clock=clock, **options
    )


@pytest.fixture(scope="module")
def built(spark, trade_dir, tmp_path_factory, clock):
    """One broken run followed by a repaired one in the same history."""
    store = TableStore(spark, str(tmp_path_factory.mktemp("store")))
    first = make(spark, trade_dir, store, "broken", clock)
    blocked = open_product(store, CONTRACT)
    # Frames are lazy: keep what the test needs of the blocked state.
    seen = {
        "status": blocked.status,
        "sales": blocked.fact_sales.count(),
        "stored": store.read("gold_fact_sales", first.run_id).count(),
        "answer": serving.governed_answer(blocked, QUESTION).count(),
        "categories": serving.category_variance(blocked, QUESTION).count(),
        "lineage": serving.source_lineage(blocked, QUESTION).count(),
        "refusal": serving.ask_governed(blocked, QUESTION).first(),
        "health": serving.health_report(blocked).first(),
        "trusted": measures.measures(blocked).first(),
        "raw": serving.raw_facts(serving.raw_answer(blocked, QUESTION)).first(),
    }
    second = make(spark, trade_dir, store, "repaired", clock)
    return store, first, second, seen


def test_blocked_product_serves_nothing(built):
    _, first, _, seen = built
    assert first.status == seen["status"] == "BLOCKED"
    assert seen["sales"] == seen["stored"] == seen["answer"] == seen["categories"] == 0
    assert seen["lineage"] == 0
    refusal = seen["refusal"]
    assert refusal["kind"] == "REFUSAL" and refusal["net_revenue_cad"] is None
    assert refusal["message"].startswith("I cannot provide a reliable answer because ")
    assert "the returns feed is stale" in refusal["message"]
    assert "duplicate order events were detected" in refusal["message"]
    assert refusal["reason_count"] == 4
    assert seen["trusted"]["net_revenue_cad_trusted"] is None
    assert seen["trusted"]["data_product_status"] == "BLOCKED"


def test_health_counters_of_the_broken_feeds(built):
    health = built[3]["health"]
    assert health["returns_freshness_minutes"] == 3600
    assert health["missing_fx_count"] == 14
    assert health["orphan_return_count"] == 134
    assert health["duplicate_count"] == 2637
    assert health["last_successful_refresh_utc"] is None
    assert [r.split(":")[0] for r in health["blocking_reasons"]] == [
        "RETURNS_FRESHNESS",
        "MISSING_FX",
        "ORPHAN_RETURNS",
        "UNSUPPORTED_CURRENCY",
    ]


def test_repair_makes_the_product_ready(built):
    store, _, second, _ = built
    product = open_product(store, CONTRACT)
    assert second.status == product.status == "READY"
    assert [r["status"] for r in serving.run_list(product).collect()] == ["READY", "BLOCKED"]
    run = serving.run_list(product).first()
    assert run["bronze_order_rows"] == 4032 and run["bronze_return_rows"] == 1818
    assert run["silver_sales_rows"] == 1111 and run["freshness_minutes"] == 45
    assert re.fullmatch(r"run-\d{8}T\d{6}Z-repaired-[0-9a-f]{6}", run["pipeline_run_id"])
    assert run["completed_at_utc"] >= run["started_at_utc"] and run["duration_ms"] >= 0
    health = product.health.first()
    assert health["last_successful_refresh_utc"] == run["completed_at_utc"]


def test_answers_agree_with_each_other(built):
    product = open_product(built[0], CONTRACT)
    answer = serving.governed_answer(product, QUESTION).first()
    facts = serving.governed_facts(product, QUESTION).first()
    per_category = serving.category_variance(product, QUESTION).collect()
    assert answer["governed_orders"] == 9
    assert answer["net_revenue_cad"] == answer["gross_revenue_cad"] - answer["returns_cad"]
    for column in set(answer.asDict()) & set(facts.asDict()):
        assert answer[column] == facts[column], column
    assert sum(r["net_revenue_cad"] for r in per_category) == answer["net_revenue_cad"]
    assert per_category == sorted(
        per_category, key=lambda r: (r["variance_cad"], r["category_code"])
    )
    worst = serving.largest_negative(product, QUESTION).first()
    assert worst["category_code"] == facts["worst_code"] == per_category[0]["category_code"]
    assert facts["source_lineage"].split(" | ") == [
        r["source_system"] for r in serving.lineage_systems(product, QUESTION).collect()
    ]
    total = measures.measures(
        product, ["region", "month"], {"region": [REGION], "month": [MONTH]}
    ).first()
    assert total["net_revenue_cad"] == answer["net_revenue_cad"]
    assert total["largest_negative_category"] == worst["category_name"]


def test_measure_grains_add_up(built):
    product = open_product(built[0], CONTRACT)
    whole = measures.measures(product).first()
    for by in (["region"], ["month", "category"], ["day"]):
        parts = measures.measures(product, by).agg(
            F.sum("net_revenue_cad"), F.sum("revenue_target_cad")
        ).first()
        assert tuple(parts) == (whole["net_revenue_cad"], whole["revenue_target_cad"])
    with pytest.raises(ValueError):
        measures.measures(product, ["planet"])


def test_raw_answer_ignores_returns_and_the_gate(built):
    product = open_product(built[0], CONTRACT)
    raw = serving.raw_answer(product, QUESTION)
    after = serving.raw_facts(raw).first()
    before = built[3]["raw"]
    assert before["revenue"] == after["revenue"]
    assert after["driver_code"] == serving.raw_categories(raw).first()["category_code"]
    notes = {r["aspect"]: r["note"] for r in serving.raw_governance(serving.raw_facts(raw)).collect()}
    assert notes["Returns"] == "not consulted"
    assert f"{after['non_cad_rows']} non-CAD rows" in notes["Currency handling"]


def test_question_without_figures_is_refused(built):
    product = open_product(built[0], CONTRACT)
    row = serving.ask_governed(product, Question(REGION, "2030-01")).first()
    assert row["kind"] == "REFUSAL" and serving.NOT_SERVED in row["message"]


def test_forged_status_does_not_pass_the_gate(built, spark, trade_dir, tmp_path, clock):
    import dataclasses

    store = TableStore(spark, str(tmp_path))
    make(spark, trade_dir, store, "broken", clock)
    forged = dataclasses.replace(open_product(store, CONTRACT), status="READY")
    assert serving.ask_governed(forged, QUESTION).count() == 0
    assert serving.governed_facts(forged, QUESTION).count() == 0


@pytest.mark.parametrize("status", ["RUNNING", "FAILED", "BLOCKED"])
def test_any_other_status_refuses(built, status):
    store, _, second, _ = built
    record = {**second.health, "status": status, "blocking_reasons": ""}
    history = f"copy-{status}"
    now = datetime(2026, 5, 1)
    store.append_event(RUNS, {"pipeline_run_id": second.run_id, "status": "READY",
                              "completed_at_utc": now}, history, 1, now)
    store.append_event(HEALTH, record, history, 1, now)
    product = open_product(store, CONTRACT, history)
    row = serving.ask_governed(product, QUESTION).first()
    assert row["kind"] == "REFUSAL"
    assert f"the data product status is {status}, not READY" in row["message"]
    assert product.fact_sales.count() == 0
    assert serving.raw_answer(product, QUESTION).count() > 0


def test_missing_health_record_is_refused(spark, tmp_path):
    product = open_product(TableStore(spark, str(tmp_path)), CONTRACT)
    row = serving.ask_governed(product, QUESTION).first()
    assert (row["status"], row["pipeline_run_id"]) == ("UNKNOWN", "none")
    assert "no data-product health record exists" in row["message"]
    assert measures.status_measures(product).first()["data_product_status"] == "UNKNOWN"


def test_rerun_gives_the_same_figures(built, spark, trade_dir, clock):
    store, _, second, _ = built
    history = "rerun"
    again = make(spark, trade_dir, store, "repaired", clock, history=history)
    assert again.run_id != second.run_id
    for table in ("gold_fact_sales", "silver_order_versions", "silver_quarantine"):
        left, right = store.read(table, second.run_id), store.read(table, again.run_id)
        assert same_rows(left, right, ["pipeline_run_id"]), table
    # Replacing the tables of one run id changes nothing either.
    make(spark, trade_dir, store, "repaired", clock, history=history, run_id=again.run_id)
    assert store.read("silver_orders", again.run_id).count() == 1111
    assert store.current(RUNS, history).count() == 1


def test_a_new_history_starts_empty(built, spark, trade_dir, clock):
    store = built[0]
    make(spark, trade_dir, store, "broken", clock, history="fresh")
    product = open_product(store, CONTRACT, "fresh")
    assert [r["status"] for r in product.runs.collect()] == ["BLOCKED"]
    assert product.health.first()["last_successful_refresh_utc"] is None


def test_failure_is_recorded_and_refused(built, spark, clock):
    store, history = built[0], "failing"

    def explode():
        # RUNNING is on record before any feed is read.
        assert store.current(HEALTH, history).first()["status"] == "RUNNING"
        raise MissingExtract("repaired returns extract missing")

    with pytest.raises(BuildFailed, match="repaired returns extract missing"):
        run_build(spark, explode, store, CONTRACT, "repaired", AS_OF, history=history, clock=clock)
    product = open_product(store, CONTRACT, history)
    assert product.status == "FAILED"
    assert "repaired returns extract missing" in serving.run_list(product).first()["failure_reasons"][0]
    assert serving.ask_governed(product, QUESTION).first()["kind"] == "REFUSAL"
    with pytest.raises(ValueError):
        run_build(spark, explode, store, CONTRACT, "halfway", AS_OF)


def test_blocked_build_can_raise_after_recording(built, spark, trade_dir, clock):
    store, history = built[0], "raising"
    with pytest.raises(ProductBlocked, match="RETURNS_FRESHNESS"):
        make(spark, trade_dir, store, "broken", clock, history=history, raise_when_blocked=True)
    assert open_product(store, CONTRACT, history).status == "BLOCKED"


def test_repeated_rates_block_through_duplicate_keys(built, spark, trade_dir, clock):
    """Two rates for one day repeat orders; the duplicate-key check stops the product."""
    from dataclasses import replace

    def load():
        feeds = TradeFeeds(spark, trade_dir, "repaired").feed_set()
        return replace(feeds, fx_rates=feeds.fx_rates.unionByName(feeds.fx_rates.limit(1500)))

    result = run_build(spark, load, built[0], CONTRACT, "repaired", AS_OF, history="rates", clock=clock)
    assert result.status == "BLOCKED"
    assert result.health["blocking_reasons"].startswith("DUPLICATE_BUSINESS_KEYS: ")
    assert FX_RATES.business_key == ("rate_date", "from_currency", "to_currency")


def test_narration_uses_the_figures(built):
    product = open_product(built[0], CONTRACT)
    facts = serving.governed_facts(product, QUESTION)
    text = narration.narrate_governed(facts, QUESTION, "America").first()["text"]
    row = facts.first()
    assert f"{row['net_revenue_cad']:,.2f}" in text and row["pipeline_run_id"] in text
    assert text.startswith("Yes. America beat" if row["beat_target"] else "No. America missed")
    raw_facts = serving.raw_facts(serving.raw_answer(product, QUESTION))
    raw = narration.narrate_raw(raw_facts, QUESTION, "America").first()["text"]
    assert f"{raw_facts.first()['revenue']:,.2f}" in raw and "May 1998 revenue target" in raw
    packed = narration.facts_json(facts, "governed").first()["facts"]
    assert f'"net_revenue_cad":"{row["net_revenue_cad"]}"' in packed
    assert '"answer_path":"governed"' in packed


def test_raw_driver_when_the_target_is_missed(spark):
    raw = spark.createDataFrame(
        [("A", "Alpha", 2, 1, dec("80.00"), dec("100.00"), None),
         ("B", "Beta", 1, 0, dec("10.00"), dec("10.00"), None)],
        "category_code STRING, category_name STRING, order_rows BIGINT, non_cad_rows BIGINT, "
        "revenue DECIMAL(18,2), target_cad DECIMAL(18,2), latest_ingested_at TIMESTAMP",
    )
    facts = serving.raw_facts(raw).first()
    assert not facts["beat_target"] and facts["driver_code"] == "A"
    assert facts["variance_pct"] == dec("-18.18")
    equal = raw.filter("category_code = 'B'")
    assert serving.raw_facts(equal).first()["beat_target"] is False  # beat is strictly greater
    assert serving.raw_facts(raw.filter("false")).count() == 0


def test_facts_are_partitioned_and_pruned_by_month(built):
    product = open_product(built[0], CONTRACT)
    plan = serving._sales_cells(product, QUESTION)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_month" in plan
    assert multiset(product.fact_sales.select("sales_month").distinct())


@pytest.mark.parametrize("by", [[], ["region"], ["region", "month"], ["month", "category"], ["category"], ["region", "month", "category"]])
def test_cube_holds_every_grain(built, by):
    product = open_product(built[0], CONTRACT)
    one = measures.measures(product, by)
    grain = ",".join(measures.GRAINS[name][2] for name in by)
    cells = measures.measure_cube(product).filter(F.col("grain") == grain)
    assert multiset(cells, sorted(one.columns)) == multiset(one)


def test_cube_reads_each_fact_once(built):
    cube = measures.measure_cube(open_product(built[0], CONTRACT))
    plan = cube._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[[^\]]*\]", plan)
    assert sum("gross_revenue_cad#" in s for s in scans) == 1
    assert sum("target_cad#" in s for s in scans) == 1


def test_nested_facts_are_read_back_and_ground_the_text(built):
    from plumbline.operators.scans import ungrounded_numbers

    product = open_product(built[0], CONTRACT)
    raw = serving.raw_answer(product, QUESTION)
    facts, categories = serving.raw_facts(raw), serving.raw_categories(raw)
    driver = ["driver_code", "driver_name", "driver_variance_cad"]
    nested = narration.with_categories(facts, categories, driver).withColumn("month", F.lit(MONTH))
    told = narration.facts_json(nested, "raw")
    read = narration.read_facts(told, nested.schema)
    assert read.schema.simpleString() == nested.schema.simpleString()
    assert read.first() == nested.first()
    assert len(read.first()["categories"]) == categories.count()
    text = narration.narrate_raw(facts, QUESTION, "America").select("text")
    checked = ungrounded_numbers(text.crossJoin(told), "text", "facts").first()
    assert checked["ungrounded"] == []
    forged = text.crossJoin(told).withColumn("text", F.concat("text", F.lit(" Also 987654.32.")))
    assert ungrounded_numbers(forged, "text", "facts").first()["ungrounded"] == ["987654.32"]


def test_build_from_extracts_keeps_rejects_apart(spark, trade_dir, built, tmp_path, clock):
    from plumbline.sources.feeds import read_extracts, write_extracts

    root = str(tmp_path / "extracts")
    write_extracts(TradeFeeds(spark, trade_dir, "repaired").feed_set(), root, "repaired")
    from plumbline.contracts import ORDERS

    with open(f"{root}/azure-sql/orders.csv/part-more.csv", "w", encoding="utf-8") as out:
        out.write(",".join(ORDERS.column_names) + "\n")
        out.write("9,E,not-a-number,2001-01-01,ON,DEV,CAD,1.00,Consumer,2001-01-01,2001-01-01\nonly,three,fields\n")
    store = TableStore(spark, str(tmp_path / "product"))
    load = lambda keep: read_extracts(spark, root, "repaired", keep_rejects=keep)
    result = run_build(spark, lambda: load(True), store, CONTRACT, "repaired", AS_OF, clock=clock)
    assert result.status == "READY"
    rejects = store.read("bronze_rejects", result.run_id)
    assert sorted(r["record"].split(",")[0] for r in rejects.collect()) == ["9", "only"]
    assert {r["feed"] for r in rejects.collect()} == {"orders"}
    assert store.measured("bronze_rejects", result.run_id)["rows"] == 2
    for table in ("gold_fact_sales", "silver_quarantine"):
        assert same_rows(store.read(table, result.run_id), built[0].read(table, built[2].run_id), ["pipeline_run_id"]), table
    # Without the choice to keep them, malformed records still fail the build.
    with pytest.raises(BuildFailed):
        run_build(spark, lambda: load(False), store, CONTRACT, "repaired", AS_OF, history="strict", clock=clock)


def test_extracts_are_written_compressed_and_read_back_whole(spark, trade_dir, tmp_path):
    from plumbline.sources.feeds import read_extracts, write_extracts

    feeds = TradeFeeds(spark, trade_dir, "repaired").feed_set()
    write_extracts(feeds, str(tmp_path), "repaired")
    read = read_extracts(spark, str(tmp_path), "repaired", keep_rejects=True)
    assert read.rejects.count() == 0
    for name in ("orders", "returns"):
        written, back = getattr(feeds, name), getattr(read, name)
        assert all(f.endswith(".csv.gz") for f in back.inputFiles()), name
        assert same_rows(written, back, ["source_system", "source_file"]), name
