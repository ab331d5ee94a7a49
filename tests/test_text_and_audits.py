"""Text functions, scans, feeds and table audits."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import dec, multiset, rows, ts
from pyspark.sql import functions as F

from plumbline.contracts import FX_RATES, ORDERS, FeedContract, Column, HealthContract
from plumbline.functions import columns as c
from plumbline.operators import audits, scans
from plumbline.operators.joins import Lookup
from plumbline.sources.calendar import date_dimension
from plumbline.sources.feeds import MissingExtract, read_extract, snapshot_at


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def money(text):
    return F.lit(text).cast("decimal(18,2)")


@pytest.mark.parametrize(
    ("amount", "signed", "text"),
    [
        ("1234567.80", False, "CAD 1,234,567.80"),
        ("-9696.55", False, "−CAD 9,696.55"),
        ("0.00", True, "+CAD 0.00"),
        ("-0.05", True, "−CAD 0.05"),
    ],
)
def test_money_text(spark, amount, signed, text):
    assert value(spark, c.cad(money(amount), signed)) == text


def test_percent_text(spark):
    assert value(spark, c.pct(money("-2.29"))) == "−2.29%"
    assert value(spark, c.pct(money("1234.50"))) == "+1234.50%"
    assert value(spark, c.percent_of(money("1"), money("0"))) is None


@pytest.mark.parametrize(("parts", "text"), [([], ""), (["a"], "a"), (["a", "b"], "a and b"), (["a", "b", "c"], "a, b and c")])
def test_sentence_list(spark, parts, text):
    array = F.lit(parts).cast("array<string>") if parts else F.array().cast("array<string>")
    assert value(spark, c.sentence_list(array)) == text


def test_reasons(spark):
    text = "A_B: first: thing |  | C: second | plain"
    array = c.split_reasons(F.lit(text))
    assert value(spark, array) == ["A_B: first: thing", "C: second", "plain"]
    assert value(spark, c.reason_texts(array)) == ["first: thing", "second", "plain"]
    assert value(spark, c.split_reasons(F.lit(None).cast("string"))) == []


def test_times(spark):
    moment = c.parse_utc(F.lit("2026-09-26T18:00:00Z"))
    assert value(spark, c.format_utc(moment)) == "2026-09-26 18:00:00 UTC"
    assert value(spark, c.iso_z(moment)) == "2026-09-26T18:00:00Z"
    assert value(spark, c.format_utc(c.parse_utc(F.lit(" ")))) == "never"
    assert value(spark, c.to_cents(money("0.25"), F.lit("2.5").cast("decimal(10,6)"))) == dec("0.63")


def test_secret_scan_reports_every_pattern_with_its_line(spark):
    lines = [
        "-----BEGIN RSA PRIVATE KEY-----",
        "Password = hunter22",
        "AccountKey=" + "A" * 24,
        "https://x?sig=" + "b" * 24,
        "key AKIA" + "A" * 16,
        "gh" + "p_" + "a" * 32,
        "sk-" + "a" * 24,
        "xox" + "b-" + "1" * 12,
        "client_secret: " + "z" * 10,
        "nothing here, pwd = x",
    ]
    df = spark.createDataFrame([(1, "\r\n".join(lines)), (2, "clean"), (3, None)], "id INT, t STRING")
    got = {(r["line_number"], r["pattern"]) for r in scans.scan_patterns(df, "id", "t").collect()}
    assert got == {(i, n) for i, n in enumerate(scans.SECRET_PATTERNS, start=1)}
    twice = scans.scan_patterns(df, "id", "t", {"a": "pwd", "b": "here"})
    assert rows(twice.select("pattern")) == [{"pattern": "a"}, {"pattern": "b"}]


@pytest.mark.parametrize(
    ("text", "unknown"),
    [
        ("Net revenue CAD 320,475.66 (-2.29%) for August 2026.", []),
        ("about 320,475 and 2", []),
        ("Net revenue CAD 330,000.00", ["330000.00"]),
        ("1,500 or 1500 or 7 or 7", ["7"]),
        (None, []),
    ],
)
def test_grounded_numbers(spark, text, unknown):
    facts = '{"net": "320475.66", "pct": "-2.29", "n": "1500.00"} August 2026'
    df = spark.createDataFrame([(text, facts)], "t STRING, f STRING")
    assert scans.ungrounded_numbers(df, "t", "f").first()["ungrounded"] == unknown


def test_diff_by_key_and_by_row(spark):
    ddl = "k INT, v STRING, run STRING"
    left = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (4, "d", "x"), (4, "d", "x")], ddl)
    right = spark.createDataFrame([(1, "a", "y"), (2, "B", "y"), (5, "e", "y"), (4, "d", "y")], ddl)
    got = {r["k"]: (r["difference"], r["left_rows"], r["right_rows"]) for r in audits.table_diff(left, right, ["k"], ["run"]).collect()}
    assert got == {2: ("changed", 1, 1), 3: ("left_only", 1, 0), 4: ("left_only", 1, 0), 5: ("right_only", 0, 1)}
    assert not audits.same_rows(left, right, ["run"])
    assert audits.same_rows(left, left.repartition(3))


def test_manifest_hash_ignores_order_and_sees_changes(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(50)], "k INT, v DOUBLE")
    one = audits.table_manifest({"t": df}, {"t": "v"}).first()
    same = audits.table_manifest({"t": df.orderBy(F.desc("k")).repartition(5)}, {"t": "v"}).first()
    other = audits.table_manifest({"t": df.filter("k <> 7").unionByName(df.filter("k = 8"))}, {"t": "v"}).first()
    assert one == same and one["rows"] == other["rows"] and one["cents"] == 122500
    assert one["content_hash"] != other["content_hash"]


def test_rate_gaps(spark):
    used = spark.createDataFrame(
        [(date(2026, 8, d), cur) for d, cur in ((1, "USD"), (2, "USD"), (2, "USD"), (3, "CAD"), (4, "EUR"))],
        "order_date DATE, currency_code STRING",
    )
    rates = spark.createDataFrame(
        [(date(2026, 8, 1), "USD", "CAD", dec("1.3")), (date(2026, 8, 2), "USD", "EUR", dec("1"))],
        "rate_date DATE, from_currency STRING, to_currency STRING, rate DECIMAL(10,6)",
    )
    got = rows(audits.rate_gaps(used, rates, HealthContract()))
    assert got == [{"order_date": date(2026, 8, 2), "currency_code": "USD", "transactions": 2}]


def test_conformance(spark):
    feed = FeedContract(
        "f", "t", "p", "s",
        (Column("id", "STRING"), Column("note", "STRING", required=False),
         Column("region_code", "STRING", references="regions.region_code"),
         Column("currency_code", "STRING"), Column("n", "INT")),
        business_key=("id",),
    )
    df = spark.createDataFrame(
        [("a", None, "ON", "CAD", 1), ("a", None, "ZZ", "EUR", 1), (None, None, None, None, 1)],
        "id STRING, note STRING, region_code STRING, currency_code STRING, n BIGINT",
    )
    refs = Lookup.checked({"regions": spark.createDataFrame([("ON",), ("ON",)], "region_code STRING")})
    got = {r["rule"]: r["violations"] for r in audits.contract_conformance(feed, df, refs, HealthContract()).collect()}
    assert got == {
        "required.id": 1, "required.region_code": 1, "reference.region_code": 1,
        "required.currency_code": 1, "accepted.currency_code": 1, "required.n": 0,
        "type.n": 3, "unique_key": 1,
    }


def test_literals_change_no_hit(spark):
    """The same hits with and without literals, over texts that just hold or just miss them."""
    body = [
        "-----BEGIN RSA PRIVATE KEY-----\nPassWord = 'abcdef'\nPRIVATE KEY-----",
        "pwd\n=abcdef\rPWD:abcdef\u2028AccountKey=" + "a" * 20, "AKIA" + "Z" * 16 + "\nakia" + "Z" * 16,
        "x?sig=" + "b" * 25 + "\n&sig=" + "c" * 19, "ghp_" + "d" * 30 + " ghx_" + "d" * 30, "sk-ant-" + "e" * 20,
        "xoxb-" + "1" * 10, "CLIENT_SECRET: abcdefgh", "nothing here", "", None, "Password=\u212Aelvin", "password",
    ]
    df = spark.createDataFrame(list(enumerate(body)), "id INT, text STRING")
    plain = multiset(scans.scan_patterns(df, "id", "text", scans.SECRET_PATTERNS, {}))
    assert multiset(scans.scan_patterns(df, "id", "text")) == plain and len(plain) >= 9
    assert set(scans.SECRET_LITERALS) == set(scans.SECRET_PATTERNS)
    own = {"password assignment": "secret"}  # another pattern under a known name keeps every hit
    one = spark.createDataFrame([(1, "a secret")], "id INT, text STRING")
    assert scans.scan_patterns(one, "id", "text", own).count() == 1
    plan = scans.scan_patterns(df, "id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Filter")  # texts are dropped before they are split


def test_unknown_keys_of_a_large_parent(spark):
    """A hot unknown key and a hot known one move as one row a task; NULL is no key and finds none."""
    child = spark.createDataFrame([("ghost",)] * 500 + [("a",)] * 500 + [(None,)] * 3 + [("lone",)], "order_id STRING")
    parent = spark.createDataFrame([("a",)] * 400 + [("b",), (None,)], "id STRING")
    found = audits.unknown_keys(child.repartition(4), "order_id", parent.repartition(4), "id")
    assert {r["order_id"]: r["rows"] for r in found.collect()} == {"ghost": 500, "lone": 1}
    empty = parent.limit(0)
    assert audits.unknown_keys(child, "order_id", empty, "id").count() == 3
    assert audits.unknown_keys(child.limit(0), "order_id", parent, "id").count() == 0


def test_conformance_with_a_large_parent(spark):
    feed = FeedContract(
        "f", "t", "p", "s", (Column("id", "STRING"), Column("order_id", "STRING", references="orders.id")), business_key=("id",)
    )
    df = spark.createDataFrame([("1", "a"), ("2", "x"), ("3", "x"), ("4", None)], "id STRING, order_id STRING")
    parents = {"orders": spark.createDataFrame([("a",), ("b",)], "id STRING")}
    got = {r["rule"]: r["violations"] for r in audits.contract_conformance(feed, df, {}, HealthContract(), parents).collect()}
    assert got == {"required.id": 0, "required.order_id": 1, "reference.order_id": 2, "unique_key": 0}


def test_allocation_adds_up(spark):
    net = spark.createDataFrame(
        [("ON", "ACC", dec("1234.56")), ("ON", "DEV", dec("5000.10")), ("ON", "SVC", dec("777.77")), ("QC", "ACC", dec("10.00"))],
        "region_code STRING, category_code STRING, net_cad DECIMAL(18,2)",
    )
    parts = audits.allocate_targets(net, "1.000")
    got = {(r["region_code"], r["category_code"]): r["target_cad"] for r in parts.collect()}
    assert got[("ON", "DEV")] == 5000 and got[("ON", "SVC")] == 800
    assert got[("ON", "ACC")] == 7000 - 5800 and got[("QC", "ACC")] == 0


def test_snapshot_is_cut_and_restamped(spark):
    df = spark.createDataFrame([(1, ts("2026-01-01 00:00:00")), (2, ts("2026-01-03 00:00:00"))], "k INT, source_updated_at TIMESTAMP")
    got = snapshot_at(df.withColumn("ingested_at", F.col("source_updated_at")), "2026-01-02 00:00:00")
    assert rows(got) == [{"k": 1, "source_updated_at": ts("2026-01-01 00:00:00"), "ingested_at": ts("2026-01-02 00:00:00")}]


def test_calendar(spark):
    days = date_dimension(spark, "2024-02-28", "2024-03-01").collect()
    assert [d["date_key"] for d in days] == [20240228, 20240229, 20240301]
    assert (days[1]["year_month"], days[1]["month_name"], days[1]["day_name"]) == ("2024-02", "February", "Thursday")


def write_rates(root, text):
    folder = root / "reference"
    folder.mkdir(parents=True)
    (folder / "fx_rates.repaired.csv").write_text(text, encoding="utf-8")
    return str(root)


HEADER = "rate_date,from_currency,to_currency,rate,published_at_utc,ingested_at\n"


def test_typed_extract_with_lineage(spark, tmp_path):
    root = write_rates(tmp_path, HEADER + "2026-08-01,USD,CAD,1.368900,2026-08-01T21:00:00Z,2026-09-26T17:00:00Z\n")
    row = read_extract(spark, FX_RATES, root, "repaired").first()
    assert (row["rate_date"], row["rate"]) == (date(2026, 8, 1), dec("1.368900"))
    assert row["published_at_utc"] == ts("2026-08-01 21:00:00")
    assert row["source_system"] == "treasury.reference.fx"
    assert row["source_file"] == "reference/fx_rates.repaired.csv"


def test_bad_extracts_fail(spark, tmp_path):
    with pytest.raises(MissingExtract):
        read_extract(spark, ORDERS, str(tmp_path))
    bad = write_rates(tmp_path / "a", HEADER + "2026-08-01,USD,CAD,abc,2026-08-01T21:00:00Z,2026-09-26T17:00:00Z\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_extract(spark, FX_RATES, bad, "repaired").collect()
    swapped = write_rates(tmp_path / "b", HEADER.replace("from_currency,to_currency", "to_currency,from_currency") + "2026-08-01,CAD,USD,1,2026-08-01T21:00:00Z,2026-09-26T17:00:00Z\n")
    with pytest.raises(Exception):
        read_extract(spark, FX_RATES, swapped, "repaired").collect()
