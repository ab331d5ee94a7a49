"""Check limits, texts, severities and the health roll-up."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from conftest import ORDER_DDL, RETURN_DDL, dec, order, returned, ts

from plumbline.contracts import Check, ContractError, HealthContract, MetricContract
from plumbline.operators import quality, silver
from plumbline.operators.joins import Lookup

CONTRACT = HealthContract()
AS_OF = "2026-09-26 18:00:00"


def evaluate(spark, observed, contract=CONTRACT):
    df = spark.createDataFrame(list(observed.items()), "check_name STRING, observed_value BIGINT")
    return {r["check_name"]: r for r in quality.evaluate(df, contract).collect()}


@pytest.mark.parametrize(
    ("minutes", "status"), [(239, "PASS"), (240, "PASS"), (241, "FAIL"), (-5, "PASS"), (None, "FAIL")]
)
def test_freshness_limit(spark, minutes, status):
    got = evaluate(spark, {"RETURNS_FRESHNESS": minutes})["RETURNS_FRESHNESS"]
    assert (got["status"], got["threshold"]) == (status, "<= 240 minutes")
    assert got["observed_value"] == minutes


@pytest.mark.parametrize(
    ("seconds", "minutes"), [(0, 0), (59, 0), (60, 1), (-1, -1), (-61, -2), (216000, 3600)]
)
def test_age_is_rounded_down(spark, seconds, minutes):
    newest = ts(AS_OF) - timedelta(seconds=seconds)
    feed = spark.createDataFrame([(newest,), (newest - timedelta(days=9),)], "ingested_at TIMESTAMP")
    row = quality.freshness(feed, AS_OF, "ORDERS_FRESHNESS").first()
    assert row["value"] == minutes


def test_age_without_rows_is_missing(spark):
    feed = spark.createDataFrame([], "ingested_at TIMESTAMP")
    assert quality.freshness(feed, AS_OF, "ORDERS_FRESHNESS").first()["value"] is None


def test_severity_decides_between_fail_and_warn(spark):
    lenient = CONTRACT.with_values(
        checks=(Check("MISSING_FX", "WARNING"), Check("ORPHAN_RETURNS", "BLOCKING"))
    )
    got = evaluate(spark, {"MISSING_FX": 1, "ORPHAN_RETURNS": 1}, lenient)
    assert got["MISSING_FX"]["status"] == "WARN" and got["ORPHAN_RETURNS"]["status"] == "FAIL"
    assert set(got) == {"MISSING_FX", "ORPHAN_RETURNS"}


def test_texts(spark):
    got = evaluate(
        spark,
        {
            "ORDERS_FRESHNESS": None,
            "RETURNS_FRESHNESS": 3600,
            "DUPLICATE_BUSINESS_KEYS": 1,
            "MISSING_FX": 3,
            "ORPHAN_RETURNS": 1,
            "UNSUPPORTED_CURRENCY": 1234,
            "HIGH_RETURN_RATE": 26,
            "VOLUME_ANOMALY": 2,
        },
    )
    assert got["ORDERS_FRESHNESS"]["detail"] == "no orders extract has been ingested"
    assert got["RETURNS_FRESHNESS"]["detail"] == (
        "the returns feed is stale (last extract 3,600 minutes old; SLA 240 minutes)"
    )
    assert got["DUPLICATE_BUSINESS_KEYS"]["detail"] == (
        "1 business key remains duplicated after Silver processing"
    )
    assert "3 orders have no transaction-date FX rate" in got["MISSING_FX"]["detail"]
    assert got["ORPHAN_RETURNS"]["detail"].startswith("1 return references an unknown order")
    assert got["UNSUPPORTED_CURRENCY"]["detail"] == "1,234 rows use a currency outside CAD, USD"
    assert got["HIGH_RETURN_RATE"]["detail"] == (
        "the highest category return rate is 26% (warning above 25%)"
    )
    assert got["HIGH_RETURN_RATE"]["status"] == "WARN"
    assert got["VOLUME_ANOMALY"]["detail"] == (
        "2 category days exceed 3x the average daily volume"
    )
    assert got["QUARANTINED_ROWS"]["detail"] == "no rows quarantined"


def test_health_roll_up(spark):
    observed = {
        "ORDERS_FRESHNESS": 30,
        "RETURNS_FRESHNESS": 3600,
        "DUPLICATE_BUSINESS_KEYS": 2,
        "ORPHAN_RETURNS": 1,
        "DUPLICATES_RESOLVED": 5,
    }
    df = spark.createDataFrame(list(observed.items()), "check_name STRING, observed_value BIGINT")
    health = quality.summarise(quality.evaluate(df, CONTRACT)).first()
    assert health["status"] == "BLOCKED"
    assert [r.split(":")[0] for r in health["blocking_reasons"].split(" | ")] == [
        "RETURNS_FRESHNESS",
        "DUPLICATE_BUSINESS_KEYS",
        "ORPHAN_RETURNS",
    ]
    assert health["warning_reasons"].startswith("DUPLICATES_RESOLVED: 5 duplicate")
    assert health["duplicate_count"] == 7
    assert health["missing_fx_count"] == 0


def test_health_is_ready_with_warnings_only(spark):
    df = spark.createDataFrame(
        [("ORDERS_FRESHNESS", 1), ("RETURNS_FRESHNESS", 1), ("QUARANTINED_ROWS", 4)],
        "check_name STRING, observed_value BIGINT",
    )
    health = quality.summarise(quality.evaluate(df, CONTRACT)).first()
    assert (health["status"], health["blocking_reasons"]) == ("READY", "")


@pytest.mark.parametrize(("returned_cad", "rate"), [("25.40", 25), ("25.60", 26), ("0.00", 0)])
def test_return_rate_is_rounded_before_the_test(spark, returned_cad, rate):
    sales = spark.createDataFrame(
        [("DEV", dec("100.00"), dec(returned_cad)), ("ACC", dec("0.00"), dec("0.00")),
         ("DEV", None, None)],
        "category_code STRING, gross_revenue_cad DECIMAL(18,2), returns_cad DECIMAL(18,2)",
    )
    assert quality.return_rate(sales).first()["value"] == rate


def test_return_rate_without_sales_is_zero(spark):
    sales = spark.createDataFrame(
        [], "category_code STRING, gross_revenue_cad DECIMAL(18,2), returns_cad DECIMAL(18,2)"
    )
    assert quality.return_rate(sales).first()["value"] == 0


@pytest.mark.parametrize(("peak", "days"), [(9, 0), (10, 1)])
def test_volume_must_exceed_the_factor(spark, peak, days):
    # Four active days; a peak of 9 with three days of 1 has mean 3: exactly three times.
    rows = [("DEV", date(2026, 8, d)) for d in (1, 2, 3)] + [("DEV", date(2026, 8, 9))] * peak
    df = spark.createDataFrame(rows, "category_code STRING, order_date DATE")
    got = quality.volume_anomaly(df, CONTRACT).first()["value"]
    assert got == (1 if peak > 3 * (peak + 3) / 4 else 0) == days


@pytest.fixture(scope="module")
def tables(spark):
    orders = spark.createDataFrame(
        [
            order("A", "E1"),
            order("A", "E2", 2),
            order("B", region_code="ZZ"),
            order("C", category_code="XXX"),
            order("D", currency_code="EUR"),
            order("F", currency_code="USD"),
            order(None, "E1"),
            order(None, "E2"),
            order("T", customer_segment="Internal Test"),
        ],
        ORDER_DDL,
    )
    returns = spark.createDataFrame(
        [
            returned("R1", "A"),
            returned("R1", "A"),
            returned("R2", "nowhere"),
            returned("R3", "A", currency_code=None),
            returned("R4", "A", "0.00"),
        ],
        RETURN_DDL,
    )
    refs = Lookup.checked(
        {
            "regions": spark.createDataFrame([("ON",), ("ON",)], "region_code STRING"),
            "categories": spark.createDataFrame([("DEV",)], "category_code STRING"),
            "rates": spark.createDataFrame(
                [],
                "rate_date DATE, from_currency STRING, to_currency STRING, rate DECIMAL(10,6)",
            ),
        }
    )
    latest = silver.latest_orders(orders, CONTRACT)
    governed = silver.governed_orders(latest)
    reconciled = silver.reconcile_returns(returns, latest)
    sales = silver.price_sales(governed, reconciled, refs["rates"], CONTRACT)
    return quality.SilverTables(
        orders, returns, latest, governed, reconciled, sales, refs["regions"], refs["categories"]
    )


def test_observed_values(tables):
    got = {
        r["check_name"]: r["observed_value"]
        for r in quality.observe(tables, CONTRACT, "2026-08-05 10:07:30").collect()
    }
    assert got == {
        "ORDERS_FRESHNESS": 7,
        "RETURNS_FRESHNESS": 7,
        "DUPLICATE_BUSINESS_KEYS": 0,
        "MISSING_FX": 1,  # the USD order; EUR is not an accepted currency
        "ORPHAN_RETURNS": 1,
        "MISSING_REQUIRED_KEYS": 3,  # region ZZ, category XXX, one NULL key
        "UNSUPPORTED_CURRENCY": 2,  # one EUR order, one return without a currency
        "DUPLICATES_RESOLVED": 2,  # version 1 of A, the other NULL key
        "QUARANTINED_ROWS": 2,
        "HIGH_RETURN_RATE": 7,
        "VOLUME_ANOMALY": 0,
    }


def test_contract_rejects_unknown_severity_and_checks():
    with pytest.raises(ContractError):
        Check("MISSING_FX", "SEVERE")
    with pytest.raises(ContractError):
        HealthContract(checks=(Check("NO_SUCH_CHECK", "WARNING"),))
    with pytest.raises(ContractError):
        CONTRACT.with_values(checks=()).severity("MISSING_FX")


def test_contract_key_values_round_trip(spark):
    frame = CONTRACT.key_value_frame(spark, MetricContract())
    again = HealthContract.from_key_values(frame, CONTRACT.data_product)
    assert [(c.name, c.severity) for c in again.checks] == [
        (c.name, c.severity) for c in CONTRACT.checks
    ]
    assert again.with_values(checks=CONTRACT.checks) == CONTRACT
    with pytest.raises(ContractError):
        HealthContract.from_key_values(frame.filter("key <> 'volume_anomaly_factor'"), CONTRACT.data_product)


def test_contract_from_mapping():
    raw = {
        "data_product": "p",
        "data_contract_version": 2,
        "parameters": {
            "orders_freshness_sla_minutes": 1,
            "returns_freshness_sla_minutes": 2,
            "accepted_currencies": ["CAD"],
            "max_category_return_rate_pct": 3,
            "volume_anomaly_factor": 4,
        },
        "checks": [{"name": "MISSING_FX", "severity": "BLOCKING"}],
    }
    contract = HealthContract.from_mapping(raw)
    assert contract.version == "2" and contract.severity("MISSING_FX") == "BLOCKING"
    with pytest.raises(ContractError):
        HealthContract.from_mapping({"data_product": "p"})
    with pytest.raises(ContractError):
        MetricContract.from_mapping({"metric": "m"})
