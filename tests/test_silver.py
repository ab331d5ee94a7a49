"""Every branch of the Silver rules on hand-made rows."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import ORDER_DDL, RETURN_DDL, dec, order, returned, ts

from plumbline.contracts import HealthContract
from plumbline.operators import silver, star
from plumbline.operators.joins import Lookup

CONTRACT = HealthContract()
RATE_DDL = (
    "rate_date DATE, from_currency STRING, to_currency STRING, rate DECIMAL(10,6), "
    "published_at_utc TIMESTAMP, ingested_at TIMESTAMP"
)


def usd(day, rate, to="CAD"):
    return (date.fromisoformat(day), "USD", to, dec(rate), None, None)


@pytest.fixture(scope="module")
def orders(spark):
    later = ts("2026-08-05 12:00:00")
    return spark.createDataFrame(
        [
            order("A", "E1", 1, "50.00"),
            order("A", "E9", 2, "60.00", source_updated_at=ts("2026-08-01 00:00:00")),
            order("A", "E5", 1, "55.00", source_updated_at=later),
            order("B", "E1", 1, "10.00"),
            order("B", "E2", 1, "10.00", source_updated_at=later),  # replay, same version
            order("T", customer_segment="Internal Test", amount="0.00"),
            order("Z", amount="0.00"),
            order("M", amount="-3.00"),
            order("N", amount=None),
            order("S", customer_segment=None),
            order("L", region_code=" on ", category_code="dev", currency_code=" usd", amount="10.05"),
            order("E", currency_code="EUR"),
            order("X", currency_code=None),
            order(None, "E1"),
            order(None, "E2"),
            order("G", currency_code="USD", amount="100.00",
                  order_timestamp_utc=ts("2026-08-20 23:59:59")),
        ],
        ORDER_DDL,
    )


@pytest.fixture(scope="module")
def latest(orders):
    return silver.latest_orders(orders, CONTRACT)


@pytest.fixture(scope="module")
def returns(spark):
    later = ts("2026-08-06 12:00:00")
    return spark.createDataFrame(
        [
            returned("R1", "A", "5.00"),
            returned("R1", "A", "6.00", source_updated_at=later),
            returned("R2", "unknown"),
            returned("R3", "Z"),
            returned("R4", "Z", "0.00"),  # excluded order and a bad amount
            returned("R5", "A", "0.00"),
            returned("R6", "A", None),
            returned("R7", "A", currency_code="USD"),
            returned("R8", "A", currency_code=None),
            returned("R9", None),
            returned("R10", "L", "0.50", currency_code="usd "),
            returned("R11", "B", "1.00"),
            returned("R11", "B", "2.00"),  # a tie on the declared order
        ],
        RETURN_DDL,
    )


@pytest.fixture(scope="module")
def reconciled(returns, latest):
    return silver.reconcile_returns(returns, latest)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_latest_version_order(latest):
    got = by(latest, "order_id")
    assert got["A"]["event_id"] == "E9"  # the version counts before the update time
    assert got["B"]["event_id"] == "E2"
    assert latest.filter("order_id IS NULL").count() == 1


def test_all_versions_are_ranked_for_audit(orders):
    ranked = silver.order_versions(orders, CONTRACT)
    assert ranked.count() == orders.count()
    ranks = {r["event_id"]: r["version_rank"] for r in ranked.filter("order_id = 'A'").collect()}
    assert ranks == {"E9": 1, "E5": 2, "E1": 3}


def test_quarantine_reasons(latest):
    got = {k: r["quarantine_reason"] for k, r in by(latest, "order_id").items()}
    assert got["T"] == "TEST_TRANSACTION"  # first rule wins over the amount rule
    assert {got["Z"], got["M"], got["N"]} == {"INVALID_AMOUNT"}
    assert got["S"] is None and got["E"] is None


def test_codes_are_normalised_and_dates_are_utc(latest):
    got = by(silver.governed_orders(latest), "order_id")
    assert (got["L"]["region_code"], got["L"]["category_code"], got["L"]["currency_code"]) == (
        "ON",
        "DEV",
        "USD",
    )
    assert got["G"]["order_date"] == date(2026, 8, 20)
    assert "Z" not in got


def test_return_status_and_reason(reconciled):
    got = {r["return_id"]: (r["reconciliation_status"], r["quarantine_reason"]) for r in reconciled.collect()}
    assert got == {
        "R1": ("ACCEPTED", None),
        "R2": ("ORPHAN", None),
        "R3": ("ORDER_EXCLUDED", None),
        "R4": ("ORDER_EXCLUDED", "INVALID_RETURN_AMOUNT"),
        "R5": ("QUARANTINED", "INVALID_RETURN_AMOUNT"),
        "R6": ("QUARANTINED", "INVALID_RETURN_AMOUNT"),
        "R7": ("QUARANTINED", "RETURN_CURRENCY_MISMATCH"),
        "R8": ("ACCEPTED", None),  # an unknown currency is left to the currency check
        "R9": ("ORPHAN", None),
        "R10": ("ACCEPTED", None),
        "R11": ("ACCEPTED", None),
    }


@pytest.mark.parametrize("hot", [["A"], ["A", None, "unknown"]])
def test_hot_orders_do_not_change_the_reconciliation(returns, latest, reconciled, hot):
    other = silver.reconcile_returns(returns, latest, hot)
    assert sorted(map(str, other.collect())) == sorted(map(str, reconciled.collect()))


def test_return_ties_are_deterministic(returns, latest):
    amounts = set()
    for parts in (1, 3, 5):
        df = silver.reconcile_returns(returns.repartition(parts), latest)
        amounts.add(by(df, "return_id")["R11"]["return_amount"])
    assert amounts == {dec("2.00")}


def test_quarantine_has_latest_orders_and_returns_only(latest, reconciled):
    q = silver.quarantine(latest, reconciled, "run-1")
    got = {(r["source_entity"], r["record_key"]) for r in q.collect()}
    assert got == {("orders", k) for k in "TZMN"} | {("returns", k) for k in ("R5", "R6", "R7")}
    assert {r["pipeline_run_id"] for r in q.collect()} == {"run-1"}


def price(spark, latest, reconciled, rates):
    frame = spark.createDataFrame(rates, RATE_DDL)
    lookup = Lookup.checked({"r": frame})["r"]
    return silver.price_sales(silver.governed_orders(latest), reconciled, lookup, CONTRACT)


def test_each_row_is_converted_and_rounded_half_up(spark, latest, reconciled):
    sales = by(price(spark, latest, reconciled, [usd("2026-08-05", "1.5"), usd("2026-08-20", "9", "EUR")]), "order_id")
    assert sales["A"]["gross_revenue_cad"] == dec("60.00")
    assert sales["A"]["returns_cad"] == dec("16.00")  # 6.00 and 10.00
    assert sales["A"]["return_count"] == 2
    # 10.05 * 1.5 = 15.075 and 0.50 * 1.5 = 0.75
    assert sales["L"]["gross_revenue_cad"] == dec("15.08")
    assert sales["L"]["returns_cad"] == dec("0.75")
    assert sales["S"]["accepted_return_amount"] == 0 and sales["S"]["return_count"] == 0
    # No rate of another day or target currency is used; other currencies get none.
    assert sales["G"]["fx_rate_to_cad"] is None and sales["G"]["gross_revenue_cad"] is None
    assert sales["E"]["gross_revenue_cad"] is None and sales["X"]["fx_rate_to_cad"] is None


def test_two_rates_for_one_day_fan_out(spark, latest, reconciled):
    sales = price(spark, latest, reconciled, [usd("2026-08-05", "1.5"), usd("2026-08-05", "1.6")])
    assert sales.filter("order_id = 'L'").count() == 2


def test_fact_drops_unknown_dimensions_and_carries_lineage(spark, latest, reconciled):
    sales = price(spark, latest, reconciled, [usd("2026-08-05", "1.5")])
    refs = {
        "dates": spark.createDataFrame(
            [(20260805, date(2026, 8, 5), 5, "2026-08")],
            "date_key INT, calendar_date DATE, day_of_month INT, year_month STRING",
        ),
        "regions": spark.createDataFrame([(1, "ON")], "region_key INT, region_code STRING"),
        "categories": spark.createDataFrame(
            [(7, "DEV")], "category_key INT, category_code STRING"
        ),
    }
    dims = Lookup.checked(refs)
    fact = star.fact_sales(sales, *dims.values(), CONTRACT, "run-1")
    got = by(fact, "order_key")
    assert "G" not in got  # outside the calendar
    assert got["A"]["net_revenue_cad"] == dec("44.00")
    assert got["A"]["returns_source_system"] == "sqlserver.dbo.returns"
    assert got["A"]["fx_source_system"] == "none (CAD)"
    assert got["L"]["fx_source_system"] == "treasury.reference.fx"
    assert got["S"]["returns_source_system"] is None
    assert tuple(c for c in fact.columns if c != "sales_month") == star.FACT_SALES_COLUMNS
    assert star.publish_or_withhold(fact, False).count() == 0
    assert star.publish_or_withhold(fact, False).schema == fact.schema
