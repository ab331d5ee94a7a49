"""Every registered query against its SQL on an independent engine, over whole tables."""

from __future__ import annotations

import glob
import os
from collections import Counter

import __spark_entry__ as entry
import pytest
from plumbline import queries as registered
from tools.compare import plain

duckdb = pytest.importorskip("duckdb")
SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(trade_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{trade_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(registered.queries()) <= set(SQL)  # optional packages test theirs by other means


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, trade_dir, con, name):
    df = QUERIES[name](spark, trade_dir)
    columns = sorted(df.columns)
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert columns == sorted(names)
    order = sorted(range(len(names)), key=names.__getitem__)
    want = Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    got = Counter(tuple(map(plain, r)) for r in df.select(*columns).collect())
    assert got == want


@pytest.mark.parametrize(
    "name", ["check_duplicate_keys_c", "check_missing_keys_c", "check_orphans_b", "check_missing_fx_b"]
)
def test_checks_find_something(con, name):
    """Checks are compared with SQL where they fail, too: no value above is a zero."""
    names = [d[0] for d in con.execute(SQL[name]).description]
    assert all(dict(zip(names, r, strict=True))["observed_value"] > 0 for r in con.fetchall())


def test_conformance_finds_something(con):
    for name, rules in {
        "conformance_c": {"required.order_id", "reference.region_code"},
        "conformance_returns_b": {"reference.order_id", "accepted.currency_code"},
        "conformance_rates_c": {"unique_key"},
    }.items():
        names = [d[0] for d in con.execute(SQL[name]).description]
        found = [dict(zip(names, r, strict=True)) for r in con.fetchall()]
        assert rules <= {r["rule"] for r in found if r["violations"] > 0}


def test_flagship_query(spark, trade_dir):
    df = entry.entry(spark)
    assert df.columns == [
        "category_code",
        "category_name",
        "net_revenue_cad",
        "target_cad",
        "variance_cad",
    ]
    assert df.count() == 6
