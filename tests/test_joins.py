"""Joins with hot keys and lookups of any size give the rows of a plain join."""

from __future__ import annotations

import pytest
from conftest import multiset
from pyspark.sql import functions as F

from plumbline.operators import joins
from plumbline.operators.joins import (
    LOOKUP_BYTE_LIMIT,
    Lookup,
    busiest_keys,
    hot_keys,
    join_unique,
    lookup,
)


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 11 == 0, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
        .alias("k"),
        "id",
    )
    right = spark.createDataFrame(
        [("hot", 1, None)] + [(f"k{i}", i, f"n{i}") for i in range(0, 97, 2)],
        "k STRING, a INT, b STRING",
    )
    return left, right


def test_hot_keys_find_large_shares_and_nulls(sides):
    found = hot_keys(sides[0], "k", share=0.05, min_rows=10)["k"]
    assert set(found) == {"hot", None}
    assert hot_keys(sides[0], "k")["k"] == []  # below the row floor nothing is hot


@pytest.mark.parametrize("how", ["left", "inner", "semi"])
@pytest.mark.parametrize("hot", [["hot"], ["hot", None], ["hot", "k2", "k3", "absent"]])
def test_hot_join_equals_plain_join(sides, how, hot):
    left, right = sides
    plain = left.join(right, "k", "left_semi" if how == "semi" else how)
    columns = ["k", "id"] if how == "semi" else ["k", "id", "a", "b"]
    split = join_unique(left, right, "k", how, hot)
    assert multiset(split, columns) == multiset(plain, columns)
    assert sorted(split.columns) == sorted(columns)


def test_hot_rows_are_spread_and_not_in_one_reducer(sides):
    left, right = sides
    joined = join_unique(left, right, "k", "left", ["hot", None])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SPARK_PARTITION_ID" in plan.upper()


def test_unknown_join_type_is_refused(sides):
    with pytest.raises(ValueError):
        join_unique(*sides, "k", "full")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("limit", [1, 1000])
def test_lookup_beyond_the_limit_gives_the_same_rows(sides, how, limit):
    left, right = sides
    doubled = right.unionByName(right.filter("a = 2"))  # a repeated key fans out
    ref = Lookup.checked({"r": doubled}, row_limit=limit)["r"]
    assert ref.fits == (limit == 1000)
    got = lookup(left, ref, "k", how)
    want = left.join(doubled, "k", how)
    assert multiset(got, want.columns) == multiset(want, want.columns)


def test_only_a_fitting_lookup_is_broadcast(sides):
    left, right = sides
    big = lookup(left, Lookup(right.hint("merge"), False), "k")
    small = lookup(left, Lookup(right, True), "k")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in big._jdf.queryExecution().executedPlan().toString()


def test_hot_follows_the_rows_of_a_reducer(spark):
    skewed = spark.range(100).selectExpr("if(id < 60, 7, id) as k")
    assert hot_keys(skewed, "k")["k"] == [7]  # four shuffle partitions: above half of all rows
    assert hot_keys(skewed.filter("k != 7"), "k")["k"] == []
    assert busiest_keys(skewed, "k", 2) == [7, 60]


def test_wide_lookups_do_not_fit(spark):
    wide = spark.range(3).selectExpr("id", f"repeat('x', {LOOKUP_BYTE_LIMIT // 2}) as text")
    assert not Lookup.checked({"wide": wide})["wide"].fits
    assert Lookup.checked({"small": spark.range(3)})["small"].fits


@pytest.mark.parametrize("cells", [1, 7])
def test_hot_keys_are_counted_exactly_whatever_shares_their_cell(sides, monkeypatch, cells):
    # Cells of many keys each: a hot cell alone makes no key hot.
    monkeypatch.setattr(joins, "_CELLS", cells)
    monkeypatch.setattr(joins, "_CELLS_PER_HOT_KEY", 0)
    left = sides[0].withColumn("all", F.lit(1))
    assert hot_keys(left, "k", "id", "all", share=0.05) == {"k": ["hot", None], "id": [], "all": [1]}
    assert hot_keys(left.limit(0), "k", "id") == {"k": [], "id": []}
