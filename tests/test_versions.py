"""Latest version and audit rank, checked against plain Python."""

from __future__ import annotations

import random

import pytest
from conftest import multiset

from plumbline.operators import versions

DDL = "k STRING, v INT, u INT, e STRING"
ORDER = ("v", "u", "e")


def events(seed=7, keys=40, hot_rows=600):
    rng = random.Random(seed)
    rows = [
        (f"k{rng.randrange(keys)}", rng.randrange(4), rng.randrange(5), f"e{rng.randrange(50)}")
        for _ in range(800)
    ]
    rows += [("hot", rng.randrange(2), rng.randrange(3), f"e{rng.randrange(30)}") for _ in range(hot_rows)]
    rows += [("hot", 9, 9, "copy")] * 150  # one event delivered many times
    rows += [(None, rng.randrange(3), None, f"e{rng.randrange(9)}") for _ in range(120)]
    rng.shuffle(rows)
    return rows


def descending(row):
    return tuple((x is not None, x) if x is not None else (False, 0) for x in row[1:])


def expected_ranks(rows):
    out = []
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=descending, reverse=True)
        out += [(*r, i) for i, r in enumerate(group, start=1)]
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def data(spark):
    raw = events()
    return raw, spark.createDataFrame(raw, DDL)


def test_latest_keeps_one_row_per_key_and_null_is_a_key(data):
    raw, df = data
    best = {}
    for row in raw:
        if row[0] not in best or descending(row) > descending(best[row[0]]):
            best[row[0]] = row
    want = sorted(map(str, best.values()))
    columns = ["k", "v", "u", "e"]
    assert multiset(versions.latest(df, "k", ORDER), columns) == want
    assert multiset(versions.latest_by_max(df, "k", ORDER), columns) == want


def test_latest_limits_rows_per_key_before_the_shuffle(data):
    plan = versions.latest(data[1], "k", ORDER)._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


@pytest.mark.parametrize("hot", [[], ["hot"], ["hot", None], [None, "k1", "absent"]])
def test_ranks_are_the_same_with_and_without_hot_keys(data, hot):
    raw, df = data
    ranked = versions.rank_versions(df, "k", ORDER, hot)
    assert multiset(ranked, ["k", "v", "u", "e", "version_rank"]) == expected_ranks(raw)


def test_copies_are_written_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(versions, "COPY_BLOCK", 7)
    raw = [("a", 1, 1, "x")] * 50 + [("a", 2, 1, "y")] * 3 + [("a", 0, 1, "z")] * 15
    ranked = versions.rank_versions(spark.createDataFrame(raw, DDL), "k", ORDER, ["a"])
    assert multiset(ranked, ["k", "v", "u", "e", "version_rank"]) == expected_ranks(raw)


def test_result_does_not_depend_on_partitions_or_row_order(data, spark):
    raw, df = data
    other = spark.createDataFrame(sorted(raw, key=str), DDL).repartition(7)
    assert multiset(versions.latest(df, "k", ORDER)) == multiset(
        versions.latest(other, "k", ORDER)
    )
