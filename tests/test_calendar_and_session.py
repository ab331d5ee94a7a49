from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from plumbline import session
from plumbline.operators import scans
from plumbline.queries import Trade
from plumbline.sources.calendar import calendar_between
from plumbline.sources.trade import TradeFeeds


def test_calendar_covers_the_months_of_all_orders(spark, trade_dir, tmp_path):
    """Orders far outside the usual years reach the fact."""
    for name in ("lineitem", "customer", "part", "supplier", "nation", "region"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{trade_dir}/{name}.parquet")
    moved = spark.read.parquet(f"{trade_dir}/orders.parquet").withColumn(
        "o_orderdate",
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("1990-03-15")).otherwise(F.lit("2030-11-02")).cast("timestamp_ntz"),
    )
    moved.write.parquet(str(tmp_path / "orders.parquet"))
    days = TradeFeeds(spark, str(tmp_path)).days().agg(F.min("calendar_date"), F.max("calendar_date")).first()
    assert tuple(days) == (date(1990, 3, 1), date(2030, 11, 30))
    trade = Trade(spark, str(tmp_path), "repaired")
    fact = trade.fact_sales()
    years = {r[0] for r in fact.select(F.expr("date_key div 10000")).distinct().collect()}
    assert years == {1990, 2030}
    assert fact.count() == trade.sales.count()


def test_calendar_of_no_orders_is_empty(spark):
    bounds = spark.sql("select cast(null as date) as first, cast(null as date) as last")
    assert calendar_between(bounds).count() == 0


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class _Cluster:
    sparkContext = _Context()

    class conf:
        set = staticmethod(lambda *a: None)
        get = staticmethod(lambda *a: None)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.prepare(_Cluster())


def test_every_line_end_counts(spark):
    text = "a\r\nb\rc\nd\x0be\x0cf\x1cg\x1dh\x1ei\x85j k hit"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    found = scans.scan_patterns(df, "doc_id", "text", {"p": "hit|[b]"}).collect()
    assert sorted(r.line_number for r in found) == [2, len(text.splitlines())]
