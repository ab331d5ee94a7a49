"""Date dimension for any range."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import date_key


def date_dimension(spark: SparkSession, first: date | str, last: date | str) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    bounds = spark.range(1).select(
        F.lit(str(first)).cast("date").alias("first"), F.lit(str(last)).cast("date").alias("last")
    )
    return calendar_between(bounds)


def calendar_between(bounds: DataFrame) -> DataFrame:
    """One row per day of the one row (first, last), both included; no day if either is NULL."""
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("calendar_date"))
    d = F.col("calendar_date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("calendar_year"),
        F.month(d).alias("month_number"),
        F.dayofmonth(d).alias("day_of_month"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
    )
