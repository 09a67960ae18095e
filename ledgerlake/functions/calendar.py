"""Calendar dimension and business days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def is_business_day(d: Column) -> Column:
    """Monday to Friday."""
    return F.weekday(d) < 5


def last_business_day(d: Column) -> Column:
    """Last Monday-to-Friday day of the month d falls in."""
    end = F.last_day(d)
    return F.date_sub(end, F.greatest(F.weekday(end) - 4, F.lit(0)))


def describe_days(days: DataFrame, name: str = "full_date") -> DataFrame:
    """Calendar attributes for a column of dates."""
    d = F.col(name)
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("full_date"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (d == last_business_day(d)).alias("is_month_end"),
    )


def calendar(spark: SparkSession, start, end) -> DataFrame:
    """Every day from start to end, both included."""
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return describe_days(spark.range(1).select(F.explode(span).alias("full_date")))


def calendar_of(df: DataFrame, column: str) -> DataFrame:
    """Every day between the first and the last date found in a column."""
    ends = df.agg(F.min(column).cast("date").alias("a"), F.max(column).cast("date").alias("z"))
    return describe_days(ends.select(F.explode(F.sequence("a", "z")).alias("full_date")))


def business_days(spark: SparkSession, start, n: int) -> DataFrame:
    """The first n business days from start on."""
    first = F.lit(start).cast("date")
    days = spark.range(1).select(
        F.explode(F.sequence(first, F.date_add(first, n + 2 * (n // 5 + 1)))).alias("full_date")
    )
    return days.where(is_business_day(F.col("full_date"))).orderBy("full_date").limit(n)
