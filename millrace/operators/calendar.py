"""The date dimension and the business calendar."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.functions import dates


def days_between(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """One row (date) per day from a one-row table of bounds."""
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date"))


def date_dimension(days: DataFrame) -> DataFrame:
    """date_key, calendar parts, and the business-day flags the feeds are scheduled by."""
    month = W.partitionBy("month_key")
    business = F.when(F.col("is_business_day"), F.col("date"))
    return (days.select(
        dates.date_key("date").alias("date_key"), "date", F.month("date").alias("month"),
        F.quarter("date").alias("quarter"), F.year("date").alias("year"),
        (F.weekday("date") >= 5).alias("is_weekend"), dates.is_business_day("date").alias("is_business_day"),
        dates.month_key("date").alias("month_key"))
        .withColumn("is_first_business_day", F.coalesce(F.col("date") == F.min(business).over(month), F.lit(False)))
        .withColumn("is_last_business_day", F.coalesce(F.col("date") == F.max(business).over(month), F.lit(False))))


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Whole months around the range, so that first and last business days are right at its edges."""
    bounds = spark.range(1).select(
        F.trunc(F.lit(start).cast("date"), "MM").alias("start"), F.last_day(F.lit(end).cast("date")).alias("end"))
    return (date_dimension(days_between(bounds, "start", "end"))
            .filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))))


def calendar_of(df: DataFrame, day: Column) -> DataFrame:
    """The calendar of the whole months a table's dates span."""
    bounds = df.agg(F.trunc(F.min(day), "MM").alias("start"), F.last_day(F.max(day)).alias("end"))
    return date_dimension(days_between(bounds, "start", "end"))
