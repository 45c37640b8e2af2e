"""Days of the year on a calendar of 365 days, and the circular window over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAYS = 365
#: The circle that distances between days are measured on. One longer than the calendar, as in the results to match.
CIRCLE = 366


def calendar_doy(date: Column) -> Column:
    """Day of the year without leap days: 29 February counts as the 28th."""
    doy = F.dayofyear(date)
    leap = F.dayofyear(F.make_date(F.year(date), F.lit(12), F.lit(31))) == 366
    return F.when(leap & (doy >= 60), doy - 1).otherwise(doy)


def circular_distance(a: Column, b: Column) -> Column:
    d = F.abs(a - b)
    return F.least(d, F.lit(CIRCLE) - d)


def reference_calendar(spark: SparkSession) -> DataFrame:
    """doy, month, day of a year without a leap day."""
    days = spark.range(1, DAYS + 1).select(F.col("id").cast("int").alias("doy"), F.date_add(F.lit("2000-12-31").cast("date"), F.col("id").cast("int")).alias("d"))
    return days.select("doy", F.month("d").alias("month"), F.dayofmonth("d").alias("day"))


def window_bridge(spark: SparkSession, window: int = 7) -> DataFrame:
    """(doy, source_doy): the days that each day of the year pools. 5,461 rows at 7 days, so it may be broadcast always."""
    targets = spark.range(1, DAYS + 1).select(F.col("id").cast("int").alias("doy"))
    sources = targets.select("doy", F.explode(F.sequence(F.lit(1), F.lit(DAYS))).alias("source_doy"))
    return sources.where(circular_distance(F.col("doy"), F.col("source_doy")) <= window)


def days_since(date: Column, epoch: str = "1980-01-01") -> Column:
    return F.datediff(date, F.lit(epoch).cast("date"))
