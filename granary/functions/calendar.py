"""Calendar columns and the generated day spine."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def iso_weekday(day: Column) -> Column:
    """1 is Monday, 7 is Sunday."""
    return F.weekday(day) + 1


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def days_between(start: Column, end: Column) -> Column:
    """end - start in days, NULL when either is NULL."""
    return F.datediff(end, start).cast("bigint")


def day_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row `date_key` per day of [start, end); the end day is excluded."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"),
        F.date_sub(F.lit(end).cast("date"), 1).alias("last_day"),
    )
    return spine_between(bounds)


def spine_between(bounds: DataFrame) -> DataFrame:
    """One row per day of a one-row frame (first_day, last_day), both included."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_key"))


def whole_years(days: DataFrame, column: str) -> DataFrame:
    """First and last day of the calendar years that `column` covers, as one row."""
    span = days.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return span.select(
        F.trunc("lo", "year").alias("first_day"),
        F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1).alias("last_day"),
    )


def date_attributes(spine: DataFrame) -> DataFrame:
    """Eleven calendar columns per `date_key`.

    `week_of_year` is the ISO week while `year` is the calendar year, so the
    two must not be grouped together: 2012-01-01 is in year 2012, week 52.
    """
    day = F.col("date_key")
    return spine.select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        is_weekend(day).alias("is_weekend"),
        F.weekofyear(day).alias("week_of_year"),
        year_month(day).alias("year_month"),
    )
