"""The date dimension, and reports that show empty periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schema as S
from ledgerloom.functions.scalars import as_of_date, sunday_week

# The least span of the date dimension.
FIRST_DAY = "2020-01-01"
LAST_DAY = "2030-12-31"


def date_spine(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """Every day of a fixed span."""
    span = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return _days(span)


def spine_covering(df: DataFrame, column: str, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """Every day of a span, widened to the first and the last date of a column."""
    day = F.to_date(column)
    return _days(df.agg(
        F.least(F.lit(first).cast("date"), F.min(day)).alias("first"), F.greatest(F.lit(last).cast("date"), F.max(day)).alias("last")))


def spine_over(df: DataFrame, column: str, months_after: int = 0) -> DataFrame:
    """Every day from the first to the last date of a column, and some months beyond."""
    day = F.to_date(column)
    return _days(df.agg(F.min(day).alias("first"), F.add_months(F.max(day), months_after).alias("last")))


def _days(span: DataFrame) -> DataFrame:
    return span.select(F.explode(F.sequence("first", "last")).alias("date_day"))


def relative_flags(day: Column, today: Column) -> dict[str, Column]:
    return {
        "is_today": day == today,
        "is_yesterday": day == F.date_sub(today, 1),
        "is_current_month": day >= F.trunc(today, "MM"),
        "is_current_year": day >= F.trunc(today, "YEAR"),
    }


def dim_dates(spine: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Calendar parts, names and flags for the days of a spine."""
    day, today = F.col("date_day"), as_of_date(as_of)
    numbers = {
        "year": F.year(day), "quarter": F.quarter(day), "month": F.month(day),
        "week_of_year": sunday_week(day), "day_of_month": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day), "day_of_year": F.dayofyear(day),
    }
    names = {
        "month_name": "MMMM", "month_short": "MMM", "day_name": "EEEE", "day_short": "EEE",
        "year_month": "yyyy-MM", "year_quarter": "yyyy-'Q'q",
    }
    before_start = (F.month(day) < S.FISCAL_YEAR_FIRST_MONTH).cast("int")
    return spine.select(
        day,
        F.date_format(day, "yyyyMMdd").alias("date_key"),
        *[c.cast("long").alias(n) for n, c in numbers.items()],
        *[F.date_format(day, p).alias(n) for n, p in names.items()],
        (F.year(day) - before_start).cast("long").alias("fiscal_year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.date_format(day, "MM-dd").isin(*S.FIXED_HOLIDAYS).alias("is_holiday"),
        *[c.alias(n) for n, c in relative_flags(day, today).items()],
    )


def revenue_per_month(dates: DataFrame, fact: DataFrame) -> DataFrame:
    """Revenue of every month of the date table, zero where nothing was sold.

    The fact is summed per day first, so the join moves days and not orders.
    """
    daily = fact.groupBy("order_date").agg(F.sum("total_amount").alias("_day_total"))
    joined = dates.join(daily, dates["date_day"] == daily["order_date"], "left")
    return joined.groupBy("year_month", "month_name").agg(
        F.coalesce(F.sum("_day_total"), F.lit(0.0)).alias("revenue")
    )


def revenue_per_sold_month(fact: DataFrame) -> DataFrame:
    """Revenue by calendar month number, only months with orders."""
    return fact.groupBy(F.month("order_date").cast("long").alias("order_month")).agg(
        F.sum("total_amount").alias("revenue")
    )
