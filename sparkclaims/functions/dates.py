"""The date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkclaims.functions.columns import date_key


def date_dimension(
    bounds: DataFrame,
    first: str,
    last: str,
    holidays: DataFrame | None = None,
    fiscal_start_month: int = 1,
) -> DataFrame:
    """One row per day between ``first`` and ``last`` of the one-row ``bounds``.

    ``holidays`` has one column ``full_date``; without it no day is a holiday.
    The fiscal year is named after the calendar year in which it ends.
    """
    day = F.col("full_date")
    shifted = F.add_months(day, (13 - fiscal_start_month) % 12)
    days = bounds.select(
        F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date"))).alias("full_date")
    )
    if holidays is None:
        days = days.withColumn("is_holiday", F.lit(False))
    else:
        marked = holidays.select("full_date").distinct().withColumn("is_holiday", F.lit(True))
        days = days.join(marked, "full_date", "left").na.fill({"is_holiday": False})
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        month_name(day).alias("month_name"),
        F.weekofyear(day).alias("week"),
        F.weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        F.col("is_holiday"),
        F.year(shifted).alias("fiscal_year"),
        F.quarter(shifted).alias("fiscal_quarter"),
    )


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")
