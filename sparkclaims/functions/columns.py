"""Small column helpers: keys, names, durations, exact averages and rates."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN_END = datetime.date(9999, 12, 31)
UNKNOWN = "Unknown"


def date_key(day: Column) -> Column:
    """YYYYMMDD as an int, from date parts (cheaper than formatting text)."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_parts(day: Column) -> dict[str, Column]:
    return {"year": F.year(day), "month": F.month(day), "quarter": F.quarter(day)}


def duration_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def full_name(first: Column, last: Column) -> Column:
    """Null when either part is null."""
    return F.concat(first, F.lit(" "), last)


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """The number with zeros up to ``width``; a longer one keeps all its digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def fill_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.fill({name: UNKNOWN for name in columns})


def load_stamp(df: DataFrame, as_of: datetime.date | None = None) -> DataFrame:
    day = F.current_date() if as_of is None else F.lit(as_of)
    return df.withColumn("load_date", day)


def mean_of(total: Column, rows: Column) -> Column:
    """Average from an exact sum and a count; null over no rows."""
    return F.try_divide(total.cast("double"), rows.cast("double"))


def exact_avg(value: Column) -> Column:
    """Average whose sum is exact for decimals, whatever the task order."""
    return mean_of(F.sum(value), F.count(value))


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator, rounded half-up from the exact quotient.

    Decimal arithmetic, since a quotient in doubles may fall on the wrong side
    of a tie. Null when the denominator is 0.
    """
    quotient = F.try_divide(
        numerator.cast("decimal(26,4)"), denominator.cast("decimal(20,0)")
    )
    return F.round(quotient, digits)


def rounded_avg(value: Column, digits: int) -> Column:
    return rounded_ratio(F.sum(value), F.count(value), digits)


def pct(part: Column, whole: Column) -> Column:
    """100 * part / whole as a double; null when whole is 0."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))
