"""Dates, weeks and the fiscal calendar.

The fiscal year has 52 weeks of seven days: 13 periods of four weeks, or four
quarters of 13. Weeks are numbered from an anchor Sunday and written as
``YYYYPPWW`` text, which sorts in time order. All of it is arithmetic on the
date, so no calendar join is needed unless a caller brings a calendar table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The first day of fiscal year 1995.
ANCHOR = dt.date(1995, 1, 1)
ANCHOR_YEAR = 1995

# Recency weight of each quarter, oldest first, in 1/10000.
QUARTER_WEIGHTS = {1: 2300, 2: 2400, 3: 2600, 4: 2700}


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def weeks_back(date, end) -> Column:
    """Week counted back from ``end``: 0 is the end date itself, 1 the week before."""
    return F.ceil(F.datediff(F.lit(end), _col(date)) / 7).cast("int")


def timeline_day(date, end, days: int = 364) -> Column:
    """Forward day in a window of ``days`` days that closes on ``end``."""
    return F.datediff(_col(date), F.lit(end)) + days


def timeline_quarter(date, end, days: int = 364) -> Column:
    """Quarter 1 (oldest) to 4 of that window."""
    return F.ceil(timeline_day(date, end, days) / (days // 4)).cast("int")


def lookback_window(as_of: dt.date, weeks: int) -> tuple[dt.date, dt.date]:
    """Whole weeks, Monday to Sunday, that ended before ``as_of``'s week."""
    monday = as_of - dt.timedelta(days=as_of.weekday())
    return monday - dt.timedelta(weeks=weeks), monday - dt.timedelta(days=1)


def fiscal_index(date) -> Column:
    """Number of whole weeks since the anchor."""
    return F.floor(F.datediff(_col(date), F.lit(ANCHOR)) / 7).cast("int")


def fiscal_week_code(index: Column) -> Column:
    """Week code as one number, digits in place, written as text: no formatting per row."""
    in_year = F.pmod(index, F.lit(52))
    year = F.floor(index / 52).cast("int") + ANCHOR_YEAR
    period, week = F.floor(in_year / 4).cast("int") + 1, F.pmod(in_year, F.lit(4)) + 1
    return (year * 10_000 + period * 100 + week).cast("string")


def fiscal_index_of(code: Column) -> Column:
    """Inverse of :func:`fiscal_week_code`."""
    year, period, week = (F.substring(code, a, n).cast("int") for a, n in ((1, 4), (5, 2), (7, 2)))
    return (year - ANCHOR_YEAR) * 52 + (period - 1) * 4 + week - 1


def fiscal_columns(date) -> dict[str, Column]:
    """Week, month (period), quarter and year of a date, by output name."""
    return fiscal_columns_of_index(fiscal_index(date))


def fiscal_columns_of_index(index: Column) -> dict[str, Column]:
    """The same from the week number."""
    year = F.floor(index / 52).cast("int") + ANCHOR_YEAR
    quarter = F.floor(F.pmod(index, F.lit(52)) / 13).cast("int") + 1
    code = fiscal_week_code(index)
    return {
        "fiscal_week": code, "fiscal_month": F.substring(code, 1, 6),
        "fiscal_quarter": (year * 100 + quarter).cast("string"),
        "fiscal_year": year.cast("string"),
    }


def week_code(index: int) -> str:
    """Driver-side form of :func:`fiscal_week_code`."""
    year, in_year = divmod(index, 52)
    return f"{ANCHOR_YEAR + year:04d}{in_year // 4 + 1:02d}{in_year % 4 + 1:02d}"


def week_index(code: str) -> int:
    return (int(code[:4]) - ANCHOR_YEAR) * 52 + (int(code[4:6]) - 1) * 4 + int(code[6:8]) - 1


def date_week(date: dt.date) -> str:
    """Fiscal week of one date."""
    return week_code((date - ANCHOR).days // 7)


def weeks_ago(code: str, n: int) -> str:
    """Fiscal week ``n`` weeks before ``code``."""
    return week_code(week_index(code) - n)


def week_dates(code: str) -> tuple[dt.date, dt.date]:
    """First and last day of a fiscal week."""
    first = ANCHOR + dt.timedelta(weeks=week_index(code))
    return first, first + dt.timedelta(days=6)


def days_between(spark: SparkSession, start: dt.date, end: dt.date, name: str = "trn_date") -> DataFrame:
    """One row per day."""
    count = (end - start).days + 1
    return spark.range(count).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def fiscal_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Fiscal calendar with one row per day."""
    return days_between(spark, start, end).withColumns(fiscal_columns("trn_date"))


def timeline(spark: SparkSession, days: int = 364) -> DataFrame:
    """Relative timeline: day, week, quarter and recency weight (1/10000)."""
    day = (F.col("id") + 1).cast("int")
    quarter = F.ceil(day / (days // 4)).cast("int")
    weight = F.element_at(F.create_map(
        *[F.lit(x) for pair in QUARTER_WEIGHTS.items() for x in pair]), quarter)
    return spark.range(days).select(day.alias("day"), F.ceil(day / 7).cast("int").alias("week"),
                                    quarter.alias("quarter"), weight.alias("weight"))


def quarter_of_week(code, start: str, weeks_per_quarter: int = 13) -> Column:
    """Quarter of a fiscal week in a window that opens at ``start``; 1 is the oldest."""
    offset = fiscal_index_of(_col(code)) - week_index(start)
    return F.floor(offset / weeks_per_quarter).cast("int") + 1


def quarter_weight(quarter) -> Column:
    """Recency weight of a quarter in 1/10000."""
    value = F.when(_col(quarter) == 1, QUARTER_WEIGHTS[1])
    for number in (2, 3, 4):
        value = value.when(_col(quarter) == number, QUARTER_WEIGHTS[number])
    return value


def week_timeline(df: DataFrame, date: str, start: dt.date) -> DataFrame:
    """Add week number from ``start`` in blocks of seven days, week end and its year."""
    week = F.floor(F.datediff(F.col(date), F.lit(start)) / 7).cast("int")
    week_end = F.date_add(F.lit(start), week * 7 + 6)
    return df.withColumns({"week": week, "week_enddate": week_end, "year": F.year(week_end)})


def holiday_weeks(holidays: DataFrame, start: dt.date, lead: int = 3) -> DataFrame:
    """Weeks touched by each holiday or by the ``lead`` days before it."""
    days = holidays.withColumn("date", F.explode(F.sequence(
        F.date_sub("date", lead), F.col("date"))))
    return week_timeline(days, "date", start).where(F.col("week") >= 0).select(
        "week", "holiday", "date").withColumn("holiday_flag", F.lit(1))
