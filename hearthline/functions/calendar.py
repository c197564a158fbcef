"""A fiscal calendar as a table, with years of 52 or 53 weeks.

A calendar has one row per day and the fiscal week, month (period), quarter and
year of that day. Its weeks get a dense number, so that "n weeks ago" and windows
of so many weeks count real weeks, a 53rd one included. Week codes are text that
sorts in time order; a window is therefore a range of codes, and the quarters of
a window are told apart by its few boundary codes, without a join.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions.timeline import days_between

FISCAL = ["fiscal_week", "fiscal_month", "fiscal_quarter", "fiscal_year"]
#: Weeks of a calendar; 4,000 are 77 years. What is broadcast is seven times as many rows.
MOST_WEEKS = 20_000


class Calendar:
    """A calendar table and its weeks in order.

    The table must hold every day of every week from its first to its last day,
    and codes must sort as their days do; otherwise a ``ValueError`` says where not.
    """

    def __init__(self, days: DataFrame, date: str = "trn_date"):
        self.days = days.select(F.col(date).cast("date").alias("trn_date"), *FISCAL).distinct()

    @cached_property
    def _weeks(self) -> list[tuple[str, dt.date, dt.date]]:
        rows = (self.days.groupBy("fiscal_week").agg(
            F.min("trn_date").alias("first"), F.max("trn_date").alias("last"), F.count(F.lit(1)).alias("n"))
            .orderBy("fiscal_week").limit(MOST_WEEKS + 1).collect())
        if len(rows) > MOST_WEEKS:
            raise ValueError(f"a calendar of more than {MOST_WEEKS} weeks")
        for before, row in zip([None, *rows], rows):
            whole = (row["last"] - row["first"]).days == 6 and row["n"] == 7
            if not whole or (before and (row["first"] - before["last"]).days != 1):
                raise ValueError(f"fiscal week {row['fiscal_week']} has {row['n']} days from {row['first']} to {row['last']}")
        return [(r["fiscal_week"], r["first"], r["last"]) for r in rows]

    @cached_property
    def _numbers(self) -> dict[str, int]:
        return {code: k for k, (code, _, _) in enumerate(self._weeks)}

    def number(self, code: str) -> int:
        """Dense number of a week, 0 for the calendar's first."""
        if code not in self._numbers:
            raise ValueError(f"fiscal week {code} is not in the calendar")
        return self._numbers[code]

    def code(self, number: int) -> str:
        if not 0 <= number < len(self._weeks):
            raise ValueError(f"week number {number} is outside the calendar")
        return self._weeks[number][0]

    def weeks_ago(self, code: str, n: int) -> str:
        """Fiscal week ``n`` weeks before ``code``; a negative ``n`` looks ahead."""
        return self.code(self.number(code) - n)

    def week_of(self, date: dt.date) -> str:
        """Fiscal week of one date."""
        at = bisect_right([first for _, first, _ in self._weeks], date) - 1
        if at < 0 or date > self._weeks[at][2]:
            raise ValueError(f"{date} is outside the calendar")
        return self._weeks[at][0]

    def week_dates(self, code: str) -> tuple[dt.date, dt.date]:
        """First and last day of a fiscal week."""
        return self._weeks[self.number(code)][1:]

    def weeks_between(self, start: str, end: str) -> list[str]:
        """All weeks from ``start`` to ``end``, in order."""
        return [code for code, _, _ in self._weeks[self.number(start):self.number(end) + 1]]

    def quarter_of_week(self, code, start: str, weeks_per_quarter: int = 13, quarters: int = 4) -> Column:
        """Quarter of a fiscal week in a window that opens at ``start``: 1 is the oldest.

        Weeks before the window have none; weeks beyond its last quarter count on from it.
        """
        code = F.col(code) if isinstance(code, str) else code
        first, number = self.number(start), F.lit(0)
        # Later boundaries than the calendar has can't be reached by its weeks.
        for k in range(max(quarters, -(-(len(self._weeks) - first) // weeks_per_quarter))):
            if first + k * weeks_per_quarter < len(self._weeks):
                number = number + (code >= self.code(first + k * weeks_per_quarter)).cast("int")
        return F.when(number > 0, number)

    def attach(self, df: DataFrame, date: str = "trn_date") -> DataFrame:
        """``df`` with the fiscal columns of its date. A date outside the calendar is an error, not a lost row."""
        self._weeks  # its size is checked before it is broadcast
        named = self.days.withColumnRenamed("trn_date", "_day")
        joined = df.join(F.broadcast(named), F.col(date) == F.col("_day"), "left").drop("_day")
        missing = F.raise_error(F.concat(F.lit("outside the calendar: "), F.col(date).cast("string"))).cast("string")
        known = F.when(F.col("fiscal_week").isNotNull() | F.col(date).isNull(), F.col("fiscal_week")).otherwise(missing)
        return joined.withColumn("fiscal_week", known)


def nearest_sunday_calendar(spark: SparkSession, first_year: int, last_year: int, month: int = 2, day: int = 1) -> Calendar:
    """A calendar whose years begin on the Sunday nearest to a day, so that some have 53 weeks.

    Twelve periods of four weeks, the 13th of four or five; quarters of 13 weeks, the
    last of 13 or 14. Codes are ``YYYYPPWW``.
    """
    def opens(year: int) -> dt.date:
        date = dt.date(year, month, day)
        past = date.isoweekday() % 7
        return date - dt.timedelta(days=past) if past <= 3 else date + dt.timedelta(days=7 - past)

    begins = [opens(year) for year in range(first_year, last_year + 2)]
    days = days_between(spark, begins[0], begins[-1] - dt.timedelta(days=1))
    # Which year a day is in: how many years have begun.
    at = sum(((F.col("trn_date") >= F.lit(b)).cast("int") for b in begins[1:-1]), F.lit(1))
    year = at + (first_year - 1)
    week = F.floor(F.datediff("trn_date", F.element_at(F.array(*map(F.lit, begins)), at)) / 7).cast("int")
    days = days.select("trn_date", year.alias("y"), week.alias("w"))
    period = F.least(F.floor(F.col("w") / 4), F.lit(12)).cast("int") + 1
    quarter = F.least(F.floor(F.col("w") / 13), F.lit(3)).cast("int") + 1
    code = (F.col("y") * 10_000 + period * 100 + F.col("w") - 4 * (period - 1) + 1).cast("string")
    days = days.select("trn_date", code.alias("fiscal_week"), F.substring(code, 1, 6).alias("fiscal_month"),
                       (F.col("y") * 100 + quarter).cast("string").alias("fiscal_quarter"),
                       F.col("y").cast("string").alias("fiscal_year"))
    return Calendar(days)
