import datetime as dt

import pytest

from hearthline.functions.calendar import Calendar, nearest_sunday_calendar
from hearthline.operators import behavior as B


@pytest.fixture(scope="module")
def calendar(spark):
    return nearest_sunday_calendar(spark, 1994, 2003)


def opens(year):
    return min((dt.date(year, 2, 1) + dt.timedelta(days=d) for d in range(-3, 4)), key=lambda d: (d.isoweekday() % 7, 0))


def test_every_day_has_its_week(calendar):
    rows = {r.trn_date: r for r in calendar.days.collect()}
    begin, stop = opens(1994), opens(2004)
    assert len(rows) == (stop - begin).days
    long_years = 0
    for year in range(1994, 2004):
        first, after = opens(year), opens(year + 1)
        weeks = (after - first).days // 7
        long_years += weeks == 53
        for k in range((after - first).days):
            week = k // 7
            period = 13 if week >= 48 else week // 4 + 1
            r = rows[first + dt.timedelta(days=k)]
            assert r.fiscal_week == f"{year}{period:02d}{week - 4 * period + 5:02d}"
            assert r.fiscal_month == r.fiscal_week[:6] and r.fiscal_year == str(year)
            assert r.fiscal_quarter == f"{year}{min(week // 13, 3) + 1:02d}"
    assert long_years >= 1


def test_weeks_ago_counts_the_53rd(calendar):
    day = opens(1994)
    codes = []
    while day < opens(2004):
        codes.append(calendar.week_of(day))
        day += dt.timedelta(weeks=1)
    assert len(set(codes)) == len(codes) and codes == sorted(codes)
    leap = next(c for c in codes if c[4:] == "1305")
    at = codes.index(leap)
    assert calendar.weeks_ago(codes[at + 1], 1) == leap
    assert calendar.weeks_ago(codes[at + 30], 52) == codes[at - 22]
    assert calendar.weeks_ago(leap, -1) == codes[at + 1]
    assert calendar.weeks_between(codes[at - 1], codes[at + 1]) == codes[at - 1:at + 2]
    first, last = calendar.week_dates(leap)
    assert calendar.week_of(first) == calendar.week_of(last) == leap and (last - first).days == 6


def test_quarters_of_a_window_over_the_53rd_week(spark, calendar):
    codes = calendar.weeks_between(calendar.week_of(dt.date(1995, 1, 1)), calendar.week_of(dt.date(2003, 1, 1)))
    at = next(k for k, c in enumerate(codes) if c[4:] == "1305")
    start = codes[at - 20]
    frame = spark.createDataFrame([(c,) for c in codes], "w string")
    found = {r.w: r.q for r in frame.select("w", calendar.quarter_of_week("w", start).alias("q")).collect()}
    for k, code in enumerate(codes):
        assert found[code] == ((k - at + 20) // 13 + 1 if k >= at - 20 else None)


def test_faulty_calendars(spark, calendar):
    def table(rows):
        return Calendar(spark.createDataFrame([(d, w, "m", "q", "y") for d, w in rows],
                                              "trn_date date, fiscal_week string, fiscal_month string, fiscal_quarter string, fiscal_year string"))

    def week(first, code, days=7):
        return [(first + dt.timedelta(days=k), code) for k in range(days)]

    begin = dt.date(2020, 2, 2)
    good = week(begin, "a") + week(begin + dt.timedelta(weeks=1), "b")
    assert table(good + good).weeks_ago("b", 1) == "a"
    for rows in (good[:-1], week(begin, "a") + week(begin + dt.timedelta(weeks=2), "b"),
                 week(begin, "b") + week(begin + dt.timedelta(weeks=1), "a")):
        with pytest.raises(ValueError):
            table(rows).number("a")
    for ask in (lambda: calendar.number("19990101x"), lambda: calendar.weeks_ago("19940101", 1),
                lambda: calendar.week_of(dt.date(1970, 1, 1))):
        with pytest.raises(ValueError):
            ask()
    late = spark.createDataFrame([(dt.date(2050, 1, 1), 1), (dt.date(2000, 1, 1), 2)], "trn_date date, hh_id long")
    with pytest.raises(Exception, match="outside the calendar"):
        calendar.attach(late).collect()
    none = spark.createDataFrame([(None, 1)], "trn_date date, hh_id long")
    assert calendar.attach(none).collect()[0].fiscal_week is None


def test_segments_over_the_53rd_week(spark, calendar):
    """Windows reach exactly as many weeks back as they say."""
    codes = calendar.weeks_between(calendar.week_of(dt.date(1995, 1, 1)), calendar.week_of(dt.date(2003, 1, 1)))
    at = next(k for k, c in enumerate(codes) if c[4:] == "1305")
    end, start = codes[at + 25], calendar.weeks_ago(codes[at + 25], 51)
    assert start == codes[at - 26]
    rows = [(1, codes[at - 27]), (2, codes[at - 26]), (3, codes[at - 27]), (3, codes[at])]
    rows += [(4, codes[at - 30])] + [(4, codes[at - 26 + k]) for k in (0, 12, 13, 14, 26, 27, 28)]
    weekly = spark.createDataFrame([(h, w, 100, 1, 1) for h, w in rows],
                                   "hh_id long, fiscal_week string, weekly_sales long, weekly_units long, weekly_visits long")
    vintage = weekly.groupBy("hh_id").agg({"fiscal_week": "min"}).withColumnRenamed("min(fiscal_week)", "vintage_week")
    found = B.household_segments(weekly, vintage, weekly, start, end, calendar=calendar)
    labels = {r.hh_id: r.segment for r in found.collect()}
    assert labels[1] == "lapsed" and labels[2] == "new" and labels[3] == "inconsistent" and labels[4] in "HML"
