import calendar
from datetime import datetime, timezone

from pyspark.sql import functions as F

from shrinkfx.functions import (movie_year, percent_label_value, rating_datetime, rating_month,
                                rating_week)


def epoch(y, mo, d, h=0, mi=0, s=0):
    return calendar.timegm(datetime(y, mo, d, h, mi, s, tzinfo=timezone.utc).timetuple())


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_rating_week_nearest_sunday(spark):
    # 2009-01-04 is a Sunday; the following Wednesday noon is exactly half a week later
    sun = epoch(2009, 1, 4)
    cases = [
        (sun, sun),
        (epoch(2009, 1, 7, 11, 59, 59), sun),            # just before half -> down
        (epoch(2009, 1, 7, 12, 0, 0), sun + 604800),     # exact half -> up
        (epoch(2009, 1, 3, 23, 0, 0), sun),              # Saturday night -> next Sunday
        (epoch(1969, 12, 28), epoch(1969, 12, 28)),      # pre-1970 Sunday
        (epoch(1969, 12, 31, 13, 0, 0), epoch(1970, 1, 4)),
    ]
    got = one(spark, rating_week("ts"), [(c[0],) for c in cases], "ts long")
    assert got == [c[1] for c in cases]


def test_rating_month_nearest_start(spark):
    cases = [
        (epoch(2000, 1, 16, 11, 59, 59), epoch(2000, 1, 1)),
        (epoch(2000, 1, 16, 12, 0, 0), epoch(2000, 2, 1)),   # 31-day month: half = 15.5 days -> up
        (epoch(2000, 2, 15, 11, 59, 59), epoch(2000, 2, 1)),  # leap February: half = 14.5 days
        (epoch(2000, 2, 15, 12, 0, 0), epoch(2000, 3, 1)),
        (epoch(1999, 12, 31, 23, 0, 0), epoch(2000, 1, 1)),
    ]
    got = one(spark, rating_month("ts"), [(c[0],) for c in cases], "ts long")
    assert got == [c[1] for c in cases]


def test_movie_year_capture(spark):
    titles = ["Toy Story (1995)", "Serial (2003-2004)", "Odd ()", "Mid (1999) cut", "NoYear",
              "Two (1980) (1999)", "Spaced ( 1990 )"]
    got = one(spark, movie_year("t"), [(t,) for t in titles], "t string")
    assert got == ["1995", "2003-2004", "", None, None, "1999", " 1990 "]


def test_rating_datetime_is_utc_wall_time(spark):
    ts = epoch(1998, 5, 3, 7, 8, 9)
    got = one(spark, rating_datetime("ts"), [(ts,)], "ts long")[0]
    assert got == datetime(1998, 5, 3, 7, 8, 9)


def test_percent_label(spark):
    got = one(spark, percent_label_value("p"), [("1%",), ("100%",), ("N/A",)], "p string")
    assert got == [1.0, 100.0, None]


def test_functions_do_not_depend_on_session_time_zone(spark):
    ts = epoch(2001, 3, 18, 23, 30, 0)
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = spark.createDataFrame([(ts,)], "ts long").select(
            rating_week("ts"), rating_month("ts"), rating_datetime("ts")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == epoch(2001, 3, 18) and got[1] == epoch(2001, 4, 1)
    assert got[2] == datetime(2001, 3, 18, 23, 30, 0)
    assert F is not None
