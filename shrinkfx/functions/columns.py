"""Derived columns of the ratings data.

Every expression works on epoch seconds or dates, so results do not depend on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's for equal results) ----------
# Release year = text inside the trailing parentheses of a title; digits,
# spaces and hyphens only ("1995", "2003-2004", "" for "()").
MOVIE_YEAR_PATTERN = r"\(([0-9 \-]*)\)$"
# Week starts are Sundays (epoch day 0 is a Thursday, so the first Sunday
# boundary sits 4 days earlier: -345600 s). A week is 604800 s; rounding to
# the nearest start adds half a week (302400 s) before flooring.
WEEK_SECONDS = 604800
SUNDAY_OFFSET_SECONDS = -345600
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts_ntz) -> Column:
    """Epoch seconds of a TIMESTAMP_NTZ / DATE value, without time-zone math."""
    c = _c(ts_ntz)
    return (F.unix_date(F.to_date(c)).cast("bigint") * 86400
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("bigint")


def rating_week(ts) -> Column:
    """Nearest week start (Sunday 00:00 UTC) as epoch seconds; exact halves round up."""
    half_shifted = _c(ts) - F.lit(SUNDAY_OFFSET_SECONDS) + F.lit(WEEK_SECONDS // 2)
    return (F.floor(half_shifted / F.lit(float(WEEK_SECONDS))).cast("bigint")
            * WEEK_SECONDS + SUNDAY_OFFSET_SECONDS)


def rating_month(ts) -> Column:
    """Nearest month start (UTC) as epoch seconds; exact halves round up."""
    t = _c(ts)
    day = F.date_from_unix_date(F.floor(t / F.lit(86400.0)).cast("int"))
    lo_date = F.trunc(day, "month")
    lo = F.unix_date(lo_date).cast("bigint") * 86400
    hi = F.unix_date(F.add_months(lo_date, 1)).cast("bigint") * 86400
    return F.when(hi - t <= t - lo, hi).otherwise(lo)


def rating_datetime(ts) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ in UTC wall time."""
    t = _c(ts)
    days = F.floor(t / F.lit(86400.0)).cast("int")
    secs = (t - days.cast("bigint") * 86400).cast("int")
    base = F.date_from_unix_date(days).cast("timestamp_ntz")
    return base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def movie_year(title) -> Column:
    """Captured year text; NULL when the title has no trailing (...) group."""
    t = _c(title)
    return F.when(t.rlike(MOVIE_YEAR_PATTERN),
                  F.regexp_extract(t, MOVIE_YEAR_PATTERN, 1))


def format_number_text(x) -> Column:
    """Shortest text of a number as R prints it for our values: 5 -> "5", 0.25 -> "0.25"."""
    c = _c(x)
    return F.when(c.isNull(), F.lit("NA")).otherwise(
        F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", ""))


def percent_label_value(label) -> Column:
    """"12%" -> 12.0 (the percent sign is removed, the rest parsed)."""
    return F.regexp_replace(_c(label), "%", "").try_cast("double")
