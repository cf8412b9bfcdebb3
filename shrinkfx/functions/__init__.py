"""Column expressions (all JVM-side built-ins, time-zone independent)."""

from shrinkfx.functions.columns import (
    MOVIE_YEAR_PATTERN,
    epoch_seconds,
    format_number_text,
    movie_year,
    percent_label_value,
    rating_datetime,
    rating_month,
    rating_week,
)

__all__ = [
    "MOVIE_YEAR_PATTERN", "epoch_seconds", "format_number_text", "movie_year",
    "percent_label_value", "rating_datetime", "rating_month", "rating_week",
]
