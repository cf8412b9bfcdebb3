"""Sources and sinks."""

from shrinkfx.sources.dat import (
    movies_from_lines,
    read_movies,
    read_ratings,
    write_movies_dat,
    write_ratings_dat,
)
from shrinkfx.sources.testdata import ratings_view
from shrinkfx.sources.stages import load_stage, save_stage

__all__ = [
    "movies_from_lines", "read_movies", "read_ratings", "write_movies_dat",
    "write_ratings_dat", "ratings_view", "load_stage", "save_stage",
]
