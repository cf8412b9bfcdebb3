import os
import tempfile

import pytest

from shrinkfx.sources import (movies_from_lines, read_movies, read_ratings, write_movies_dat,
                              write_ratings_dat)
from shrinkfx.sources.dat import rejected


def test_movies_split_into_at_most_three_parts(spark):
    lines = ["1::Toy Story (1995)::Animation|Kids", "2::A::B::C (x)", "3::OnlyTitle",
             "4::Serial (2003-2004)::Drama", "x::Bad id::Drama"]
    got = movies_from_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [tuple(r) for r in got] == [
        (1, "Toy Story (1995)", "Animation|Kids"), (2, "A", "B::C (x)"), (3, "OnlyTitle", ""),
        (4, "Serial (2003-2004)", "Drama"), (None, "Bad id", "Drama")]


def test_ratings_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="shrinkfx-test-")
    path = os.path.join(d, "ratings")
    with open(os.path.join(d, "raw.dat"), "w") as f:
        f.write("1::122::5::838985046\n1::185::4.5::838983525\n2::7::oops::1\n")
    got = read_ratings(spark, os.path.join(d, "raw.dat")).collect()
    assert [tuple(r) for r in got] == [(1, 122, 5.0, 838985046), (1, 185, 4.5, 838983525),
                                       (2, 7, None, 1)]
    df = spark.createDataFrame(got[:2])
    write_ratings_dat(df, path)
    back = read_ratings(spark, path).orderBy("movie_id").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in got[:2]]


def test_movies_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="shrinkfx-test-")
    df = spark.createDataFrame([(1, "X (1990)", "A|B"), (2, "Y", "")], "movie_id long, title string, genres string")
    write_movies_dat(df, os.path.join(d, "m"))
    back = read_movies(spark, os.path.join(d, "m")).orderBy("movie_id").collect()
    assert [tuple(r) for r in back] == [(1, "X (1990)", "A|B"), (2, "Y", "")]


def test_malformed_lines_are_counted_and_weigh_nothing(spark, tmp_path):
    (tmp_path / "ratings.dat").write_text("1::10::4::100\n1::11::x::100\n2::10::3.5::200\nbroken\n")
    r = read_ratings(spark, str(tmp_path / "ratings.dat"))
    assert tuple(rejected(r).first()) == (4, 2)
    assert r.where("rating is null").count() == 2


def test_a_movie_id_on_two_lines_is_an_error(spark, tmp_path):
    from shrinkfx.operators.keys import repeated_keys
    from shrinkfx.plans.experiment import load_ratings_files
    (tmp_path / "ratings.dat").write_text("1::10::4::100\n1::11::5::100\n2::10::3.5::200\n2::12::3::100\n")
    (tmp_path / "good.dat").write_text("10::X (1990)::A\n11::Y (1991)::B\nbad::no id::C\nbad::no id::D\n")
    (tmp_path / "twice.dat").write_text("10::X (1990)::A\n11::Y (1991)::B\n10::X again (1990)::A\n")
    rows = load_ratings_files(spark, str(tmp_path / "ratings.dat"), str(tmp_path / "good.dat")).orderBy("user_id", "movie_id").collect()
    assert [(r.user_id, r.movie_id, r.title) for r in rows] == [
        (1, 10, "X (1990)"), (1, 11, "Y (1991)"), (2, 10, "X (1990)"), (2, 12, None)]
    with pytest.raises(Exception, match="movie_id occurs twice or more: 10"):
        load_ratings_files(spark, str(tmp_path / "ratings.dat"), str(tmp_path / "twice.dat")).collect()
    movies = read_movies(spark, str(tmp_path / "twice.dat"))
    assert [tuple(r) for r in repeated_keys(movies, "movie_id").collect()] == [(10, 2)]
