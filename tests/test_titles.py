from pyspark.sql import functions as F

from reelsim.functions.display import (chart_label, display_title, match_badge, rank_label,
                                       score_percent, short_description)
from reelsim.functions.genres import genre_pieces, primary_genre
from reelsim.functions.titles import display_with_year, name_only, title_key, year


def test_title_key_and_name(spark):
    rows = [("  Die Hard - 1988 ",), ("Se7en-1995",), ("A - B - 2001",), ("X - 19999",),
            (" - 1999",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(
        title_key("t").alias("k")).select("k", name_only("k").alias("n"))
    got = [(r.k, r.n) for r in df.collect()]
    assert got == [("die hard - 1988", "die hard"), ("se7en-1995", "se7en"),
                   ("a - b - 2001", "a - b"), ("x - 19999", "x - 19999"),
                   ("- 1999", ""), ("nan", "nan")]


def test_year_and_display(spark):
    df = spark.createDataFrame([("Die Hard - 1988",), ("No Year",)], "t string")
    got = df.select(year("t").alias("y"), display_with_year("t").alias("d")).collect()
    assert [(r.y, r.d) for r in got] == [("1988", "Die Hard (1988)"), (None, "No Year")]


def test_display_columns(spark):
    df = spark.createDataFrame([("A - B - 2001", "x" * 250, 0.5678, 3)],
                               "t string, d string, s double, r int")
    r = df.select(display_title("t").alias("a"), short_description("d").alias("b"),
                  match_badge("s").alias("c"), score_percent("s").alias("e"),
                  chart_label("t").alias("f"), rank_label("r").alias("g")).first()
    assert r.a == "A - B"
    assert len(r.b) == 201 and r.b.endswith("…")
    assert r.c == "56% match"
    assert r.e == "56.8%"
    assert r.f == "A - B - 2001…"
    assert r.g == "03"


def test_genre_pieces(spark):
    df = spark.createDataFrame([("War,",), ("Action, Drama|Sci-Fi/War",)], "g string")
    got = [r.p for r in df.select(genre_pieces("g").alias("p")).collect()]
    assert got == [["War", ""], ["Action", "Drama", "Sci-Fi", "War"]]
    assert df.select(primary_genre("g").alias("p")).collect()[1].p == "Action"


def test_words_of_seven_characters_are_one_gram(spark):
    from reelsim.functions.titles import query_grams
    got = spark.createDataFrame([("1234567",), ("123456",)], "q string").select(query_grams("q").alias("g")).collect()
    assert [r.g for r in got] == [["1234567"], ["123456"]]
