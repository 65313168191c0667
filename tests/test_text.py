from pyspark.sql import functions as F

from reelsim.functions.text import (bigrams, clean_tokens, default_stop_words, raw_tokens,
                                    uni_bi_grams, word_count)


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first().y


def test_default_stop_words_has_fragments():
    words = default_stop_words()
    assert len(words) == 202
    for frag in ("don", "isn", "couldn", "ll", "ve"):
        assert frag in words


def test_clean_tokens_rules(spark):
    # punctuation before the stop-word test; short tokens dropped; digits gone
    assert _one(spark, clean_tokens, "Don't STOP the Heroes, 42 times!!") == ["stop", "heroes", "times"]
    assert _one(spark, clean_tokens, None) == []
    assert _one(spark, clean_tokens, "   ") == []
    assert _one(spark, clean_tokens, "ab cd ef") == []
    # non-ASCII letters split words like the source's [^a-z] rule
    assert _one(spark, clean_tokens, "café crème über") == ["caf", "ber"]


def test_lexicon_applies_after_filter(spark):
    out = _one(spark, lambda c: clean_tokens(c, lexicon={"heroes": "hero", "running": "run"}),
               "heroes running movies")
    assert out == ["hero", "run", "movies"]


def test_bigrams_short_arrays(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b", "c"],)], "t array<string>")
    got = [r.b for r in df.select(bigrams("t").alias("b")).collect()]
    assert got == [[], [], ["a b", "b c"]]
    got = [r.u for r in df.select(uni_bi_grams("t").alias("u")).collect()]
    assert got == [[], ["a"], ["a", "b", "c", "a b", "b c"]]


def test_raw_tokens_and_word_count(spark):
    assert _one(spark, raw_tokens, "Été x_1 a 42 b") == ["été", "x_1", "42"]
    assert _one(spark, word_count, "  two  words ") == 2
    assert _one(spark, word_count, None) is None
