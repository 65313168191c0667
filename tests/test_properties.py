"""Property tests: the Spark expressions against plain-Python statements
of the same rules, on generated text."""

import re
import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelsim.functions.text import clean_tokens, default_stop_words, uni_bi_grams
from reelsim.functions.titles import name_only, title_key

STOPS = set(default_stop_words())
ALPHABET = string.ascii_letters + string.digits + " \t\n.,;:'\"-!?éÉßü" + " "


texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=60)), min_size=1, max_size=25)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_clean_tokens_matches_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r.i: (r.t, r.g) for r in df.select(
        "i", clean_tokens("x").alias("t"), uni_bi_grams(clean_tokens("x")).alias("g")).collect()}
    for i, v in enumerate(values):
        tokens, terms = got[i]
        low, at = (v or "").lower(), 0
        for w in tokens:
            # a whole run of letters of the text, in order, neither short nor a stop word
            at = low.index(w, at) + len(w)
            assert re.fullmatch("[a-z]{3,}", w) and w not in STOPS
            assert re.search(f"(?<![a-z]){w}(?![a-z])", low)
        assert terms[:len(tokens)] == tokens and len(terms) == max(2 * len(tokens) - 1, 0)
        assert [t.split(" ") for t in terms[len(tokens):]] == [list(x) for x in zip(tokens, tokens[1:])]


def test_clean_tokens_by_hand(spark):
    cases = {"The Hero's 2nd life": ["hero", "life"], "sci-fi/horror": ["sci", "horror"], "": [], "it is an": [], "É1abc2": ["abc"]}
    df = spark.createDataFrame(list(enumerate(cases)), "i int, x string")
    got = {r.i: r.t for r in df.select("i", clean_tokens("x").alias("t")).collect()}
    assert got == dict(enumerate(cases.values()))


titles = st.lists(st.text(alphabet=string.ascii_letters + string.digits + " -", max_size=25),
                  min_size=1, max_size=25)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(titles)
def test_title_key_and_name_match_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    got = {r.i: (r.k, r.n) for r in df.select(
        "i", title_key("t").alias("k"), name_only(title_key("t")).alias("n")).collect()}
    for i, v in enumerate(values):
        key, name = got[i]
        assert key == key.strip() == key.lower() and key in v.lower()
        # the name is the key, or the key short of a dash and four digits
        rest = key[len(name):] if key.startswith(name) else None
        assert name == name.strip() and rest is not None
        assert not rest.strip() or (rest.strip()[0] == "-" and rest.strip()[-4:].isdigit() and len(rest.strip()[1:].strip()) == 4)


def test_title_names_by_hand(spark):
    cases = {"Se7en-1995": "se7en", "A - B - 2001": "a - b", "X - 19999": "x - 19999", " - 1999": "", "2012 - 2009 ": "2012"}
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = {r.i: r.n for r in df.select("i", name_only(title_key("t")).alias("n")).collect()}
    assert got == dict(enumerate(cases.values()))
