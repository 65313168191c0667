"""Noun lemmas against a word-by-word version."""

from reelsim.operators.lemma import NOUN_ENDINGS, lemmatise_nouns, noun_lemmas

KNOWN = ["bus", "dress", "wolf", "box", "quiz", "church", "dish", "woman", "story", "hero", "axe", "goose", "as", "a", "gas", "x", "men"]
LISTED = {"geese": ["goose"], "axes": ["axe", "axis"], "mice": ["mouse"]}
FORMS = ["buses", "dresses", "wolves", "boxes", "quizes", "churches", "dishes", "women", "stories", "heros", "geese", "axes", "mice", "bus", "gases",
         "asses", "men", "busess", "boxess", "xs", "s", "ss", "plain", "storys", "as", "ases", "", "ménses"]


def plain(form):
    if form in LISTED:
        tries = [[form, *LISTED[form]]]
    else:
        step = lambda fs: [f[:len(f) - len(a)] + b for f in fs for a, b in NOUN_ENDINGS if f.endswith(a)]
        fs = step([form])
        tries = [[form, *fs]]
        while fs:
            fs = step(fs)
            tries.append(fs)
    for some in tries:
        hits = sorted((x for x in some if x in KNOWN), key=lambda x: (len(x), x))
        if hits:
            return hits[0]
    return None


def test_noun_lemmas(spark):
    forms = spark.createDataFrame([(f,) for f in FORMS + FORMS + [None]], "form string")
    lemmas = spark.createDataFrame([(x,) for x in KNOWN + [None, ""]], "lemma string")
    listed = spark.createDataFrame([(k, x) for k, v in LISTED.items() for x in v], "form string, lemma string")
    got = {r.form: r.lemma for r in noun_lemmas(forms, lemmas, listed).collect()}
    assert got == {f: plain(f) for f in FORMS if plain(f)}
    assert got["wolves"] == "wolf" and got["women"] == "woman" and got["axes"] == "axe" and "mice" not in got
    docs = spark.createDataFrame([(1, ["two", "boxes", "mice", "boxes"]), (2, []), (3, ["geese"])], "row_id long, tokens array<string>")
    out = {r.row_id: r.tokens for r in lemmatise_nouns(docs, lemmas, listed).collect()}
    assert out == {1: ["two", "box", "mice", "box"], 2: [], 3: ["goose"]}
    assert noun_lemmas(forms.limit(0), lemmas).count() == 0


def test_rows_rewritten_where_they_are_read(spark):
    """Rows of one id are no shuffle; ids that repeat or are missing go the
    way of positions, with the same results."""
    from reelsim.operators.lemma import _by_position, lemmatise_with_table
    lex = spark.createDataFrame([("heroes", "hero"), ("heroes", "heron"), ("a", "a"), ("b", None)], "form string, lemma string")
    one = spark.createDataFrame([(1, "x", ["heroes", "a", "b"]), (2, "y", []), (3, "z", None)], "row_id long, t string, tokens array<string>")
    got = lemmatise_with_table(one, lex)
    assert got.columns == ["row_id", "t", "tokens"]
    assert "Exchange hashpartitioning(form" not in got._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in got.selectExpr("row_id", "t", "try_element_at(tokens, 1)").collect()} == {(1, "x", "hero"), (2, "y", None), (3, "z", None)}
    both = one.unionByName(spark.createDataFrame([(1, "w", ["heroes"]), (None, "n", ["heroes"])], one.schema))
    plain = _by_position(both, lex.groupBy("form").agg({"lemma": "min"}).toDF("form", "lemma"), "tokens", "row_id")
    key = lambda d: sorted(map(str, d.collect()))
    assert key(lemmatise_with_table(both, lex)) == key(plain)
