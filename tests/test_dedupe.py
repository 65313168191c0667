from pyspark.sql import Observation
from pyspark.sql import functions as F

from reelsim.operators.dedupe import keep_first
from reelsim.plans.prepare import prepare_catalog
from reelsim.sources.tables import films

SHUFFLE_ONLY = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def test_stored_first_rows_are_sent(spark):
    """The wide side of the de-dupe is not shuffled, whatever is thought of
    the size of the ids."""
    df = spark.range(1000).select(F.col("id").alias("row_id"), (F.col("id") % 300).cast("string").alias("title"), F.lit("text").alias("wide"))
    df = df.unionByName(spark.createDataFrame([(2000, None, "a"), (2001, None, "b"), (None, "9", "c")], "row_id long, title string, wide string"))
    for k, v in SHUFFLE_ONLY.items():
        spark.conf.set(k, v)
    try:
        got = keep_first(df, ["title"], stored=True)
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = sorted(tuple(r) for r in got.collect())
    finally:
        for k in SHUFFLE_ONLY:
            spark.conf.unset(k)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows == sorted(tuple(r) for r in keep_first(df, ["title"]).collect()) and len(rows) == 301


def test_observed_catalog_makes_tokens_after_the_dedupe(spark, sf_small):
    seen = Observation("tokens-late")
    f = films(spark, sf_small)
    observed = prepare_catalog(f, seen=seen)
    plan = observed._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, x in enumerate(lines) if "Join LeftSemi" in x)
    cleaned = [i for i, x in enumerate(lines) if "regexp_extract_all" in x and "[a-z]+" in x]
    assert cleaned and max(cleaned) < join
    cols = ["row_id", "title", "title_key", "tokens", "clean_description"]
    want = prepare_catalog(f).select(*cols)
    assert sorted(map(tuple, observed.select(*cols).collect())) == sorted(map(tuple, want.collect()))
