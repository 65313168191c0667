from reelsim.operators.profile import duplicate_count, histogram, null_counts


def test_histogram_nulls_last_bin_and_constant(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.5,), (10.0,), (None,), (None,)], "v double")
    rows = sorted(histogram(df, "v", 5).collect())
    assert [r["count"] for r in rows] == [2, 1, 0, 0, 1]      # width 2; max in the closed last bin; nulls ignored
    assert rows[0].lo == 0.0 and rows[-1].hi == 10.0
    const = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    rows = sorted(histogram(const, "v", 2).collect())
    assert [(r.lo, r.hi, r["count"]) for r in rows] == [(2.5, 3.0, 0), (3.0, 3.5, 2)]


def test_null_and_duplicate_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3), ("b", 4)], "t string, x int")
    assert null_counts(df).first().asDict() == {"t": 2, "x": 1}
    assert df.agg(duplicate_count("t").alias("d")).first().d == 2


def test_dense_index_across_partitions(spark):
    from pyspark.sql import functions as F
    from reelsim.operators.order import dense_index
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k")).repartition(9)
    out = dense_index(df, [F.col("k").desc()], "pos", start=1).collect()
    assert sorted((r.pos, r.k) for r in out) == [(i + 1, 499 - i) for i in range(500)]
