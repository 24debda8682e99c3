"""Folds and samplers: deterministic, order-invariant, balanced."""

from pyspark.sql import functions as F

from casebook.operators import sampling as SP


def test_folds_partition_and_balance(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    f = SP.add_folds(df, "k", 10, seed=3, stratify="y")
    per = {r[0]: (r[1], r[2]) for r in f.groupBy("fold").agg(F.count("*"), F.sum("y")).collect()}
    assert sorted(per) == list(range(10))
    assert all(n == 100 and pos == 10 for n, pos in per.values())
    assert f.select("k").distinct().count() == 1000


def test_same_seed_same_folds_any_order(spark):
    df = spark.range(300).select(F.col("id").alias("k"))
    a = {tuple(r) for r in SP.add_folds(df, "k", 5, seed=1).select("k", "fold").collect()}
    b = {tuple(r) for r in SP.add_folds(df.orderBy(F.rand(7)).repartition(5), "k", 5, seed=1)
         .select("k", "fold").collect()}
    assert a == b


def test_split_and_undersample(spark):
    df = spark.range(401).select(F.col("id").alias("k"), (F.col("id") < 50).cast("int").alias("y"))
    s = SP.train_test(df, "k", 0.25, seed=2)
    assert s.filter("split = 'test'").count() == 101
    u = SP.undersample(df, 100, seed=2, id_col="k", label="y")
    assert u.count() == 301 and u.filter("y = 1").count() == 50


def test_oversample_to_parity(spark):
    df = spark.range(120).select(F.col("id").alias("k"), (F.col("id") < 20).cast("int").alias("y"))
    o = SP.resample(df, "y", "k", "over", seed=5)
    counts = {r[0]: r[1] for r in o.groupBy("y").count().collect()}
    assert counts == {0: 100, 1: 100}
