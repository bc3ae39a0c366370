"""Scalar expressions: word count (FIXTURES C1), hash (C7), rounding, division."""

import math

from pyspark.sql import functions as F

from affinis.functions.expr import round_half_up, safe_div, unit_hash, word_count

# (title, expected words) as Java's String.split("[^\\w']+").length gives them
CASES = [("", 1), ("hello", 1), ("!hello world!", 3), ("中国", 0), ("don't stop", 2), ("a--b", 2),
         ("  ", 0), ("été noir", 3), ("x ", 1), ("__a", 1), ("Hello, big world", 3), ("!wow", 2)]


def test_word_count(spark):
    df = spark.createDataFrame(CASES, "t string, n int")
    got = {r.t: r.w for r in df.select("t", word_count("t").alias("w")).collect()}
    assert got == dict(CASES)
    assert spark.range(1).select(word_count(F.lit(None).cast("string")).alias("w")).first().w == 0


def test_hash_value(spark):
    v = spark.range(1).select(unit_hash(F.lit("42"), F.lit("7"), F.lit("3")).alias("h")).first().h
    assert round(v * 2 ** 32) == 843983919
    assert 0.0 <= v < 1.0


def test_safe_div_nulls(spark):
    r = spark.range(1).select(safe_div(F.lit(0), F.lit(0)).alias("a"), safe_div(F.lit(3), F.lit(0)).alias("b"),
                              safe_div(F.lit(1), F.lit(4)).alias("c")).first()
    assert r.a is None and r.b is None and r.c == 0.25


def test_round_half_up(spark):
    vals = [0.5, 1.5, -0.5, -1.5, 2.4999, 0.125]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.r for r in df.select(round_half_up("x").alias("r")).collect()]
    assert got == [float(math.floor(v + 0.5)) for v in vals]
    got2 = [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()]
    assert got2 == [math.floor(v * 100 + 0.5) / 100 for v in vals]


def test_native_sample_and_sketch(spark):
    from affinis.operators.candidates import sample_users_native
    from affinis.operators.eda import count_distinct_keys_approx
    users = spark.range(0, 5000).withColumnRenamed("id", "user_id")
    s = sample_users_native(users, 0.1, 100, seed=3)
    assert s.count() == 100 and s.distinct().count() == 100
    a = [r.user_id for r in sample_users_native(users, 0.1, 100, seed=3).collect()]
    assert a == [r.user_id for r in s.collect()]
    su = users.selectExpr("user_id", "user_id % 20 AS blog_id", "1 AS likes", "1 AS num_likes")
    r = count_distinct_keys_approx(su, su, su).first()
    assert abs(r.n_stats_users - 5000) < 250 and r.n_post_blogs == 20


def test_count_at_or_below(spark):
    from affinis.functions.expr import with_count_at_or_below
    vals = [0.1, 0.2, 0.5, 0.9]
    xs = [-1.0, 0.1, 0.15, 0.2, 0.3, 0.9, 2.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.n for r in with_count_at_or_below(df, "x", vals, "n").orderBy("x").collect()]
    assert got == [sum(1 for v in vals if v <= x) for x in xs]
    assert {r.n for r in with_count_at_or_below(df, "x", [], "n").collect()} == {0}
