"""Readers and writers of the reference's text formats (S1-S10, P3 / FIXTURES C8)."""

import math

import pytest
from pyspark.sql import functions as F

from affinis.functions.expr import FEATURES
from affinis.session import scratch_path
from affinis.sources import readers as RD
from affinis.sources import writers as WR


def test_stats_user_last_duplicate_wins(spark):
    p = scratch_path(spark, "su.json")
    spark.createDataFrame(
        [([("1", "2"), ("2", "5"), ("1", "3")], 10, 7)],
        "like_blog_dist array<struct<blog_id:string,likes:string>>, num_likes bigint, user_id bigint",
    ).write.json(p)
    got = {r.blog_id: r.likes for r in RD.stats_user_long(RD.read_stats_user_raw(spark, p)).collect()}
    assert got == {1: 3, 2: 5}


def test_feature_tsv_roundtrip_keeps_nan_inf_and_null(spark):
    rows = [(1.0, 0.5, float("nan"), float("inf"), None, 0.25, -1.0, 2.0)]
    df = spark.createDataFrame(rows, "label double, " + ", ".join(f"{c} double" for c in FEATURES))
    p = scratch_path(spark, "f.tsv")
    WR.write_features_tsv(df, p)
    r = RD.read_train_features(spark, p).first()
    assert r.label == 1.0 and math.isnan(r.tags_likelihood) and r.language_likelihood == math.inf
    assert r.author_likelihood is None


def test_truth_and_id_list(spark):
    truth = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "user_id bigint, post_id bigint")
    p = scratch_path(spark, "t.csv")
    WR.write_truth_csv(truth, p)
    assert sorted(map(tuple, RD.read_truth(spark, p).collect())) == [(1, 10), (1, 11), (2, 12)]
    q = scratch_path(spark, "ids.csv")
    WR.write_id_list(truth.select("user_id").distinct(), "user_id", q)
    assert sorted(r.user_id for r in RD.read_id_list(spark, q).collect()) == [1, 2]


POST = ("post_id bigint, blog_id bigint, author_id bigint, language string, title string, content string, "
        "categories array<string>, tags array<string>")


def test_posts_json_nulls_and_any_url(spark):
    posts = spark.createDataFrame(
        [(1, 1, 10, "en", "t", "c", ["A", "A"], ["x"], "http://blog/1#likes-7"), (2, 1, 10, "en", None, "c", ["B"], ["y"], "u")],
        POST + ", url string")
    likes = spark.createDataFrame([(u, 1) for u in range(20_000)], "user_id bigint, post_id bigint")
    p = scratch_path(spark, "posts.json")
    WR.write_posts_json(posts, likes, p)
    raw = RD.read_posts_raw(spark, p)
    assert raw.count() == 2                    # one record per post, whatever its size
    ps = RD.posts_from_raw(raw).collect()
    assert [r.post_id for r in ps] == [1] and ps[0].categories == ["A"]   # null title dropped, set semantics
    assert RD.likes_from_raw(raw).count() == 20_000


def test_two_records_of_a_user_stay_two(spark):
    p = scratch_path(spark, "twice.json")
    spark.createDataFrame([([("1", "2"), ("2", "3"), ("1", "4")], 5, 7), ([("1", "9")], 9, 7)],
                          "like_blog_dist array<struct<blog_id:string,likes:string>>, num_likes bigint, user_id bigint").write.json(p)
    raw = RD.read_stats_user_raw(spark, p)
    assert sorted(map(tuple, RD.stats_user_long(raw).collect())) == [(7, 1, 4, 5), (7, 1, 9, 9), (7, 2, 3, 5)]
    assert sorted(map(tuple, RD.stats_users(raw).collect())) == [(7, 5), (7, 9)]


def test_feature_parquet_prunes(spark):
    cols = ", ".join(f"{c} double" for c in FEATURES)
    rows = [(u, 7 * u % 50, float(u % 2), *([None, float("nan")] + [u / 3] * 5)) for u in range(2000)]
    df = spark.createDataFrame(rows, f"user_id bigint, post_id bigint, label double, {cols}")
    p, q = scratch_path(spark, "train.parquet"), scratch_path(spark, "keyed.parquet")
    WR.write_features(df, p)
    WR.write_features(df, q, keyed=True, files=8)
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    ones = RD.read_features(spark, p).where("label = 1.0")
    assert ones.count() == 1000 and "PartitionFilters: [isnotnull(label" in plan(ones)
    few = RD.read_features(spark, q, keyed=True).where("user_id >= 1900")
    assert "GreaterThanOrEqual(user_id,1900)" in plan(few)
    # key ranges are in files of their own
    assert few.select(F.input_file_name()).distinct().count() <= 2
    key = lambda r: tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in r)
    assert set(map(key, few.collect())) == {key((r[0], r[1], *r[3:])) for r in rows if r[0] >= 1900}


def test_posts_with_one_id_in_two_blogs_are_two(spark):
    posts = spark.createDataFrame([(1, b, 10, "en", "t", "c", ["A"], ["x"]) for b in (1, 2)],
                                  "post_id bigint, blog_id bigint, author_id bigint, language string, title string, "
                                  "content string, categories array<string>, tags array<string>")
    p = scratch_path(spark, "twins.json")
    WR.write_posts_json(posts, None, p)
    assert sorted(r.blog_id for r in RD.posts_from_raw(RD.read_posts_raw(spark, p, test=True)).collect()) == [1, 2]


def test_users_with_an_empty_list_stay(spark):
    p = scratch_path(spark, "empty.json")
    spark.createDataFrame([([("1", "2")], 2, 7), ([], 0, 8), (None, 0, 9)],
                          "like_blog_dist array<struct<blog_id:string,likes:string>>, num_likes bigint, user_id bigint").write.json(p)
    raw = RD.read_stats_user_raw(spark, p)
    assert {r.user_id: r.num_likes for r in RD.stats_users(raw).collect()} == {7: 2, 8: 0, 9: 0}
    assert [r.user_id for r in RD.stats_user_long(raw).collect()] == [7]


def test_feature_text_is_compressed(spark):
    """The text of many doubles is written gzipped, and is read back to the bit."""
    import glob
    import gzip
    import os
    cols = ", ".join(f"{c} double" for c in FEATURES)
    rows = [(u, 7 * u, *[(u + i) / 7 if (u + i) % 5 else None for i in range(7)]) for u in range(3000)]
    df = spark.createDataFrame(rows, f"user_id bigint, post_id bigint, {cols}")
    p = scratch_path(spark, "keyed.tsv")
    WR.write_features_tsv(df, p, keyed=True)
    files = glob.glob(f"{p.removeprefix('file:')}/part-*")
    assert files and all(f.endswith(".gz") for f in files)
    text = sum(len(gzip.open(f).read()) for f in files)
    assert sum(map(os.path.getsize, files)) < text / 2
    assert sorted(map(tuple, RD.read_test_features(spark, p).collect())) == sorted(rows)
