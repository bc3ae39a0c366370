"""Declared schemas of the input files and domain tables (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

from affinis.functions.expr import FEATURES

STATS_BLOG = T.StructType([
    T.StructField("blog_id", T.LongType()),
    T.StructField("num_likes", T.LongType()),
    T.StructField("num_posts", T.LongType()),
])

STATS_USER = T.StructType([
    T.StructField("like_blog_dist", T.ArrayType(T.StructType([
        T.StructField("blog_id", T.StringType()),
        T.StructField("likes", T.StringType()),
    ]))),
    T.StructField("num_likes", T.LongType()),
    T.StructField("user_id", T.LongType()),
])

_POST_FIELDS = [
    ("author", T.StringType()),
    ("blog", T.StringType()),
    ("blogname", T.StringType()),
    ("categories", T.ArrayType(T.StringType())),
    ("content", T.StringType()),
    ("date", T.StringType()),
    ("date_gmt", T.StringType()),
    ("language", T.StringType()),
    ("likes", None),
    ("post_id", T.StringType()),
    ("tags", T.ArrayType(T.StringType())),
    ("title", T.StringType()),
    ("url", T.StringType()),
]

LIKE = T.StructType([T.StructField("dt", T.StringType()), T.StructField("uid", T.StringType())])


def _posts(likes_type) -> T.StructType:
    return T.StructType([T.StructField(n, likes_type if t is None else t) for n, t in _POST_FIELDS])


TRAIN_POSTS = _posts(T.ArrayType(LIKE))
TEST_POSTS = _posts(T.ArrayType(T.StringType()))

TRUTH_CSV = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("posts", T.StringType()),
    T.StructField("extra", T.StringType()),
])

TRAIN_FEATURES = T.StructType([T.StructField("label", T.DoubleType())]
                              + [T.StructField(f, T.DoubleType()) for f in FEATURES])

TEST_FEATURES = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("post_id", T.LongType())]
                             + [T.StructField(f, T.DoubleType()) for f in FEATURES])

# domain tables (long form; see README)
POSTS = T.StructType([
    T.StructField("post_id", T.LongType()),
    T.StructField("blog_id", T.LongType()),
    T.StructField("author_id", T.LongType()),
    T.StructField("language", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content_chars", T.IntegerType()),
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("tags", T.ArrayType(T.StringType())),
])
