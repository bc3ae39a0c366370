"""Readers for the reference's input files.

Each reader declares its schema and fails fast on a malformed row, as the
reference's positional pattern match does.  Nested inputs are turned into
long form right away (one row per like / per blog count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.operators.clean import last_entries
from affinis.sources import schemas as S

_TSV = dict(sep="\t", mode="FAILFAST", nanValue="NaN", positiveInf="Infinity", negativeInf="-Infinity")


def read_stats_blog(spark: SparkSession, path: str) -> DataFrame:
    """Blog statistics, JSON lines."""
    return spark.read.schema(S.STATS_BLOG).option("mode", "FAILFAST").json(path)


def read_stats_user_raw(spark: SparkSession, path: str) -> DataFrame:
    """User statistics with the nested per-blog list, as stored."""
    return spark.read.schema(S.STATS_USER).option("mode", "FAILFAST").json(path)


def stats_user_long(raw: DataFrame) -> DataFrame:
    """S2 + P3: one row per (record, blog) with the like count; ids cast from strings.

    A blog listed twice in a record keeps its last entry (a map built from the
    list overwrites earlier keys).  Two records of one user stay two records.
    """
    # in a step of its own: numbered before the list is exploded
    raw = raw.withColumn("record", F.monotonically_increasing_id())
    e = raw.select("record", "user_id", "num_likes", F.posexplode("like_blog_dist").alias("pos", "e"))
    e = e.select(
        "record", "user_id", "num_likes", "pos",
        F.col("e.blog_id").cast("bigint").alias("blog_id"),
        F.col("e.likes").cast("bigint").alias("likes"),
    )
    return last_entries(e, "record").select("user_id", "blog_id", "likes", "num_likes")


def stats_users(raw: DataFrame) -> DataFrame:
    """Each user with the total, records of different totals apart; empty or missing per-blog lists are kept."""
    return raw.select("user_id", "num_likes").distinct()


def read_posts_raw(spark: SparkSession, path: str, test: bool = False) -> DataFrame:
    """Posts JSON lines, nested likes (train) or an empty list (test)."""
    return spark.read.schema(S.TEST_POSTS if test else S.TRAIN_POSTS).option("mode", "FAILFAST").json(path)


def posts_from_raw(raw: DataFrame) -> DataFrame:
    """P1 + P2: drop records with any null field, cast ids, lists to sets; every record is one post."""
    clean = raw.na.drop()
    return clean.select(
        F.col("post_id").cast("bigint").alias("post_id"),
        F.col("blog").cast("bigint").alias("blog_id"),
        F.col("author").cast("bigint").alias("author_id"),
        "language",
        "title",
        "content",
        F.array_distinct("categories").alias("categories"),
        F.array_distinct("tags").alias("tags"),
    )


def likes_from_raw(raw: DataFrame) -> DataFrame:
    """S3: long-form likes (user, post), one row per distinct pair."""
    clean = raw.na.drop()
    return (clean.select(F.col("post_id").cast("bigint").alias("post_id"), F.explode("likes").alias("l"))
            .select(F.col("l.uid").cast("bigint").alias("user_id"), "post_id")
            .distinct())


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """CSV ``user,post post post,extra`` to long form (user_id, post_id)."""
    raw = spark.read.schema(S.TRUTH_CSV).option("mode", "FAILFAST").csv(path)
    return (raw.select("user_id", F.explode(F.split("posts", " ")).alias("p"))
            .where(F.col("p") != "")
            .select("user_id", F.col("p").cast("bigint").alias("post_id"))
            .distinct())


def read_id_list(spark: SparkSession, path: str, name: str = "user_id") -> DataFrame:
    """One id per line; lines starting with 'id' are headers."""
    return (spark.read.text(path)
            .where(~F.col("value").startswith("id") & (F.trim("value") != ""))
            .select(F.trim("value").cast("bigint").alias(name)))


def read_train_features(spark: SparkSession, path: str) -> DataFrame:
    """Label + seven features, tab separated."""
    return spark.read.schema(S.TRAIN_FEATURES).options(**_TSV).csv(path)


def read_test_features(spark: SparkSession, path: str) -> DataFrame:
    """User, post + seven features, tab separated."""
    return spark.read.schema(S.TEST_FEATURES).options(**_TSV).csv(path)


def read_features(spark: SparkSession, path: str, keyed: bool = False) -> DataFrame:
    """S7 / S8 from Parquet: filters on the label or on the keys are pushed down to files and row groups."""
    schema = S.TEST_FEATURES if keyed else S.TRAIN_FEATURES
    return spark.read.schema(schema).parquet(path).select(schema.names)
