"""Writers (S9, S10) and the nested formats of the reference's inputs.

Feature files are Parquet by default: labelled rows in one folder per label, keyed rows ordered by user over range
partitions, so that a reader of one label or of a range of users skips the other files and row groups.  The text
form is the reference's.  A nested record holds all likes of its post, or all blogs of its user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.expr import FEATURES

_TSV = dict(sep="\t", nanValue="NaN", positiveInf="Infinity", negativeInf="-Infinity")
# a row of doubles is many times as long in text as in Parquet; the fastest level already takes most of that back
_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_features(df: DataFrame, path: str, keyed: bool = False, files: int | None = None, mode: str = "errorifexists") -> None:
    """S9 (by label) or S10 (``keyed``: by user_id, post_id) as Parquet; ``files`` sets the number of key ranges."""
    if keyed:
        by = [F.col("user_id"), F.col("post_id")]
        parts = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
        parts.sortWithinPartitions(*by).select("user_id", "post_id", *FEATURES).write.mode(mode).parquet(path)
    else:
        df.select("label", *FEATURES).sortWithinPartitions("label").write.mode(mode).partitionBy("label").parquet(path)


def write_features_tsv(df: DataFrame, path: str, keyed: bool = False, mode: str = "errorifexists") -> None:
    """S9 (label first) or S10 (user_id, post_id first) as tab-separated text, gzipped."""
    head = ["user_id", "post_id"] if keyed else ["label"]
    df.select(*head, *FEATURES).write.mode(mode).options(**_TSV, **_GZIP).csv(path)


def write_stats_blog_json(stats_blog: DataFrame, path: str) -> None:
    stats_blog.select("blog_id", "num_likes", "num_posts").write.mode("errorifexists").json(path)


def write_stats_user_json(stats_user_long: DataFrame, path: str) -> None:
    """Long (user, blog, likes, num_likes) to one nested record per user."""
    (stats_user_long.groupBy("user_id")
     .agg(F.first("num_likes").alias("num_likes"),
          F.collect_list(F.struct(F.col("blog_id").cast("string").alias("blog_id"),
                                  F.col("likes").cast("string").alias("likes"))).alias("like_blog_dist"))
     .select("like_blog_dist", "num_likes", "user_id")
     .write.mode("errorifexists").json(path))


def write_posts_json(posts: DataFrame, likes: DataFrame | None, path: str) -> None:
    """Posts (with ``content``, and ``url`` if they have one) with nested likes (train form) or an empty likes list (test form)."""
    base = posts.select(
        F.col("author_id").cast("string").alias("author"),
        F.col("blog_id").cast("string").alias("blog"),
        F.concat(F.lit("blog "), F.col("blog_id").cast("string")).alias("blogname"),
        "categories", "content",
        F.lit("2000-01-01 00:00:00").alias("date"), F.lit("2000-01-01 00:00:00").alias("date_gmt"),
        "language",
        F.col("post_id").cast("string").alias("post_id"),
        "tags", "title",
        F.col("url") if "url" in posts.columns else F.concat(F.lit("http://blog/"), F.col("post_id").cast("string")).alias("url"),
    )
    if likes is None:
        out = base.withColumn("likes", F.array().cast("array<string>"))
    else:
        nested = likes.groupBy(F.col("post_id").cast("string").alias("post_id")).agg(
            F.collect_list(F.struct(F.lit("2000-01-01 00:00:00").alias("dt"), F.col("user_id").cast("string").alias("uid"))).alias("likes"))
        out = base.join(nested, "post_id", "left").withColumn(
            "likes", F.coalesce("likes", F.array().cast("array<struct<dt:string,uid:string>>")))
    out.select("author", "blog", "blogname", "categories", "content", "date", "date_gmt", "language",
               "likes", "post_id", "tags", "title", "url").write.mode("errorifexists").json(path)


def write_truth_csv(truth: DataFrame, path: str) -> None:
    """Long (user, post) to ``user,post post ...,n`` lines."""
    (truth.groupBy("user_id")
     .agg(F.concat_ws(" ", F.collect_list(F.col("post_id").cast("string"))).alias("posts"),
          F.count(F.lit(1)).cast("string").alias("extra"))
     .select("user_id", "posts", "extra")
     .write.mode("errorifexists").csv(path))


def write_id_list(ids: DataFrame, col: str, path: str) -> None:
    """One id per line under an ``id`` header line."""
    ids.select(F.col(col).cast("string").alias("id")).write.mode("errorifexists").option("header", True).csv(path)
