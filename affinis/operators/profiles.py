"""Per-user frequency profiles and global priors.

A profile is long form ``(user_id, kind, key, cnt)``: one row per user and
label instead of a per-user map, so a heavy user is many rows spread by the
shuffle rather than one huge object.  All five kinds come out of one explode
and one aggregate (partial aggregation before the shuffle plays the part of
the map monoid merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.functions.expr import safe_div, title_words_of
from affinis.session import stage

# The kinds of a profile, and which of them the reference cuts to
# the 100 most frequent entries (categories, tags, authors; not language or title length);
# P9 takes the blogs of users with fewer than 1000.  Both are operators, no defaults of the features.
KINDS = ["category", "tag", "language", "author", "title_len"]
CAPPED_KINDS = ["category", "tag", "author"]
TOP_ENTRIES = 100
MAX_BLOGS_PER_USER = 1000
#: Partitions of a stored profile: what an upkeep with few new users reads and writes is in proportion.
PROFILE_BUCKETS = 64


def _kv(kind: str, key) -> F.Column:
    return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"))


def liked_posts(likes: DataFrame, posts: DataFrame) -> DataFrame:
    cols = ["post_id", "categories", "tags", "language", "author_id"]
    p = posts.select(*cols, title_words_of(posts).alias("title_words"))
    return likes.select("user_id", "post_id").join(p, "post_id")


def profile_long(likes: DataFrame, posts: DataFrame, cap: int | None = None,
                 kinds: list[str] | None = None) -> DataFrame:
    """(user_id, kind, key, cnt) counts of liked labels.

    With ``cap``, the category, tag and author maps keep only their ``cap``
    largest counts (ties by key), as the reference truncates them.
    """
    kinds = kinds or KINDS
    lp = liked_posts(likes, posts)
    parts = []
    if "category" in kinds:
        parts.append(F.transform("categories", lambda c: _kv("category", c)))
    if "tag" in kinds:
        parts.append(F.transform("tags", lambda t: _kv("tag", t)))
    singles = []
    if "language" in kinds:
        singles.append(_kv("language", F.col("language")))
    if "author" in kinds:
        singles.append(_kv("author", F.col("author_id")))
    if "title_len" in kinds:
        singles.append(_kv("title_len", F.col("title_words")))
    if singles:
        parts.append(F.array(*singles))
    items = parts[0] if len(parts) == 1 else F.concat(*parts)
    counts = (lp.select("user_id", F.explode(items).alias("kv"))
              .groupBy("user_id", F.col("kv.kind").alias("kind"), F.col("kv.key").alias("key"))
              .agg(F.count(F.lit(1)).alias("cnt")))
    if cap is None:
        return counts
    # Spark's window group limit cuts each map before the shuffle; the other kinds are not ranked at all
    w = Window.partitionBy("user_id", "kind").orderBy(F.col("cnt").desc(), F.col("key").asc())
    capped = F.col("kind").isin(CAPPED_KINDS)
    top = counts.where(capped).withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= cap).drop("_rank")
    return top.unionByName(counts.where(~capped))


def profile_kind(likes: DataFrame, posts: DataFrame, kind: str, key_name: str, key_type: str = "string",
                 cap: int | None = None) -> DataFrame:
    """One kind of profile as (user_id, <key_name>, cnt)."""
    p = profile_long(likes, posts, cap=cap, kinds=[kind])
    return p.select("user_id", F.col("key").cast(key_type).alias(key_name), "cnt")


def user_profile_totals(profile: DataFrame) -> DataFrame:
    """Per user: sum of each (possibly truncated) map and the title-length statistics."""
    k = F.col("kind")
    return profile.groupBy("user_id").agg(
        F.sum(F.when(k == "category", F.col("cnt"))).alias("tot_category"),
        F.sum(F.when(k == "tag", F.col("cnt"))).alias("tot_tag"),
        F.sum(F.when(k == "language", F.col("cnt"))).alias("tot_language"),
        F.sum(F.when(k == "author", F.col("cnt"))).alias("tot_author"),
        F.sum(F.when(k == "title_len", F.col("cnt"))).alias("tl_sum"),
        F.count(F.when(k == "title_len", F.lit(1))).alias("tl_n"),
        F.sum(F.when(k == "title_len", F.col("cnt") * F.col("key").cast("bigint"))).alias("tl_wsum"),
    )


# ---- upkeep of a stored profile -----------------------------------------------------------

def _bucketed(profile: DataFrame, buckets: int) -> DataFrame:
    return profile.select("user_id", "kind", "key", "cnt", F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int").alias("bucket"))


def write_profile(profile: DataFrame, path: str, buckets: int = PROFILE_BUCKETS) -> None:
    """Store a whole (uncut) profile, one partition per bucket of users."""
    _bucketed(profile, buckets).repartition("bucket", F.pmod(F.xxhash64("key"), F.lit(8))).write.partitionBy("bucket").parquet(path)


def read_profile(spark, path: str) -> DataFrame:
    return spark.read.schema("user_id long, kind string, key string, cnt long, bucket int").parquet(path)


def merge_profile(spark, path: str, more: DataFrame, buckets: int = PROFILE_BUCKETS) -> int:
    """A10: add the counts of ``more`` (a profile of new likes) to the stored profile; the number of partitions written.

    Counts of two sets of likes add up, so old likes are not read.  Only the partitions of users with new likes are
    read and overwritten.  The merged rows are written apart first: a failed job leaves the stored profile as it was.
    """
    new = stage(_bucketed(more, buckets), "new_profile")
    touched = [r.bucket for r in new.select("bucket").distinct().collect()]       # at most ``buckets`` numbers
    if not touched:
        return 0
    merged = (read_profile(spark, path).where(F.col("bucket").isin(touched)).unionByName(new)
              .groupBy("user_id", "kind", "key", "bucket").agg(F.sum("cnt").alias("cnt")))
    merged = stage(merged.select("user_id", "kind", "key", "cnt", "bucket"), "merged_profile")
    (merged.repartition("bucket", F.pmod(F.xxhash64("key"), F.lit(8))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))
    return len(touched)


# ---- statistics-based priors -------------------------------------------------------------

def blog_like_totals(stats_user: DataFrame) -> DataFrame:
    """(blog_id, blog_likes): likes of a blog summed over all users in the statistics."""
    return stats_user.groupBy("blog_id").agg(F.sum("likes").alias("blog_likes"))


def total_user_likes(stats_user: DataFrame) -> F.Column:
    """Scalar: sum of num_likes over users (each user counted once)."""
    per_user = stats_user.groupBy("user_id").agg(F.max("num_likes").alias("n"))
    return per_user.agg(F.sum("n")).scalar()


def prior_blog_likelihood(stats_user: DataFrame) -> DataFrame:
    """A1: (blog_id, prior) = likes of the blog over all users / sum of all users' likes."""
    return blog_like_totals(stats_user).select(
        "blog_id", safe_div(F.col("blog_likes"), total_user_likes(stats_user)).alias("prior"))


def mean_blog_likes(stats_blog: DataFrame) -> DataFrame:
    """A2: one row, mean likes per post over all blogs = sum of likes / sum of posts."""
    return stats_blog.agg(safe_div(F.sum("num_likes"), F.sum("num_posts")).alias("mean_likes_per_post"))


def blog_avg_likes(stats_blog: DataFrame) -> DataFrame:
    """A3: (blog_id, avg_likes_per_post); a blog with no posts is undefined (null)."""
    return stats_blog.select("blog_id", safe_div("num_likes", "num_posts").alias("avg_likes_per_post"))


def user_blog_likelihood(stats_user: DataFrame) -> DataFrame:
    """A4: (user_id, blog_id, likelihood) = share of the user's likes that went to the blog."""
    return stats_user.select("user_id", "blog_id", safe_div("likes", "num_likes").alias("likelihood"))


def capped_stats_users(stats_user: DataFrame, cap: int | None = MAX_BLOGS_PER_USER) -> DataFrame:
    """Statistics rows of users who liked fewer than ``cap`` blogs (all rows without a cap)."""
    if cap is None:
        return stats_user
    n = stats_user.groupBy("user_id").agg(F.count(F.lit(1)).alias("_nb")).where(F.col("_nb") < cap)
    return stats_user.join(n.select("user_id"), "user_id")


def user_blog_likelihood_capped(stats_user: DataFrame, cap: int = MAX_BLOGS_PER_USER) -> DataFrame:
    return user_blog_likelihood(capped_stats_users(stats_user, cap))
