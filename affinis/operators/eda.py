"""Exploratory checks and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.operators.negatives import hist_by_edges
from affinis.sources.schemas import POSTS

TOP_CATEGORIES = 25
# The notebook's histograms of likes per user: 25 equal-width bins, and edges 0..24.
HIST_BINS = 25
HIST_EDGES = list(range(0, 25))


def check_user_totals(stats_user: DataFrame) -> DataFrame:
    """P5: number of users whose per-blog counts do not add up to their total."""
    s = stats_user.groupBy("user_id").agg(F.sum("likes").alias("s"), F.max("num_likes").alias("n"))
    return s.agg(F.count(F.when(F.col("s") != F.col("n"), F.lit(1))).alias("n_mismatch"))


def check_empty_language(posts: DataFrame) -> DataFrame:
    """Number of posts whose language is the empty string."""
    return posts.agg(F.count(F.when(F.length("language") == 0, F.lit(1))).alias("n_empty_language"))


def lookup_post(posts: DataFrame, blog_id: int, post_id: int) -> DataFrame:
    """The post with the given (blog, post) key."""
    return posts.where((F.col("blog_id") == blog_id) & (F.col("post_id") == post_id)).select(
        "post_id", "blog_id", "author_id", "language", "title")


def check_null_fields(posts: DataFrame) -> DataFrame:
    """Number of null values in every field of the posts table (one row)."""
    cols = [c for c in POSTS.fieldNames() if c in posts.columns]
    return posts.agg(*[F.sum(F.col(c).isNull().cast("int")).cast("bigint").alias(f"null_{c}") for c in cols])


def hist_equal_width(values: DataFrame, col: str, n: int = HIST_BINS) -> DataFrame:
    """(bin, lo_edge, cnt) for n equal-width bins from min to max; the last bin is closed.

    Same bucket arithmetic as Spark's RDD histogram: floor((x - min) / (max - min) * n).
    """
    v = F.col(col).cast("double")
    lo = values.agg(F.min(v)).scalar()
    hi = values.agg(F.max(v)).scalar()
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((v - lo) / (hi - lo) * F.lit(float(n))), F.lit(n - 1)))
    counts = values.where(F.col(col).isNotNull()).select(b.cast("int").alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias("cnt"))
    bins = values.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / F.lit(float(n))
    return (bins.join(counts, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("lo_edge"), F.coalesce("cnt", F.lit(0)).alias("cnt")))


def hist_edges(values: DataFrame, col: str, edges: list[float] = HIST_EDGES) -> DataFrame:
    """Counts on the given edges (left-closed, last bin closed, outside dropped)."""
    return hist_by_edges(values, col, edges).select("bin", "lo_edge", "hi_edge", "cnt")


def category_counts(posts: DataFrame) -> DataFrame:
    """(category, cnt): number of posts per category."""
    return posts.select(F.explode("categories").alias("category")).groupBy("category").agg(
        F.count(F.lit(1)).alias("cnt"))


def top_categories(posts: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """The n most frequent categories (ties by name)."""
    return category_counts(posts).orderBy(F.col("cnt").desc(), F.col("category")).limit(n)


def users_without_stats(train_likes: DataFrame, stats_user: DataFrame) -> DataFrame:
    """One row, number of liking users with no statistics row."""
    u = train_likes.select("user_id").distinct()
    return u.join(stats_user.select("user_id"), "user_id", "left_anti").agg(F.count(F.lit(1)).alias("n_users_no_stats"))


def blogs_without_stats(posts: DataFrame, stats_blog: DataFrame) -> DataFrame:
    """One row, number of blogs of the posts with no blog statistics."""
    b = posts.select("blog_id").distinct()
    return b.join(stats_blog.select("blog_id"), "blog_id", "left_anti").agg(F.count(F.lit(1)).alias("n_blogs_no_stats"))


def blogs_with_stats(posts: DataFrame, stats_blog: DataFrame) -> DataFrame:
    """One row, number of blogs of the posts that have blog statistics."""
    b = posts.select("blog_id").distinct()
    return b.join(stats_blog.select("blog_id"), "blog_id", "left_semi").agg(F.count(F.lit(1)).alias("n_blogs_with_stats"))


def count_distinct_keys(stats_user: DataFrame, train_likes: DataFrame, posts: DataFrame,
                        stats_blog: DataFrame) -> DataFrame:
    """A18 + A19: users in the statistics, users who liked, blogs of the posts, rows of blog statistics."""
    return stats_user.agg(F.countDistinct("user_id").alias("n_stats_users")).select(
        "n_stats_users",
        train_likes.agg(F.countDistinct("user_id")).scalar().alias("n_like_users"),
        posts.agg(F.countDistinct("blog_id")).scalar().alias("n_post_blogs"),
        stats_blog.agg(F.count(F.lit(1))).scalar().alias("n_stats_blogs"))


def count_distinct_keys_approx(stats_user: DataFrame, train_likes: DataFrame, posts: DataFrame,
                               rsd: float = 0.01) -> DataFrame:
    """A18, sketch form: HyperLogLog++ estimates of the same distinct counts (one pass, fixed memory)."""
    return stats_user.agg(F.approx_count_distinct("user_id", rsd).alias("n_stats_users")).select(
        "n_stats_users",
        train_likes.agg(F.approx_count_distinct("user_id", rsd)).scalar().alias("n_like_users"),
        posts.agg(F.approx_count_distinct("blog_id", rsd)).scalar().alias("n_post_blogs"))


def preview(df: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """T5: first n rows by key (``take`` / ``show``)."""
    return df.orderBy(*keys).limit(n)
