"""Row filters and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.expr import FEATURES, is_finite_all, title_words_of


def drop_any_null(df: DataFrame) -> DataFrame:
    """Drop a row if any of its columns is null."""
    return df.na.drop(how="any")


def post_sets(posts: DataFrame) -> DataFrame:
    """P2 for display: category and tag sets as sorted, comma-joined strings."""
    return posts.select(
        "post_id", "blog_id", "author_id",
        F.concat_ws(",", F.array_sort(F.array_distinct("categories"))).alias("categories"),
        F.concat_ws(",", F.array_sort(F.array_distinct("tags"))).alias("tags"),
        F.size(F.array_distinct("tags")).alias("n_tags"),
    )


def last_entries(entries: DataFrame, *within: str) -> DataFrame:
    """(user_id, blog_id, likes, ...) from list entries with their place ``pos``: the last entry of a blog wins.

    ``within`` names what tells a user's lists apart.  Long form: a user's map is rows, however many blogs there are.
    """
    rest = [c for c in entries.columns if c not in ("user_id", "blog_id", "likes", "pos", *within)]
    return entries.groupBy(*within, "user_id", "blog_id").agg(F.max_by("likes", "pos").alias("likes"),
                                                              *[F.first(c).alias(c) for c in rest])


def finite_features(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Keep rows whose features are all defined and finite."""
    return df.where(is_finite_all(cols or FEATURES))


def title_word_counts(posts: DataFrame) -> DataFrame:
    """(post_id, title_words)."""
    return posts.select("post_id", title_words_of(posts).alias("title_words"))
