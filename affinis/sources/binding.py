"""Binding of the driver's test tables to the domain tables.

posts   <- part joined to documents (doc_id = p_partkey mod number of documents)
likes   <- distinct (o_custkey, l_partkey) of orders x lineitem, first order date
period  <- stats before 1999-01-01 <= train before 2000-07-01 <= test
stats_user, stats_blog <- stats-period likes
truth, test users      <- test-period likes
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.functions.expr import title_of, word_count
from affinis.session import input_signature, stage_once

# Fixed values of the binding: period boundaries, and posts per topic of the tag vocabulary.
STATS_END = "1999-01-01 00:00:00"
TRAIN_END = "2000-07-01 00:00:00"
POSTS_PER_TOPIC = 24

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


class Bound:
    """Domain tables over one directory of driver tables; every table is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str, staged: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.staged = staged

    def signature(self, names: list[str]) -> tuple:
        return input_signature(self.spark, [f"{self.sf_dir}/{n}.parquet" for n in names])

    def _maybe_stage(self, name: str, inputs: list[str], build) -> DataFrame:
        if not self.staged:
            return build()
        return stage_once(self.spark, name, self.signature(inputs), build)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def posts(self) -> DataFrame:
        # no whole text in the domain tables: a post keeps its length and its title's word count
        return self._maybe_stage("posts", ["part", "documents"], self._posts)

    def _posts(self) -> DataFrame:
        docs = self.table("documents")
        part = self.table("part")
        n_docs = docs.agg(F.count(F.lit(1))).scalar()
        n_topics = part.agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / POSTS_PER_TOPIC))).scalar()
        p = part.select("*", F.pmod("p_partkey", n_docs).alias("doc_id"),
                        F.pmod("p_partkey", n_topics).cast("string").alias("topic")).select(
            F.col("p_partkey").alias("post_id"),
            "doc_id",
            F.col("p_size").cast("bigint").alias("author_id"),
            F.array_distinct(F.array("p_type", "p_brand")).alias("categories"),
            # words within a topic: the vocabulary grows with the posts, so a tag stays selective at any size
            F.array_distinct(F.transform(F.split("p_name", " "), lambda w: F.concat(w, F.lit("-"), F.col("topic")))).alias("tags"),
        )
        d = docs.select(
            "doc_id",
            F.regexp_extract("source", "[0-9]+", 0).cast("bigint").alias("blog_id"),
            F.col("lang").alias("language"),
            title_of("text").alias("title"),
            F.length("text").alias("content_chars"),
        )
        # a sort-merge join leaves the posts table hash-partitioned instead of in the input's split layout
        return p.join(d.hint("merge"), "doc_id").select(
            "post_id", "blog_id", "author_id", "language", "title", "content_chars", "categories", "tags",
            word_count("title").alias("title_words"))

    def with_content(self, posts: DataFrame) -> DataFrame:
        """``posts`` with the whole text in ``content``, for the writers of the nested files alone."""
        docs = self.table("documents")
        n_docs = docs.agg(F.count(F.lit(1))).scalar()
        keyed = posts.withColumn("_doc", F.pmod("post_id", n_docs))
        return keyed.join(docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("content")), "_doc").drop("_doc")

    @cached_property
    def likes(self) -> DataFrame:
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        li = self.table("lineitem").select("l_orderkey", "l_partkey")
        return self._maybe_stage("likes", ["orders", "lineitem"], lambda: (
            o.join(li, o.o_orderkey == li.l_orderkey)
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("post_id"))
            .agg(F.min("o_orderdate").alias("ts"))))

    def _period(self, lo: str | None, hi: str | None) -> DataFrame:
        c = F.lit(True)
        if lo:
            c = c & (F.col("ts") >= _ts(lo))
        if hi:
            c = c & (F.col("ts") < _ts(hi))
        return self.likes.where(c).select("user_id", "post_id")

    @cached_property
    def stats_likes(self) -> DataFrame:
        return self._period(None, STATS_END)

    @cached_property
    def train_likes(self) -> DataFrame:
        return self._period(STATS_END, TRAIN_END)

    @cached_property
    def test_likes(self) -> DataFrame:
        return self._period(TRAIN_END, None)

    @cached_property
    def stats_user(self) -> DataFrame:
        """Long form (user_id, blog_id, likes, num_likes)."""
        return self._maybe_stage("stats_user", ["part", "documents", "orders", "lineitem"], self._stats_user)

    def _stats_user(self) -> DataFrame:
        ub = (self.stats_likes.join(self.posts.select("post_id", "blog_id"), "post_id")
              .groupBy("user_id", "blog_id").agg(F.count(F.lit(1)).alias("likes")))
        tot = ub.groupBy("user_id").agg(F.sum("likes").alias("num_likes"))
        return ub.join(tot, "user_id").select("user_id", "blog_id", "likes", "num_likes")

    @cached_property
    def stats_blog(self) -> DataFrame:
        """(blog_id, num_likes, num_posts)."""
        return self._maybe_stage("stats_blog", ["part", "documents", "orders", "lineitem"], self._stats_blog)

    def _stats_blog(self) -> DataFrame:
        posts = self.posts.select("post_id", "blog_id")
        n_posts = posts.groupBy("blog_id").agg(F.count(F.lit(1)).alias("num_posts"))
        n_likes = (self.stats_likes.join(posts, "post_id")
                   .groupBy("blog_id").agg(F.count(F.lit(1)).alias("num_likes")))
        return (n_posts.join(n_likes, "blog_id", "left")
                .select("blog_id", F.coalesce("num_likes", F.lit(0)).alias("num_likes"), "num_posts"))

    @cached_property
    def truth(self) -> DataFrame:
        """Evaluation truth, long form (user_id, post_id)."""
        return self.test_likes

    @cached_property
    def test_users(self) -> DataFrame:
        return self.test_likes.select("user_id").distinct()

    @cached_property
    def train_posts(self) -> DataFrame:
        """Posts of the training file: every post; posts nobody liked keep zero likes."""
        return self.posts

    @cached_property
    def test_posts(self) -> DataFrame:
        return self.posts


def bind(spark: SparkSession, sf_dir: str, staged: bool = False) -> Bound:
    """Domain tables over ``sf_dir``; with ``staged`` the base tables (posts, likes) are written once
    to the shared checkpoint folder and read back, for pipelines that use them many times."""
    return Bound(spark, sf_dir, staged)
