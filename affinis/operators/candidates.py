"""Test-side pairs: test users or a sample, candidate pairs and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from affinis.functions.expr import unit_hash
from affinis.plans.skew import salted_join

SEED = 42
# The notebook samples a tenth of the test users and takes 100 of them.
SAMPLE_FRACTION = 0.1
SAMPLE_SIZE = 100


def sample_users(users: DataFrame, fraction: float = SAMPLE_FRACTION, n: int | None = SAMPLE_SIZE,
                 seed: int = SEED, col: str = "user_id") -> DataFrame:
    """Reproducible sample without replacement: keep h(seed, user) < fraction, then the n smallest hashes."""
    h = users.select(col).distinct().withColumn("_h", unit_hash(F.lit(seed), F.col(col))).where(F.col("_h") < fraction)
    if n is not None:
        h = h.orderBy("_h", col).limit(n)
    return h.select(col)


def sample_users_native(users: DataFrame, fraction: float = SAMPLE_FRACTION, n: int | None = SAMPLE_SIZE,
                        seed: int = SEED, col: str = "user_id") -> DataFrame:
    """N1 with Spark's own Bernoulli sampler (``DataFrame.sample``), then n of the sample by a seeded hash.

    Reproducible for a fixed seed and input partitioning; the hash form
    ``sample_users`` is the one with an exact SQL oracle.
    """
    s = users.select(col).distinct().sample(withReplacement=False, fraction=fraction, seed=seed)
    return s.orderBy(F.xxhash64(F.lit(seed), F.col(col)), col).limit(n) if n is not None else s


def posts_in_truth(posts: DataFrame, truth: DataFrame) -> DataFrame:
    """Test posts that somebody liked in the truth."""
    return posts.join(truth.select("post_id"), "post_id", "left_semi")


def tag_user_index(profile: DataFrame, users: DataFrame) -> DataFrame:
    """A21 + J5: (tag, user_id) for the tags of the selected users' (truncated) profiles."""
    return (profile.where(F.col("kind") == "tag")
            .join(users.select("user_id"), "user_id", "left_semi")
            .select(F.col("key").alias("tag"), "user_id").distinct())


def candidate_pairs(test_posts: DataFrame, index: DataFrame) -> DataFrame:
    """(user_id, post_id) where the post carries a tag in the user's profile.

    A popular tag is salted on both sides (see ``salted_join``), so its users
    and its posts are spread over several tasks; pairs are de-duplicated, but not
    before they are shuffled, as the tags that a user and a post share meet in
    different tasks.
    """
    pt = test_posts.select("post_id", F.explode("tags").alias("tag")).distinct()
    return salted_join(pt, index, ["tag"]).select("user_id", "post_id").repartition("user_id", "post_id").distinct()


def known_or_counted(rows: DataFrame, flag: str, key: str, dropped: Observation | None, strict: bool) -> DataFrame:
    """Rows of a left join whose ``flag`` is set, without it.

    ``dropped`` counts the others while the rows are made (its ``n_dropped``); with ``strict`` the first one fails the job.
    """
    if dropped is not None:
        rows = rows.observe(dropped, F.count(F.when(F.col(flag).isNull(), 1)).alias("n_dropped"))
    known = F.col(flag).isNotNull()
    if strict:
        unknown = F.raise_error(F.concat(F.lit(f"no match for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
        known = F.when(known, F.lit(True)).otherwise(unknown.cast("boolean"))
    return rows.where(known).drop(flag)


def label_pairs(pairs: DataFrame, truth: DataFrame, dropped: Observation | None = None, strict: bool = False) -> DataFrame:
    """Label 1.0 if the pair is in the truth, else 0.0; users absent from the truth are left out.

    ``dropped`` and ``strict``: see ``known_or_counted``; the reference fails on such a user.
    """
    users = truth.select("user_id").distinct()
    t = truth.select("user_id", "post_id", F.lit(1.0).alias("_hit")).distinct()
    if dropped is None and not strict:
        known = pairs.join(users, "user_id", "left_semi")
    else:
        known = known_or_counted(pairs.join(users.withColumn("_known", F.lit(True)), "user_id", "left"), "_known", "user_id", dropped, strict)
    return (known.join(t, ["user_id", "post_id"], "left")
            .withColumn("label", F.coalesce("_hit", F.lit(0.0)))
            .drop("_hit"))
