"""Negative examples.

For every training post, the number of negatives is drawn from the
empirical distribution of likes per post, then that many users are drawn
with replacement from the users who did not like the post, and duplicates
are removed.  All randomness is a hash of (seed, post, draw), so results
are reproducible and a recomputed task draws the same users.

The non-liking users are never materialised.  Users get a dense index
0..U-1; the j-th non-liking user of a post with liked indices l_0 < l_1 < ...
is ``j + #{m : l_m - m <= j}`` (complement rank).  The count is done in two
levels, each one window over the union of what is counted and what asks:
first a post's index buckets (fixed width) and its draws, then the liked
indices of one bucket and the draws that fall there.  Draws of a post are
cut into salts of ``DRAW_ROWS``, so no window holds a whole hot post.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.functions.expr import unit_hash, with_count_at_or_below
from affinis.plans.prefix import dense_index, running_totals
from affinis.plans.skew import salted_join
from affinis.session import stage

SEED = 42
# The reference's histogram of likes per post has edges 0, 1, ..., 100 (last bin closed).
DIST_EDGES = list(range(0, 101))
INDEX_BUCKET_WIDTH = 1 << 16
DRAW_ROWS = 1 << 18
TRAIN_FRACTION = 0.8


def universe_users(train_likes: DataFrame) -> DataFrame:
    """Every user who liked a training post."""
    return train_likes.select("user_id").distinct()


def likes_per_post(train_posts: DataFrame, train_likes: DataFrame) -> DataFrame:
    """(post_id, n_likes) over all training posts; a post nobody liked has 0."""
    n = train_likes.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_likes"))
    return (train_posts.select("post_id").join(n, "post_id", "left")
            .select("post_id", F.coalesce("n_likes", F.lit(0)).alias("n_likes")))


def edge_bins(spark, edges: list[float]) -> DataFrame:
    """Bin table (bin, lo_edge, hi_edge, last) of the edge parameter; bounded by the number of edges."""
    rows = [(i, float(edges[i]), float(edges[i + 1]), i == len(edges) - 2) for i in range(len(edges) - 1)]
    return spark.createDataFrame(rows, "bin int, lo_edge double, hi_edge double, last boolean")


def hist_by_edges(values: DataFrame, col: str, edges: list[float]) -> DataFrame:
    """Counts per bin [e_i, e_i+1), the last bin closed; values outside are dropped; empty bins kept."""
    e = [float(x) for x in edges]
    nb = len(e) - 1
    v = F.col(col).cast("double")
    inside = values.select(v.alias("_v")).where((F.col("_v") >= e[0]) & (F.col("_v") <= e[-1]))
    counts = (with_count_at_or_below(inside, F.col("_v"), e[1:-1], "_b")
              .select(F.least(F.col("_b"), F.lit(nb - 1)).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("cnt")))
    return (F.broadcast(edge_bins(values.sparkSession, e)).join(counts, "bin", "left")
            .select("bin", "lo_edge", "hi_edge", F.coalesce("cnt", F.lit(0)).alias("cnt")))


def likes_per_post_distribution(train_posts: DataFrame, train_likes: DataFrame,
                                edges: list[float] = DIST_EDGES) -> DataFrame:
    """(bin, n_users, cnt, lo, hi): the empirical distribution as cumulative ranges, never expanded.

    Position r in the reference's expanded array falls in bin b iff lo_b <= r < hi_b.
    Bounded by the number of bins, so ordering it in one task is safe.
    """
    h = hist_by_edges(likes_per_post(train_posts, train_likes), "n_likes", edges)
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    lo = F.coalesce(F.sum("cnt").over(w), F.lit(0))
    return h.select("bin", F.col("lo_edge").cast("int").alias("n_users"), "cnt",
                    lo.alias("lo"), (lo + F.col("cnt")).alias("hi"))


def _distribution(lpp: DataFrame, edges: list[float] | None) -> DataFrame:
    """(n_neg, cnt): posts by number of likes, falling into ``edges`` or by every like count there is."""
    if edges is None:
        return lpp.groupBy(F.col("n_likes").alias("n_neg")).agg(F.count(F.lit(1)).alias("cnt"))
    return hist_by_edges(lpp, "n_likes", edges).where("cnt > 0").select(F.col("lo_edge").cast("bigint").alias("n_neg"), "cnt")


def negative_counts(train_posts: DataFrame, train_likes: DataFrame, seed: int = SEED,
                    edges: list[float] | None = None, buckets: int | None = None) -> DataFrame:
    """N2 + J12: (post_id, n_likes, n_neg), n_neg drawn from the likes-per-post distribution.

    By default the distribution holds every like count of the data.  With
    ``edges`` (the reference: ``DIST_EDGES``) posts outside them are left out
    of it, and it is an error if that leaves none.

    A draw is a place in the posts ordered by likes.  The starts of the like
    counts' ranges and the draws are merged in order of place; the ranges
    started by then are a running count over buckets of places.
    """
    lpp = stage(likes_per_post(train_posts, train_likes), "likes_per_post")
    dist = stage(_distribution(lpp, edges), "like_distribution")
    if dist.isEmpty():
        if lpp.isEmpty():
            return lpp.withColumn("n_neg", F.lit(0).cast("bigint"))
        raise ValueError("no post has a number of likes inside the edges: nothing to draw from")
    ranges = stage(running_totals(dist, "n_neg", ["cnt"], buckets=buckets, position_col="range").select(
        "n_neg", "range", (F.col("cum_cnt") - F.col("cnt")).alias("place")), "draw_ranges")
    total = dist.agg(F.sum("cnt")).scalar()
    place = F.floor(unit_hash(F.lit(seed), F.lit("n"), F.col("post_id")) * total)
    null = F.lit(None).cast("bigint")
    merged = ranges.select(F.col("place").cast("bigint").alias("place"), F.lit(0).alias("kind"), null.alias("post_id"), null.alias("n_likes"),
                           F.lit(1).alias("started"))
    merged = merged.unionByName(lpp.select(place.cast("bigint").alias("place"), F.lit(1).alias("kind"), "post_id", "n_likes",
                                           F.lit(0).alias("started")))
    drawn = running_totals(stage(merged, "draws_and_ranges"), "place", ["started"], buckets=buckets, position_col=None,
                           tie_cols=["kind", "post_id"])
    drawn = drawn.where("kind = 1").select("post_id", "n_likes", (F.col("cum_started") - 1).alias("range"))
    return salted_join(drawn, ranges.select("range", "n_neg"), ["range"]).select("post_id", "n_likes", "n_neg")


def non_like_counts(train_posts: DataFrame, train_likes: DataFrame) -> DataFrame:
    """J11 / U2 in count form: (post_id, n_likes, n_non_like).

    The set of non-liking users of a post is all users minus its likers; it
    is sampled from by complement rank and never listed, since listing it
    would be every (post, user) pair.
    """
    u = universe_users(train_likes).agg(F.count(F.lit(1))).scalar()
    return likes_per_post(train_posts, train_likes).withColumn("n_non_like", u - F.col("n_likes"))


def _complement_pick(draws: DataFrame, liked: DataFrame, width: int, many: DataFrame | None = None,
                     draw_rows: int = DRAW_ROWS) -> DataFrame:
    """(post_id, k, idx) of each draw (post_id, k, j, n_likes): the j-th index not in the post's liked set.

    ``many`` (post_id, salts) lists the posts with more than ``draw_rows``
    draws; it has at most draws / draw_rows rows, so it is a broadcast side.
    """
    if many is None:
        many = draws.groupBy("post_id").agg((F.floor(F.max("k") / draw_rows) + 1).cast("int").alias("salts")).where("salts > 1")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")
    per_salt = lambda df: df.join(F.broadcast(many), "post_id", "left").select(*df.columns, copies)
    lk = liked.select("post_id", "idx", F.floor(F.col("idx") / width).alias("b"))
    buckets = lk.groupBy("post_id", "b").agg(F.count(F.lit(1)).alias("cnt"), F.max("idx").alias("at"))
    null = F.lit(None).cast("bigint")

    # level 1, per (post, salt): buckets (kind 0) get the likes before them, draws (kind 1) find their bucket
    one = per_salt(buckets).select("post_id", "salt", F.lit(0).alias("kind"), "b", "cnt", "at", null.alias("k"), null.alias("j"),
                                   null.alias("n_likes"))
    ask = draws.select("post_id", F.floor(F.col("k") / draw_rows).cast("int").alias("salt"), F.lit(1).alias("kind"), null.alias("b"),
                       F.lit(0).cast("bigint").alias("cnt"), null.alias("at"), F.col("k").cast("bigint").alias("k"),
                       F.col("j").cast("bigint").alias("j"), "n_likes")
    by_bucket = Window.partitionBy("post_id", "salt").orderBy("kind", "b").rowsBetween(Window.unboundedPreceding, -1)
    one = one.unionByName(ask).withColumn("before", F.coalesce(F.sum("cnt").over(by_bucket), F.lit(0)))
    # a bucket's largest number of non-liked indices below one of its own; it never falls from bucket to bucket
    one = one.withColumn("v", F.when(F.col("kind") == 0, F.col("at") - F.col("before") - F.col("cnt") + 1).otherwise(F.col("j")))
    # the draw's bucket is the first whose largest value exceeds j: the last one seen when values fall
    falling = (Window.partitionBy("post_id", "salt").orderBy(F.col("v").desc(), F.col("kind").desc(), F.col("b").desc())
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = F.last(F.when(F.col("kind") == 0, F.struct("b", "before")), ignorenulls=True).over(falling)
    one = one.withColumn("own", own).select("post_id", "salt", "kind", F.col("own.b").alias("b"), F.col("own.before").alias("before"),
                                            "k", "j", "n_likes")

    # level 2, per (post, bucket, salt): the bucket's header (kind 0), its liked indices (1) and the draws in it (2)
    two = one.select("post_id", "b", "salt", F.when(F.col("kind") == 0, 0).otherwise(2).alias("kind"), null.alias("idx"), "before",
                     "k", "j", "n_likes")
    members = per_salt(lk).select("post_id", "b", "salt", F.lit(1).alias("kind"), "idx", null.alias("before"), null.alias("k"),
                                  null.alias("j"), null.alias("n_likes"))
    two = two.unionByName(members)
    in_bucket = Window.partitionBy("post_id", "b", "salt").orderBy("kind", "idx", "k").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    is_like = F.when(F.col("kind") == 1, 1).otherwise(0)
    head = F.first("before", ignorenulls=True).over(in_bucket)
    two = two.withColumn("g", F.when(F.col("kind") == 1, F.col("idx") - head - (F.sum(is_like).over(in_bucket) - 1)).otherwise(F.col("j")))
    rising = Window.partitionBy("post_id", "b", "salt").orderBy("g", "kind", "k").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    two = two.withColumn("inside", F.sum(is_like).over(rising)).where("kind = 2")
    # a draw beyond the last bucket comes after every like of the post
    likes_before = F.when(F.col("b").isNull(), F.col("n_likes")).otherwise(F.col("before") + F.col("inside"))
    return two.select("post_id", "k", (F.col("j") + likes_before).alias("idx"))


def negative_pairs(train_posts: DataFrame, train_likes: DataFrame, seed: int = SEED,
                   edges: list[float] | None = None, width: int = INDEX_BUCKET_WIDTH, draw_rows: int = DRAW_ROWS) -> DataFrame:
    """Distinct (user_id, post_id) negatives; none of them is a like.

    The user index, the numbers per post and the likes by index are written
    first, so each is computed once and the pairs read them by scans.
    """
    users = stage(dense_index(stage(universe_users(train_likes), "universe"), "user_id"), "user_index")
    n_users = users.count()
    counts = stage(negative_counts(train_posts, train_likes, seed, edges)
                   .withColumn("m", F.lit(n_users) - F.col("n_likes")).where("n_neg > 0 AND m > 0"), "negative_counts")
    # a user may hold a third of the likes; the drawn indices below are uniform over the users
    likes = train_likes.select("user_id", "post_id").distinct()
    liked = stage(salted_join(likes, users, ["user_id"]).select("post_id", "idx"), "liked_index")
    many = counts.where(F.col("n_neg") > draw_rows).select(
        "post_id", F.ceil(F.col("n_neg") / draw_rows).cast("int").alias("salts"))
    # two steps, so no row holds more than ``draw_rows`` numbers
    draws = (counts.select("*", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n_neg") / draw_rows).cast("int") - 1)).alias("s"))
             .select("post_id", "n_likes", "m", F.explode(F.sequence(
                 F.col("s") * draw_rows, F.least(F.col("n_neg"), (F.col("s") + 1) * draw_rows) - 1)).alias("k"))
             .withColumn("j", F.floor(unit_hash(F.lit(seed), F.lit("u"), F.col("post_id"), F.col("k")) * F.col("m")))
             .select("post_id", "k", "j", "n_likes"))
    picks = _complement_pick(draws, liked, width, many, draw_rows)
    return picks.join(users, "idx").select("user_id", "post_id").distinct()


def split_train_holdout(rows: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = SEED) -> DataFrame:
    """Adds ``split`` = 'train' when h(seed, 's', user, post) < fraction, else 'holdout'."""
    h = unit_hash(F.lit(seed), F.lit("s"), F.col("user_id"), F.col("post_id"))
    return rows.withColumn("split", F.when(h < fraction, F.lit("train")).otherwise(F.lit("holdout")))


def split_train_holdout_native(rows: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = SEED) -> DataFrame:
    """N4 with ``DataFrame.randomSplit``; adds ``split`` = 'train' / 'holdout'."""
    train, holdout = rows.randomSplit([fraction, 1.0 - fraction], seed=seed)
    return (train.withColumn("split", F.lit("train"))
            .unionByName(holdout.withColumn("split", F.lit("holdout"))))
