"""Negative sampling: complement rank (FIXTURES C7), distribution draws, invariants."""

import random

import pytest
from pyspark.sql import functions as F

from affinis.operators import negatives as NE
from affinis.operators.eda import hist_equal_width


def _pick(spark, liked, n_users, js, width, draw_rows=NE.DRAW_ROWS):
    draws = spark.createDataFrame([(1, k, j, len(liked)) for k, j in enumerate(js)],
                                  "post_id bigint, k int, j bigint, n_likes bigint")
    lk = spark.createDataFrame([(1, i) for i in liked] or [(2, 0)], "post_id bigint, idx bigint")
    return [r.idx for r in NE._complement_pick(draws, lk, width, draw_rows=draw_rows).orderBy("k").collect()]


def test_complement_rank_example(spark):
    assert _pick(spark, [0, 2], 5, [0, 1, 2], 1 << 16) == [1, 3, 4]


@pytest.mark.parametrize("width", [1, 2, 3, 1 << 16])
def test_complement_rank_matches_enumeration(spark, width):
    rnd = random.Random(width)
    n = 23
    liked = sorted(rnd.sample(range(n), 9))
    free = [i for i in range(n) if i not in liked]
    assert _pick(spark, liked, n, list(range(len(free))), width) == free
    assert _pick(spark, liked, n, list(range(len(free))), width, draw_rows=4) == free      # several salts of draws


def test_histograms(spark):
    v = spark.createDataFrame([(0,), (1,), (1,), (2,), (10,)], "x int")
    eq = [r.cnt for r in hist_equal_width(v, "x", 5).orderBy("bin").collect()]
    assert eq == [3, 1, 0, 0, 1]
    ed = [r.cnt for r in NE.hist_by_edges(v, "x", [0, 1, 2]).orderBy("bin").collect()]
    assert ed == [1, 3]


@pytest.fixture(scope="module")
def small(spark):
    rnd = random.Random(3)
    likes = set()
    for p in range(40):
        for u in rnd.sample(range(25), rnd.randint(0, 8)):
            likes.add((u, p))
    likes |= {(u, 40) for u in range(25)}          # a post liked by everyone
    posts = spark.createDataFrame([(p,) for p in range(42)], "post_id bigint")
    lk = spark.createDataFrame(sorted(likes), "user_id bigint, post_id bigint")
    return posts, lk


def test_negatives_are_never_likes(spark, small):
    posts, lk = small
    neg = NE.negative_pairs(posts, lk, seed=1, width=4)
    assert neg.join(lk, ["user_id", "post_id"], "left_semi").count() == 0
    assert neg.where("post_id = 40").count() == 0
    users = {r.user_id for r in lk.select("user_id").distinct().collect()}
    assert {r.user_id for r in neg.select("user_id").distinct().collect()} <= users
    counts = {r.post_id: r.n_neg for r in NE.negative_counts(posts, lk, seed=1).collect()}
    per_post = {r.post_id: r["count"] for r in neg.groupBy("post_id").count().collect()}
    assert all(per_post.get(p, 0) <= counts[p] for p in counts)


def test_negatives_independent_of_bucket_width(spark, small):
    posts, lk = small
    a = sorted(map(tuple, NE.negative_pairs(posts, lk, seed=5, width=3).collect()))
    b = sorted(map(tuple, NE.negative_pairs(posts, lk, seed=5, width=1 << 16).collect()))
    assert a == b and len(a) > 0


def test_popular_posts_draw_negatives(spark):
    """Every post has more likes than the reference's last edge: the data's own distribution still draws."""
    likes = spark.createDataFrame([(u, p) for p in range(6) for u in range(p, 130 + p)], "user_id bigint, post_id bigint")
    posts = spark.createDataFrame([(p,) for p in range(6)], "post_id bigint")
    counts = NE.negative_counts(posts, likes).collect()
    assert all(r.n_neg == 130 for r in counts)
    neg = NE.negative_pairs(posts, likes, draw_rows=50)
    assert neg.count() > 0 and neg.join(likes, ["user_id", "post_id"], "left_semi").count() == 0
    assert sorted(map(tuple, neg.collect())) == sorted(map(tuple, NE.negative_pairs(posts, likes).collect()))
    with pytest.raises(ValueError):
        NE.negative_counts(posts, likes, edges=NE.DIST_EDGES)
    assert NE.negative_counts(posts.limit(0), likes).collect() == []


def test_own_distribution_equals_edges_inside_them(spark, small):
    posts, lk = small
    a = sorted(map(tuple, NE.negative_counts(posts, lk, seed=3).collect()))
    assert a == sorted(map(tuple, NE.negative_counts(posts, lk, seed=3, edges=NE.DIST_EDGES).collect()))


def test_distribution_ranges(spark, small):
    posts, lk = small
    d = NE.likes_per_post_distribution(posts, lk).orderBy("bin").collect()
    assert len(d) == 100
    assert d[0].lo == 0 and all(d[i].hi == d[i + 1].lo for i in range(99))
    assert d[-1].hi == posts.count()


def test_split_is_reproducible(spark, small):
    _, lk = small
    a = NE.split_train_holdout(lk, seed=9).collect()
    b = NE.split_train_holdout(lk.repartition(3), seed=9).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    share = sum(1 for r in a if r.split == "train") / len(a)
    assert 0.6 < share < 0.95


def test_native_split_covers_every_row_once(spark, small):
    _, lk = small
    s = NE.split_train_holdout_native(lk, seed=4)
    assert s.count() == lk.count()
    assert s.select("user_id", "post_id").distinct().count() == lk.count()


def test_draws_do_not_depend_on_the_buckets_and_nothing_is_collected(spark, small):
    import inspect

    posts, lk = small
    want = sorted(map(tuple, NE.negative_counts(posts, lk, seed=5).collect()))
    assert want == sorted(map(tuple, NE.negative_counts(posts, lk, seed=5, buckets=3).collect()))
    assert ".collect()" not in inspect.getsource(NE)


def test_a_user_with_most_likes(spark):
    """One user likes every post; negatives are the same however the likes are split."""
    from affinis.plans import skew

    likes = spark.range(3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id") % 40 + 2).cast("bigint").alias("user_id"),
                                     (F.col("id") % 2000).alias("post_id")).distinct()
    posts = spark.range(2000).select(F.col("id").alias("post_id"))
    want = sorted(map(tuple, NE.negative_pairs(posts, likes, seed=2).collect()))
    old, skew.ROWS_PER_SALT = skew.ROWS_PER_SALT, 100
    try:
        split = skew.salted_join(likes, spark.range(50).select(F.col("id").alias("user_id"), F.col("id").alias("idx")), ["user_id"], 100)
        assert split.count() == likes.count()
        assert want == sorted(map(tuple, NE.negative_pairs(posts, likes, seed=2, draw_rows=3).collect()))
    finally:
        skew.ROWS_PER_SALT = old
    assert not any(u == 1 for u, _ in want)
