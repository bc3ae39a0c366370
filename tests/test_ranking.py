"""Average precision and MAP (FIXTURES C3); the one-pass grid against a per-threshold loop."""

import random

import pytest
from pyspark.sql import functions as F

from affinis.operators import ranking as RA

SCORED = [(1, 1, 0.9), (1, 2, 0.8), (1, 3, 0.7), (1, 4, 0.6), (2, 5, 0.5)]
TRUTH = [(1, 1), (1, 4), (2, 9), (3, 7)]


@pytest.fixture(scope="module")
def data(spark):
    s = spark.createDataFrame(SCORED, "user_id bigint, post_id bigint, score double")
    t = spark.createDataFrame(TRUTH, "user_id bigint, post_id bigint")
    return s, t


def test_ap(spark, data):
    s, t = data
    ap = {r.user_id: r.ap for r in RA.ap_at_k(s, t, 100).collect()}
    assert ap == {1: 0.75, 2: 0.0}
    ap2 = {r.user_id: r.ap for r in RA.ap_at_k(s, t, 2).collect()}
    assert ap2[1] == 0.5


def test_map(spark, data):
    s, t = data
    assert RA.map_at_k(s, t, 100).first().map == 0.375
    assert RA.map_at_k(s, t, 100, over="all_truth").first().map == 0.25
    assert RA.map_at_k(s, t, 2).first().map == 0.25
    empty = s.where("score > 5")
    assert RA.map_at_k(empty, t).first().map == 0.0


def test_recommend_lists(spark, data):
    s, _ = data
    got = {(r.user_id, r.part): (r.n_recs, r.recs) for r in RA.recommend_lists(s).collect()}
    assert got == {(1, 0): (4, "1 2 3 4"), (2, 0): (1, "5")}
    got = {(r.user_id, r.part): r.recs for r in RA.recommend_lists(s, per_row=3).collect()}
    assert got == {(1, 0): "1 2 3", (1, 1): "4", (2, 0): "5"}


def test_ranked_hits(spark, data):
    s, t = data
    rows = RA.ranked_hits(s, t).where("user_id = 1").orderBy("k").collect()
    assert [(r.k, r.hit, r.cum_hits) for r in rows] == [(1, 1, 1), (2, 0, 1), (3, 0, 1), (4, 1, 2)]
    many = spark.createDataFrame([(1, p, 1.0 / (p + 1)) for p in range(250)], "user_id bigint, post_id bigint, score double")
    assert RA.ranked_hits(many, t).count() == 250          # the whole list; only AP and MAP cut
    assert RA.top_n(many, 100).count() == 100


def test_nan_score_never_recommended(spark):
    s = spark.createDataFrame([(1, 1, float("nan")), (1, 2, 0.4)], "user_id bigint, post_id bigint, score double")
    t = spark.createDataFrame([(1, 1)], "user_id bigint, post_id bigint")
    assert [r.post_id for r in RA.top_n(s).collect()] == [2]


def test_grid_equals_per_threshold_loop(spark):
    rnd = random.Random(7)
    scored, truth = [], set()
    for u in range(30):
        for p in range(rnd.randint(0, 140)):
            scored.append((u, p, round(rnd.random(), 2)))
            if rnd.random() < 0.2:
                truth.add((u, p))
        truth.add((u, 10_000 + u))
    s = spark.createDataFrame(scored, "user_id bigint, post_id bigint, score double")
    t = spark.createDataFrame(sorted(truth), "user_id bigint, post_id bigint")
    grid = {r.threshold: (r.map, r.n_users) for r in RA.map_threshold_grid(s, t, 1, 100, 3).collect()}
    for th in [k / 100.0 for k in range(1, 101, 3)]:
        m = RA.map_at_k(s, t, threshold=th).first()
        assert grid[th][0] == pytest.approx(m.map, abs=1e-8)
        assert grid[th][1] == m.n_users


def test_best_threshold_tie_goes_low(spark):
    g = spark.createDataFrame([(0.1, 0.5, 1), (0.2, 0.7, 1), (0.3, 0.7, 1)], "threshold double, map double, n_users bigint")
    b = RA.best_map_threshold(g).first()
    assert (b.threshold, b.map) == (0.2, 0.7)


def test_one_user_with_most_rows_is_ranked_in_ranges(spark):
    """Lists ranked range by range equal lists ranked at once; no range holds a tenth of the hot list, ties included."""
    n = 40_000
    s = spark.range(n).select(F.when(F.col("id") % 20 == 0, F.col("id") % 7 + 2).otherwise(1).alias("user_id"), F.col("id").alias("post_id"),
                              (F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.xxhash64("id") % 1000 / 1000.0)).alias("score"))
    t = s.where("post_id % 11 = 0").select("user_id", "post_id")
    far, near = RA.ranked_hits(s, t, range_rows=2_500), RA.ranked_hits(s, t)
    assert far.count() == n and far.exceptAll(near).count() == 0
    lists = RA.recommend_lists(s, range_rows=2_500)
    assert lists.count() == RA.recommend_lists(s).count() and lists.exceptAll(RA.recommend_lists(s)).count() == 0
    from affinis.plans.skew import hot_keys
    hot = hot_keys(s, ["user_id"], 2_500)
    cut = s.join(F.broadcast(hot), "user_id", "left_semi").repartitionByRange(int(hot.agg(F.sum("salts")).first()[0]), "user_id", *RA._order())
    sizes = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n - n // 20 and max(sizes) < sum(sizes) / 10


def test_a_million_rows_of_one_user(spark):
    s = spark.range(1_000_000).select(F.lit(1).alias("user_id"), F.col("id").alias("post_id"), (F.col("id") % 5000 / 5000.0).alias("score"))
    r = RA.ranked(s, range_rows=50_000).agg(F.max("k"), F.countDistinct("k"), F.sum((F.round(F.col("score") * 5000).cast("int") == 4999 - F.floor((F.col("k") - 1) / 200)).cast("int"))).first()
    assert tuple(r) == (1_000_000, 1_000_000, 1_000_000)
