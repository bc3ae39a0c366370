"""Physical-plan shape of representative queries.

No cartesian product, no Python evaluation, and every window without a
partition key orders a table that is bounded by construction: quantile
bucket offsets (``_bucket``), histogram bins (``bin``) or the threshold grid
(``gi``).
"""

import re

import pytest

from pyspark.sql import Observation

from affinis.operators import features as FE
from affinis.operators import negatives as NE
from affinis.plans.registry import QUERIES
from affinis.plans.workflows import Workflow
from affinis.sources.binding import bind

from conftest import SF

BOUNDED_ORDER_KEYS = ("_bucket", "bin", "gi")
SAMPLE = ["features_true", "negative_pairs", "candidate_pairs", "confusion_by_threshold", "area_under_pr",
          "map_threshold_grid", "profile_topk", "likes_per_post_distribution", "negative_counts", "ranked_hits",
          "curve_percentile_bins", "hist_edges"]


def _plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SAMPLE)
def test_plan_shape(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    for spec in re.findall(r"windowspecdefinition\(([^,)]*)", plan):
        if " ASC" in spec or " DESC" in spec:          # the first argument is an ordering: no PARTITION BY
            key = spec.strip().split("#")[0]
            assert key in BOUNDED_ORDER_KEYS, (name, spec)


def _nodes(plan, name):
    return len(re.findall(rf"^[\s:+*\-()0-9]*{name}\b", plan, re.M))


def test_scans_prune_columns_and_push_filters(spark):
    wf = Workflow(bind(spark, SF, staged=True))
    plan = wf.features_of(wf.b.train_likes)._jdf.queryExecution().executedPlan().toString()
    # the period filter reaches the Parquet scan of the staged likes table
    assert re.search(r"FileScan parquet \[user_id#\d+L,post_id#\d+L,ts#\d+\].*DataFilters: \[.*ts#", plan)


def test_features_shuffle_no_exploded_rows(spark):
    """Rows are shuffled four times (pairs and posts by post, pairs with profiles and totals by user), counts twice."""
    wf = Workflow(bind(spark, SF, staged=True))
    wf.ctx
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = wf.features_of(wf.b.train_likes)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by = [re.sub(r"#\d+L?", "", b) for b in re.findall(r"[^d]Exchange hashpartitioning\((.*?), \d+\)", plan)]
    # bare user_id, post_id: counts of the hot keys; blog_id: the prior's total
    assert sorted(b for b in by if b not in ("user_id", "post_id", "blog_id")) == ["post_id, part"] * 2 + ["user_id, salt"] * 2
    exploded = plan.split("Exchange hashpartitioning(user_id")[0]
    assert "Generate explode(labels" in exploded and "Sort" in exploded


def test_features_of_salted_pairs(spark):
    """Every user and post split into salts: the same features, pairs of unknown users counted."""
    wf = Workflow(bind(spark, SF, staged=True))
    pairs = wf.b.train_likes.select("user_id", "post_id").where("post_id % 7 = 0").unionByName(
        spark.createDataFrame([(-1, 7)], "user_id bigint, post_id bigint"))
    for variant in ("coded", "documented"):
        whole = FE.pair_features(pairs, wf.ctx, variant)
        seen = Observation("seen")
        split = FE.pair_features(pairs, wf.ctx, variant, rows_per_salt=2, dropped=seen)
        got = sorted(map(tuple, split.collect()))
        assert got == sorted(map(tuple, whole.collect())) and len(got) == pairs.distinct().count() - 1 - (
            FE.users_without_profile(pairs, wf.ctx).where("user_id >= 0").distinct().count())
        assert seen.get["n_dropped"] >= 1


def test_plan_that_writes_the_negatives(spark):
    """The plan that is written, not the scan of what it wrote."""
    wf = Workflow(bind(spark, SF, staged=True))
    plan = NE.negative_pairs(wf.b.train_posts, wf.b.train_likes)._jdf.queryExecution().executedPlan().toString()
    assert _nodes(plan, "FileScan") <= 6 and _nodes(plan, "Exchange") <= 15
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_no_staged_table_holds_texts(spark):
    b = bind(spark, SF, staged=True)
    assert "content" not in b.posts.columns and "text" not in b.posts.columns


def test_candidates_are_a_small_share(spark):
    wf = Workflow(bind(spark, "/root/testdata/sf0.01", staged=True))
    assert 0 < wf.candidate_pairs.count() <= 0.05 * wf.b.test_users.count() * wf.b.posts.count()


def test_candidates_are_made_distinct_after_their_shuffle(spark):
    """No task holds the pairs of a tag to make them distinct: what a user and a post share meets after the shuffle."""
    wf = Workflow(bind(spark, SF, staged=True))
    plan = wf._candidate_pairs()._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("REPARTITION_BY_COL")[:2]
    assert len(re.findall(r"HashAggregate\(keys=\[user_id#\d+L, post_id#\d+L\]", before)) == 2
    assert not re.search(r"HashAggregate\(keys=\[user_id#\d+L, post_id#\d+L\]", after)
