"""Stored profiles kept up with new likes (A10); pairs that joins leave out."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from affinis.operators import candidates as CA
from affinis.operators import features as FE
from affinis.operators import profiles as PR
from affinis.plans.workflows import Workflow
from affinis.session import stage
from affinis.sources.binding import bind

from conftest import SF

PROFILE = "user_id bigint, kind string, key string, cnt bigint"


@pytest.fixture(scope="module")
def wf(spark):
    return Workflow(bind(spark, SF, staged=True))


def test_merge_adds_counts_and_writes_touched_buckets_alone(spark, tmp_path):
    p = str(tmp_path / "profile")
    old = [(u, "tag", k, u + 1) for u in range(200) for k in ("a", "b")]
    PR.write_profile(spark.createDataFrame(old, PROFILE), p, buckets=16)
    files = lambda: {os.path.join(d, f) for d, _, fs in os.walk(p) for f in fs if f.startswith("part-")}
    before = files()
    new = [(5, "tag", "a", 10), (5, "tag", "c", 1), (900, "author", "7", 2)]
    n = PR.merge_profile(spark, p, spark.createDataFrame(new, PROFILE), buckets=16)
    want = {(u, k, key): c for u, k, key, c in old}
    for u, k, key, c in new:
        want[u, k, key] = want.get((u, k, key), 0) + c
    got = {(r.user_id, r.kind, r.key): r.cnt for r in PR.read_profile(spark, p).collect()}
    assert got == want and 1 <= n <= 2
    assert len({os.path.dirname(f) for f in before - files()}) <= n       # other partitions keep their files
    assert PR.merge_profile(spark, p, spark.createDataFrame([], PROFILE), buckets=16) == 0


def test_dropped_label_pairs_are_counted_in_the_job(spark, wf):
    pairs = wf.candidate_pairs.unionByName(wf.b.train_likes).distinct()
    seen = Observation()
    labelled = stage(CA.label_pairs(pairs, wf.b.truth, dropped=seen), "labelled")
    assert labelled.count() + seen.get["n_dropped"] == pairs.count()
    assert labelled.exceptAll(CA.label_pairs(pairs, wf.b.truth)).count() == 0


def test_strict_labels_fail_on_an_unknown_user(spark):
    truth = spark.createDataFrame([(1, 10)], "user_id bigint, post_id bigint")
    ok = spark.createDataFrame([(1, 10), (1, 11)], "user_id bigint, post_id bigint")
    assert sorted(r.label for r in CA.label_pairs(ok, truth, strict=True).collect()) == [0.0, 1.0]
    with pytest.raises(PySparkException, match="no match for user_id 2"):
        CA.label_pairs(ok.union(spark.createDataFrame([(2, 10)], ok.schema)), truth, strict=True).collect()


def test_feature_pairs_without_a_profile(spark, wf):
    known = wf.b.train_likes.limit(50)
    pairs = known.union(spark.createDataFrame([(-5, 1), (-6, 1)], known.schema)).where("post_id IS NOT NULL")
    seen = Observation()
    rows = stage(FE.pair_features(pairs, wf.ctx, dropped=seen), "some_features")
    there = pairs.join(wf.ctx.post_attrs.select("post_id"), "post_id", "left_semi")
    assert seen.get["n_dropped"] == there.where("user_id < 0").count() > 0
    assert rows.count() == there.where("user_id >= 0").distinct().count()
    assert rows.exceptAll(FE.pair_features(pairs, wf.ctx)).count() == 0
    with pytest.raises(PySparkException, match="no match for user_id -"):
        FE.pair_features(pairs, wf.ctx, strict=True).collect()
    assert FE.pair_features(known, wf.ctx, strict=True).count() == FE.pair_features(known, wf.ctx).agg(F.count(F.lit(1))).first()[0]
