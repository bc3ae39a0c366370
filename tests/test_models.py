"""Logistic regression (R checks): probabilities in [0, 1], coefficients stable over repartitioning."""

import pytest
from pyspark.sql import functions as F

from affinis.functions.expr import FEATURES
from affinis.operators import models as MO
from affinis.plans.workflows import Workflow
from affinis.sources.binding import bind

from conftest import SF


@pytest.fixture(scope="module")
def wf(spark):
    return Workflow(bind(spark, SF, staged=True))


def test_training_set_labels_and_keys(wf):
    t = wf.training_set
    assert set(r.label for r in t.select("label").distinct().collect()) == {0.0, 1.0}
    assert t.groupBy("user_id", "post_id").count().where("count > 1").count() == 0
    # no negative is a like
    neg = t.where("label = 0.0").select("user_id", "post_id")
    assert neg.join(wf.b.train_likes, ["user_id", "post_id"], "left_semi").count() == 0


def test_likelihoods_are_probabilities(wf):
    f = wf.features_true
    for c in FEATURES[:4] + [FEATURES[5]]:
        lo, hi = f.agg(F.min(c), F.max(c)).first()
        assert lo >= 0.0 and hi <= 1.0 + 1e-12, c


def test_lr_scores_and_stability(spark, wf):
    m1 = MO.fit_lr(wf.training_set, checkpoint=True)
    m2 = MO.fit_lr(wf.training_set.repartition(7), checkpoint=True)
    assert m1.coefficients.toArray() == pytest.approx(m2.coefficients.toArray(), rel=1e-4, abs=1e-6)
    w = MO.lr_weights(m1, spark)
    assert w.count() == len(FEATURES) + 1
    s = MO.lr_scores(m1, wf.features_candidates)
    lo, hi = s.agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= lo <= hi <= 1.0


def test_weights_minimise_the_penalised_loss(spark, wf):
    """Gradient of mean log loss + lambda/2 |w * sd|^2 (standardised columns) is near zero at the fit, by numpy."""
    import numpy as np

    m = MO.fit_lr(wf.training_set, max_iter=200)
    rows = wf.training_set.select("label", *FEATURES).dropna().toPandas()
    x, y = rows[FEATURES].to_numpy(), rows["label"].to_numpy()
    sd = x.std(axis=0, ddof=1)
    p = 1 / (1 + np.exp(-(x @ m.coefficients.toArray() + m.intercept)))
    grad = ((p - y) @ x) / len(y) + MO.REG_PARAM * sd ** 2 * m.coefficients.toArray()
    scaled = grad[sd > 0] / sd[sd > 0]
    assert np.abs(scaled).max() < 1e-3 and abs((p - y).mean()) < 1e-3


def test_scores_are_the_sigmoid_and_undefined_rows_stay(spark, wf):
    import math

    m = wf.lr_model
    pairs = wf.features_candidates.limit(50)
    bad = pairs.withColumn("user_id", -F.col("user_id") - 1).withColumn("author_likelihood", F.lit(float("nan"))).limit(3)
    null = pairs.withColumn("user_id", -F.col("user_id") - 1_000_000).withColumn("blog_likelihood", F.lit(None).cast("double")).limit(2)
    both = pairs.unionByName(bad).unionByName(null)
    got = {(r.user_id, r.post_id): r.score for r in MO.lr_scores(m, both).collect()}
    assert sum(v is None for v in got.values()) == 5 and len(got) == both.count()
    w, b = m.coefficients.toArray(), m.intercept
    for r in pairs.collect():
        assert got[r.user_id, r.post_id] == pytest.approx(1 / (1 + math.exp(-(sum(wi * r[f] for wi, f in zip(w, FEATURES)) + b))))


def test_areas_of_the_model_on_test_pairs_match_spark(spark, wf):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector

    from affinis.operators import curves as CU
    from affinis.plans.registry import QUERIES

    s = wf.lr_scored.where("score IS NOT NULL")
    ev = s.select("label", array_to_vector(F.array(1 - F.col("score"), F.col("score"))).alias("rawPrediction"))
    for metric, query in (("areaUnderROC", "lr_area_under_roc"), ("areaUnderPR", "lr_area_under_pr")):
        want = BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(ev)
        assert QUERIES[query](spark, SF).first()[0] == pytest.approx(want, abs=1e-8)
    assert CU.confusion_by_threshold(wf.lr_scored).count() > 10


def test_both_populations_of_map_agree(spark, wf):
    """Every test user with candidates is scored: the denominators differ only by users without a candidate."""
    from affinis.operators import ranking as RA

    users = wf.candidate_pairs.select("user_id").distinct().count()
    joined, every = RA.map_at_k(wf.tag_scored, wf.b.truth).first(), RA.map_at_k(wf.tag_scored, wf.b.truth, over="all_truth").first()
    assert joined.n_users == users and every.n_users == wf.b.test_users.count()
    assert every.map == pytest.approx(joined.map * joined.n_users / every.n_users)


def test_stored_weights_score_as_the_fitted_model(spark, wf, tmp_path):
    m = MO.fit_lr(wf.training_set)
    MO.write_weights(MO.lr_weights(m, spark), str(tmp_path / "m"))
    stored = MO.stored_scores(MO.read_weights(spark, str(tmp_path / "m")), wf.features_candidates)
    both = stored.withColumnRenamed("score", "a").join(MO.lr_scores(m, wf.features_candidates), ["user_id", "post_id"])
    r = both.agg(F.count(F.lit(1)), F.max(F.abs(F.col("a") - F.col("score"))),
                 F.sum((F.col("a").isNull() != F.col("score").isNull()).cast("int"))).first()
    assert r[0] == wf.features_candidates.count() and r[1] < 1e-12 and r[2] == 0


def test_weights_of_other_features_are_refused(spark, tmp_path):
    w = MO.weights_table(spark, MO.FIXED_WEIGHTS)
    for name, bad in (("less", w.limit(5)), ("twice", w.union(w)), ("other", w.replace("intercept", "bias", "feature"))):
        MO.write_weights(bad, str(tmp_path / name))
        with pytest.raises(ValueError):
            MO.read_weights(spark, str(tmp_path / name))


def test_gradient_is_that_of_the_loss_and_vanishes_at_the_fit(spark, wf):
    rows = wf.training_set
    at = lambda w, i=0.0: {r.term: r.value for r in MO.loss_and_gradient(rows, MO.weights_table(spark, w, i)).collect()}
    base, step = at(MO.FIXED_WEIGHTS), 1e-4
    for k in (0, 1, 5):
        up, down = list(MO.FIXED_WEIGHTS), list(MO.FIXED_WEIGHTS)
        up[k] += step
        down[k] -= step
        assert (at(up)["loss"] - at(down)["loss"]) / (2 * step) == pytest.approx(base[FEATURES[k]], rel=1e-4, abs=1e-8)
    m = MO.fit_lr(rows, max_iter=200)
    end = at(m.coefficients.toArray(), m.intercept)
    assert max(abs(v) for t, v in end.items() if t != "loss") < 1e-3
    assert end["loss"] < base["loss"]
    plan = MO.loss_and_gradient(rows, MO.weights_table(spark, MO.FIXED_WEIGHTS))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_scores_after_something_was_observed(spark):
    """The tasks that score hold no session: once anything was observed, it does not serialise."""
    from pyspark.sql import Observation

    rows = [(i, i, float(i % 2), *[float((i * (k + 3)) % 7) for k in range(len(FEATURES))]) for i in range(40)]
    t = spark.createDataFrame(rows, ["user_id", "post_id", "label", *FEATURES])
    seen = Observation()
    t.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 40
    got = MO.lr_scores(MO.fit_lr(t, checkpoint=False), t).collect()
    assert len(got) == 40 and all(0.0 < r.score < 1.0 for r in got)
