"""Confusion counts, curves and areas (FIXTURES C5); equality with Spark's evaluator (numBins=0)."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors

from affinis.operators import curves as CU


def _conf(spark, rows, buckets=None):
    df = spark.createDataFrame(rows, "score double, label double")
    return CU.confusion_by_threshold(df, buckets=buckets)


def test_confusion_rows(spark):
    c = _conf(spark, [(0.9, 1.0), (0.8, 0.0), (0.8, 1.0), (0.3, 0.0)])
    rows = [(r.threshold, r.tp, r.fp) for r in c.orderBy("position").collect()]
    assert rows == [(0.9, 1, 0), (0.8, 2, 1), (0.3, 2, 2)]
    assert CU.area_under_roc(c).first()[0] == pytest.approx(0.875)
    assert CU.area_under_pr(c).first()[0] == pytest.approx(0.916667, abs=1e-6)


def test_pr_start_point(spark):
    c = _conf(spark, [(0.9, 0.0), (0.9, 1.0), (0.9, 0.0), (0.2, 1.0)])
    assert CU.area_under_pr(c).first()[0] == pytest.approx(0.375)
    pr = CU.pr_curve(c).orderBy("recall").collect()
    assert (pr[0].recall, pr[0].precision) == (0.0, pytest.approx(1 / 3))


def test_roc_has_end_points(spark):
    c = _conf(spark, [(0.9, 1.0), (0.1, 0.0)])
    pts = sorted((r.fpr, r.tpr) for r in CU.roc_curve(c).collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)


def test_missing_scores_pass_no_threshold_but_count(spark):
    c = _conf(spark, [(float("nan"), 1.0), (None, 0.0), (0.5, 1.0), (0.4, 0.0)])
    rows = c.orderBy("position").collect()
    assert [(r.threshold, r.tp, r.fp, r.n_pos, r.n_neg) for r in rows] == [(0.5, 1, 0, 2, 2), (0.4, 1, 1, 2, 2)]
    assert max(r.recall for r in CU.recall_by_threshold(c).collect()) == 0.5


def test_curves_are_ordered(spark):
    rnd = random.Random(5)
    c = _conf(spark, [(rnd.random(), float(rnd.random() < 0.4)) for _ in range(300)])
    roc = CU.roc_curve(c).orderBy("position").collect()
    assert [r.position for r in roc] == list(range(302))
    assert all(a.fpr <= b.fpr and a.tpr <= b.tpr for a, b in zip(roc, roc[1:]))
    pr = CU.pr_curve(c).orderBy("position").collect()
    assert [r.position for r in pr] == list(range(301)) and all(a.recall <= b.recall for a, b in zip(pr, pr[1:]))
    thin = CU.ordered(CU.round_x(CU.linear_bins(CU.roc_curve(c).selectExpr("fpr AS x", "tpr AS y"), 25), 2)).collect()
    assert 1 < len(thin) <= 25 and [r.x for r in thin] == sorted(r.x for r in thin)


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_areas_match_spark_evaluator(spark, buckets):
    rnd = random.Random(buckets)
    rows = [(round(rnd.random(), 3), float(rnd.random() < 0.3)) for _ in range(600)]
    c = _conf(spark, rows, buckets)
    ev_df = spark.createDataFrame([(Vectors.dense([1 - s, s]), lab) for s, lab in rows], ["rawPrediction", "label"])
    roc = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(ev_df)
    pr = BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0).evaluate(ev_df)
    assert CU.area_under_roc(c).first()[0] == pytest.approx(roc, abs=1e-8)
    assert CU.area_under_pr(c).first()[0] == pytest.approx(pr, abs=1e-8)
    # running counts are exact whatever the number of buckets
    got = sorted((r.threshold, r.tp, r.fp) for r in c.collect())
    exp = []
    for th in sorted({s for s, _ in rows}):
        exp.append((th, sum(1 for s, lab in rows if s >= th and lab > 0.5), sum(1 for s, lab in rows if s >= th and lab <= 0.5)))
    assert got == exp


def test_thresholds_and_thinning(spark):
    rows = [(i / 100, float(i % 3 == 0)) for i in range(100)]
    c = _conf(spark, rows)
    b = CU.best_threshold_min_fpr(c, 0.7).first()
    assert b.tpr > 0.7
    pts = CU.roc_curve(c).where("threshold IS NOT NULL")
    assert b.fpr == min(r.fpr for r in pts.where("tpr > 0.7").collect())
    b2 = CU.best_threshold_max_tpr(c, 0.1).first()
    assert b2.fpr < 0.1
    prec = CU.precision_by_threshold(c).join(c.select("threshold", "position"), "threshold").selectExpr(
        "threshold AS x", "precision AS y", "position")
    assert CU.percentile_bins(prec, 25).count() <= 25
    assert CU.linear_bins(prec, 25).count() <= 25
    assert CU.round_x(prec, 1).count() == 11


def test_linear_bins_single_x(spark):
    pts = spark.createDataFrame([(0.5, 1.0), (0.5, 3.0)], "x double, y double")
    r = CU.linear_bins(pts, 25).collect()
    assert len(r) == 1 and r[0].y == 2.0
