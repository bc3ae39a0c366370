"""Binary-classification curves of scored, labelled pairs.

``confusion_by_threshold`` is exact (one point per distinct score, as
Spark's evaluator with numBins=0).  The running counts come from
``plans.prefix.running_totals`` (bucketed, no single-task window), and each
curve point also carries the counts of the point before it (running count
minus its own), so areas are plain sums with no ordered pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.functions.expr import round_half_up, safe_div
from affinis.plans.prefix import running_totals
from affinis.session import stage


def confusion_by_threshold(scored: DataFrame, score_col: str = "score", label_col: str = "label",
                           buckets: int | None = None) -> DataFrame:
    """(threshold, tp, fp, pos, neg, position, n_pos, n_neg), thresholds = distinct scores, falling.

    tp/fp count rows with score >= threshold; pos/neg those at exactly the
    threshold; position is 0 for the highest score.  A row without a score
    (null or NaN) passes no threshold but counts in n_pos and n_neg.
    """
    s = scored.select(F.when(~F.isnan(score_col), F.col(score_col)).alias("threshold"), F.col(label_col).alias("label"))
    pos = F.when(F.col("label") > 0.5, F.lit(1)).otherwise(F.lit(0))
    # one row per distinct score: written once, as the quantiles, the bucket totals, the rows and the class totals all read it
    g = stage(s.groupBy("threshold").agg(F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg")), "score_counts")
    tot = g.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    rt = running_totals(g.where("threshold IS NOT NULL"), "threshold", ["pos", "neg"], descending=True, buckets=buckets)
    return rt.select("threshold", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"), "pos", "neg",
                     "position", tot.select("p").scalar().alias("n_pos"), tot.select("n").scalar().alias("n_neg"))


def precision_by_threshold(conf: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(threshold, precision[, keep])."""
    return conf.select("threshold", *(keep or []), safe_div("tp", F.col("tp") + F.col("fp")).alias("precision"))


def recall_by_threshold(conf: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(threshold, recall[, keep])."""
    return conf.select("threshold", *(keep or []), safe_div("tp", "n_pos").alias("recall"))


def _f(beta: float):
    b2 = beta * beta
    p = safe_div("tp", F.col("tp") + F.col("fp"))
    r = safe_div("tp", "n_pos")
    return F.when(p + r == 0, F.lit(0.0)).otherwise((F.lit(1.0 + b2) * (p * r)) / (F.lit(b2) * p + r))


def f_measure_by_threshold(conf: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """C4: (threshold, f1, f05[, keep]): F-measure with beta 1 and 0.5."""
    return conf.select("threshold", *(keep or []), _f(1.0).alias("f1"), _f(0.5).alias("f05"))


def pr_curve(conf: DataFrame) -> DataFrame:
    """C3 + T6: (threshold, recall, precision, position) points ordered by position, falling threshold.

    The start point (0, precision of the first point) has position 0.
    """
    pts = conf.select("threshold", safe_div("tp", "n_pos").alias("recall"),
                      safe_div("tp", F.col("tp") + F.col("fp")).alias("precision"),
                      (F.col("position") + 1).alias("position"))
    start = pts.where(F.col("position") == 1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"),
                                                     "precision", (F.col("position") - 1).alias("position"))
    return start.unionByName(pts)


def roc_curve(conf: DataFrame) -> DataFrame:
    """C7 + J14 + T6: (threshold, fpr, tpr, position) with the (0, 0) and (1, 1) end points (threshold null).

    Thresholds and rates sit in one row, so no positional zip is needed.
    """
    pts = conf.select("threshold", safe_div("fp", "n_neg").alias("fpr"), safe_div("tp", "n_pos").alias("tpr"),
                      (F.col("position") + 1).alias("position"))
    spark = conf.sparkSession
    n = conf.agg(F.count(F.lit(1)) + 1).scalar()
    ends = spark.createDataFrame([(None, 0.0, 0.0), (None, 1.0, 1.0)], "threshold double, fpr double, tpr double")
    return ends.withColumn("position", F.when(F.col("fpr") == 0, F.lit(0)).otherwise(n).cast("bigint")).unionByName(pts)


def ordered(points: DataFrame, x: str = "x") -> DataFrame:
    """A thinned curve in the order of its x (a total sort: Spark ranges the rows, no single task)."""
    return points.orderBy(x)


def area_under_roc(conf: DataFrame) -> DataFrame:
    """Trapezoidal area under the ROC curve, one row."""
    fpr = safe_div("fp", "n_neg")
    tpr = safe_div("tp", "n_pos")
    fpr0 = safe_div(F.col("fp") - F.col("neg"), "n_neg")
    tpr0 = safe_div(F.col("tp") - F.col("pos"), "n_pos")
    seg = (fpr - fpr0) * (tpr + tpr0) / 2.0
    return conf.agg(F.sum(seg).alias("area_under_roc"))


def area_under_pr(conf: DataFrame) -> DataFrame:
    """Trapezoidal area under the PR curve (with its start point), one row."""
    r = safe_div("tp", "n_pos")
    p = safe_div("tp", F.col("tp") + F.col("fp"))
    tp0 = F.col("tp") - F.col("pos")
    fp0 = F.col("fp") - F.col("neg")
    r0 = safe_div(tp0, "n_pos")
    p0 = F.when(tp0 + fp0 == 0, p).otherwise(safe_div(tp0, tp0 + fp0))
    seg = (r - r0) * (p + p0) / 2.0
    return conf.agg(F.sum(seg).alias("area_under_pr"))


def best_threshold_min_fpr(conf: DataFrame, min_tpr: float = 0.7) -> DataFrame:
    """Threshold with the lowest FPR among points with TPR > min_tpr (ties: higher threshold)."""
    pts = roc_curve(conf).where(F.col("threshold").isNotNull() & (F.col("tpr") > min_tpr))
    b = pts.agg(F.min_by(F.struct("threshold", "fpr", "tpr"), F.struct("fpr", -F.col("threshold"))).alias("b"))
    return b.select("b.threshold", "b.fpr", "b.tpr").where(F.col("threshold").isNotNull())


def best_threshold_max_tpr(conf: DataFrame, max_fpr: float = 0.1) -> DataFrame:
    """Threshold with the highest TPR among points with FPR < max_fpr (ties: higher threshold)."""
    pts = roc_curve(conf).where(F.col("threshold").isNotNull() & (F.col("fpr") < max_fpr))
    b = pts.agg(F.max_by(F.struct("threshold", "fpr", "tpr"), F.struct("tpr", "threshold")).alias("b"))
    return b.select("b.threshold", "b.fpr", "b.tpr").where(F.col("threshold").isNotNull())


# ---- curve thinning (for display) --------------------------------------------------------

def percentile_bins(points: DataFrame, n: int, x: str = "x", y: str = "y", index: str = "position") -> DataFrame:
    """C11: group points by round(index / (len / (n - 1))) and average x and y per group."""
    size = points.agg(F.count(F.lit(1))).scalar()
    step = size / F.lit(float(n - 1))
    g = points.withColumn("_g", round_half_up(F.col(index) / step))
    return g.groupBy("_g").agg(F.avg(x).alias("x"), F.avg(y).alias("y")).drop("_g")


def linear_bins(points: DataFrame, n: int, x: str = "x", y: str = "y") -> DataFrame:
    """Group points by round((x - min) / ((max - min) / (n - 1))); one group when all x are equal."""
    lo = points.agg(F.min(x)).scalar()
    hi = points.agg(F.max(x)).scalar()
    step = (hi - lo) / F.lit(float(n - 1))
    raw = (F.col(x) - lo) / step
    g = points.withColumn("_g", F.when(step == 0, F.lit(0.0)).otherwise(round_half_up(raw)))
    return g.groupBy("_g").agg(F.avg(x).alias("x"), F.avg(y).alias("y")).drop("_g")


def round_x(points: DataFrame, digits: int, x: str = "x", y: str = "y") -> DataFrame:
    """X rounded half up to ``digits`` digits, mean y per rounded x."""
    return (points.withColumn("_x", round_half_up(F.col(x), digits))
            .groupBy("_x").agg(F.avg(y).alias("y"))
            .select(F.col("_x").alias("x"), "y"))
