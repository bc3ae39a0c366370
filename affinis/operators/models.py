"""Logistic regression next to the single-feature baseline (M1-M5).

A fitted model is kept as a table of eight rows (``write_weights``), which another application reads back and
scores with: plain column arithmetic on the seven features, no model object needed.  ``loss_and_gradient`` is the
objective of the fit at any such weights, as one aggregate over the training rows.

Spark ML does the fitting (distributed gradient aggregation per
iteration).  The training table is checkpointed to the shared checkpoint
folder first: the fit makes 20+ passes over it, and the checkpoint cuts
the long lineage (profiles, negatives) so a lost executor recomputes from
the written table, not from the raw inputs.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.functions.expr import FEATURES, is_finite_all
from affinis.session import ensure_checkpoint_dir, scratch_path

# The reference's fit.
MAX_ITER = 20
REG_PARAM = 0.01
# The weights that the reference's notebook shows, in the order of FEATURES; it shows no intercept.
FIXED_WEIGHTS = [3.6547179874888527, 29.954612632966224, 0.0, 8.94198351877905, 0.011719211972634485, 4.5715749793686795,
                 0.10861817701433805]
INTERCEPT = "intercept"


def assemble(df: DataFrame) -> DataFrame:
    """The seven features as one vector column; undefined values become NaN components."""
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(df)


def fit_lr(training: DataFrame, max_iter: int = MAX_ITER, reg_param: float = REG_PARAM,
           checkpoint: bool = True) -> LogisticRegressionModel:
    """M1: L2-regularised, standardised logistic regression on (label, *FEATURES).

    The model is stored and read back.  A model fresh from the fit carries its training summary, and with it the
    session, into every task that scores; once anything was observed in the session, that no longer serialises.
    """
    data = assemble(training.where(is_finite_all(FEATURES))).select("label", "features")     # P4
    if checkpoint:
        ensure_checkpoint_dir(training.sparkSession)
        data = data.checkpoint(eager=True)
    lr = LogisticRegression(maxIter=max_iter, regParam=reg_param, featuresCol="features", labelCol="label",
                            probabilityCol="probability")
    path = scratch_path(training.sparkSession, "lr_model")
    lr.fit(data).write().save(path)
    return LogisticRegressionModel.load(path)


def lr_weights(model: LogisticRegressionModel, spark) -> DataFrame:
    """M2: (feature, weight) plus the intercept; seven values from the fitted model."""
    return weights_table(spark, model.coefficients.toArray(), model.intercept)


def weights_table(spark, weights, intercept: float = 0.0) -> DataFrame:
    """(feature, weight) of given weights in the order of FEATURES, and the intercept."""
    rows = [(f, float(w)) for f, w in zip([*FEATURES, INTERCEPT], [*weights, intercept], strict=True)]
    return spark.createDataFrame(rows, "feature string, weight double")


def write_weights(weights: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store a model: its (feature, weight) table, one Parquet file."""
    weights.select("feature", "weight").coalesce(1).write.mode(mode).parquet(path)


def read_weights(spark, path: str) -> DataFrame:
    """A stored model; an error if its features are not those of this library, each once."""
    w = spark.read.schema("feature string, weight double").parquet(path)
    found = sorted(r.feature or "" for r in w.limit(len(FEATURES) + 2).collect())
    if found != sorted([*FEATURES, INTERCEPT]):
        raise ValueError(f"{path} holds weights of {found}")
    return w


def _weight(weights: DataFrame) -> Column:
    """Scalar: a struct of all weights, one field per feature."""
    one = [F.max(F.when(F.col("feature") == f, F.col("weight"))).alias(f) for f in [*FEATURES, INTERCEPT]]
    return weights.agg(F.struct(*one).alias("w")).scalar()


def linear(weights: DataFrame) -> Column:
    """Intercept plus the weighted features, summed in the order of FEATURES; null where a feature is undefined."""
    w = _weight(weights)
    z = w[INTERCEPT]
    for f in FEATURES:
        z = z + w[f] * F.col(f)
    return F.when(is_finite_all(FEATURES), z)


def stored_scores(weights: DataFrame, pairs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M3 from a stored model: (user_id, post_id[, keep], score); the sigmoid of ``linear``."""
    scored = pairs.withColumn("_z", linear(weights))
    return scored.select("user_id", "post_id", *(keep or []), (1.0 / (1.0 + F.exp(-F.col("_z")))).alias("score"))


def loss_and_gradient(training: DataFrame, weights: DataFrame, reg_param: float = REG_PARAM) -> DataFrame:
    """(term, value): penalised loss of the fit at ``weights``, and its derivatives by each weight and the intercept.

    Mean log loss plus half of ``reg_param`` times the squared weights of the standardised features.  The features'
    deviations come out of the same single aggregate as the sums of the loss and of its gradient.
    """
    y = F.col("label")
    rows = training.where(is_finite_all(FEATURES)).withColumn("_z", linear(weights))
    away = F.when(y > 0.5, -F.col("_z")).otherwise(F.col("_z"))          # log(1 + exp(away)) is a row's loss
    miss = 1.0 / (1.0 + F.exp(-F.col("_z"))) - y
    one = rows.agg(F.avg(F.greatest(away, F.lit(0.0)) + F.log(1.0 + F.exp(-F.abs(away)))).alias("loss"),
                   F.avg(miss).alias(INTERCEPT), *[F.avg(miss * F.col(f)).alias(f) for f in FEATURES],
                   *[F.var_samp(f).alias(f"var_{f}") for f in FEATURES])
    w = _weight(weights)
    penalty = sum((F.col(f"var_{f}") * w[f] * w[f] for f in FEATURES), F.lit(0.0))
    terms = [("loss", F.col("loss") + reg_param / 2 * penalty), (INTERCEPT, F.col(INTERCEPT))]
    terms += [(f, F.col(f) + reg_param * F.col(f"var_{f}") * w[f]) for f in FEATURES]
    pairs = F.array(*[F.struct(F.lit(t).alias("term"), v.alias("value")) for t, v in terms])
    return one.select(F.explode(pairs).alias("t")).select("t.term", "t.value")


def lr_scores(model: LogisticRegressionModel, pairs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M3 + P13: (user_id, post_id, score[, keep]) with score = P(label = 1).

    Every pair stays; one with an undefined feature has a null score.
    """
    keep = keep or []
    t = model.transform(assemble(pairs))
    score = F.when(is_finite_all(FEATURES), vector_to_array("probability")[1])
    return t.select("user_id", "post_id", *keep, score.alias("score"))


def tag_scores(features: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M4: the baseline scores a pair by its tags likelihood alone."""
    keep = keep or []
    return features.select("user_id", "post_id", *keep, F.col("tags_likelihood").alias("score"))
