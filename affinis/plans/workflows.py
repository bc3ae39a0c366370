"""The reference's three end-to-end jobs as lazy DataFrame plans.

``Workflow`` wires the operators over one set of domain tables; each
property is a DataFrame built on first use, so a caller pays only for what
it asks for and Catalyst sees one plan per result.

* feature extraction: profiles, priors, positives, negatives, training set,
  candidates and their features  (``training_set``, ``features_candidates``)
* recommendation evaluation: scores of both scorers, MAP over a threshold grid
* classifier evaluation: confusion counts and curves of a scored table
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.operators import candidates as CA
from affinis.operators import curves as CU
from affinis.operators import features as FE
from affinis.operators import models as MO
from affinis.operators import negatives as NE
from affinis.operators import ranking as RA
from affinis.session import scratch_path, stage_once
from affinis.sources.binding import Bound


#: Digits of a stored model's scores.
SCORE_DIGITS = 9

_MODELS: dict[tuple, object] = {}


def forget_models() -> None:
    _MODELS.clear()


class Workflow:
    def __init__(self, bound: Bound, seed: int = 42, variant: str = "coded",
                 top_entries: int | None = None, max_blogs: int | None = None, staged: bool = True):
        self.b = bound
        self.staged = staged
        self.spark = bound.spark
        self.seed = seed
        self.variant = variant
        self.top_entries = top_entries
        self.max_blogs = max_blogs

    @cached_property
    def inputs(self) -> tuple:
        return self.b.signature(["part", "documents", "orders", "lineitem"])

    def _stage(self, name: str, build, *params) -> DataFrame:
        """``build()``, written once per inputs and those parameters the table depends on."""
        if not self.staged:
            return build()
        return stage_once(self.spark, name, (self.inputs, *params), build)

    @property
    def _feature_params(self) -> tuple:
        return self.variant, self.top_entries, self.max_blogs

    # ---- feature extraction ---------------------------------------------------------------
    @cached_property
    def ctx(self) -> FE.FeatureContext:
        b = self.b
        return FE.build_context(b.posts, b.train_likes, b.stats_user, b.stats_blog,
                                top_entries=self.top_entries, max_blogs=self.max_blogs, stage=self._stage)

    def features_of(self, pairs: DataFrame, keep: list[str] | None = None, variant: str | None = None) -> DataFrame:
        return FE.pair_features(pairs, self.ctx, variant=variant or self.variant, keep=keep)

    @cached_property
    def features_true(self) -> DataFrame:
        return self._stage("features_true", lambda: self.features_of(self.b.train_likes), *self._feature_params)

    @cached_property
    def negative_pairs(self) -> DataFrame:
        return self._stage("negative_pairs",
                           lambda: NE.negative_pairs(self.b.train_posts, self.b.train_likes, seed=self.seed), self.seed)

    @cached_property
    def features_false(self) -> DataFrame:
        return self._stage("features_false", lambda: self.features_of(self.negative_pairs), self.seed, *self._feature_params)

    @cached_property
    def training_set(self) -> DataFrame:
        """E3 + U1 + P12: keyed positives (label 1.0) and negatives (label 0.0)."""
        return self.features_true.withColumn("label", F.lit(1.0)).unionByName(
            self.features_false.withColumn("label", F.lit(0.0)))

    @cached_property
    def test_posts(self) -> DataFrame:
        return CA.posts_in_truth(self.b.test_posts, self.b.truth)

    @cached_property
    def tag_index(self) -> DataFrame:
        return CA.tag_user_index(self.ctx.profile, self.b.test_users)

    @cached_property
    def candidate_pairs(self) -> DataFrame:
        return self._stage("candidate_pairs", self._candidate_pairs, self.top_entries)

    def _candidate_pairs(self) -> DataFrame:
        return CA.candidate_pairs(self.test_posts, self.tag_index)

    @cached_property
    def labelled_candidates(self) -> DataFrame:
        # straight from the pairs: the labels' join takes the partitions in which the pairs became distinct
        return self._stage("labelled_candidates", lambda: CA.label_pairs(self._candidate_pairs(), self.b.truth), self.top_entries)

    @cached_property
    def features_candidates(self) -> DataFrame:
        """Candidate features with their truth label, for all test users."""
        return self._stage("features_candidates",
                           lambda: self.features_of(self.labelled_candidates, keep=["label"]), *self._feature_params)

    # ---- scoring ---------------------------------------------------------------------------
    @cached_property
    def tag_scored(self) -> DataFrame:
        return MO.tag_scores(self.features_candidates, keep=["label"])

    @cached_property
    def lr_model(self):
        """M1, fitted once per training set (the staged training table is keyed the same way)."""
        if not self.staged:
            return MO.fit_lr(self.training_set)
        k = (self.spark.sparkContext.applicationId, self.inputs, self.seed, *self._feature_params)
        if k not in _MODELS:
            _MODELS[k] = MO.fit_lr(self.training_set, checkpoint=False)
        return _MODELS[k]

    @cached_property
    def lr_scored(self) -> DataFrame:
        return MO.lr_scores(self.lr_model, self.features_candidates, keep=["label"])

    @cached_property
    def fixed_weights(self) -> DataFrame:
        """The fixed weights, stored in the shared folder and read back as another application would."""
        path = scratch_path(self.spark, "weights")
        MO.write_weights(MO.weights_table(self.spark, MO.FIXED_WEIGHTS), path)
        return MO.read_weights(self.spark, path)

    @cached_property
    def stored_scored(self) -> DataFrame:
        """Scores of the stored model on the test pairs, to 9 digits: thresholds are the same on any machine."""
        return MO.stored_scores(self.fixed_weights, self.features_candidates, keep=["label"]).withColumn(
            "score", F.round("score", SCORE_DIGITS))

    @cached_property
    def holdout_scored(self) -> DataFrame:
        """Classifier evaluation (training data only): fit on the 80 % split, score the 20 % holdout."""
        split = NE.split_train_holdout(self.training_set, seed=self.seed)
        model = MO.fit_lr(split.where(F.col("split") == "train"), checkpoint=not self.staged)
        return MO.lr_scores(model, split.where(F.col("split") == "holdout"), keep=["label"])

    # ---- evaluation ------------------------------------------------------------------------
    def map_grid(self, scored: DataFrame, lo: int, hi: int, step: int) -> DataFrame:
        return RA.map_threshold_grid(scored, self.b.truth, lo, hi, step)

    def _confusion(self, name: str, scored: DataFrame) -> DataFrame:
        return self._stage(name, lambda: CU.confusion_by_threshold(scored), self.seed, *self._feature_params)

    @cached_property
    def tag_confusion(self) -> DataFrame:
        return self._confusion("tag_confusion", self.tag_scored)

    @cached_property
    def stored_confusion(self) -> DataFrame:
        """M5: threshold counts of the stored model on the test pairs."""
        return self._confusion("stored_confusion", self.stored_scored)

    @cached_property
    def lr_confusion(self) -> DataFrame:
        """M5: threshold counts of the logistic regression on the test pairs."""
        return self._confusion("lr_confusion", self.lr_scored)

    @cached_property
    def holdout_confusion(self) -> DataFrame:
        return self._confusion("holdout_confusion", self.holdout_scored)
