"""Every operator of the inventory as a named query over the driver tables.

Each entry takes (spark, sf_dir) and returns a DataFrame.  Building one may
run jobs: tables that feed several steps are written to the shared checkpoint
directory first, and a few bounded values (quantiles, the like-count
distribution, a fitted model) come to the driver.  Source queries (``src_*``,
``tsv_*``) write their bound table in the reference's text format to a fresh
folder there and read it back through the reader under test.

Operators return exact values; sums of doubles are rounded to ``ROUND``
digits here alone.  Checks and filters run on tables with planted faults
(``_faulty_*``), so that each one acts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from affinis.functions.expr import FEATURES
from affinis.operators import candidates as CA
from affinis.operators import clean as CL
from affinis.operators import curves as CU
from affinis.operators import eda as ED
from affinis.operators import models as MO
from affinis.operators import negatives as NE
from affinis.operators import profiles as PR
from affinis.operators import ranking as RA
from affinis.plans.workflows import Workflow
from affinis.session import scratch_path, stage
from affinis.sources import readers as RD
from affinis.sources import writers as WR
from affinis.sources.binding import Bound, bind

Query = Callable[[SparkSession, str], DataFrame]

# The notebook's settings.  Tag grid 1..100 by 2 (notebook), LR grid 50..100 by 2,
# curve thinning to 25 points, x rounded to 2 digits; the post looked up by key.
TAG_GRID = (1, 100, 2)
TAG_GRID_FINE = (1, 100, 1)
LR_GRID = (50, 100, 2)
CURVE_POINTS = 25
ROUND_DIGITS = 2
PR_DIGITS, F_DIGITS = 4, 3
ROUND = 9
LOOKUP = (3, 3)          # (blog_id, post_id)
SMALL_TOP = 3            # top-k cap that binds on the test data
SMALL_BLOG_CAP = 15      # blog cap that binds on the test data


def _bound(spark: SparkSession, sf_dir: str) -> Bound:
    return bind(spark, sf_dir, staged=True)


def _wf(spark: SparkSession, sf_dir: str, **kw) -> Workflow:
    return Workflow(_bound(spark, sf_dir), **kw)


def _post_display(posts: DataFrame) -> DataFrame:
    return posts.select(
        "post_id", "blog_id", "author_id", "language", "title",
        F.concat_ws(",", F.array_sort(F.array_distinct("categories"))).alias("categories"),
        F.concat_ws(",", F.array_sort(F.array_distinct("tags"))).alias("tags"),
        "content_chars" if "content_chars" in posts.columns else F.length("content").alias("content_chars"),
    )


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, ROUND) for c in cols})


def _faulty_posts(posts: DataFrame) -> DataFrame:
    """Posts with missing titles, languages and tags, and empty languages."""
    def without(col, mod, rest, value=None):
        return F.when(F.col("post_id") % mod == rest, F.lit(value)).otherwise(F.col(col)).alias(col)
    return (posts.withColumns({"title": without("title", 7, 3), "tags": without("tags", 17, 4)})
            .withColumn("language", without("language", 11, 5, "")).withColumn("language", without("language", 13, 6)))


def _faulty_totals(stats_user: DataFrame) -> DataFrame:
    """Statistics whose total is one too high for some users."""
    return stats_user.withColumn("num_likes", F.col("num_likes") + F.when(F.col("user_id") % 13 == 0, 1).otherwise(0))


def _repeated_entries(stats_user: DataFrame) -> DataFrame:
    """List entries with their place; some blogs stand twice, the first time with another count."""
    e = stats_user.select("user_id", "blog_id", "likes", F.lit(1).alias("pos"))
    again = e.where((F.col("user_id") + F.col("blog_id")) % 5 == 0)
    return e.unionByName(again.select("user_id", "blog_id", (F.col("likes") + 100).alias("likes"), F.lit(0).alias("pos")))


def _faulty_features(rows: DataFrame) -> DataFrame:
    """Feature rows with NaN, infinite and missing values."""
    key = F.col("user_id") + F.col("post_id")
    bad = F.when(key % 9 == 0, float("nan")).when(key % 10 == 0, float("inf")).when(key % 11 == 0, F.lit(None).cast("double"))
    return rows.withColumn("tags_likelihood", F.when((key % 9 == 0) | (key % 10 == 0) | (key % 11 == 0), bad)
                           .otherwise(F.col("tags_likelihood")))


def _feature(col: str, variant: str = "coded") -> Query:
    def q(spark, sf_dir):
        w = _wf(spark, sf_dir, variant=variant)
        return w.features_of(w.b.train_likes).select("user_id", "post_id", col)
    return q


# ---- sources ------------------------------------------------------------------------------

def src_stats_blog(spark, sf_dir):
    b = _bound(spark, sf_dir)
    p = scratch_path(spark, "stats_blog.json")
    WR.write_stats_blog_json(b.stats_blog, p)
    return RD.read_stats_blog(spark, p)


def src_stats_user_long(spark, sf_dir):
    b = _bound(spark, sf_dir)
    p = scratch_path(spark, "stats_user.json")
    WR.write_stats_user_json(b.stats_user, p)
    return RD.stats_user_long(RD.read_stats_user_raw(spark, p))


def src_stats_users(spark, sf_dir):
    b = _bound(spark, sf_dir)
    p = scratch_path(spark, "stats_user.json")
    WR.write_stats_user_json(b.stats_user, p)
    return RD.stats_users(RD.read_stats_user_raw(spark, p))


def _train_posts_file(spark, sf_dir) -> str:
    b = _bound(spark, sf_dir)
    p = scratch_path(spark, "train_posts.json")
    WR.write_posts_json(b.with_content(b.train_posts), b.train_likes, p)
    return p


def src_posts(spark, sf_dir):
    return _post_display(RD.posts_from_raw(RD.read_posts_raw(spark, _train_posts_file(spark, sf_dir))))


def src_likes(spark, sf_dir):
    return RD.likes_from_raw(RD.read_posts_raw(spark, _train_posts_file(spark, sf_dir)))


def src_test_posts(spark, sf_dir):
    b = _bound(spark, sf_dir)
    p = scratch_path(spark, "test_posts.json")
    WR.write_posts_json(b.with_content(b.test_posts), None, p)
    return _post_display(RD.posts_from_raw(RD.read_posts_raw(spark, p, test=True)))


def src_truth(spark, sf_dir):
    b = _bound(spark, sf_dir)
    p = scratch_path(spark, "truth.csv")
    WR.write_truth_csv(b.truth, p)
    return RD.read_truth(spark, p)


def src_user_list(spark, sf_dir):
    b = _bound(spark, sf_dir)
    p = scratch_path(spark, "test_users.csv")
    WR.write_id_list(b.test_users, "user_id", p)
    return RD.read_id_list(spark, p)


def tsv_train_roundtrip(spark, sf_dir):
    w = _wf(spark, sf_dir)
    p = scratch_path(spark, "train_features.tsv")
    WR.write_features_tsv(w.training_set, p, keyed=False)
    return RD.read_train_features(spark, p)


def tsv_test_roundtrip(spark, sf_dir):
    w = _wf(spark, sf_dir)
    p = scratch_path(spark, "test_features.tsv")
    WR.write_features_tsv(w.features_candidates, p, keyed=True)
    return RD.read_test_features(spark, p)


def parquet_train_roundtrip(spark, sf_dir):
    p = scratch_path(spark, "train_features.parquet")
    WR.write_features(_wf(spark, sf_dir).training_set, p)
    return RD.read_features(spark, p)


def parquet_test_roundtrip(spark, sf_dir):
    p = scratch_path(spark, "test_features.parquet")
    WR.write_features(_wf(spark, sf_dir).features_candidates, p, keyed=True)
    return RD.read_features(spark, p, keyed=True)


def profile_merged(spark, sf_dir):
    """A10: the stored profile of one half of the likes, kept up with the other half."""
    b = _bound(spark, sf_dir)
    second = F.pmod(F.xxhash64("user_id", "post_id"), F.lit(2)) == 1
    p = scratch_path(spark, "profile")
    PR.write_profile(PR.profile_long(b.train_likes.where(~second), b.posts), p)
    PR.merge_profile(spark, p, PR.profile_long(b.train_likes.where(second), b.posts))
    return PR.read_profile(spark, p).drop("bucket")


def label_pairs_dropped(spark, sf_dir):
    """Pairs left out for a user outside the truth, counted while the labels are written."""
    w, seen = _wf(spark, sf_dir), Observation()
    pairs = w.candidate_pairs.unionByName(w.b.train_likes).distinct()
    n = stage(CA.label_pairs(pairs, w.b.truth, dropped=seen), "labelled_pairs").count()
    return spark.createDataFrame([(n, seen.get["n_dropped"])], "n_labelled long, n_dropped long")


# ---- scored-table helpers -----------------------------------------------------------------

def _tag_conf(spark, sf_dir) -> DataFrame:
    return _wf(spark, sf_dir).tag_confusion


def _points(conf: DataFrame, curve: str) -> DataFrame:
    """A curve as (x, y, position)."""
    if curve == "pr":
        return CU.pr_curve(conf).select(F.col("recall").alias("x"), F.col("precision").alias("y"), "position")
    if curve == "roc":
        return CU.roc_curve(conf).select(F.col("fpr").alias("x"), F.col("tpr").alias("y"), "position")
    make = {"precision": CU.precision_by_threshold, "recall": CU.recall_by_threshold}.get(curve, CU.f_measure_by_threshold)
    return make(conf, keep=["position"]).select(F.col("threshold").alias("x"), F.col(curve).alias("y"), "position")


#: The thinned curves as the reference uses them: curve, by index or by x, digits of x.
THINNED = {"precision_linear": ("precision", "linear", ROUND_DIGITS), "precision": ("precision", "index", ROUND_DIGITS),
           "recall": ("recall", "index", ROUND_DIGITS), "pr": ("pr", "index", PR_DIGITS), "f1": ("f1", "index", F_DIGITS),
           "f05": ("f05", "index", F_DIGITS), "roc": ("roc", "linear", F_DIGITS)}


def _thinned(conf: DataFrame, curve: str, by: str, digits: int) -> DataFrame:
    """C11 or C12, then C13, in the order of x."""
    pts = _points(conf, curve)
    thin = CU.percentile_bins(pts, CURVE_POINTS) if by == "index" else CU.linear_bins(pts, CURVE_POINTS)
    return CU.ordered(_rounded(CU.round_x(_rounded(thin, "x", "y"), digits), "y"))


def _evaluation(name: str, conf_of) -> dict[str, Query]:
    """Every curve, area and thinned curve of a scorer's threshold counts."""
    conf = lambda s, d: conf_of(_wf(s, d))
    out: dict[str, Query] = {
        f"{name}_confusion": conf,
        f"{name}_precision_by_threshold": lambda s, d: CU.precision_by_threshold(conf(s, d)),
        f"{name}_recall_by_threshold": lambda s, d: CU.recall_by_threshold(conf(s, d)),
        f"{name}_pr_curve": lambda s, d: CU.pr_curve(conf(s, d)),
        f"{name}_f_measure_by_threshold": lambda s, d: CU.f_measure_by_threshold(conf(s, d)),
        f"{name}_roc_curve": lambda s, d: CU.roc_curve(conf(s, d)),
        f"{name}_area_under_pr": lambda s, d: _rounded(CU.area_under_pr(conf(s, d)), "area_under_pr"),
        f"{name}_area_under_roc": lambda s, d: _rounded(CU.area_under_roc(conf(s, d)), "area_under_roc"),
        f"{name}_best_threshold_min_fpr": lambda s, d: CU.best_threshold_min_fpr(conf(s, d)),
        f"{name}_best_threshold_max_tpr": lambda s, d: CU.best_threshold_max_tpr(conf(s, d)),
    }
    for k, v in THINNED.items():
        out[f"{name}_thin_{k}"] = lambda s, d, v=v: _thinned(conf(s, d), *v)
    return out


MODEL_EVALUATION = _evaluation("lr", lambda w: w.lr_confusion) | _evaluation("holdout", lambda w: w.holdout_confusion)


def _holdout_metrics(spark, sf_dir) -> DataFrame:
    c = _wf(spark, sf_dir).holdout_confusion
    both = CU.area_under_roc(c).select("area_under_roc", CU.area_under_pr(c).scalar().alias("area_under_pr"))
    return _rounded(both, "area_under_roc", "area_under_pr")


def _test_users_without_profile(spark, sf_dir) -> DataFrame:
    w = _wf(spark, sf_dir)
    u = w.b.test_users
    return u.join(w.ctx.user_totals.select("user_id"), "user_id", "left_anti").agg(
        F.count(F.lit(1)).alias("n_users_no_profile"))


def _scored_vs_truth(spark, sf_dir, fn, **kw) -> DataFrame:
    w = _wf(spark, sf_dir)
    return fn(w.tag_scored, w.b.truth, **kw)


def _tag_grid(spark, sf_dir, grid) -> DataFrame:
    w = _wf(spark, sf_dir)
    return _rounded(w.map_grid(w.tag_scored, *grid), "map")


def _lr_map_grid(spark, sf_dir):
    w = _wf(spark, sf_dir)
    return _rounded(w.map_grid(w.lr_scored, *LR_GRID), "map")


def _stored_map_grid(spark, sf_dir):
    w = _wf(spark, sf_dir)
    return _rounded(w.map_grid(w.stored_scored, *LR_GRID), "map")


def _loss_gradient(spark, sf_dir):
    w = _wf(spark, sf_dir)
    return _rounded(MO.loss_and_gradient(w.training_set, w.fixed_weights), "value")


def _assembled(spark, sf_dir):
    """The components of the assembled vector, under the features' names again."""
    v = MO.assemble(_wf(spark, sf_dir).features_candidates).withColumn("v", vector_to_array("features"))
    part = lambda i: F.when(~F.isnan(F.col("v")[i]), F.col("v")[i])
    return v.select("user_id", "post_id", *[part(i).alias(f) for i, f in enumerate(FEATURES)])


def _label_pairs(spark, sf_dir) -> DataFrame:
    """J10 on the candidates and the training likes, which also have users outside the truth."""
    w = _wf(spark, sf_dir)
    return CA.label_pairs(w.candidate_pairs.unionByName(w.b.train_likes).distinct(), w.b.truth)


QUERIES: dict[str, Query] = {
    # S: scans, sources, sinks
    "src_stats_blog": src_stats_blog,
    "src_stats_user_long": src_stats_user_long,
    "src_stats_users": src_stats_users,
    "src_posts": src_posts,
    "src_likes": src_likes,
    "src_test_posts": src_test_posts,
    "src_truth": src_truth,
    "src_user_list": src_user_list,
    "tsv_train_roundtrip": tsv_train_roundtrip,
    "tsv_test_roundtrip": tsv_test_roundtrip,
    "parquet_train_roundtrip": parquet_train_roundtrip,
    "parquet_test_roundtrip": parquet_test_roundtrip,
    # P: projections, filters
    "filter_any_null": lambda s, d: CL.drop_any_null(_faulty_posts(_bound(s, d).posts)).select(
        "post_id", "blog_id", "author_id", "language", "title"),
    "project_post_sets": lambda s, d: CL.post_sets(_bound(s, d).posts),
    "stats_user_map": lambda s, d: CL.last_entries(_repeated_entries(_bound(s, d).stats_user)),
    "filter_finite_features": lambda s, d: CL.finite_features(_faulty_features(_wf(s, d).training_set)),
    "check_user_totals": lambda s, d: ED.check_user_totals(_faulty_totals(_bound(s, d).stats_user)),
    "check_empty_language": lambda s, d: ED.check_empty_language(_faulty_posts(_bound(s, d).posts)),
    "lookup_post": lambda s, d: ED.lookup_post(_bound(s, d).posts, *LOOKUP),
    "check_null_fields": lambda s, d: ED.check_null_fields(_faulty_posts(_bound(s, d).posts)),
    "user_blog_likelihood_capped": lambda s, d: PR.user_blog_likelihood_capped(_bound(s, d).stats_user),
    "user_blog_likelihood_capped_small": lambda s, d: PR.user_blog_likelihood_capped(
        _bound(s, d).stats_user, SMALL_BLOG_CAP),
    "title_word_count": lambda s, d: CL.title_word_counts(_bound(s, d).posts),
    # J: joins
    "feature_avg_likes_per_post": lambda s, d: _wf(s, d).ctx.post_attrs.select("post_id", "avg_likes_per_post"),
    "feature_blog_likelihood": _feature("blog_likelihood"),
    "semi_test_posts": lambda s, d: _wf(s, d).test_posts.select("post_id", "blog_id", "author_id", "language"),
    "candidate_pairs": lambda s, d: _wf(s, d).candidate_pairs,
    "check_users_no_stats": lambda s, d: ED.users_without_stats(_bound(s, d).train_likes, _bound(s, d).stats_user),
    "check_blogs_no_stats": lambda s, d: ED.blogs_without_stats(_bound(s, d).posts, _bound(s, d).stats_blog),
    "check_blogs_with_stats": lambda s, d: ED.blogs_with_stats(_bound(s, d).posts, _bound(s, d).stats_blog),
    "label_pairs": _label_pairs,
    "label_pairs_dropped": label_pairs_dropped,
    "non_like_users": lambda s, d: NE.non_like_counts(_bound(s, d).train_posts, _bound(s, d).train_likes),
    # A: aggregations
    "prior_blog_likelihood": lambda s, d: PR.prior_blog_likelihood(_bound(s, d).stats_user),
    "mean_blog_likes": lambda s, d: PR.mean_blog_likes(_bound(s, d).stats_blog),
    "blog_avg_likes": lambda s, d: PR.blog_avg_likes(_bound(s, d).stats_blog),
    "user_blog_likelihood": lambda s, d: PR.user_blog_likelihood(_bound(s, d).stats_user),
    "profile_categories": lambda s, d: PR.profile_kind(_bound(s, d).train_likes, _bound(s, d).posts, "category", "category"),
    "profile_tags": lambda s, d: PR.profile_kind(_bound(s, d).train_likes, _bound(s, d).posts, "tag", "tag"),
    "profile_languages": lambda s, d: PR.profile_kind(_bound(s, d).train_likes, _bound(s, d).posts, "language", "language"),
    "profile_authors": lambda s, d: PR.profile_kind(_bound(s, d).train_likes, _bound(s, d).posts, "author", "author_id",
                                                    "bigint"),
    "profile_merged": profile_merged,
    "profile_title_lengths": lambda s, d: PR.profile_kind(_bound(s, d).train_likes, _bound(s, d).posts, "title_len",
                                                          "title_len", "int"),
    "feature_categories_likelihood": _feature("categories_likelihood"),
    "feature_tags_likelihood": _feature("tags_likelihood"),
    "feature_categories_likelihood_plain": _feature("categories_likelihood", "documented"),
    "feature_tags_likelihood_plain": _feature("tags_likelihood", "documented"),
    "feature_language_likelihood": _feature("language_likelihood"),
    "feature_author_likelihood": _feature("author_likelihood"),
    "feature_title_length_error": _feature("title_length_error"),
    "feature_title_length_error_mean": _feature("title_length_error", "documented"),
    "hist_equal_width": lambda s, d: ED.hist_equal_width(
        _bound(s, d).stats_user.groupBy("user_id").agg(F.max("num_likes").alias("num_likes")), "num_likes"),
    "hist_edges": lambda s, d: ED.hist_edges(
        _bound(s, d).stats_user.groupBy("user_id").agg(F.max("num_likes").alias("num_likes")), "num_likes"),
    "count_distinct_keys": lambda s, d: ED.count_distinct_keys(_bound(s, d).stats_user, _bound(s, d).train_likes,
                                                               _bound(s, d).posts, _bound(s, d).stats_blog),
    "count_distinct_keys_approx": lambda s, d: ED.count_distinct_keys_approx(
        _bound(s, d).stats_user, _bound(s, d).train_likes, _bound(s, d).posts),
    "universe_users": lambda s, d: NE.universe_users(_bound(s, d).train_likes),
    "tag_user_index": lambda s, d: _wf(s, d).tag_index,
    "recommend_lists": lambda s, d: RA.recommend_lists(_wf(s, d).tag_scored),
    "ap_at_k": lambda s, d: _rounded(_scored_vs_truth(s, d, RA.ap_at_k), "ap"),
    "map_at_k": lambda s, d: _rounded(_scored_vs_truth(s, d, RA.map_at_k), "map"),
    "map_at_k_all_truth": lambda s, d: _rounded(_scored_vs_truth(s, d, RA.map_at_k, over="all_truth"), "map"),
    "likes_per_post_distribution": lambda s, d: NE.likes_per_post_distribution(_bound(s, d).train_posts,
                                                                               _bound(s, d).train_likes),
    "best_map_threshold": lambda s, d: RA.best_map_threshold(_tag_grid(s, d, TAG_GRID)),
    "best_threshold_min_fpr": lambda s, d: CU.best_threshold_min_fpr(_tag_conf(s, d)),
    "best_threshold_max_tpr": lambda s, d: CU.best_threshold_max_tpr(_tag_conf(s, d)),
    # W: windows
    "ranked_hits": lambda s, d: _scored_vs_truth(s, d, RA.ranked_hits),
    "confusion_by_threshold": _tag_conf,
    # T: top-k, limits
    "profile_topk": lambda s, d: PR.profile_long(_bound(s, d).train_likes, _bound(s, d).posts, cap=100).where(
        F.col("kind").isin(PR.CAPPED_KINDS)),
    "profile_topk_small": lambda s, d: PR.profile_long(_bound(s, d).train_likes, _bound(s, d).posts, cap=SMALL_TOP).where(
        F.col("kind").isin(PR.CAPPED_KINDS)),
    "top_categories": lambda s, d: ED.top_categories(_bound(s, d).posts),
    "preview": lambda s, d: ED.preview(_wf(s, d).labelled_candidates, ["user_id", "post_id"]),
    # U / E: unions, feature rows
    "training_set": lambda s, d: _wf(s, d).training_set,
    "features_true": lambda s, d: _wf(s, d).features_true,
    "features_false": lambda s, d: _wf(s, d).features_false,
    "features_candidates": lambda s, d: _wf(s, d).features_candidates,
    # N: sampling
    "sample_test_users": lambda s, d: CA.sample_users(_bound(s, d).test_users),
    "sample_test_users_native": lambda s, d: CA.sample_users_native(_bound(s, d).test_users),
    "negative_counts": lambda s, d: NE.negative_counts(_bound(s, d).train_posts, _bound(s, d).train_likes),
    "negative_pairs": lambda s, d: _wf(s, d).negative_pairs,
    "split_train_holdout": lambda s, d: NE.split_train_holdout(_wf(s, d).training_set).select(
        "user_id", "post_id", "label", "split"),
    "split_train_holdout_native": lambda s, d: NE.split_train_holdout_native(
        _wf(s, d).training_set.select("user_id", "post_id", "label")),
    # M: models and scoring
    "tag_scores": lambda s, d: _wf(s, d).tag_scored,
    "lr_weights": lambda s, d: MO.lr_weights(_wf(s, d).lr_model, s),
    "lr_scores": lambda s, d: _wf(s, d).lr_scored,
    "lr_map_grid": _lr_map_grid,
    "lr_best_map_threshold": lambda s, d: RA.best_map_threshold(_lr_map_grid(s, d)),
    "lr_holdout_metrics": _holdout_metrics,
    # the same model operators at fixed weights, from a stored model
    "assemble_features": _assembled,
    "stored_weights": lambda s, d: _wf(s, d).fixed_weights,
    "stored_scores": lambda s, d: _wf(s, d).stored_scored,
    "stored_map_grid": _stored_map_grid,
    "stored_best_map_threshold": lambda s, d: RA.best_map_threshold(_stored_map_grid(s, d)),
    "loss_gradient": _loss_gradient,
    "check_test_users_without_profile": _test_users_without_profile,
    # C: curves and tuning
    "precision_by_threshold": lambda s, d: CU.precision_by_threshold(_tag_conf(s, d)),
    "recall_by_threshold": lambda s, d: CU.recall_by_threshold(_tag_conf(s, d)),
    "pr_curve": lambda s, d: CU.pr_curve(_tag_conf(s, d)),
    "f_measure_by_threshold": lambda s, d: CU.f_measure_by_threshold(_tag_conf(s, d)),
    "area_under_pr": lambda s, d: _rounded(CU.area_under_pr(_tag_conf(s, d)), "area_under_pr"),
    "roc_curve": lambda s, d: CU.roc_curve(_tag_conf(s, d)),
    "area_under_roc": lambda s, d: _rounded(CU.area_under_roc(_tag_conf(s, d)), "area_under_roc"),
    "map_threshold_grid": lambda s, d: _tag_grid(s, d, TAG_GRID_FINE),
    "curve_percentile_bins": lambda s, d: _rounded(CU.percentile_bins(_points(_tag_conf(s, d), "precision"), CURVE_POINTS), "x", "y"),
    "curve_linear_bins": lambda s, d: _rounded(CU.linear_bins(_points(_tag_conf(s, d), "roc"), CURVE_POINTS), "x", "y"),
    "curve_round_x": lambda s, d: _rounded(CU.round_x(_points(_tag_conf(s, d), "precision"), ROUND_DIGITS), "y"),
}
QUERIES |= {f"curve_thin_{k}": lambda s, d, v=v: _thinned(_tag_conf(s, d), *v) for k, v in THINNED.items()}
QUERIES |= MODEL_EVALUATION | _evaluation("stored", lambda w: w.stored_confusion)

# Queries with no exact SQL oracle (model fitting; Spark's own samplers and sketches): checked by
# row count and by pytest invariants.
ROWS_ONLY = {"lr_weights", "lr_scores", "lr_map_grid", "lr_best_map_threshold", "lr_holdout_metrics",
             "sample_test_users_native", "split_train_holdout_native", "count_distinct_keys_approx", *MODEL_EVALUATION}
