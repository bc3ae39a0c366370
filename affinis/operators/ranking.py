"""Ranking quality: ranked lists, average precision, MAP@n and the one-pass threshold grid.

A whole list (``ranked_hits``, ``recommend_lists``) of up to ``RANGE_ROWS`` rows is ranked by one window.  Longer
lists are cut at ranges of (score, post) by a range partitioning over all of them; each range gets the rows and
hits of the ranges before it, so no task holds more than a range.

Only the first n recommendations of a user count towards AP@n, and raising
the score threshold keeps a prefix of each ranked list.  So the top n per
user (Spark's window group limit cuts each list before the shuffle) is computed once,
and every threshold of a grid is answered from it in a single aggregate
over at most (grid size) groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.functions.expr import with_count_at_or_below
from affinis.plans.skew import hot_keys
from affinis.session import stage

# Fixed value: the cut of MAP@n, as the reference has it.
MAP_N = 100
#: Post ids in one row of a recommendation list.
LIST_ROW = 100
#: Rows of a user's list beyond which it is ranked range by range.
RANGE_ROWS = 1_000_000


def _valid(scored: DataFrame, threshold: float | None) -> DataFrame:
    s = scored.where(F.col("score").isNotNull() & ~F.isnan("score"))
    if threshold is not None:
        s = s.where(F.col("score") >= F.lit(float(threshold)))
    return s


def top_n(scored: DataFrame, n: int = MAP_N, threshold: float | None = None) -> DataFrame:
    """T3 + T4: per user, the n best (score desc, post_id) rows, rank in ``k`` (1-based)."""
    s = _valid(scored, threshold).select("user_id", "post_id", "score")
    w = Window.partitionBy("user_id").orderBy(F.col("score").desc(), F.col("post_id").asc())
    return s.withColumn("k", F.row_number().over(w)).where(F.col("k") <= n)      # Spark cuts before the shuffle


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("post_id").asc()]


def placed(rows: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(user_id, post_id, score, hit) rows with their rank ``k`` (1-based) and running ``cum_hits`` per user."""
    def within(df, *part):
        w = Window.partitionBy("user_id", *part).orderBy(*_order())
        return df.withColumn("k", F.row_number().over(w).cast("bigint")).withColumn(
            "cum_hits", F.sum("hit").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    hot = hot_keys(rows, ["user_id"], range_rows)
    ranges = hot.agg(F.sum("salts")).first()[0]
    if not ranges:
        return within(rows)
    cold = rows.join(F.broadcast(hot), "user_id", "left_anti")
    # written with the number of the range, so that it stays what it was when a task is run again
    cut = (rows.join(F.broadcast(hot), "user_id", "left_semi").repartitionByRange(int(ranges), "user_id", *_order())
           .withColumn("range", F.spark_partition_id()))
    cut = stage(cut, "ranges_of_lists")
    before = Window.partitionBy("user_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy("user_id", "range").agg(F.count(F.lit(1)).alias("n"), F.sum("hit").alias("h"))
    offsets = totals.select("user_id", "range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n", "h")])
    far = within(cut, "range").join(offsets, ["user_id", "range"]).withColumns(
        {"k": F.col("k") + F.col("n_before"), "cum_hits": F.col("cum_hits") + F.col("h_before")})
    return within(cold).unionByName(far.select(*rows.columns, "k", "cum_hits"))


def ranked(scored: DataFrame, threshold: float | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Every valid row with its rank ``k`` (1-based) in the user's list (score desc, post_id)."""
    rows = _valid(scored, threshold).select("user_id", "post_id", "score", F.lit(0).alias("hit"))
    return placed(rows, range_rows).select("user_id", "post_id", "score", "k")


def _with_hits(r: DataFrame, truth: DataFrame) -> DataFrame:
    t = truth.select("user_id", "post_id", F.lit(1).alias("_t")).distinct()
    r = r.join(t, ["user_id", "post_id"], "left").withColumn("hit", F.coalesce("_t", F.lit(0))).drop("_t")
    w = Window.partitionBy("user_id").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return r.withColumn("cum_hits", F.sum("hit").over(w)).select(
        "user_id", F.col("k").cast("bigint").alias("k"), "post_id", "score", "hit", "cum_hits")


def ranked_hits(scored: DataFrame, truth: DataFrame, threshold: float | None = None,
                range_rows: int = RANGE_ROWS) -> DataFrame:
    """(user_id, k, post_id, score, hit, cum_hits) for the whole list of each user."""
    t = truth.select("user_id", "post_id", F.lit(1).alias("_t")).distinct()
    rows = (_valid(scored, threshold).select("user_id", "post_id", "score").join(t, ["user_id", "post_id"], "left")
            .withColumn("hit", F.coalesce("_t", F.lit(0))).drop("_t"))
    return placed(rows, range_rows).select("user_id", "k", "post_id", "score", "hit", "cum_hits")


def recommend_lists(scored: DataFrame, threshold: float | None = None, per_row: int = LIST_ROW,
                    range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each user's whole list in rank order, ``per_row`` post ids a row: (user_id, part, n_recs, recs)."""
    t = ranked(scored, threshold, range_rows).withColumn("part", F.floor((F.col("k") - 1) / per_row).cast("int"))
    return t.groupBy("user_id", "part").agg(
        F.count(F.lit(1)).alias("n_recs"),
        F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("k", "post_id"))),
                                     lambda x: x["post_id"].cast("string"))).alias("recs"))


def truth_sizes(truth: DataFrame) -> DataFrame:
    return truth.select("user_id", "post_id").distinct().groupBy("user_id").agg(F.count(F.lit(1)).alias("n_truth"))


def ap_at_k(scored: DataFrame, truth: DataFrame, n: int = MAP_N, threshold: float | None = None) -> DataFrame:
    """(user_id, ap) for users with recommendations and a truth set."""
    h = _with_hits(top_n(scored, n, threshold), truth)
    num = h.groupBy("user_id").agg(F.sum(F.col("hit") * F.col("cum_hits") / F.col("k")).alias("_s"))
    return (num.join(truth_sizes(truth), "user_id")
            .select("user_id", (F.col("_s") / F.least(F.col("n_truth"), F.lit(n))).alias("ap")))


def map_at_k(scored: DataFrame, truth: DataFrame, n: int = MAP_N, threshold: float | None = None,
             over: str = "joined") -> DataFrame:
    """One row (map, n_users).

    ``over="joined"``: mean over users with recommendations (the reference);
    ``over="all_truth"``: users of the truth without recommendations count 0.
    """
    ap = ap_at_k(scored, truth, n, threshold)
    if over == "all_truth":
        ap = truth_sizes(truth).select("user_id").join(ap, "user_id", "left").fillna(0.0, ["ap"])
    return ap.agg(F.coalesce(F.avg("ap"), F.lit(0.0)).alias("map"), F.count(F.lit(1)).alias("n_users"))


def grid_values(lo: int, hi: int, step: int) -> list[float]:
    """thresholds k/100 for k in lo..hi by step."""
    return [k / 100.0 for k in range(lo, hi + 1, step)]


def map_threshold_grid(scored: DataFrame, truth: DataFrame, lo: int = 1, hi: int = 100, step: int = 1,
                       n: int = MAP_N) -> DataFrame:
    """(threshold, map, n_users) for every threshold of the grid, in one pass.

    Each top-n row adds hit*cum_hits/k / min(n_truth, n) to every threshold
    at or below its score: rows are bucketed to the highest such grid point
    and suffix sums over the (small, bounded) grid give each threshold's sum.
    """
    grid = grid_values(lo, hi, step)
    spark = scored.sparkSession
    h = _with_hits(top_n(scored, n), truth).join(truth_sizes(truth), "user_id")
    rows = with_count_at_or_below(h, F.col("score"), grid, "_n").select(
        (F.col("_n") - 1).alias("gi"),
        (F.col("hit") * F.col("cum_hits") / F.col("k") / F.least(F.col("n_truth"), F.lit(n))).alias("c"),
        F.when(F.col("k") == 1, F.lit(1)).otherwise(F.lit(0)).alias("u"),
    ).where(F.col("gi") >= 0)
    agg = rows.groupBy("gi").agg(F.sum("c").alias("s"), F.sum("u").alias("nu"))
    g = spark.createDataFrame([(i, v) for i, v in enumerate(grid)], "gi int, threshold double")
    w = Window.orderBy(F.col("gi").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = (g.join(agg, "gi", "left")
           .withColumn("s_cum", F.sum(F.coalesce("s", F.lit(0.0))).over(w))
           .withColumn("n_users", F.sum(F.coalesce("nu", F.lit(0))).over(w)))
    return out.select(
        "threshold",
        F.when(F.col("n_users") > 0, F.col("s_cum") / F.col("n_users")).otherwise(F.lit(0.0)).alias("map"),
        F.col("n_users").cast("bigint").alias("n_users"))


def best_map_threshold(grid: DataFrame) -> DataFrame:
    """The (threshold, map) with the highest MAP; ties go to the lowest threshold."""
    best = grid.agg(F.min_by(F.struct("threshold", "map"), F.struct(-F.col("map"), F.col("threshold"))).alias("b"))
    return best.select(F.col("b.threshold").alias("threshold"), F.col("b.map").alias("map"))
