"""Ordered running totals over a whole table without a single-task window.

A window with no PARTITION BY sends every row to one task.  Here the order
column is cut into buckets at approximate quantiles (a bounded list of split
points, computed once), each bucket gets the totals of all buckets before it
(a table with one row per bucket, so its size is bounded by the bucket
count), and the running total inside a bucket is a window partitioned by
bucket.  Bucket membership is a pure function of the value, so recomputing a
lost task gives the same answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinis.functions.expr import with_count_at_or_below

#: Rows of a bucket on average; the number of buckets follows the number of rows.
BUCKET_ROWS = 1_000_000
LEAST_BUCKETS, MOST_BUCKETS = 8, 20_000


def bucket_count(rows: int) -> int:
    """Buckets for a table of ``rows`` rows.  The upper limit bounds the split points on the driver, not the rows."""
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS)))


def _splits(df: DataFrame, col: str, buckets: int) -> list[float]:
    if buckets <= 1:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    qs = df.approxQuantile(col, probs, 1.0 / (4 * buckets))
    out: list[float] = []
    for q in qs:
        if q is None:
            continue
        if not out or q > out[-1]:
            out.append(float(q))
    return out


def with_bucket(df: DataFrame, col: str, splits: list[float], out: str = "_bucket") -> DataFrame:
    """Add the index of the half-open interval [s_i, s_i+1) holding ``col``."""
    return with_count_at_or_below(df, F.col(col), splits, out)


def running_totals(df: DataFrame, order_col: str, value_cols: list[str],
                   descending: bool = False, buckets: int | None = None,
                   position_col: str | None = "position", tie_cols: list[str] | None = None) -> DataFrame:
    """Add ``cum_<v>`` (sum of v over this row and all rows before it) and a 0-based position.

    Rows must be unique on (order_col, *tie_cols).  Order is ascending on
    ``order_col`` unless ``descending``; ``tie_cols`` break ties ascending.
    """
    tie_cols = tie_cols or []
    buckets = buckets or bucket_count(df.count())
    splits = _splits(df, order_col, buckets)
    b = with_bucket(df, order_col, splits)
    if descending:
        b = b.withColumn("_bucket", F.lit(len(splits)) - F.col("_bucket"))
    aggs = [F.sum(v).alias(f"_bt_{v}") for v in value_cols] + [F.count(F.lit(1)).alias("_bt_n")]
    totals = b.groupBy("_bucket").agg(*aggs)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket: a bounded table, safe to order in one task and broadcast
    offsets = totals.select(
        "_bucket",
        *[F.coalesce(F.sum(f"_bt_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in value_cols],
        F.coalesce(F.sum("_bt_n").over(before), F.lit(0)).alias("_off_n"),
    )
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w = Window.partitionBy("_bucket").orderBy(o, *[F.col(t).asc() for t in tie_cols]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = b.join(F.broadcast(offsets), "_bucket")
    for v in value_cols:
        out = out.withColumn(f"cum_{v}", F.col(f"_off_{v}") + F.sum(v).over(w))
    if position_col:
        out = out.withColumn(position_col, F.col("_off_n") + F.row_number().over(w) - 1)
    return out.drop("_bucket", "_off_n", *[f"_off_{v}" for v in value_cols])


def dense_index(df: DataFrame, key: str, index_col: str = "idx", buckets: int | None = None) -> DataFrame:
    """Distinct ``key`` values with their 0-based rank in ascending order."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return running_totals(keys, key, [], descending=False, buckets=buckets, position_col=index_col)
