"""Join that keeps a hot key (one user, tag or post holding a large share of
all rows) from landing in a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_SALT = 200_000


def hot_keys(df: DataFrame, keys: list[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """(keys, salts) of the keys with more than ``rows_per_salt`` rows: at most count / rows_per_salt of them.

    That bound is what makes this table a broadcast side.
    """
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_salt)
    return n.select(*keys, F.ceil(F.col("_n") / F.lit(rows_per_salt)).cast("int").alias("salts"))


def with_salt(df: DataFrame, hot: DataFrame, key: str, by: str, name: str = "salt") -> DataFrame:
    """``df`` with one salt per row, by a hash of column ``by``; a cold key has salt 0."""
    return (df.join(F.broadcast(hot), key, "left")
            .withColumn(name, F.pmod(F.xxhash64(by), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts"))


def copied(df: DataFrame, hot: DataFrame, key: str | list[str], name: str = "salt") -> DataFrame:
    """``df`` with every row once per salt of its key."""
    return (df.join(F.broadcast(hot), key, "left")
            .withColumn(name, F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts"))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Inner equi-join whose keys may be hot on either side.

    A key with more than ``rows_per_salt`` rows on one side is split into
    salts there, and its rows on the other side are copied once per salt; a
    key hot on both sides is split on both.  No task joins a whole hot key,
    and nothing joins on the bare key but the broadcast hot lists.
    """
    hot_l, hot_r = hot_keys(left, keys, rows_per_salt), hot_keys(right, keys, rows_per_salt)

    def own(df, hot, name):
        rest = [F.col(c) for c in df.columns if c not in keys] or [F.col(k) for k in keys]
        return (df.join(F.broadcast(hot), keys, "left")
                .withColumn(name, F.pmod(F.xxhash64(*rest), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts"))

    l = copied(own(left, hot_l, "_sl"), hot_r, keys, "_sr")
    r = copied(own(right, hot_r, "_sr"), hot_l, keys, "_sl")
    return l.join(r, [*keys, "_sl", "_sr"]).drop("_sl", "_sr")
