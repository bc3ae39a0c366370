"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words (runs without ASCII white space) of a text; null counts as no word."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_text(col: Column) -> Column:
    """An id as text for hashing; null is the empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def never_null(col: Column) -> Column:
    """A text that is equal exactly where the values are equal, null with null: a plain join and grouping key.

    A null-safe join hashes other expressions than a grouping does, so Spark would shuffle twice.
    """
    return F.when(col.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), col.cast("string")))


def nested(df: DataFrame, *taken: str) -> Column:
    """All columns of ``df`` but those named in ``taken``, as one struct, so that helper columns cannot clash."""
    low = {t.lower() for t in taken}
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


@contextmanager
def rows_a_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """A Python worker gets at most ``rows`` rows at a time, however many its task has."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def one_row_a_batch(spark: SparkSession) -> AbstractContextManager[None]:
    """A Python worker gets one (large) row at a time, however many its task has."""
    return rows_a_batch(spark, 1)


def running_offset(df: DataFrame, key: str, size: str, group: int = 1024) -> DataFrame:
    """(key, offset): sum of ``size`` over all smaller integer keys, in two levels, so no window holds all keys."""
    sup = df.select(key, size, F.floor(F.col(key) / group).alias("_sup"))
    inner = Window.partitionBy("_sup").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("_sup").rowsBetween(Window.unboundedPreceding, -1)
    tops = sup.groupBy("_sup").agg(F.sum(size).alias("_n")).select(
        "_sup", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_before"))
    return (sup.withColumn("_in", F.coalesce(F.sum(size).over(inner), F.lit(0)))
            .join(tops, "_sup").select(key, (F.col("_in") + F.col("_before")).alias("offset")))
