"""Operator 1, sharding: two-pass external shuffle.

Pass one scatters the records uniformly into buckets that fit in memory, by
a seeded hash of the record's place in the scan (so repeated records and
repeated keys spread as well), and writes them.  Pass two takes each bucket
whole, applies a Fisher-Yates shuffle (Spark's ``shuffle``) and numbers the
records.  There are as many buckets as keep the average under both
``BUCKET_ROWS`` records and ``BUCKET_BYTES`` bytes.  Of a bucket that long
records make larger than ``LARGE`` times that only the records' places in the
scan (8 bytes each) are held and Fisher-Yates shuffled; the records are joined
to them.  Buckets laid end to end are one random permutation of the input;
dealing it out in turn gives shards whose row counts differ by at most one.

The scattered table is written to the shared folder, so a lost executor
reads the same buckets again, and a bucket is shuffled and numbered in one
task.  The single-partition window inside ``running_offset`` sees one row
per 1024 buckets.

Cases: an empty table gives no rows; null columns, empty texts and repeated
records are records like any other; an input column named ``shard`` or
``slot`` is replaced by the operator's; other columns pass unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.llm.common import nested, running_offset
from affinis.session import stage

N_SHARDS = 24
SEED = 42
BUCKET_ROWS = 2048              # records of a bucket on average, at most
BUCKET_BYTES = 4 * 1024 * 1024  # bytes of a bucket on average, at most
LARGE = 4                       # a bucket of more than LARGE * BUCKET_BYTES is never held in memory


def record_bytes(df: DataFrame) -> Column:
    """Bytes of a record: its texts and binaries, nested values as text, 8 for any other value."""
    total = F.lit(8)
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            c = c.cast("string")
        elif not isinstance(kind, (T.StringType, T.BinaryType)):
            total = total + 8
            continue
        total = total + F.coalesce(F.octet_length(c), F.lit(0))
    return total.cast("long")


def external_shuffle(df: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The records of ``df`` with shard (0 to n_shards - 1) and slot (gapless from 0 in its shard)."""
    size = df.select(record_bytes(df).alias("bytes")).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).first()
    buckets = max(1, math.ceil(size["n"] / bucket_rows), math.ceil((size["bytes"] or 0) / bucket_bytes))
    scattered = stage(
        df.select(F.monotonically_increasing_id().alias("pos"), record_bytes(df).alias("bytes"),
                  nested(df, "shard", "slot").alias("rec"))
        .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "pos"), F.lit(buckets))), "scattered")
    sizes = stage(scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")), "bucket_sizes")
    large = sizes.where(F.col("bytes") > LARGE * bucket_bytes).select("bucket")
    fits = scattered
    if not large.isEmpty():
        fits = scattered.join(large, "bucket", "left_anti")
    shuffled = (fits.repartition("bucket").sortWithinPartitions("bucket", "pos")
                .groupBy("bucket").agg(F.collect_list("rec").alias("recs"))
                .select("bucket", F.posexplode(F.shuffle("recs", seed)).alias("place", "rec")))
    if fits is not scattered:
        whole = scattered.join(large, "bucket", "left_semi")
        order = (whole.groupBy("bucket").agg(F.sort_array(F.collect_list("pos")).alias("all"))
                 .select("bucket", F.posexplode(F.shuffle("all", seed)).alias("place", "pos")))
        shuffled = shuffled.unionByName(whole.join(order, ["bucket", "pos"]).select("bucket", "place", "rec"))
    at = F.col("offset") + F.col("place")
    return shuffled.join(running_offset(sizes, "bucket", "n"), "bucket").select(
        "rec.*", (at % n_shards).cast("int").alias("shard"), F.floor(at / n_shards).cast("long").alias("slot"))


def shard_documents(docs: DataFrame) -> DataFrame:
    """Contract columns, from the shuffled records; a null text has no bytes."""
    text = F.coalesce("text", F.lit(""))
    return external_shuffle(docs).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
