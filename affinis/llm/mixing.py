"""Operator 9, mixing sources to target weights: multivariate-hypergeometric splitting tree.

1. Words per source and per (source, bucket of the permutation): one
   aggregate.  A source's permutation is the order of md5(seed, doc_id, text);
   buckets cut it into ranges of equal width, so a hot source is many
   buckets and no window holds a whole source, also where ids are missing.
2. Targets: the sources share ``share`` of all words by weight, none above
   ``most`` times its own (water filling on a table of one row per source).
3. A source's line is its permutation laid ``most`` times end to end; the
   mix takes the first ``target`` words of it.  The line is cut into blocks
   of equal words; a document belongs to the block where it starts.  Only
   the document at the very end of a line is cut.
4. Splitting tree: at each node the blocks of all sources are ranked by a
   seeded hash and the first ones, in exact number, go to the left half of
   the node's shards.  How many of each source go left is a multivariate
   hypergeometric draw.  Leaves are the output shards.
5. Each shard receives its blocks and is shuffled locally by a seeded hash.
   A block without a ticket is in no shard.

``mix_digest`` counts the words of the mixed rows themselves; a document is
known by its place in its source's line, which no other document with words
has.

The block table has at most ``n_shards * blocks_per_shard`` rows plus one
per source, whatever the corpus size.

Cases: a null source is a source of its own, last in order; a null or empty
text has size 0 and is never taken; an empty table gives no rows; repeated
rows are documents of their own; input columns named like an output column
(copy, take, shard) are replaced, others pass unchanged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from affinis.llm.common import id_text, nested, never_null, word_count
from affinis.session import stage

# Weights by source order, share of all words, most copies of a document.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 42
N_SHARDS = 32
BLOCKS_PER_SHARD = 16
BUCKET_ROWS = 1024
PART_ROWS = 4096
BROADCAST_BLOCKS = 100_000      # a larger block table (very many sources) is joined by a shuffle


def _permuted(docs: DataFrame, seed: int, rec: Column) -> DataFrame:
    """``rec`` of each row, with its source, size and place key in the permutation."""
    buckets = max(1, math.ceil(docs.count() / BUCKET_ROWS))
    h = F.md5(F.concat(F.lit(f"{seed}:"), id_text(F.col("doc_id")), F.lit(":"), F.coalesce(F.md5("text"), F.lit(""))))
    return docs.select(
        rec.alias("rec"), F.col("doc_id").alias("id"), F.col("source").alias("src"),
        never_null(F.col("source")).alias("key"),
        word_count(F.col("text")).alias("size"), h.alias("h"),
        F.shiftright(F.conv(F.substring(h, 1, 8), 16, 10).cast("long") * F.lit(buckets), 32).alias("bucket"))


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(src, source_size, target, quota) from (src, source_size); windows over one row per source."""
    order = Window.orderBy(F.col("src").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("at") - 1, F.lit(len(weights))) + 1).cast("int"))
    t = totals.withColumn("at", F.row_number().over(order)).select(
        "src", "source_size", w.alias("w"), (F.col("source_size") * most).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("src").asc_nulls_last())
    all_rows = Window.partitionBy()
    t = (t.withColumn("total", F.sum("source_size").over(all_rows) * F.lit(float(share)))
         .withColumn("before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("left_w", F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("full", F.col("cap") / F.col("w") <= (F.col("total") - F.col("before")) / F.col("left_w")))
    capped = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(all_rows)
    open_w = F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(all_rows)
    level = F.try_divide(F.col("total") - capped, open_w)
    t = t.withColumn("target", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(level * F.col("w")))
    return t.select("src", "source_size", "target",
                    F.least(F.floor(F.col("target") + 0.5), F.col("cap")).cast("long").alias("quota"))


def split_blocks(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """Splitting tree: (src, block, shard) from (src, n_blocks)."""
    t = (quotas.where("n_blocks > 0").select("src", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"))
         .withColumn("lo", F.lit(0)).withColumn("hi", F.lit(n_shards)))
    for level in range(math.ceil(math.log2(n_shards)) if n_shards > 1 else 0):
        node = Window.partitionBy("lo", "hi")
        rank = F.row_number().over(node.orderBy(F.xxhash64(F.lit(seed), F.lit(level), "src", "block"),
                                                F.col("src").asc_nulls_last(), "block"))
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        t = (t.withColumn("rank", rank).withColumn("n", F.count(F.lit(1)).over(node)).withColumn("mid", mid)
             .withColumn("left", F.col("rank") * (F.col("hi") - F.col("lo")) <= F.col("n") * (F.col("mid") - F.col("lo")))
             .withColumn("left", F.when(F.col("mid") == F.col("lo"), F.lit(False)).otherwise(F.col("left")))
             .select("src", "block", F.when(F.col("left"), F.col("lo")).otherwise(F.col("mid")).alias("lo"),
                     F.when(F.col("left"), F.col("mid")).otherwise(F.col("hi")).alias("hi")))
    return t.select("src", "block", F.col("lo").alias("shard"))


def _taken(quota: Column, begin: Column, size: Column) -> Column:
    return F.greatest(F.lit(0), F.least(quota - begin, size)).cast("long")


def _places(buckets: DataFrame, group: int = 1024) -> DataFrame:
    """(key, bucket, before): words of the source's earlier buckets, in two levels, so no window holds all buckets of a source."""
    sup = buckets.select("key", "bucket", "words", F.floor(F.col("bucket") / group).alias("sup"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inner, outer = earlier(Window.partitionBy("key", "sup").orderBy("bucket")), earlier(Window.partitionBy("key").orderBy("sup"))
    tops = sup.groupBy("key", "sup").agg(F.sum("words").alias("n")).select(
        "key", "sup", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("top"))
    return (sup.withColumn("in", F.coalesce(F.sum("words").over(inner), F.lit(0))).join(tops, ["key", "sup"])
            .select("key", "bucket", (F.col("top") + F.col("in")).alias("before")))


@dataclass
class Line:
    """What every document's share follows from: words before each bucket, quotas, tickets of the blocks."""

    buckets: DataFrame      # key, bucket, before
    quotas: DataFrame       # key, source_size, target, quota, width
    tickets: DataFrame      # key, block, shard
    seed: int
    n_shards: int
    most: int


def lay_out(docs: DataFrame, seed: int = SEED, n_shards: int = N_SHARDS, weights=WEIGHTS, share: float = SHARE,
            most: int = MOST) -> Line:
    """Steps 1 to 4, from one scan of the documents."""
    buckets = stage(_permuted(docs, seed, F.lit(0)).groupBy("key", "src", "bucket").agg(F.sum("size").alias("words")), "mix_buckets")
    targets = stage(source_targets(buckets.groupBy("src").agg(F.sum("words").alias("source_size")), weights, share, most),
                    "mix_targets")
    width = targets.agg(F.greatest(F.lit(1), F.ceil(F.sum("quota") / (n_shards * BLOCKS_PER_SHARD))).cast("long").alias("v"))
    lines = targets.select("*", width.scalar().alias("width"))
    by_key = never_null(F.col("src")).alias("key")
    tickets = stage(split_blocks(lines.select(
        "src", F.ceil(F.col("quota") / F.col("width")).cast("int").alias("n_blocks")), n_shards, seed), "mix_tickets")
    return Line(_places(buckets), lines.select("*", by_key).drop("src"), tickets.select(by_key, "block", "shard"), seed, n_shards, most)


def draws(docs: DataFrame, line: Line, rec: Column | None = None) -> DataFrame:
    """One row per document: rec (by default its columns), key, begin (place in its source's line), size, source_size,
    target, h, pieces (copy, take, shard) drawn by the shards."""
    rows = _permuted(docs, line.seed, nested(docs, "copy", "take", "shard") if rec is None else rec)
    # rows are put in order inside their bucket and meet its place by one shuffle
    inside = Window.partitionBy("key", "bucket").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.drop("src").withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    j = rows.join(line.buckets.join(line.quotas, "key"), ["key", "bucket"]).withColumn("begin", F.col("before") + F.col("ahead"))
    small = line.tickets.count() <= BROADCAST_BLOCKS
    for c in range(line.most):
        begin = F.col("begin") + F.col("source_size") * c
        j = j.withColumn(f"take{c}", _taken(F.col("quota"), begin, F.col("size")))
        j = j.withColumn("block", F.when(F.col(f"take{c}") > 0, F.floor(begin / F.col("width")).cast("int")))
        shards = line.tickets.withColumnRenamed("shard", f"shard{c}")
        j = j.join(F.broadcast(shards) if small else shards, ["key", "block"], "left").drop("block")
    piece = [F.struct(F.lit(c).alias("copy"), F.col(f"take{c}").alias("take"), F.col(f"shard{c}").alias("shard")) for c in range(line.most)]
    return j.select("rec", "key", "begin", "size", "source_size", "target", "h",
                    F.filter(F.array(*piece), lambda p: p["shard"].isNotNull()).alias("pieces"))


def _mixed(docs: DataFrame, line: Line) -> DataFrame:
    """(rec, piece, key, begin) in shards: rec with the text cut to the piece's words."""
    d = draws(docs, line).withColumn("piece", F.explode("pieces"))
    parts = max(1, math.ceil(docs.count() * line.most / line.n_shards / PART_ROWS))
    # a shard is written as parts, each a random share of its rows in random order, so no task holds a whole shard
    d = d.withColumn("place", F.xxhash64(F.lit(line.seed), "piece.copy", "h")).withColumn("part", F.pmod("place", F.lit(parts)))
    d = d.repartition(F.col("piece.shard"), "part").sortWithinPartitions(F.col("piece.shard"), "part", "place")
    cut = F.call_function("regexp_extract", F.col("rec.text"), F.concat(
        F.lit(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){"), F.col("piece.take").cast("string"), F.lit("}+")), F.lit(0))
    text = F.when(F.col("piece.take") < F.col("size"), cut).otherwise(F.col("rec.text"))
    cols = [(text if c == "text" else F.col("rec")[c]).alias(c) for c in d.schema["rec"].dataType.names]
    return d.select(F.struct(*cols).alias("rec"), "piece", "key", "begin")


def mix(docs: DataFrame, seed: int = SEED, n_shards: int = N_SHARDS, **kw) -> DataFrame:
    """The mixed rows: the documents' columns with copy, take (words) and shard, each shard shuffled locally.

    The text of the one document cut at the end of a source's line keeps its first ``take`` words.
    """
    return _mixed(docs, lay_out(docs, seed, n_shards, **kw)).select("rec.*", "piece.copy", "piece.take", "piece.shard")


def mix_digest(docs: DataFrame) -> DataFrame:
    """Contract columns of every document and its copies; ``taken`` counts the words of its rows in the shards."""
    line = lay_out(docs)
    drawn = _mixed(docs, line).groupBy("key", "begin").agg(
        F.sum(word_count(F.col("rec.text"))).alias("taken"), F.count(F.lit(1)).cast("int").alias("copies"))
    own = stage(draws(docs, line, F.col("doc_id")).select(F.col("rec").alias("doc_id"), "size", "source_size", "target", "key", "begin"),
                "mix_places")
    none = {"taken": F.lit(0).cast("long"), "copies": F.lit(0)}
    with_words = own.where("size > 0").join(drawn, ["key", "begin"], "left").fillna(0, ["taken", "copies"])
    return with_words.unionByName(own.where("size = 0").withColumns(none)).drop("key", "begin")
