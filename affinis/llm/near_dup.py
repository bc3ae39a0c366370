"""Operator 7, SimHash near-dedup: meet-in-the-middle ball hashing.

1. A document's fingerprint: the majority bits of XXH64 (seed 42) over its
   three-word shingles, repeats included.
2. Fingerprints are made distinct first, so a group of copies is one item.
3. Two fingerprints at most ``distance`` bits apart share a point within
   half of it from each.  Every fingerprint emits all variants within that
   radius (65 for distance 2); rows are shuffled on the variant.  A variant
   holds at most 65 distinct fingerprints, so no bucket grows with the data.
4. Members of a bucket are tied to its smallest member (a star, never all
   pairs) and the tied pairs are verified by their bit distance.  For
   distance 2 and radius 1 all members of a bucket are within 2 bits of each
   other, so the stars keep exactly the components of all links.
5. Components by alternating large-star and small-star rounds; every round
   is written to the shared folder.

Cases: null and empty texts, and texts of white space, have fingerprint zero
and are linked like any other; a text of one or two words is one shingle;
repeated rows stay rows; a null doc_id counts as largest, and a component of
null ids alone has a null id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from affinis.llm.common import nested, never_null
from affinis.session import stage

# Fixed values of the contract.
SHINGLE_WORDS = 3
DISTANCE = 2
HASH_SEED = 42
BITS_AT_ONCE = 65536


def simhash(text: bytes, words: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """64-bit fingerprint of a UTF-8 text, unsigned."""
    from xxhash import xxh64_intdigest

    parts = text.lower().split()      # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    begins = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(words, len(parts)) - 1:] - 1)[:n].tolist()
    h = np.fromiter(map(xxh64_intdigest, map(joined.__getitem__, map(slice, begins, stops)), repeat(seed)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BITS_AT_ONCE):
        part = h[i:i + BITS_AT_ONCE].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp, th): fingerprint as a signed long and a hash of the text, one row per document."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((simhash(t.as_py() or b"", words) for t in batch.column(1).cast(pa.binary())),
                             np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "th", "fp"])

    return (docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
            .mapInArrow(run, f"doc_id {id_type}, th long, fp long"))


def _flipped(value, bit):
    """``value`` with one bit flipped; bit -1 flips none."""
    return F.when(bit < 0, value).otherwise(value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit)))


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: stars that connect all distinct fingerprints at most ``distance`` bits apart.

    ``distance`` must be 0 to 2: half of it is one bit at most, and all members of a bucket are linked.
    """
    if not 0 <= distance <= 2:
        raise ValueError("distance must be 0, 1 or 2")
    bits = F.sequence(F.lit(-1), F.lit(63 if distance else -1))
    bit, variant = F.col("bit"), F.col("variant")
    rows = fps.select("fp", F.explode(bits).alias("bit")).select(_flipped(F.col("fp"), bit).alias("variant"), bit.cast("byte").alias("bit"))
    # the flipped bit travels instead of the fingerprint, which the variant gives back behind the shuffle
    rows = rows.repartition("variant").select("variant", _flipped(variant, bit.cast("int")).alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return (rows.withColumn("a", F.min("b").over(Window.partitionBy("variant"))).where("a <> b")
            .select("a", "b").where(near).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots; root is the smallest node of its component."""
    def large_star(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()

    def small_star(e):
        low = e.groupBy("b").agg(F.min("a").alias("m"))
        j = e.join(low, "b")
        return (j.select(F.col("m").alias("a"), F.col("a").alias("b"))
                .unionByName(j.select(F.col("m").alias("a"), "b")).where("a <> b").distinct())

    def mark(e):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "links")
    now = mark(e)
    while now[0]:
        e = stage(small_star(large_star(e)), "star_round")
        before, now = now, mark(e)
        if now == before:
            break
    return e.select(F.col("b").alias("node"), F.col("a").alias("root"))


def clusters(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, root, component_id) from (doc_id, fp): root names the component, component_id is its smallest doc_id."""
    firsts = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(links(firsts.select("fp"), distance))
    f = firsts.join(roots, firsts.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    ids = f.groupBy("root").agg(F.min("first").alias("component_id"))
    return f.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document."""
    prints = stage(fingerprints(docs, words), "simhash")
    return prints.join(clusters(prints, distance), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (null last), of its rows the smallest text hash."""
    prints = stage(fingerprints(docs, words), "simhash")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("th").alias("th")))
    kept = (prints.join(clusters(prints, distance), "fp").groupBy("root").agg(best.alias("k"))
            .select(never_null(F.col("k.id")).alias("rid"), F.col("k.th").alias("rth")))
    rows = docs.select(nested(docs).alias("rec"), never_null(F.col("doc_id")).alias("rid"), F.xxhash64("text").alias("rth"))
    return rows.join(kept, ["rid", "rth"], "left_semi").dropDuplicates(["rid", "rth"]).select("rec.*")
