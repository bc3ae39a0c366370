"""Operator 11, n-gram Jaccard join: adaptive multi-match prefixes.

1. A document's set: 64-bit hashes of its distinct three-word shingles, ascending.  Documents with equal sets are
   one item from here on.
2. Partners of a set of n shingles share at least t = ceil(0.9 n) of them.  In one order for all sets, the first
   n - t + l shingles of two partners therefore share at least l.  The *head* is that prefix in hash order with a
   generous l; its shingles are counted over all heads, which gives their posting lengths.
3. Within the heads the order is rarest first.  A set's prefix is lengthened by e - 1 shingles and then asks for e
   shared shingles before a pair is verified.  Each set takes the e whose estimated cost (postings read, and
   candidates verified) is least.  A pair of sets with different e uses the smaller one, on those parts of both
   prefixes that their two sizes and this e leave (``_in_prefix``), so no link is lost.  A set with too few shared
   shingles in its head has no partner.
4. Candidates meet on prefix shingles.  First each posting list is tied to one pivot of its own, and the verified ties give
   components, so a group of near copies costs in proportion to its members.  Then sets of different components
   that still share a list are paired; a list within one component is left to step 5.  Pairs are kept only where
   sizes and parity bitmaps (a lower bound of the symmetric difference) allow a link, and verified on whole sets.
5. Within the components of the ties every set is compared with every other, block by block inside the tasks: a
   row per set and block with its number of links leaves them, not a row per pair.
6. Components of all verified links; the smallest doc_id names one.

Cases: null, empty and white-space texts have the empty set and are linked with nothing; a text of one or two words
is one shingle; repeated rows are linked (equal sets); a null doc_id counts as largest, and a component of null
ids alone has a null id; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.near_dup import components
from affinis.plans.skew import hot_keys
from affinis.session import stage

# Fixed values of the contract.
SHINGLE_WORDS = 3
PERCENT = 90

#: Longest lengthening of a prefix, and the cost of verifying a candidate in postings read.
MOST_MATCHES = 32
VERIFY_COST = 4
#: Words whose hash a worker remembers.
MEMO = 500_000
PARITY_LONGS = 8
#: Sets of one component in a block, on average; two blocks meet in a task.
BLOCK = 128
#: Shingles that a block's table of sets is wide.
WIDTH = 16_384


class _Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxh64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, words: int, memo: _Words) -> np.ndarray:
    """Ascending distinct 64-bit hashes of the word shingles of a UTF-8 text."""
    parts = text.lower().split()              # bytes: A-Z and ASCII white space only
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    n = len(parts) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = _mixed(out + h[k:k + n])
    return np.unique(out)


def least_shared(n, percent: int):
    """Shingles that a set of ``n`` shares with any partner at least."""
    return (percent * n + 99) // 100


def head_matches(n, percent: int):
    """Shared shingles that the heads of two partners of at least ``n`` shingles have at least."""
    return np.minimum(least_shared(n, percent), n // 16 + 8)


def head_length(n, percent: int):
    return n - least_shared(n, percent) + head_matches(n, percent)


def sets(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT, whole: bool = False) -> DataFrame:
    """(doc_id, th, h1, h2, n, parity, head): one row per document; ``whole`` gives the whole set as head."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh128_digest

        memo = _Words()
        for batch in batches:
            ns, marks, parity, heads, ends = [], [], [], [], [0]
            for t in batch.column(1).cast(pa.binary()):
                s = shingle_set(t.as_py() or b"", words, memo)
                ns.append(len(s))
                marks.append(xxh128_digest(s.tobytes()))
                odd = np.bincount((s & np.uint64(64 * PARITY_LONGS - 1)).astype(np.int64), minlength=64 * PARITY_LONGS) & 1
                parity.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                heads.append(s.view(np.int64) if whole else s[:head_length(len(s), percent)].view(np.int64))
                ends.append(ends[-1] + len(heads[-1]))
            mark = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
            flat = np.concatenate(heads) if heads else np.empty(0, np.int64)
            bits = pa.array(np.concatenate(parity) if parity else np.empty(0, np.int64))
            steps = pa.array(np.arange(len(ns) + 1, dtype=np.int32) * PARITY_LONGS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(mark[:, 0]), pa.array(mark[:, 1]), pa.array(ns, pa.int64()),
                 pa.ListArray.from_arrays(steps, bits),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=["doc_id", "th", "h1", "h2", "n", "parity", "head"])

    return (docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
            .mapInArrow(run, f"doc_id {id_type}, th long, h1 long, h2 long, n long, parity array<long>, head array<long>"))


def prefixes(tokens: DataFrame, percent: int) -> DataFrame:
    """(sid, n, gap, own, matches, token, place): the adaptive prefix of each set from its shared head shingles.

    ``tokens``: (sid, n, shared array of (df, token)).  ``own`` is the number of head shingles that no other head
    has; they come first.  ``place`` counts from 1 with them.  ``gap`` is what the head leaves of the set less.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            starts, flat = lists.offsets.to_numpy(), lists.values
            df_all, token_all = flat.field("df").to_numpy(), flat.field("token").to_numpy()
            out: list[list] = [[], [], [], [], [], [], []]
            for i, (sid, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                df, token = df_all[starts[i]:starts[i + 1]], token_all[starts[i]:starts[i + 1]]
                head = int(head_length(n, percent))
                own = head - len(df)
                need = int(head_matches(least_shared(n, percent), percent))     # what any partner's head shares
                if len(df) < need:
                    continue
                order = np.lexsort((token, df))
                df, token = df[order], token[order]
                e = np.arange(1, min(need, MOST_MATCHES) + 1)
                # the cost of partners of like size, whose prefixes are shorter than those of the smallest partners
                like = np.clip(n - (2 * percent * n) // (100 + percent) - own + e, 0, len(df))
                reads = np.concatenate(([0], np.cumsum(df)))[like]
                best = int(e[np.argmin(reads * (1 + VERIFY_COST / e))])
                size = head - need - own + best
                for column, value in zip(out, (np.full(size, sid), np.full(size, n), np.full(size, n - head), np.full(size, own),
                                               np.full(size, best), token[:size], own + np.arange(1, size + 1)), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, types, strict=True)],
                names=["sid", "n", "gap", "own", "matches", "token", "place"])

    return tokens.select("sid", "n", "shared").mapInArrow(
        run, "sid long, n long, gap long, own long, matches int, token long, place long")


def _pair(a: str, b: str, percent: int) -> Column:
    """Sizes and parity bitmaps allow a link of sets ``a`` and ``b``, and the token is in the prefixes of both."""
    col = lambda side, name: F.col(f"{side}.{name}")
    small, both = F.least(col(a, "n"), col(b, "n")), col(a, "n") + col(b, "n")
    apart = sum((F.bit_count(col(a, "parity")[i].bitwiseXOR(col(b, "parity")[i])) for i in range(PARITY_LONGS)), F.lit(0))
    # the intersection is at most half of what the sizes leave beside the difference
    most = F.floor((both - apart) / 2)
    return ((100 * small >= percent * (both - small)) & _in_prefix(a, b, percent) & _in_prefix(b, a, percent)
            & (100 * most >= percent * (both - most)))


def _in_prefix(a: str, b: str, percent: int) -> Column:
    """The token's place in ``a`` is among the first that hold as many shared shingles as the pair asks for.

    Partners share c = ceil(0.9 (n + m) / 1.9) shingles or more, so their heads share c less the larger gap.  The
    e-th shared one in the order of the heads has all but e of these behind it.
    """
    col = lambda side, name: F.col(f"{side}.{name}")
    shared = F.ceil(percent * (col(a, "n") + col(b, "n")) / (100 + percent))
    heads = shared - F.greatest(col(a, "gap"), col(b, "gap"))
    return col(a, "place") <= col(a, "n") - col(a, "gap") - heads + F.least(col(a, "matches"), col(b, "matches"))


def _enough(met: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b) that share as many prefix shingles as the less demanding prefix of the two asks for."""
    asked = F.least(F.col(f"{a}.matches"), F.col(f"{b}.matches")).alias("asked")
    return (met.select(F.col(f"{a}.sid").alias("a"), F.col(f"{b}.sid").alias("b"), asked)
            .groupBy("a", "b", "asked").agg(F.count(F.lit(1)).alias("found")).where("found >= asked").select("a", "b"))


def star_candidates(postings: DataFrame, percent: int) -> DataFrame:
    """(a, b): each posting list's pivot, one of its sets by a hash of both, with the other sets of the list.

    A set meets as many pivots as it has prefix shingles, so the sets of a large group that are close to many
    others are soon in one component.  The lists of two partners have different pivots: one list is enough here.
    """
    pivots = postings.groupBy("token").agg(
        F.min_by(F.struct("sid", "n", "gap", "place", "matches", "parity"), F.xxhash64("token", "sid")).alias("p"))
    p = pivots.select("token", "p.*").alias("p")
    met = postings.alias("x").join(p, (F.col("x.token") == F.col("p.token")) & (F.col("x.sid") != F.col("p.sid"))
                                   & _pair("x", "p", percent))
    return met.select(F.least("p.sid", "x.sid").alias("a"), F.greatest("p.sid", "x.sid").alias("b")).distinct()


def cross_candidates(postings: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets of different components that share posting lists; ``links_within`` counts inside components."""
    c = comps.select(F.col("node").alias("sid"), F.col("root").alias("comp"))
    named = postings.join(c, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    named = stage(named, "named_postings")
    mixed = named.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
    left = stage(named.join(mixed, "token", "left_semi"), "mixed_postings")
    met = left.alias("x").join(left.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.sid") < F.col("y.sid"))
                               & (F.col("x.comp") != F.col("y.comp")) & _pair("x", "y", percent))
    return _enough(met, "x", "y")


def verified(pairs: DataFrame, items: DataFrame, docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) of ``pairs`` whose whole sets, made anew from the texts, reach the similarity; and those sets (sid, s)."""
    # written first: its size is known then, and texts are only shuffled where the list of their hashes is large
    needed = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    needed = stage(needed.join(items.select("sid", "h1", "h2", "th"), "sid"), "needed_sets")
    texts = (docs.select("text").withColumn("th", F.xxhash64("text"))
             .join(needed.select("th").distinct(), "th", "left_semi").distinct())
    full = sets(texts.select(F.col("th").alias("doc_id"), "text"), words, percent, whole=True).select("h1", "h2", F.col("head").alias("s"))
    full = stage(full.join(needed, ["h1", "h2"]).dropDuplicates(["sid"]).select("sid", "s"), "whole_sets")
    j = (pairs.join(full.select(F.col("sid").alias("a"), F.col("s").alias("sa")), "a")
         .join(full.select(F.col("sid").alias("b"), F.col("s").alias("sb")), "b"))
    shared = F.size(F.array_intersect("sa", "sb"))
    j = j.select("a", "b", shared.alias("i"), (F.size("sa") + F.size("sb")).alias("both"))
    return j.where(100 * F.col("i") >= percent * (F.col("both") - F.col("i"))).select("a", "b"), full


def _linked(found: list[np.ndarray], side: np.ndarray, apart: bool, percent: int) -> np.ndarray:
    """How many of the sets ``found`` each of them is linked to; ``apart``: only to those of another side."""
    n = np.array([len(s) for s in found], np.int64)
    known, column = np.unique(np.concatenate(found), return_inverse=True)
    row = np.repeat(np.arange(len(n)), n)
    shared = np.zeros((len(n), len(n)), np.int64)
    for start in range(0, len(known), WIDTH):
        here = (column >= start) & (column < start + WIDTH)
        has = np.zeros((len(n), min(WIDTH, len(known) - start)), np.float32)       # sums of at most WIDTH ones are exact
        has[row[here], column[here] - start] = 1
        shared += (has @ has.T).astype(np.int64)
    linked = 100 * shared >= percent * (n[:, None] + n[None, :] - shared)
    np.fill_diagonal(linked, False)
    if apart:
        linked &= side[:, None] != side[None, :]
    return linked.sum(1)


def links_within(full: DataFrame, comps: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """(sid, n_links): the links of each set to the others of its component, a row per block that it was compared with.

    ``full``: (sid, s), the whole sets; ``comps``: (node, root) as ``components`` gives it.  A component is dealt
    into blocks of about ``block`` sets, and every two blocks meet in one group, so a task holds two blocks at a
    time however large the component.
    """
    nodes = comps.select(F.col("node").alias("sid"), "root").unionByName(comps.select(F.col("root").alias("sid"), "root").distinct())
    hot = hot_keys(nodes, ["root"], block)          # at most a row for every ``block`` sets
    blocks = F.coalesce("salts", F.lit(1))
    members = (full.join(nodes, "sid").join(F.broadcast(hot), "root", "left")
               .select("root", "sid", "s", F.pmod(F.xxhash64("sid"), blocks).cast("int").alias("own"), blocks.alias("blocks")))
    met = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("root", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "sid", "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> pa.RecordBatch:
            n = _linked(found, np.array(own), key[1] != key[2], percent)
            return pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(n, pa.int64())], names=["sid", "n_links"])

        key, own, sid, found = None, [], [], []
        for batch in batches:
            done = []
            keys = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            starts, flat = batch.column(5).offsets.to_numpy(), batch.column(5).values.to_numpy()
            for i, (k, o, x) in enumerate(zip(keys, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                if k != key:
                    if key:
                        done.append(made())
                    key, own, sid, found = k, [], [], []
                own.append(o)
                sid.append(x)
                found.append(flat[starts[i]:starts[i + 1]])
            found = [s.copy() for s in found]       # a group that goes on does not keep its batches
            yield from pa.Table.from_batches(done).combine_chunks().to_batches() if done else ()
        if key:
            yield made()

    group = ["root", "lo", "hi"]
    return met.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, "sid long, n_links long")


def links(items: DataFrame, docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT,
          block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(sid, n_links) of the distinct sets that have links, and (node, root) of the components these make.

    ``items``: (sid, h1, h2, n, th, parity, head), one row per distinct set.
    """
    tokens = items.where("n > 0").select("sid", "n", F.explode("head").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = tokens.join(counts, "token").groupBy("sid", "n").agg(F.collect_list(F.struct("df", "token")).alias("shared"))
    postings = prefixes(shared, percent).join(items.select("sid", "parity"), "sid")
    postings = stage(postings, "postings")
    near, full = verified(stage(star_candidates(postings, percent), "star_pairs"), items, docs, words, percent)
    near = stage(near, "star_links")
    comps = stage(components(near), "star_components")
    more, _ = verified(stage(cross_candidates(postings, comps, percent), "cross_pairs"), items, docs, words, percent)
    more = stage(more, "cross_links")
    counts = links_within(full, comps, percent, block)
    for side in ("a", "b"):
        counts = counts.unionByName(more.select(F.col(side).alias("sid"), F.lit(1).cast("long").alias("n_links")))
    return counts.groupBy("sid").agg(F.sum("n_links").alias("n_links")), components(near.unionByName(more))


def jaccard_components(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links), one row per document.

    n_links counts the document's links to other distinct sets, by which copies of one set count once.
    """
    rows = stage(sets(docs, words, percent), "shingle_sets")
    items = rows.where("n > 0").groupBy("h1", "h2").agg(
        F.first("n").alias("n"), F.first("th").alias("th"), F.min("doc_id").alias("first_id"),
        F.first("parity").alias("parity"), F.first("head").alias("head"))
    items = stage(items.withColumn("sid", F.monotonically_increasing_id()), "distinct_sets")
    degree, comps = links(items, docs, words, percent, block)
    named = (items.select("h1", "h2", "sid", "first_id").join(comps, F.col("sid") == F.col("node"), "left")
             .withColumn("root", F.coalesce("root", "sid")).join(degree, "sid", "left"))
    named = stage(named.select("h1", "h2", "root", "first_id", F.coalesce("n_links", F.lit(0)).alias("n_links")), "set_components")
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(ids, "root").select("h1", "h2", "component_id", "n_links")
    own = rows.select("doc_id", "n", "h1", "h2")
    return (own.where("n > 0").join(named, ["h1", "h2"])
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
            .unionByName(own.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                                   F.lit(0).cast("long").alias("n_links"))))
