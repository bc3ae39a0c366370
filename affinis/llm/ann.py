"""Operator 10, approximate nearest neighbours: vantage-point trees per shard.

Index: vectors are dealt by a hash of their id to shards of bounded size; one
task builds one shard's vantage-point tree and writes it as a row.  Largest
inner product becomes smallest distance by one added coordinate that gives
all of a shard's vectors the same norm, so the triangle inequality holds.

Search: the trees stay where they are written.  Queries go to them in passes
of bounded size; each task of a pass walks its share of the trees, one at a
time, and carries every query's k nearest from tree to tree, so that a later
tree begins with a small radius.  A block of queries goes down a tree
together; a subtree is skipped for a query when its ball or shell lies
further than ``factor`` times the distance of the query's k-th nearest so
far, and a whole tree when no vector of its largest norm could be nearer.
Factor one is exact; a smaller factor prunes more and may miss some.  The
candidates are scored exactly (double precision, components in order).
The vectors are shuffled once, to their shards; a pass shuffles k rows per
query and task, and the number of tasks follows the cluster and not the rows.

A vector found many times in a shard is kept under its k + 1 smallest ids:
no query can return more of them, as ties go to the smaller id, so the
result stays exact whatever the size of a group of copies.

Cases: vectors that are null, empty, zero or hold a null or non-finite
component, and rows without an id, take no part; equal rows (id and vector)
are one; a query never returns rows of its own id; only vectors of the
query's length are compared; an empty table gives no rows; fewer candidates
than k are all returned; other columns are not read.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from affinis.llm.common import one_row_a_batch
from affinis.session import scratch_path, stage

# Fixed values of the contract.
K = 20
QUERY_EVERY = 20

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
PASS_BYTES = 32 << 20     # queries of one pass, with their nearest so far
LEAF_ROWS = 256
FACTOR = 1.0
SEED = 42


def usable(vec: Column) -> Column:
    """Whether a vector takes part."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(vec, lambda x: x != 0), F.lit(False))


def _blob(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _arrays(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob), allow_pickle=False) as f:
        return {k: f[k] for k in f.files}


def build_tree(ids: np.ndarray, vecs: np.ndarray, keep: int, leaf_rows: int = LEAF_ROWS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Arrays of a tree: vectors in leaf order, and per node its vantage point, children, and their distance ranges."""
    order = np.argsort(ids, kind="stable")
    ids, vecs = ids[order], np.ascontiguousarray(vecs[order], np.float64)
    _, group = np.unique(vecs, axis=0, return_inverse=True)
    by_group = np.argsort(group.ravel(), kind="stable")
    sizes = np.bincount(group.ravel())
    rank = np.empty(len(ids), np.int64)
    rank[by_group] = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ids, vecs = ids[rank < keep], vecs[rank < keep]
    norms = (vecs ** 2).sum(axis=1)
    top = norms.max()
    raised = np.column_stack([vecs, np.sqrt(np.maximum(top - norms, 0))])
    rng = np.random.default_rng(seed)
    nodes: list[list[float]] = []          # first, last, inner child, outer child, split, ranges of inner and outer
    points: list[np.ndarray] = []
    perm = np.arange(len(ids))

    def grow(first: int, last: int) -> int:
        me = len(nodes)
        nodes.append([first, last, -1, -1, 0, 0, 0, 0, 0])
        own = perm[first:last]
        point = raised[own[rng.integers(len(own))]]
        points.append(point)
        if last - first <= leaf_rows:
            return me
        d = np.sqrt(((raised[own] - point) ** 2).sum(axis=1))
        half = len(own) // 2
        by_d = np.argsort(d, kind="stable")
        perm[first:last] = own[by_d]
        d = d[by_d]
        if d[0] == d[-1]:                  # all equally far: no ball separates them
            return me
        inner, outer = grow(first, first + half), grow(first + half, last)
        nodes[me][2:] = [inner, outer, d[half - 1], d[0], d[half - 1], d[half], d[-1]]
        return me

    grow(0, len(ids))
    return {"ids": ids[perm], "vecs": vecs[perm], "nodes": np.array(nodes, np.float64), "points": np.array(points),
            "top": np.array(top)}


def search(tree: dict[str, np.ndarray], qids: np.ndarray, q: np.ndarray, k: int = K,
           factor: float = FACTOR, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, vec id, score) of each query's k nearest in the tree, and the number of products computed.

    ``floor`` holds each query's k best scores found elsewhere, ascending (-inf: none); what is worse is left out.
    """
    ids, vecs, nodes, points, top = (tree[n] for n in ("ids", "vecs", "nodes", "points", "top"))
    q = np.ascontiguousarray(q, np.float64)
    qq = (q ** 2).sum(axis=1)
    scale = np.sqrt(qq * float(top)) + 1e-300
    slack = 1e-10 * scale                               # rounding of the matrix product
    best = np.full((len(q), k), -np.inf) if floor is None else floor.copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    work = 0

    def radius(rows):
        reach = np.sqrt(np.maximum(qq[rows] + top - 2 * best[rows, 0], 0))
        return factor * reach + 1e-6 * np.sqrt(qq[rows] + top)

    def visit(node: int, rows: np.ndarray) -> None:
        nonlocal work
        if not len(rows):
            return
        first, last, inner, outer, split, in_lo, in_hi, out_lo, out_hi = nodes[node]
        first, last, inner, outer = int(first), int(last), int(inner), int(outer)
        if inner < 0:
            for at in range(first, last, 4 * LEAF_ROWS):
                span = slice(at, min(at + 4 * LEAF_ROWS, last))
                near = q[rows] @ vecs[span].T
                work += near.size
                near[ids[span][None, :] == qids[rows][:, None]] = -np.inf
                both = np.concatenate([best[rows], near], axis=1)
                best[rows] = np.sort(np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)
                r, c = np.nonzero((near >= (best[rows, 0] - slack[rows])[:, None]) & (near > -np.inf))
                found.append((rows[r], c + at, near[r, c]))
            return
        d = np.sqrt(np.maximum(qq[rows] + top - 2 * (q[rows] @ points[node][:-1]), 0))
        work += len(rows)
        inside = d <= split
        visit(inner, rows[inside])
        visit(outer, rows[~inside])
        gap_out, gap_in = np.maximum(out_lo - d, d - out_hi), np.maximum(in_lo - d, d - in_hi)
        reach = radius(rows)
        visit(outer, rows[inside & (gap_out <= reach)])
        visit(inner, rows[~inside & (gap_in <= reach)])

    # no product exceeds the norms' product
    visit(0, np.flatnonzero(best[:, 0] <= scale + slack))
    if not found:
        return np.empty(0, np.int64), ids[:0], np.empty(0), work
    row, col, near = (np.concatenate(x) for x in zip(*found))
    ok = near >= best[row, 0] - slack[row]
    row, col = row[ok], col[ok]
    score = np.zeros(len(row))
    for j in range(q.shape[1]):
        score += q[row, j] * vecs[col, j]
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    return row[place < k], ids[col[place < k]], score[place < k], work


def _keyed(vectors: DataFrame) -> DataFrame:
    v = F.col("embedding")
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding"))
            .where(F.col("vec_id").isNotNull() & usable(v)).withColumn("dim", F.size("embedding")))


def index(vectors: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """((dim, shard, tree), number of shards): one row per shard, written to the shared folder."""
    n = max(1, math.ceil(vectors.count() / shard_rows))

    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = build_tree(pdf["vec_id"].to_numpy(), np.stack(pdf["embedding"].to_list()), k + 1)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "tree": [_blob(**tree)]})

    rows = _keyed(vectors).distinct().withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n)).cast("int"))
    return stage(rows.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, tree binary"), "vp_trees"), n


class Nearest:
    """The k nearest so far of one block of queries."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray, k: int):
        self.ids, self.vecs, self.k = ids, vecs, k
        self.row, self.vec_id, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def floor(self) -> np.ndarray:
        """The scores so far, ascending; -inf where fewer than k were found."""
        out = np.full((len(self.ids), self.k), -np.inf)
        place = np.arange(len(self.row)) - np.searchsorted(self.row, self.row, side="left")
        out[self.row, self.k - 1 - place] = self.score
        return out

    def walk(self, tree: dict[str, np.ndarray], factor: float) -> None:
        row, ids, score, _ = search(tree, self.ids, self.vecs, self.k, factor, self.floor())
        row, ids, score = (np.concatenate(x) for x in ((self.row, row), (self.vec_id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        first = np.arange(len(row)) - np.searchsorted(row, row, side="left") < self.k
        self.row, self.vec_id, self.score = row[first], ids[first], score[first]


def _blocks(rows: pa.Table, block_rows: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, ids, vectors) of at most ``block_rows`` queries of one length each."""
    ids, vecs = rows.column("vec_id").to_numpy(), rows.column("embedding").combine_chunks()
    dims = rows.column("dim").to_numpy()
    out = []
    for dim in np.unique(dims):
        own = np.flatnonzero(dims == dim)
        flat = vecs.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
        out += [(int(dim), ids[own[i:i + block_rows]], flat[i:i + block_rows]) for i in range(0, len(own), block_rows)]
    return out


def search_pass(trees: DataFrame, blocks: list[tuple[int, np.ndarray, np.ndarray]], k: int, factor: float) -> DataFrame:
    """(query_id, vec_id, score): for each query of a pass and each task the k nearest in the task's trees."""
    shared = trees.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = [(dim, Nearest(ids, vecs, k)) for dim, ids, vecs in shared.value]
        for batch in batches:
            for dim, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                tree = _arrays(blob.as_py())
                for of, block in so_far:
                    if of == dim:
                        block.walk(tree, factor)
        for _, x in so_far:
            yield pa.RecordBatch.from_arrays([pa.array(x.ids[x.row], pa.int64()), pa.array(x.vec_id, pa.int64()), pa.array(x.score)],
                                             names=["query_id", "vec_id", "score"])

    return trees.select("dim", "tree").mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR, shard_rows: int = SHARD_ROWS,
            block_rows: int = BLOCK_ROWS, pass_bytes: int = PASS_BYTES, tasks: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` nearest to each row of ``queries``.

    A pass holds queries of about ``pass_bytes``; one pass at a time is on the driver.  ``tasks`` (default: two a core)
    share the trees.
    """
    spark = vectors.sparkSession
    trees, _ = index(vectors, k, shard_rows)
    trees = trees.coalesce(tasks or 2 * spark.sparkContext.defaultParallelism)
    asked = stage(_keyed(queries).distinct(), "queries")
    # a query's vector, and its k nearest so far: id, score and place, twice while they are merged
    size = asked.agg(F.sum(F.col("dim") * 8 + 48 * k)).first()[0] or 0
    passes = -(-size // pass_bytes)
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    first = lambda hits: hits.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    if passes:
        schema, path = found.schema, scratch_path(spark, "nearest")
        for p in range(passes):
            rows = asked.where(F.pmod(F.xxhash64(F.lit(1), "vec_id", "embedding"), F.lit(passes)) == p).toArrow()
            hits = first(search_pass(trees, _blocks(rows, block_rows), k, factor)).drop("rank")
            with one_row_a_batch(spark):
                hits.write.parquet(f"{path}/pass={p}")
        found = spark.read.schema(schema).parquet(path).select(schema.names)
    return first(found).select("query_id", "rank", "vec_id", "score")


def nearest_embeddings(vectors: DataFrame) -> DataFrame:
    """The contract's queries (every ``QUERY_EVERY``-th id) against all rows."""
    return nearest(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))
