"""Operator 13, ranked lexical search: K2-treaps over the term-document grid.

1. Corpus totals N and L are one aggregate over all documents.
2. ``build_index``: every task turns its documents into shards.  A shard is a grid of terms (rows, most frequent
   first) and documents (columns, by length) and a quadtree over it: a cell knows its non-empty quadrants (four
   bits) and the largest impact below it.  Cells of at most ``BUCKET`` postings are not divided further, so the
   tree is a fraction of its postings.  The impact of a posting is the contract's, without the term's weight.
3. A term's df is the sum of its row lengths over all shards; the weights follow.
4. ``search``: for each item and shard, the rows of its terms descend the tree together over document ranges.  The
   bound of a range is the sum of weight times cell maximum; the ranges of the highest bound are divided first, in
   waves, and ranges below the 20th best score so far are dropped.  At a single document the bound is the score.
5. The best of each shard are ranked per item.

Queries are taken in blocks of bounded size, each against all shards; a shard is read once per block.

Cases: null, empty and term-less texts are in no count and no result; repeated rows are documents of their own; of
equal scores the smaller doc_id wins, null last; the rows of one item_id are one item (equal rows once, terms of
different texts added up), also for a null item_id; an item without terms has no rows; other columns are ignored;
empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from affinis.session import stage

# Fixed values of the contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 20

SHARD_DOCS = 1024
SHARD_TERMS = 250_000     # terms with repeats, beyond which a shard takes no further document
BATCH_DOCS = 256          # texts that are on their way to a Python worker at a time
#: Parquet options of the index: row groups of a few shards.  A row is a shard of some MB; its writer and its readers hold a whole
#: row group at a time, and by default look at its size only after 100 rows.  Statistics would hold two shards a row group until the end.
ROW_GROUP = {"parquet.block.size": 4 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1,
             "parquet.column.statistics.enabled": False, "parquet.enable.dictionary": False}
BUCKET = 8
WAVE = 256
#: Terms with repeats in one block of items.
BLOCK_TERMS = 200_000

#: UTF-8 bytes to term bytes: separators become a space, A-Z a-z.
_BYTES = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b
               for b in range(256))
_ONES = np.array([x.bit_count() for x in range(16)], np.int64)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


def totals(docs: DataFrame) -> tuple[int, int]:
    """N, L: documents with a term, and their terms with repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = np.fromiter((len(terms(t.as_py() or b"")) for t in b.column(0).cast(pa.binary())), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], names=["docs", "terms"])

    r = docs.select("text").mapInArrow(run, "docs long, terms long").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    return r.docs or 0, r.terms or 0


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers, apart by one."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Grid:
    """Postings in Z-order, and the quadtree's cells from the root down, children of a cell side by side."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, height: int):
        code = (_spread(term) << np.uint64(1)) | _spread(doc)
        order = np.argsort(code, kind="stable")
        self.term, self.doc, self.impact, self.height = term[order], doc[order], impact[order], height
        self._cells(code[order])

    def _cells(self, code: np.ndarray) -> None:
        start, stop = np.zeros(1, np.int64), np.array([len(code)], np.int64)
        levels = []
        for level in range(self.height, -1, -1):
            # undivided cells of higher levels lie between the cells of this one
            top = np.maximum.reduceat(np.append(self.impact, 0), np.stack((start, stop), 1).ravel())[::2]
            split = (stop - start > BUCKET) if level else np.zeros(len(start), bool)
            mask = np.zeros(len(start), np.uint8)
            quadrant = (code >> np.uint64(2 * max(level - 1, 0))) & np.uint64(3)
            # of each divided cell the first posting of every quadrant; in Z-order the quadrants follow each other
            cuts = [np.where(split, start, stop)]
            for q in range(4):
                cuts.append(_first_at_least(quadrant, q + 1, cuts[-1], stop))
            begin, end = np.stack(cuts[:4], 1), np.stack(cuts[1:], 1)
            there = (end > begin) & split[:, None]
            mask[:] = (there << np.arange(4)).sum(1)
            levels.append((mask, top, start, stop))
            start, stop = begin[there], end[there]
            if not len(start):
                break
        sizes = np.cumsum([0] + [len(x[0]) for x in levels])
        self.mask = np.concatenate([x[0] for x in levels])
        self.top, self.start, self.stop = (np.concatenate([x[i] for x in levels]) for i in (1, 2, 3))
        self.child = np.concatenate([sizes[i + 1] + np.concatenate(([0], np.cumsum(_ONES[x[0]])))[:-1] for i, x in enumerate(levels)])

    @classmethod
    def stored(cls, term, doc, impact, height, mask, top, start, stop, child) -> Grid:
        g = cls.__new__(cls)
        g.term, g.doc, g.impact, g.height, g.mask, g.top, g.start, g.stop, g.child = term, doc, impact, height, mask, top, start, stop, child
        return g

    def down(self, node: np.ndarray, row: np.ndarray, ranges: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells and maxima of ``row`` in document ``ranges`` of ``level``, from the cells one level above (-1: none)."""
        quadrant = 2 * ((row >> level) & 1)[None, :] + (ranges & 1)[:, None]
        mask = np.where(node >= 0, self.mask[node], 0)
        below = np.where((mask >> quadrant) & 1, self.child[node] + _ONES[mask & ((1 << quadrant) - 1)], -1)
        top = np.where(below >= 0, self.top[below], 0)
        i, j = np.nonzero((node >= 0) & (mask == 0))        # undivided: its few postings are looked through
        if len(i):
            at = self.start[node[i, j]][:, None] + np.arange(BUCKET)
            here = at < self.stop[node[i, j]][:, None]
            at = np.where(here, at, 0)
            here &= (self.term[at] == row[j][:, None]) & (self.doc[at] >> level == ranges[i][:, None])
            top[i, j] = np.where(here, self.impact[at], 0).max(1)
            below[i, j] = np.where(here.any(1), node[i, j], -1)
        return below, top

    def best(self, row: np.ndarray, weight: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """(score, column) of the ``k`` best documents and all ties of the last, none below ``floor``."""
        found: list[tuple[int, int]] = []
        if not len(row):
            return found
        # open ranges by level: (bounds, ranges, cells of each row)
        open_: dict[int, list] = {self.height: [np.array([1 << 62]), np.zeros(1, np.int64), np.zeros((1, len(row)), np.int64)]}
        while open_:
            level = max(open_, key=lambda x: (open_[x][0].max(), -x))
            bounds, ranges, node = open_.pop(level)
            if len(bounds) > WAVE:
                first = np.argpartition(-bounds, WAVE)
                open_[level] = [x[first[WAVE:]] for x in (bounds, ranges, node)]
                ranges, node = ranges[first[:WAVE]], node[first[:WAVE]]
            ranges = np.repeat(2 * ranges, 2) + np.tile((0, 1), len(ranges)) if level else ranges
            node = np.repeat(node, 2, 0) if level else node
            if not level:       # a grid of one document
                below, top = node, np.where((self.term[None, :] == row[:, None]), self.impact, 0).max(1)[None, :]
            else:
                below, top = self.down(node, row, ranges, level - 1)
            bounds = top @ weight
            kept = (bounds > 0) & (bounds >= floor)
            bounds, ranges, below = bounds[kept], ranges[kept], below[kept]
            if not len(bounds):
                continue
            if level <= 1:
                found += zip(bounds.tolist(), ranges.tolist(), strict=True)
                found.sort(key=lambda x: -x[0])
                if len(found) >= k:
                    floor = max(floor, found[k - 1][0])
                    found = [x for x in found if x[0] >= floor]
                    open_ = {at: [y[x[0] >= floor] for y in x] for at, x in open_.items() if (x[0] >= floor).any()}
            elif level - 1 in open_:
                open_[level - 1] = [np.concatenate(x) for x in zip(open_[level - 1], (bounds, ranges, below), strict=True)]
            else:
                open_[level - 1] = [bounds, ranges, below]
        return found


def _first_at_least(quadrant: np.ndarray, q: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each [start, stop) of ascending quadrants, the first place with one of at least ``q``."""
    low, high = start.copy(), stop.copy()
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        less = open_ & (quadrant[np.minimum(mid, len(quadrant) - 1)] < q)
        low = np.where(less, mid + 1, low)
        high = np.where(open_ & ~less, mid, high)
    return low


def build_index(docs: DataFrame, n_docs: int, n_terms: int, shard_docs: int = SHARD_DOCS, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """One row per shard: its documents, its terms with their df, and its grid."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, vocabulary, filled = [], [], {}, 0
        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1).cast(pa.binary()), strict=True):
                words = terms(text.as_py() or b"")
                if not words:
                    continue
                ids.append(doc_id)
                rows.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), np.int64, len(words)))
                filled += len(words)
                if len(ids) >= shard_docs or filled >= shard_terms:
                    yield made(ids, rows, vocabulary)
                    ids, rows, vocabulary, filled = [], [], {}, 0
        if ids:
            yield made(ids, rows, vocabulary)

    def made(ids: list, rows: list[np.ndarray], vocabulary: dict[bytes, int]) -> pa.RecordBatch:
        n = np.array([len(r) for r in rows], np.int64)
        column = np.empty(len(n), np.int64)
        by_length = np.argsort(n, kind="stable")
        column[by_length] = np.arange(len(n))
        cell = np.sort(np.concatenate(rows) * len(n) + np.repeat(column, n))
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        tf = np.diff(np.append(first, len(cell)))
        term, doc = np.divmod(cell[first], len(n))
        df = np.bincount(term, minlength=len(vocabulary))
        place = np.empty(len(df), np.int64)
        by_df = np.argsort(-df, kind="stable")
        place[by_df] = np.arange(len(df))
        m = 75 + (25 * n[by_length] * n_docs) // n_terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
        g = Grid(place[term], doc, impact, int(max(len(df), len(n)) - 1).bit_length())
        names = np.array(list(vocabulary), dtype=object)[by_df]
        out = {"doc_ids": pa.array([[ids[i].as_py() for i in by_length]], pa.list_(ids[0].type)),
               "terms": pa.array([b" ".join(names)], pa.binary()), "df": _stored(df[by_df]), "height": pa.array([g.height], pa.int32())}
        return pa.RecordBatch.from_pydict(out | {c: _stored(getattr(g, c), kind) for c, kind in GRID.items()})

    grid = ", ".join(f"{c} binary" for c in GRID)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_ids array<{id_type}>, terms binary, df binary, height int, {grid}")


#: A grid's numbers as they are stored: bytes, of which an executor holds one copy; a reader of arrays keeps levels beside them.
GRID = {"term": "<i4", "doc": "<i4", "impact": "<i4", "mask": "u1", "top": "<i4", "start": "<i4", "stop": "<i4", "child": "<i4"}


def _stored(values: np.ndarray, kind: str = "<i4") -> pa.Array:
    return pa.array([values.astype(kind).tobytes()], pa.binary())


def _numbers(column: pa.Array, i: int, kind: str = "<i4") -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), kind)


@contextmanager
def _rows_a_batch(spark, rows: int) -> Iterator[None]:
    """A Python worker gets ``rows`` rows at a time, however many its task has; the buffers stay small."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def dfs(index: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """df of each of ``words`` over all shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for i in range(b.num_rows):
                n = _numbers(b.column(1), i).tolist()
                for k, t in enumerate(b.column(0)[i].as_py().split(b" ")):
                    if t in words:
                        found[t] += n[k]
        yield pa.RecordBatch.from_pydict({"term": pa.array(found.keys(), pa.binary()), "df": pa.array(found.values(), pa.int64())})

    rows = index.select("terms", "df").mapInArrow(run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    with _rows_a_batch(index.sparkSession, 1):
        return {bytes(r.term): r.df for r in rows.collect()}


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search_block(index: DataFrame, items: list[Counter], n_docs: int, k: int = TOP) -> DataFrame:
    """(item, doc_id, score): for each item (a bag of terms, named by its place) and shard the best documents.

    ``items`` is one block: its size is bounded by the caller.
    """
    df = dfs(index, {t for bag in items for t in bag})
    weights = {t: weight(n, n_docs) for t, n in df.items()}
    id_type = index.schema["doc_ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores: list[list[int]] = [[] for _ in items]       # the k best of this task's shards so far
        for b in batches:
            for i in range(b.num_rows):
                g = Grid.stored(**{c: _numbers(b.column(c), i, kind) for c, kind in GRID.items()}, height=b.column("height")[i].as_py())
                row_of = {t: r for r, t in enumerate(b.column("terms")[i].as_py().split(b" ")) if t in weights}
                ids = b.column("doc_ids")[i].values
                hits: list[tuple] = []
                for item, bag in enumerate(items):
                    rows = [(row_of[t], weights[t] * n) for t, n in bag.items() if t in row_of and weights[t]]
                    floor = scores[item][-1] if len(scores[item]) == k else 0
                    best = g.best(np.array([r for r, _ in rows], np.int64), np.array([w for _, w in rows], np.int64), k, floor)
                    named = sorted(((s, ids[c].as_py()) for s, c in best), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
                    scores[item] = sorted(scores[item] + [s for s, _ in named], reverse=True)[:k]
                    hits += ((item, doc_id, s) for s, doc_id in named)
                if hits:
                    item, doc, score = zip(*hits, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, b.schema.field("doc_ids").type.value_type),
                                                      pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, f"item int, doc_id {id_type.simpleString()}, score long")


def blocks(items: DataFrame, most: int = BLOCK_TERMS) -> Iterator[list[tuple]]:
    """(item_id, bag of terms) in blocks of about ``most`` terms; one block at a time is on the driver."""
    texts = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    n = texts.agg(F.sum(F.regexp_count("text", F.lit(TERM)))).first()[0] or 0
    parts = -(-n // most)
    for p in range(parts):
        bags: dict = {}
        for r in texts.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == p).collect():
            bags.setdefault(r.item_id, Counter()).update(terms(r.text.encode()))
        yield [(i, bag) for i, bag in bags.items() if bag]


def search(docs: DataFrame, items: DataFrame, k: int = TOP, shard_docs: int = SHARD_DOCS, shard_terms: int = SHARD_TERMS,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    with _rows_a_batch(spark, BATCH_DOCS):
        n_docs, n_terms = totals(docs)
    id_type, item_type = (t.schema[c].dataType.simpleString() for t, c in ((docs, "doc_id"), (items, "item_id")))
    best = spark.createDataFrame([], f"item_id {item_type}, doc_id {id_type}, score long")
    if n_docs:
        with _rows_a_batch(spark, BATCH_DOCS):
            index = stage(build_index(docs, n_docs, n_terms, shard_docs, shard_terms), "k2_treaps", **ROW_GROUP)
        for block in blocks(items, block_terms):
            names = spark.createDataFrame([(p, i) for p, (i, _) in enumerate(block)], f"item int, item_id {item_type}")
            hits = search_block(index, [bag for _, bag in block], n_docs, k)
            with _rows_a_batch(spark, 1):
                hits = stage(hits.join(F.broadcast(names), "item").select("item_id", "doc_id", "score"), "hits")
            best = best.unionByName(hits)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
