import math
import random
import re
from collections import Counter

import numpy as np

from affinis.llm import lexical_search as L
from tests.llm.odd import SCHEMA, odd_rows, words, no_docs, odd_docs  # noqa: F401

ITEM = "item_id long, text string"


def brute_terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, items, k=20):
    bags = [(r[0], Counter(brute_terms(r[1]))) for r in rows]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, total = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for t, c in df.items()}
    asked = {}
    for item, text in dict.fromkeys(items):
        if text is not None:
            asked.setdefault(item, Counter()).update(brute_terms(text))
    out = []
    for item, bag in asked.items():
        scored = []
        for doc, b, size in bags:
            m = 75 + 25 * size * n // total
            s = sum(c * w[t] * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t, c in bag.items() if t in b)
            if s > 0:
                scored.append((doc, s))
        scored.sort(key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        out += [(item, r + 1, doc, s) for r, (doc, s) in enumerate(scored[:k])]
    return sorted(out, key=str)


def some_items(rng):
    rows = [(i, words(rng, rng.randint(1, 30))) for i in range(20)]
    return rows + [(1, rows[1][1]), (2, "ka ka ka LO-mi É"), (None, "ka lo"), (50, None), (51, ""), (52, "!?"), (53, "xi po 123")]


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_search_equals_brute_force(spark):
    rng = random.Random(4)
    rows = odd_rows() + [(500 + i, words(rng, rng.choice((3, 40, 300))) + " É12", "aa", "s", 0) for i in range(200)]
    items = some_items(rng)
    docs, asked = spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(items, ITEM)
    want = brute(rows, items)
    assert got(L.search(docs, asked)) == want
    # many small shards, several blocks of items
    assert got(L.search(docs, asked, shard_docs=17, shard_terms=5000, block_terms=100)) == want
    assert got(L.search(docs, asked, k=3)) == brute(rows, items, 3)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = [(1, "ka lo mi"), (2, None)]
    asked = spark.createDataFrame(items, ITEM).withColumn("rank", L.F.lit("x")).withColumn("score", L.F.lit("y"))
    assert got(L.search(odd_docs, asked)) == brute(odd_rows(), items)
    assert L.search(no_docs, asked).collect() == []
    assert L.search(odd_docs, asked.limit(0)).collect() == []
    one = spark.createDataFrame([(5, "only", None, None, None)], SCHEMA)
    assert got(L.search(one, spark.createDataFrame([(1, "only")], ITEM))) == brute([(5, "only")], [(1, "only")])


def test_grid_holds_every_posting_and_its_maxima():
    rng = np.random.default_rng(6)
    for n_terms, n_docs, n in ((1, 1, 1), (1, 40, 30), (300, 5, 400), (200, 300, 5000)):
        cells = np.unique(rng.integers(0, n_terms * n_docs, n))
        term, doc = np.divmod(cells, n_docs)
        impact = rng.integers(1, 1000, len(cells))
        g = L.Grid(term, doc, impact, int(max(n_terms, n_docs) - 1).bit_length())
        assert all(g.top[i] == g.impact[a:b].max() for i, (a, b) in enumerate(zip(g.start, g.stop, strict=True)))
        undivided = g.mask == 0
        assert (g.stop - g.start)[undivided].sum() == len(cells)
        full = np.zeros((n_terms, n_docs), np.int64)
        full[term, doc] = impact
        for _ in range(20):
            rows = rng.choice(n_terms, min(n_terms, 6), replace=False)
            weights = rng.integers(1, 50, len(rows))
            scores = weights @ full[rows]
            want = sorted((s for s in scores.tolist() if s), reverse=True)[:10]
            best = g.best(rows, weights, 10, 0)
            assert sorted((s for s, _ in best), reverse=True)[:10] == want
            assert all(scores[c] == s for s, c in best)
            ties = [c for c, s in enumerate(scores.tolist()) if s and len(want) == 10 and s == want[-1]]
            assert {c for s, c in best if len(want) == 10 and s == want[-1]} == set(ties)


def test_shards_hold_their_numbers_as_bytes(odd_docs):
    """No array columns of a posting an element: their reader keeps two levels per element beside the values."""
    index = L.build_index(odd_docs, *L.totals(odd_docs))
    kinds = dict(index.dtypes)
    assert {kinds[c] for c in ("df", *L.GRID)} == {"binary"}
    r = index.first()
    assert len(r.term) == len(r.doc) == len(r.impact) and len(r.top) == len(r.child) == 4 * len(r.mask)


def test_row_groups_of_the_index_hold_few_shards(spark, monkeypatch):
    """Whoever reads or writes a shard holds its whole row group: that is bounded by size and not by a hundred rows."""
    import pyarrow.parquet as pq
    rng, kept = random.Random(5), []

    def staged(df, name, **options):
        kept.append((name, L_stage(df, name, **options)))
        return kept[-1][1]

    L_stage = L.stage
    monkeypatch.setattr(L, "stage", staged)
    monkeypatch.setitem(L.ROW_GROUP, "parquet.block.size", 64 << 10)
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(1000)), "aa", "s", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    items = [(1, rows[3][1])]
    assert got(L.search(docs, spark.createDataFrame(items, ITEM), shard_docs=1)) == brute(rows, items)
    (file,) = dict(kept)["k2_treaps"].inputFiles()
    m = pq.ParquetFile(file.removeprefix("file:")).metadata
    assert m.num_rows == 30 and m.num_row_groups >= 10
    assert max(m.row_group(i).num_rows for i in range(m.num_row_groups)) <= 3
