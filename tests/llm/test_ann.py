import math

import numpy as np

from affinis.llm import ann as A

SCHEMA = "vec_id long, embedding array<float>, label int, rank string"


def brute(rows, k=20):
    ok = {(r[0], tuple(r[1])) for r in rows if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])}
    out = {}
    for i, q in ok:
        if i % 20:
            continue
        scored = []
        for j, v in ok:
            if j != i and len(v) == len(q):
                s = 0.0
                for a, b in zip(q, v):
                    s += float(np.float32(a)) * float(np.float32(b))
                scored.append((-s, j))
        out[i] = [(j, -s) for s, j in sorted(scored)[:k]]
    return out


def vectors(n=500, d=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, d))
    x = (centres[rng.integers(8, size=n)] + 0.4 * rng.normal(size=(n, d))).astype(np.float32)
    return [(i, [float(v) for v in x[i]], 0, "x") for i in range(n)]


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    for r in A.nearest(df, df.where("vec_id % 20 = 0"), **kw).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows)
    assert {q: [(i + 1, j, s) for i, (j, s) in enumerate(x)] for q, x in want.items() if x} == {q: sorted(x) for q, x in got.items()}


def test_factor_one_is_exact_over_shards_and_blocks(spark):
    check(spark, vectors(), shard_rows=150, block_rows=10)


def test_many_passes_and_trees_in_one_task_equal_brute_force(spark):
    check(spark, vectors(700, 6, 5), shard_rows=60, block_rows=7, pass_bytes=6000, tasks=2)
    check(spark, vectors(300, 6, 7), shard_rows=10, tasks=1)                 # trees smaller than k


def test_nearest_so_far_is_carried_and_prunes_later_trees():
    rows = vectors(3000, 8, 9)
    x = np.array([r[1] for r in rows], np.float64)
    x[2000:] *= 1e-3                                                         # a tree that cannot hold a nearer vector
    trees = [A.build_tree(np.arange(a, a + 1000), x[a:a + 1000], 6, leaf_rows=64) for a in (0, 1000, 2000)]
    q = np.arange(0, 2000, 20)
    far = (x[q] @ x[:2000].T).max(axis=1) > 0.1
    q = q[far]
    block = A.Nearest(q, x[q], 5)
    for tree in trees[:2]:
        block.walk(tree, 1.0)
    _, _, _, cold = A.search(trees[1], q, x[q], 5)
    first = A.Nearest(q, x[q], 5)
    first.walk(trees[0], 1.0)
    _, _, _, warm = A.search(trees[1], q, x[q], 5, floor=first.floor())
    assert warm < cold
    row, ids, _, work = A.search(trees[2], q, x[q], 5, floor=block.floor())
    assert len(row) == 0 and work == 0
    whole = A.build_tree(np.arange(2000), x[:2000], 6)
    row, ids, score, _ = A.search(whole, q, x[q], 5)
    assert (row.tolist(), ids.tolist(), score.tolist()) == (block.row.tolist(), block.vec_id.tolist(), block.score.tolist())


def test_one_id_with_many_vectors_is_spread_over_shards(spark):
    rows = vectors(400)
    rows = [(7, *r[1:]) if r[0] % 3 == 1 else r for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    trees, n = A.index(df, shard_rows=50)
    held = [len(A._arrays(bytes(r.tree))["ids"]) for r in trees.collect()]
    assert n == 8 and sum(held) == 400 and max(held) < 100
    check(spark, rows, shard_rows=50)


def test_odd_vectors_copies_and_other_lengths(spark):
    rows = vectors(120)
    one = rows[40][1]
    rows += [(1000 + i, one, 0, "x") for i in range(60)]                     # a group of copies larger than k
    rows += [rows[0], rows[20]]                                              # repeated rows
    rows += [(None, one, 0, "x"), (2000, None, 0, "x"), (2020, [], 0, "x"), (2040, [0.0] * 12, 0, "x"), (2060, [None] + one[1:], 0, "x"),
             (2080, [float("nan")] + one[1:], 0, "x"), (2100, [float("inf")] + one[1:], 0, "x")]
    rows += [(3000 + i, [1.0 + i, 2.0], 0, "x") for i in range(5)] + [(4000, [1.0], 0, "x")]
    check(spark, rows, shard_rows=64)
    empty = spark.createDataFrame([], SCHEMA)
    assert A.nearest_embeddings(empty).collect() == []


def test_smaller_factor_prunes_and_keeps_recall():
    rows = vectors(4000, 8, 3)
    x = np.array([r[1] for r in rows])
    tree = A.build_tree(np.arange(len(x)), x, 21, leaf_rows=64)
    q = np.arange(0, len(x), 20)
    sets, work = {}, {}
    for factor in (1.0, 0.85, 0.4):
        row, ids, _, work[factor] = A.search(tree, q, x[q], 20, factor)
        sets[factor] = set(zip(row.tolist(), ids.tolist()))
    assert work[1.0] < 0.9 * len(q) * len(x) and work[0.4] < work[0.85] < work[1.0]
    assert len(sets[0.85] & sets[1.0]) >= 0.9 * len(sets[1.0])
