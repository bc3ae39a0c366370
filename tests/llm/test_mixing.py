import random
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from affinis.llm import mixing as M
from tests.llm.odd import SCHEMA, odd_rows, words, no_docs, odd_docs  # noqa: F401


def brute_targets(sizes):
    """Reshare the excess by weight until no source is above twice its size; exact fractions."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(2 * sizes[s] for s in capped)
        t = {s: 2 * Fraction(sizes[s]) for s in capped} | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if t[s] > 2 * sizes[s]}
        if not over:
            return t
        capped |= over


def test_targets_taken_and_reruns(odd_docs):
    rows = odd_rows()
    got = M.mix_digest(odd_docs).collect()
    count = lambda t: len((t or "").encode().split())
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += count(r[1])
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == Counter((r[0], count(r[1]), sizes[r[3]]) for r in rows)
    want = brute_targets(sizes)
    taken = defaultdict(int)
    by_size = {v: k for k, v in sizes.items()}
    for r in got:
        s = by_size[r.source_size]
        assert abs(r.target - float(want[s])) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - float(want[s])) <= 1 for s in sizes)
    again = M.mix_digest(odd_docs.repartition(7)).collect()
    assert Counter((r.doc_id, r["size"], r.taken) for r in again) == Counter((r.doc_id, r["size"], r.taken) for r in got)


def test_targets_of_many_sources(spark):
    rng = random.Random(1)
    sizes = {f"s{i}é" if i % 2 else f"S{i}": rng.choice([0, 1, 10, 1000, 10 ** 6]) for i in range(40)} | {None: 77}
    df = spark.createDataFrame(list(sizes.items()), "src string, source_size long")
    got = {r.src: r for r in M.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert all(abs(got[s].target - float(want[s])) <= 1e-9 * max(1, float(want[s])) for s in sizes)
    assert all(got[s].quota <= 2 * sizes[s] and abs(got[s].quota - got[s].target) <= 0.5 for s in sizes)


def test_splitting_tree_is_exact_and_even(spark):
    quotas = spark.createDataFrame([("a", 70), ("b", 20), (None, 11), ("z", 0)], "src string, n_blocks int")
    for shards in (1, 5, 8):
        got = M.split_blocks(quotas, shards, 3).collect()
        assert Counter(r.src for r in got) == {"a": 70, "b": 20, None: 11}
        assert len({(r.src, r.block) for r in got}) == 101
        per = Counter(r.shard for r in got)
        assert set(per) == set(range(shards)) and max(per.values()) - min(per.values()) <= 3


def test_split_counts_are_hypergeometric(spark):
    """Mean and variance of source a's blocks in the left half over many seeds."""
    quotas = spark.createDataFrame([("a", 30), ("b", 10)], "src string, n_blocks int")
    tickets = [M.split_blocks(quotas, 2, seed).withColumn("seed", F.lit(seed)) for seed in range(60)]
    out = tickets[0]
    for t in tickets[1:]:
        out = out.unionByName(t)
    left = [r["count"] for r in out.where("shard = 0 AND src = 'a'").groupBy("seed").count().collect()]
    mean = sum(left) / 60
    var = sum((x - mean) ** 2 for x in left) / 59
    assert abs(mean - 15) < 0.7 and 0.8 < var < 3.6          # exact: 15 and 20 * 3/4 * 1/4 * 20/39 = 1.92


def test_mixed_rows_hold_the_taken_words(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, rng.randint(1, 60)) + " \n", "aa", rng.choice(["x", "y", "z", None]), 1) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    taken = {r.doc_id: r.taken for r in M.mix_digest(df).collect()}
    mixed = M.mix(df).collect()
    got = Counter()
    for r in mixed:
        text = rows[r.doc_id][1]
        n = len(r.text.split())
        assert r.take == n and text.startswith(r.text) and r.source == rows[r.doc_id][3]
        got[r.doc_id] += n
    assert got == Counter({k: v for k, v in taken.items() if v})
    assert sum(r.text != rows[r.doc_id][1] for r in mixed) <= 4          # one cut per source at most


def test_empty_and_wordless(spark, no_docs, odd_docs):
    assert M.mix_digest(no_docs).collect() == [] and M.mix(no_docs).collect() == []
    blank = spark.createDataFrame([(1, None, "aa", "s", 0), (2, " ", "aa", None, 0)], SCHEMA)
    assert [(r["size"], r.target, r.taken) for r in M.mix_digest(blank).collect()] == [(0, 0.0, 0)] * 2
    assert set(odd_docs.columns) <= set(M.mix(odd_docs).columns)


def test_taken_comes_from_the_shards(spark, monkeypatch):
    """A block whose ticket is lost is in no shard, and its documents' words are missing from the digest."""
    rng = random.Random(3)
    rows = [(i, words(rng, rng.randint(1, 60)), "aa", rng.choice(["x", "y"]), 1) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = {r.doc_id: (r.taken, r.copies) for r in M.mix_digest(df).collect()}
    split = M.split_blocks
    monkeypatch.setattr(M, "split_blocks", lambda *a: split(*a).where("NOT (src = 'x' AND block = 0)"))
    less = {r.doc_id: (r.taken, r.copies) for r in M.mix_digest(df).collect()}
    lost = {i for i in whole if less[i] != whole[i]}
    assert lost and all(rows[i][3] == "x" and less[i][1] == whole[i][1] - 1 for i in lost)


def test_rows_without_ids_spread_over_buckets(spark):
    rng = random.Random(4)
    rows = [(None, words(rng, 5), "aa", "x", 1) for _ in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    per = [r["count"] for r in M._permuted(df, 1, F.lit(0)).groupBy("bucket").count().collect()]
    assert len(per) == 3 and max(per) < 1300
    got = M.mix_digest(df).collect()
    assert len(got) == 3000 and sum(r.taken for r in got) == sum(2 * 5 for r in rows) * 3 // 4


def test_places_equal_one_window(spark):
    rng = random.Random(5)
    b = [(k, i, rng.randint(0, 9)) for k in "ab" for i in range(50)]
    got = {(r.key, r.bucket): r.before for r in M._places(spark.createDataFrame(b, "key string, bucket int, words long"), 8).collect()}
    assert got == {(k, i): sum(w for q, j, w in b if q == k and j < i) for k, i, _ in b}
