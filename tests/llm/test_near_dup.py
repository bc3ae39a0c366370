import random
import re

import xxhash

from affinis.llm import near_dup as N
from tests.llm.odd import SCHEMA, odd_rows, words, no_docs, odd_docs  # noqa: F401


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, distance=2):
    """fp -> root by union-find over all pairs."""
    u = sorted(set(prints))
    root = {x: x for x in u}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(u):
        for b in u[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                root[find(b)] = find(a)
    return {x: find(x) for x in u}


def test_fingerprints_equal_brute_force():
    rng = random.Random(1)
    for t in ["", " \n", "One", "one TWO", "É é İ\x1cx\x85y z", "a a a a a a"] + [words(rng, n) for n in (3, 10, 200)]:
        assert N.simhash(t.encode()) == brute_print(t), t


def near_rows():
    """Chains of near copies: long texts with a word changed, again and again."""
    rng = random.Random(2)
    rows = []
    for g in range(12):
        w = words(rng, 400).split()
        for i in range(10):
            rows.append((g * 100 + 99 - i, " ".join(w), "aa", "s", 0))
            w[rng.randrange(len(w))] = "changed"
    return rows + odd_rows()


def test_components_equal_brute_force(spark):
    rows = near_rows()
    got = N.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    prints = [brute_print(r[1]) for r in rows]
    root = brute_components(prints)
    best = {}
    for r, p in zip(rows, prints):
        best.setdefault(root[p], []).append(r[0])
    want = sorted((str(r[0]), f"{p:016x}", min((d for d in best[root[p]] if d is not None), default=None)) for r, p in zip(rows, prints))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    assert any(root[p] != p for p in prints)


def test_variants_reach_every_link(spark):
    """Random fingerprints with planted chains at 0 to 3 bits; links connect exactly what all pairs connect."""
    rng = random.Random(3)
    fps = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(6):
            fps.add(x)
            for _ in range(rng.randint(0, 3)):
                x ^= 1 << rng.randrange(64)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for distance in (0, 1, 2):
        roots = {r.node: r.root for r in N.components(N.links(df, distance)).collect()}
        mine, want = {}, {}
        brute = brute_components([x % (1 << 64) for x in signed], distance)
        for x in signed:
            mine.setdefault(roots.get(x, x), set()).add(x)
            want.setdefault(brute[x % (1 << 64)], set()).add(x)
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_long_chain_of_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001)]
    got = {r.node: r.root for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {1001: 1000}


def test_one_row_of_each_component_stays(spark, odd_docs, no_docs):
    kept = N.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows, prints = odd_rows(), [brute_print(r[1]) for r in odd_rows()]
    root = brute_components(prints)
    first = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            first[root[p]] = min(first.get(root[p], r[0]), r[0])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())
    assert N.keep_one(no_docs).collect() == [] and N.near_duplicates(no_docs).collect() == []
