import random
import re

import pytest

from affinis.llm import jaccard_join as J
from tests.llm.odd import SCHEMA, odd_rows, words, no_docs, odd_docs  # noqa: F401


def brute_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()


def brute(rows, percent=90):
    """(doc_id, n_shingles, component_id) over all pairs of distinct sets, and the links of each set."""
    of = [brute_set(r[1]) for r in rows]
    u = list(dict.fromkeys(s for s in of if s))
    root = {s: s for s in u}
    degree = dict.fromkeys(u, 0)

    def find(x):
        while root[x] is not x:
            x = root[x]
        return x

    for i, a in enumerate(u):
        for b in u[i + 1:]:
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                root[find(b)] = find(a)
                degree[a] += 1
                degree[b] += 1
    best = {}
    for r, s in zip(rows, of, strict=True):
        if s and r[0] is not None:
            best[find(s)] = min(r[0], best.get(find(s), r[0]))
    return [(r[0], len(s), best.get(find(s)) if s else r[0]) for r, s in zip(rows, of, strict=True)], degree, of


def text_key(rows):
    return sorted(rows, key=str)


def near_rows():
    """Groups of near copies at 1 to 8 changed words, a passage shared by unrelated texts, hot groups."""
    rng = random.Random(5)
    rows = []
    for g in range(25):
        w = words(rng, rng.choice((25, 60, 150, 600))).split()
        for i in range(8):
            v = list(w)
            for _ in range(rng.randint(0, 8)):
                v[rng.randrange(len(v))] = f"changed{rng.randrange(50)}"
            rows.append((1000 * g + 99 - i, " ".join(v), "aa", "s", 0))
    passage = words(rng, 60)
    rows += [(50_000 + i, passage + " " + words(rng, rng.randint(1, 90)), "aa", "s", 0) for i in range(60)]
    chain = words(rng, 120).split()
    for i in range(30):         # each links to the next alone
        rows.append((60_000 - i, " ".join(chain), "aa", "s", 0))
        chain[(7 * i) % 120] = f"link{i}"
    base = words(rng, 80).split()
    for i in range(150):
        v = list(base)
        for _ in range(i % 4):
            v[rng.randrange(80)] = words(rng, 1)
        rows.append((70_000 + i, " ".join(v), "aa", "s", 0))
    return rows + odd_rows()


def test_links_equal_brute_force(spark):
    rows = near_rows()
    got = J.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    want, degree, of = brute(rows)
    assert text_key((r.doc_id, r.n_shingles, r.component_id) for r in got) == text_key(want)
    # star links and links across components are not all links, but never more
    most = {(r[0], len(s)): degree.get(s, 0) for r, s in zip(rows, of, strict=True)}
    assert all(r.n_links <= most[r.doc_id, r.n_shingles] for r in got)
    assert sum(r.n_links > 0 for r in got) > 100


@pytest.mark.parametrize("block", (J.BLOCK, 6))
def test_every_link_is_counted(spark, block):
    """Also those inside a component that the pivots' ties have already made, over one block or several."""
    rows = near_rows()
    got = J.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(4), block=block).collect()
    _, degree, of = brute(rows)
    assert text_key((r.doc_id, r.n_shingles, r.n_links) for r in got) == text_key(
        (r[0], len(s), degree.get(s, 0)) for r, s in zip(rows, of, strict=True))


@pytest.mark.parametrize("percent", (80, 95))
def test_other_thresholds(spark, percent):
    rows = near_rows()[:320]
    got = J.jaccard_components(spark.createDataFrame(rows, SCHEMA), percent=percent).collect()
    assert text_key((r.doc_id, r.n_shingles, r.component_id) for r in got) == text_key(brute(rows, percent)[0])


def test_odd_rows_and_no_rows(odd_docs, no_docs):
    got = J.jaccard_components(odd_docs).collect()
    assert text_key((r.doc_id, r.n_shingles, r.component_id) for r in got) == text_key(brute(odd_rows())[0])
    assert J.jaccard_components(no_docs).collect() == []


def test_prefix_is_longer_where_that_is_cheaper(spark):
    """A set whose shared shingles all have long lists asks for several matches, one with rare ones for fewer."""
    n = 400
    h = int(J.head_length(n, 90))
    hot = [(10_000, 7 * i) for i in range(h)]
    rare = [(2, 100_000 + i) for i in range(h // 4)] + [(10_000, 7 * i) for i in range(h - h // 4)]
    df = spark.createDataFrame([(1, n, hot), (2, n, rare)], "sid long, n long, shared array<struct<df:long,token:long>>")
    got = {r.sid: r.matches for r in J.prefixes(df, 90).collect()}
    assert got[1] > got[2] > 1
