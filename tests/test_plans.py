"""Hand-written plans: bucketed running totals, salted join."""

import random

from affinis.plans.prefix import dense_index, running_totals
from affinis.plans.skew import hot_keys, salted_join, with_salt


def test_running_totals_equal_window(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.random(), rnd.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "id bigint, x double, v bigint")
    for desc in (False, True):
        got = {r.id: (r.cum_v, r.position) for r in running_totals(df, "x", ["v"], descending=desc, buckets=7).collect()}
        srt = sorted(rows, key=lambda t: -t[1] if desc else t[1])
        acc = 0
        for pos, (i, _, v) in enumerate(srt):
            acc += v
            assert got[i] == (acc, pos)


def test_dense_index(spark):
    df = spark.createDataFrame([(5,), (3,), (5,), (9,), (1,)], "u bigint")
    assert {r.u: r.idx for r in dense_index(df, "u", buckets=2).collect()} == {1: 0, 3: 1, 5: 2, 9: 3}


def test_bucket_count_follows_rows():
    from affinis.plans.prefix import BUCKET_ROWS, bucket_count
    assert bucket_count(10) == bucket_count(BUCKET_ROWS) and bucket_count(100 * BUCKET_ROWS) == 100


def test_salted_join_equals_join(spark):
    """Keys hot on the left (1), on the right (0), on both sides (3) and on none (2)."""
    left = [(t, p) for t in range(3) for p in range(5)] + [(1, 100 + p) for p in range(40)] + [(3, p) for p in range(30)]
    right = [(0, u) for u in range(50)] + [(1, 7), (2, 8)] + [(3, u) for u in range(20)]
    l, r = spark.createDataFrame(left, "tag bigint, post bigint"), spark.createDataFrame(right, "tag bigint, user bigint")
    got = sorted(map(tuple, salted_join(l, r, ["tag"], rows_per_salt=6).select("tag", "post", "user").collect()))
    assert got == sorted((t, p, u) for t, p in left for s, u in right if s == t)
    assert {r.tag: r.salts for r in hot_keys(l, ["tag"], 6).collect()} == {1: 8, 3: 5}
    # every salt of a hot key holds a part of its rows
    per = with_salt(l, hot_keys(l, ["tag"], 6), "tag", "post").where("tag = 1").groupBy("salt").count().collect()
    assert len(per) > 4 and max(x["count"] for x in per) < 20
