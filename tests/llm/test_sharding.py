import zlib
from collections import Counter

from affinis.llm import sharding as S
from affinis.session import stage
from tests.llm.odd import odd_rows, no_docs, odd_docs  # noqa: F401


def test_all_rows_in_even_gapless_shards(odd_docs):
    got = S.shard_documents(odd_docs).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in odd_rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    by = {}
    for r in got:
        assert r.law == "rows" and r.grown_shard is None
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by.get(s, [])) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_buckets_laid_end_to_end_and_reruns_agree(spark):
    df = spark.range(1000).repartition(5)
    one = S.external_shuffle(df, 7, 1, bucket_rows=50)
    got = {r.id: (r.shard, r.slot) for r in one.collect()}
    assert sorted(s + 7 * t for s, t in got.values()) == list(range(1000))
    assert got != {i: (i % 7, i // 7) for i in range(1000)}
    other = {r.id: (r.shard, r.slot) for r in S.external_shuffle(df, 7, 2, bucket_rows=50).collect()}
    assert other != got


def test_records_keep_their_columns_but_shard_and_slot(odd_docs):
    df = S.external_shuffle(odd_docs, 3)
    assert set(df.columns) == set(odd_docs.columns)
    assert df.count() == odd_docs.count() and dict(df.dtypes)["shard"] == "int"


def test_buckets_follow_bytes_and_large_ones_are_not_held(spark, monkeypatch):
    """A bucket of long records is small in rows; one above its size gets the sort, and every record stays whole."""
    seen = {}
    monkeypatch.setattr(S, "stage", lambda df, name: seen.setdefault(name, stage(df, name)))
    rows = [(i, chr(97 + i % 26) * (200_000 if i == 5 else 1000)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = S.external_shuffle(df, 7, 1, bucket_bytes=20_000).collect()
    assert {r.doc_id: r.text for r in got} == dict(rows) and len(got) == 400
    assert sorted(r.shard + 7 * r.slot for r in got) == list(range(400))
    sizes = seen["bucket_sizes"].collect()
    assert len(sizes) > 20 and sum(r.bytes > 80_000 for r in sizes) == 1


def test_large_buckets_are_fisher_yates_shuffled(spark, monkeypatch):
    """All records in buckets above their size: the places' permutation, not their order, and another seed's is another."""
    df = spark.createDataFrame([(i, "x" * 500) for i in range(40)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(S, "LARGE", 0)
    orders = set()
    for seed in range(3):
        got = S.external_shuffle(df, 1, seed).collect()
        assert sorted(r.slot for r in got) == list(range(40)) and all(r.text == "x" * 500 for r in got)
        orders.add(tuple(r.doc_id for r in sorted(got, key=lambda r: r.slot)))
    assert len(orders) == 3 and tuple(range(40)) not in orders
    plan = S.external_shuffle(df, 1, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "shuffle(" in plan and "row_number" not in plan


def test_query_shuffles_whole_records(odd_docs, monkeypatch):
    shuffled = []
    monkeypatch.setattr(S, "external_shuffle", lambda df, f=S.external_shuffle: shuffled.append(df.columns) or f(df))
    assert S.shard_documents(odd_docs).count() == len(odd_rows())
    assert shuffled == [odd_docs.columns]


def test_empty(no_docs):
    assert S.shard_documents(no_docs).collect() == []
