import corpus_pipeline as C
import __spark_entry__ as E

from affinis.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.odd import odd_rows, no_docs, odd_docs  # noqa: F401
from tests.llm.test_near_dup import brute_components, brute_print
from tests.llm.test_packing import check

SF = "/root/testdata/sf0.001"


def test_registered():
    q, o = E.queries(), E.oracle_sql()
    assert set(QUERIES) | {"pipeline"} <= set(q) and set(ORACLE_SQL) <= set(o)
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert [n for n, _ in C.STAGES] == ["language", "near_duplicates", "pii", "mixture", "pack"]


def test_stages_on_odd_rows(spark, odd_docs, no_docs):
    """Each stage on what the one before kept, against brute force."""
    from affinis.session import stage

    docs, step = odd_docs, dict(C.STAGES)
    docs = stage(step["language"](spark, docs, ""), "t")
    lettered = [r for r in odd_rows() if r[1] and any(c.isalpha() for c in r[1])]
    assert docs.columns == odd_docs.columns and docs.count() == len(lettered)
    docs = stage(step["near_duplicates"](spark, docs, ""), "t")
    assert docs.columns == odd_docs.columns
    assert docs.count() == len(set(brute_components([brute_print(r[1]) for r in lettered]).values()))
    docs = stage(step["pii"](spark, docs, ""), "t")
    assert docs.columns == odd_docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    docs = stage(step["mixture"](spark, docs, ""), "t")
    assert docs.columns == odd_docs.columns
    rows = [tuple(r[c] for c in ("doc_id", "text")) for r in docs.collect()]
    assert all(before[i].startswith(t) for i, t in rows)
    words = sum(len(t.split()) for t in before.values())
    assert abs(sum(len(t.split()) for _, t in rows) - 1.5 * words) <= 4
    assert check(rows, step["pack"](spark, docs, "").collect()) > 0.5
    empty = no_docs
    for _, f in C.STAGES:
        empty = f(spark, empty, "")
        assert empty.count() == 0


def test_run_on_the_smallest_tables(spark):
    out = C.run(spark, SF)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0
