"""Driver contract: entry(), queries() and oracle_sql() agree with each other."""

import __spark_entry__ as E
from affinis.plans.registry import QUERIES, ROWS_ONLY


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
    assert set(df.columns) == {"user_id", "post_id", "label", "score"}


def test_every_sql_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(q)
    assert set(QUERIES) - set(o) == ROWS_ONLY
    assert len(QUERIES) >= 85
