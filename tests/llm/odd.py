import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
# columns whose names the operators use for their own
CLASH = ("shard", "slot", "fp", "th", "size", "rec", "key", "score", "copy", "take", "votes", "bucket", "rank", "base", "spans")


def words(rng, n, syllables="ka lo mi ren su ta vo zel"):
    s = syllables.split()
    return " ".join("".join(rng.choice(s) for _ in range(rng.randint(1, 4))) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and blank texts, repeated rows, one very long text."""
    rng = random.Random(7)
    rows = [(None, None, None, None, None), (1, None, "aa", "s0", 0), (2, "", "aa", "s0", 0), (3, " \t\n\x0b ", "aa", None, 4),
            (4, "one", "aa", "s1", 3), (5, "one two", "aa", "s1", 7), (6, "!!! 123", None, "s1", 7)]
    text = words(rng, 120)
    rows += [(7, text, "aa", "s2", len(text))] * 3
    rows += [(None, text, "aa", "s2", len(text))]
    rows += [(100 + i, text, "bb", "s2", len(text)) for i in range(10)]
    rows += [(200 + i, words(rng, 30 + i), "aa", f"s{i % 4}", 1) for i in range(40)]
    rows += [(300 + i, words(rng, 40, "xi po gru wen dra"), "bb", f"s{i % 4}", 1) for i in range(20)]
    rows += [(400, words(rng, 30_000), "aa", "s3", 1)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows(), SCHEMA)
    return df.withColumns({c: F.lit(f"other {c}") for c in CLASH}).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
