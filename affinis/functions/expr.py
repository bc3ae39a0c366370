"""Scalar column expressions.

All of them are built-in Spark SQL expressions, so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The feature order of a feature row, as the reference writes it
# (categories, tags, language, author, title-length error, blog, average likes per post).
FEATURES = [
    "categories_likelihood",
    "tags_likelihood",
    "language_likelihood",
    "author_likelihood",
    "title_length_error",
    "blog_likelihood",
    "avg_likes_per_post",
]

# A word is a run of ASCII word characters or apostrophes; the
# title is the text up to the first full stop or line break.
WORD_SPLIT = r"[^\w']+"
TITLE_PATTERN = r"^[^\n.]*"
# prefix up to the last word character; linear time, unlike stripping "[^\w']+$",
# which backtracks quadratically over a long run of non-word characters
UP_TO_LAST_WORD = r"(?s)^(.*[\w'])"

_TWO_POW_52 = 4503599627370496.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_count(title) -> Column:
    """Number of pieces a Java ``String.split("[^\\w']+")`` yields.

    Java drops trailing empty pieces and keeps a leading one; an empty
    string is one piece.  A null title counts 0 words.
    """
    t = _c(title)
    rest = F.regexp_extract(t, UP_TO_LAST_WORD, 1)
    return (
        F.when(t.isNull(), F.lit(0))
        .when(t == "", F.lit(1))
        .when(rest == "", F.lit(0))
        .otherwise(F.size(F.split(rest, WORD_SPLIT)))
    )


def title_words_of(df) -> Column:
    """The post's title word count: the precomputed ``title_words`` column when present."""
    return F.col("title_words") if "title_words" in df.columns else word_count("title")


def title_of(text) -> Column:
    """First sentence of a text: everything before the first '.' or newline."""
    return F.regexp_extract(_c(text), TITLE_PATTERN, 0)


def unit_hash(*keys) -> Column:
    """Reproducible uniform number in [0, 1) from the keys.

    First 52 bits of md5 over the keys joined by '|', divided by 2^52: exact in
    a double, and fine enough to reach every one of 10^12 users.  The same
    value comes out of DuckDB, which gives every sample an exact oracle.
    Deterministic, so a recomputed task after an executor loss draws the
    same numbers.
    """
    parts = [(_c(k) if not isinstance(k, (int, float)) else F.lit(k)).cast("string") for k in keys]
    hexdigits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13)
    return F.conv(hexdigits, 16, 10).cast("double") / F.lit(_TWO_POW_52)


def safe_div(num, den) -> Column:
    """Double division where x/0 is null (undefined) instead of an error."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def round_half_up(x, digits: int = 0) -> Column:
    """``math.round``: floor(x * 10^d + 0.5) / 10^d (Spark's round differs on negative halves)."""
    scale = float(10 ** digits)
    if digits == 0:
        return F.floor(_c(x) + F.lit(0.5)).cast("double")
    return F.floor(_c(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def with_count_at_or_below(df, x, sorted_values: list[float], out: str):
    """Add column ``out`` = number of ``sorted_values`` that are <= x (a bucket index).

    Spark ML's ``Bucketizer`` does a JVM binary search over the split points,
    so the expression stays small whatever the number of values.  NaN goes
    past the last bucket; null stays null.
    """
    from pyspark.ml.feature import Bucketizer

    vals = sorted({float(v) for v in sorted_values})
    src = f"{out}__in"
    d = df.withColumn(src, _c(x).cast("double"))
    if not vals:
        return d.withColumn(out, F.when(F.col(src).isNotNull(), F.lit(0))).drop(src)
    splits = [float("-inf")] + vals + [float("inf")]
    b = Bucketizer(splits=splits, inputCol=src, outputCol=out + "__b", handleInvalid="keep")
    return (b.transform(d)
            .withColumn(out, F.when(F.col(src).isNotNull(), F.col(out + "__b").cast("int")))
            .drop(src, out + "__b"))


def finite(x) -> Column:
    """Not null, not NaN and not infinite."""
    c = _c(x)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def is_finite_all(cols) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & finite(c)
    return cond
