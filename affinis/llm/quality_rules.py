"""Operator 3, quality rules: weak supervision.

Each rule votes good (1), bad (0) or abstains (-1) on a document.  No rule
decides alone: expectation-maximisation estimates how accurate every rule is
and how common good documents are, from how the rules agree over all
documents (bad, good and abstention are three outcomes, so that a rule with
one kind of vote speaks by it too), and gives each document the posterior probability of being good.

The documents meet in one aggregate, the count of each pattern of votes.
There are at most 3 ** len(rules()) patterns, so the model is fitted on a
bounded table that stands for all documents, and the posterior of each
pattern goes back to the documents by a join of that bounded table.

Cases: null and empty texts have no words, every rule abstains but the one
on length; ties of the posterior at 0.5 count as good; an empty table gives
no rows; repeated rows get equal verdicts; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.session import stage

# Fixed values of the contract's base verdict.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

ROUNDS = 100
START_ACCURACY = 0.8
START_PRIOR = 0.8
PSEUDO_DOCS = 4        # documents of each class that vote as at the start

_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))
_WHITE = b" \t\n\x0b\x0c\r"
_ENDS = (b".", b"!", b"?", b":", b'"', b"'")
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(0xC0, 0x100)])     # ASCII letters and lead bytes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines",
          "n_letters", "n_upper", "n_shouts", "n_distinct_words")


def repeated_words(ids: np.ndarray, size: int = 3) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    code, width = ids[:n].copy(), int(ids.max()) + 1
    for k in range(1, size):
        if width * (int(ids.max()) + 1) >= 2**62:
            _, code = np.unique(code, return_inverse=True)
            width = n
        code = code * (int(ids.max()) + 1) + ids[k:n + k]
        width *= int(ids.max()) + 1
    _, inverse, found = np.unique(code, return_inverse=True, return_counts=True)
    again = found[inverse] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(ids), bool)
    for k in range(size):
        covered[k:n + k] |= again
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one UTF-8 text."""
    words = text.split()              # bytes: ASCII white space only
    if not words:
        return (0, 0, len(text) - len(text.translate(None, SYMBOLS)), *[0] * 8)
    number = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    chars = len(text.translate(None, _WHITE + _CONTINUATION))
    lines = [line for line in text.split(b"\n") if line.split()]
    ended = sum(line.rstrip().endswith(_ENDS) for line in lines)
    upper = len(text) - len(text.translate(None, _UPPER))
    letters = chars - len(text.translate(None, _WHITE + _CONTINUATION + _LETTERS))
    return (len(words), chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(ids), len(lines), ended, letters, upper, text.count(b"!"), len(number))


def counted(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py() or b"") for t in batch.column(1).cast(pa.binary())]
            table = np.array(rows, np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, table.T)], names=["doc_id", *COUNTS])

    schema = T.StructType([T.StructField("doc_id", id_type)] + [T.StructField(c, T.LongType()) for c in COUNTS])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _share(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part), F.col(whole))


def rules() -> dict[str, tuple[Column, Column]]:
    """Name -> (good if, bad if); neither, or a null share: the rule abstains."""
    mean = _share("word_chars", "n_words")
    symbols, dup, repeat = _share("n_symbols", "n_words"), _share("n_dup_lines", "n_lines"), _share("n_repeat_words", "n_words")
    ended, letters, upper = _share("n_ended_lines", "n_lines"), _share("n_letters", "word_chars"), _share("n_upper", "n_letters")
    shouts = _share("n_shouts", "n_words")
    long = F.col("n_words") >= MIN_WORDS
    never = F.lit(False)
    return {
        "length": (never, F.col("n_words") < 30),
        "word_length": (never, (mean < 2.5) | (mean > 12)),
        "symbols": (symbols < 0.02, symbols > 0.1),
        "duplicate_lines": (never, dup > 0.3),
        "repeated_windows": (never, (repeat > 0.2) & long),
        "line_ends": ((ended >= 0.5) & long, (ended < 0.12) & long),
        "letters": (letters >= 0.92, letters < 0.8),
        "upper_case": (never, upper > 0.5),
        "shouting": (never, shouts > 0.3),
    }


def votes(counts: DataFrame) -> DataFrame:
    """``counts`` with ``votes``: one code per pattern, base 3, a digit per rule (0 bad, 1 good, 2 abstains)."""
    code = F.lit(0)
    for good, bad in rules().values():
        digit = F.when(bad, 0).when(good, 1).otherwise(2)
        code = code * 3 + digit
    return counts.withColumn("votes", code.cast("int"))


def patterns_of(codes: np.ndarray, n_rules: int) -> np.ndarray:
    """(code, rule) digits."""
    return (codes[:, None] // 3 ** np.arange(n_rules - 1, -1, -1)) % 3


def expectation_maximisation(codes: np.ndarray, counts: np.ndarray, n_rules: int,
                             rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of each pattern, accuracy of each rule, share of good) from the counts of vote patterns."""
    hot = (patterns_of(codes, n_rules)[:, :, None] == np.arange(3)).astype(float)      # pattern, rule, vote
    share = np.einsum("p,prv->rv", counts, hot) + 1
    # the start: a rule's votes as all documents have them, good and bad tilted to their class, abstention to none
    tilt = np.array([[START_ACCURACY, 1 - START_ACCURACY, 0.5], [1 - START_ACCURACY, START_ACCURACY, 0.5]])
    start = share * tilt[:, None, :]
    start /= start.sum(axis=2, keepdims=True)
    given, prior = start, START_PRIOR                       # given[c, j, v]: rule j votes v on class c
    post = np.full(len(codes), prior)
    for _ in range(rounds):
        log0, log1 = np.einsum("prv,crv->cp", hot, np.log(given))
        post = 1 / (1 + np.exp(np.clip(np.log(1 - prior) + log0 - np.log(prior) - log1, -700, 700)))
        weight = np.stack([(1 - post) * counts, post * counts])
        found = np.einsum("cp,prv->crv", weight, hot) + PSEUDO_DOCS * start
        of = found.sum(axis=2, keepdims=True)
        given = found / of
        # a bad vote never speaks for good nor a good one for bad, which fixes the classes' names
        both = found.sum(axis=0) / of.sum(axis=0)
        for vote, right in ((0, 0), (1, 1)):
            wrong = given[1 - right, :, vote] > given[right, :, vote]
            given[:, wrong, vote] = both[wrong, vote]
        given[:, :, 2] = np.maximum(1 - given[:, :, 0] - given[:, :, 1], 1e-9)
        prior = float(np.clip((weight[1].sum() + START_PRIOR) / (counts.sum() + 1), 0.01, 0.99))
    acc = np.stack([given[c, :, c] / (given[c, :, 0] + given[c, :, 1]) for c in (0, 1)])
    return post, acc, prior


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, all counts, votes, posterior, base_failed and kept of every document."""
    spark = docs.sparkSession
    voted = stage(votes(counted(docs)), "quality_votes")
    seen = sorted((r["votes"], r["n"]) for r in voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect())
    codes, n = np.array([c for c, _ in seen], np.int64), np.array([k for _, k in seen], np.float64)
    post = expectation_maximisation(codes, n, len(rules()))[0] if seen else []
    known = spark.createDataFrame([(int(c), float(p)) for c, p in zip(codes, post)], "votes int, posterior double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (voted.join(F.broadcast(known), "votes").withColumn("base_failed", failed)    # at most 3 ** rules rows
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)))


def verdicts(docs: DataFrame) -> DataFrame:
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept", "posterior")
