import random
import re
from collections import Counter

import numpy as np

from affinis.llm import quality_rules as Q
from tests.llm.odd import SCHEMA, odd_rows, words, no_docs, odd_docs  # noqa: F401


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    in_window = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(in_window)


def test_counts_equal_brute_force():
    rng = random.Random(1)
    texts = ["", " ", "a", "a b", "a b c a b c", "a\na\n\n a \nb", "é É ###\u2003x\x85y\x1cz", "a a a a"]
    texts += [words(rng, n, "ka lo") + "\n" + words(rng, 5) for n in (3, 40, 400)]
    for t in texts:
        assert Q.measure(t.encode())[:5] == brute(t), t


def test_repeated_words_with_wide_codes():
    ids = np.array([3_000_000, 1, 2, 7, 3_000_000, 1, 2], np.int64)
    assert Q.repeated_words(ids, 3) == 6 and Q.repeated_words(ids, 4) == 0


def test_accuracies_are_recovered():
    rng = np.random.default_rng(2)
    y = rng.random(20_000) < 0.7
    true = np.array([0.95, 0.9, 0.7, 0.85])
    right, speaks = rng.random((len(y), 4)) < true, rng.random((len(y), 4)) < 0.8
    v = np.where(speaks, np.where(right, y[:, None], ~y[:, None]).astype(int), 2)
    codes, counts = np.unique(v @ 3 ** np.arange(3, -1, -1), return_counts=True)
    post, acc, prior = Q.expectation_maximisation(codes, counts.astype(float), 4)
    assert abs(prior - 0.7) < 0.03 and np.abs(acc - true).max() < 0.05
    verdict = dict(zip(codes, post >= 0.5))
    assert np.mean([verdict[c] for c in v @ 3 ** np.arange(3, -1, -1)] == y) > 0.93


def test_rules_with_bad_votes_only_can_reject(spark):
    """Junk that six one-sided rules flag while the other three see normal text."""
    rng = np.random.default_rng(5)
    sided = [i for i, name in enumerate(Q.rules()) if name in
             ("length", "word_length", "duplicate_lines", "repeated_windows", "upper_case", "shouting")]
    junk = rng.random(10_000) < 0.05
    v = np.where(rng.random((10_000, 9)) < 0.98, 1, 0)                   # symbols, line ends and letters: normal
    flagged = rng.random((10_000, 6)) < np.where(junk, 0.8, 0.01)[:, None]
    v[:, sided] = np.where(flagged, 0, 2)
    place = 3 ** np.arange(8, -1, -1)
    codes, n = np.unique(v @ place, return_counts=True)
    post = dict(zip(codes, Q.expectation_maximisation(codes, n.astype(float), 9)[0]))
    worst, fine = np.full(9, 1), np.full(9, 1)
    worst[sided], fine[sided] = 0, 2
    assert post[worst @ place] < 0.5 < post[fine @ place]
    assert np.mean([(post[c] < 0.5) == j for c, j in zip(v @ place, junk)]) > 0.98


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(9)
    prose = lambda: "\n".join(words(rng, 12).capitalize() + "." for _ in range(8))
    junk = lambda: " ".join(f"{w}{rng.choice(['###', '&&&', '$$$'])}" for w in words(rng, 90).split())
    rows = [(i, junk() if i % 8 == 0 else prose(), None, None, 0) for i in range(160)]
    got = {r.doc_id: r.kept for r in Q.verdicts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == (i % 8 != 0) for i in got)


def test_odd_rows(odd_docs, no_docs):
    rows = Q.verdicts(odd_docs).collect()
    assert len(rows) == len(odd_rows())
    by = {r.doc_id: r for r in rows}
    assert by[1].n_words == 0 and by[1].base_failed and not by[1].kept
    assert sum(r.n_words == 120 for r in rows) >= 14
    assert Q.verdicts(no_docs).collect() == []
