import random
import zlib

from affinis.llm import language_id as L
from tests.llm.odd import SCHEMA, odd_rows, words, no_docs, odd_docs  # noqa: F401


def longest_match_parse(sample, text):
    """Phrases by brute force: each the longest prefix of the rest that occurs in the sample, one symbol at least."""
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in sample:
            j += 1
        i = max(i + 1, j - 1)
        n += 1
    return n


def test_phrases_equal_brute_force():
    rng = random.Random(3)
    samples = {"a": words(rng, 60), "b": words(rng, 60, "xi po gru wen dra")}
    model = L.Model(samples)
    texts = [words(rng, 20) + " ", words(rng, 15, "xi po ka dra") + " ", "k ", "qqq ", ""]
    total, n, letters = L.phrase_counts(model, texts)
    for i, lang in enumerate(model.languages):
        want = [longest_match_parse(samples[lang], t) for t in texts]
        assert total[i].tolist() == want
    assert n.tolist() == [len(t) for t in texts] and letters.tolist() == [True] * 4 + [False]


def test_windows_split_long_texts_only_at_their_ends():
    rng = random.Random(4)
    sample = words(rng, 80)
    model = L.Model({"a": sample})
    text = L._squeezed(words(rng, 900)) + " "
    total, _, _ = L.phrase_counts(model, [text])
    parts = [text[i:i + L.WINDOW] for i in range(0, len(text), L.WINDOW)]
    assert total[0, 0] == sum(longest_match_parse(sample, p) for p in parts)


def test_held_out_accuracy_and_odd_rows(spark, odd_docs):
    rng = random.Random(5)
    rows = [(i, words(rng, 12, s), lang, None, 0) for i in range(300)
            for lang, s in [(("aa", "ka lo mi ren su"), ("bb", "xi po gru wen dra"), ("cc", "ko li me ran so"))[i % 3]]]
    got = L.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    truth = {r[0]: r[2] for r in rows}
    out = [r for r in got if r.held_out]
    assert {r.doc_id for r in out} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.95 * len(out)
    odd = L.identify(odd_docs).collect()
    assert len(odd) == len(odd_rows()) and all(0 <= r.score <= 1 for r in odd)
    assert {r.doc_id for r in odd if r.lang_pred == "und"} == {None, 1, 2, 3, 6}


def test_only_texts_and_other_folds_are_learned(spark):
    rows = [(i, "solo text here", "zz", "s", 0) for i in range(50) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {r.lang_pred for r in L.identify(spark.createDataFrame(rows, SCHEMA)).collect()} == {"und"}


def test_stage_keeps_rows_and_fills_null_language(spark, odd_docs, no_docs):
    kept = L.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert len(rows) == len([r for r in odd_rows() if r[1] and any(c.isalpha() for c in r[1])])
    assert all(r.lang for r in rows) and all(r.score == "other score" for r in rows)
    assert L.keep_identified(no_docs).collect() == [] and L.identify(no_docs).collect() == []


def test_stage_keeps_prose_when_nothing_is_learned(spark):
    rng = random.Random(8)
    fold = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    unlabelled = [(i, words(rng, 20), None, "s", 0) for i in range(40)] + [(50, "123 !", None, "s", 0), (51, None, None, "s", 0)]
    held = [(i, words(rng, 20), "aa" if i in fold else None, "s", 0) for i in range(40)]
    for rows in (unlabelled, held):
        got = {r.doc_id: (r.text, r.lang) for r in L.keep_identified(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got == {r[0]: (r[1], r[2]) for r in rows[:40]}
