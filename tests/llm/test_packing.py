import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from affinis.llm import packing as K
from affinis.llm.queries import tokenizer_path
from tests.llm.odd import SCHEMA, odd_rows, words, no_docs, odd_docs  # noqa: F401


def first_fit_brute(lengths, capacity):
    used, out = [], []
    for n in lengths:
        b = next((i for i, u in enumerate(used) if u + n <= capacity), len(used))
        if b == len(used):
            used.append(0)
        out.append((b, used[b]))
        used[b] += n
    return out


def test_tree_equals_first_fit():
    rng = random.Random(1)
    for n in (0, 1, 2, 7, 300):
        lengths = sorted((rng.randint(1, 64) for _ in range(n)), reverse=True)
        assert list(zip(*K.first_fit(lengths, 64))) == first_fit_brute(lengths, 64)


def test_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    t, cache = Tokenizer.from_file(tokenizer_path()), K.ChunkIds(tokenizer_path())
    rng = random.Random(2)
    alphabet = "aBcdé ÀßñÑ'’.,#$_-019 \n\t\x0b\x1c 　éİΣς\U0001F600<|>中"
    texts = ["", " ", "it's don't we'll", "<|endoftext|> x<|startoftext|>y", "Hello,world!!! ###", "a_b", "ÀÉ"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    for x in texts:
        assert np.frombuffer(cache.ids(x.encode()), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, x


def check(rows, got):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    want, by_doc, by_seq = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in rows:
        want[r[0]].append(t.encode(r[1] or "", add_special_tokens=False).ids + [1])
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(want)
    for doc, texts in want.items():
        pieces = Counter((i, min(2048, len(x) - i), zlib.crc32(np.array(x[i:i + 2048], "<u4").tobytes()), len(x))
                         for x in texts for i in range(0, len(x), 2048))
        assert Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[doc]) == pieces
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return sum(r.length for r in got) / (2048 * len(by_seq))


def test_whole_documents_packed(spark, odd_docs, no_docs):
    assert check(odd_rows(), K.pack_documents(odd_docs, tokenizer_path()).collect()) > 0.9
    assert K.pack_documents(no_docs, tokenizer_path()).collect() == []


def test_many_groups_fill_well(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, rng.randint(1, 300)), None, None, 0) for i in range(600)]
    pieces = K.token_pieces(spark.createDataFrame(rows, SCHEMA).repartition(4), tokenizer_path())
    assert check(rows, K.pack(pieces, group_pieces=150).collect()) > 0.95


def test_a_worker_gets_few_texts_at_once(spark):
    """One large partition reaches the Python worker in bounded batches; the setting is as before afterwards."""
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([b.num_rows] * b.num_rows, pa.int64())], names=["doc_id", "n"])

    name, n = "spark.sql.execution.arrow.maxRecordsPerBatch", 2 * K.BATCH_DOCS + 1
    before = spark.conf.get(name)
    pieces = spark.range(0, n, 1, 1).selectExpr("id AS doc_id").mapInArrow(sizes, "doc_id long, n long").selectExpr("*", "1L AS length")
    got = K.pack(pieces).collect()
    assert len(got) == n and max(r.n for r in got) == K.BATCH_DOCS
    assert spark.conf.get(name) == before


@pytest.mark.parametrize("with_ids", [True])
def test_ids_of_the_pieces(odd_docs, with_ids):
    for r in K.token_pieces(odd_docs, tokenizer_path(), with_ids=with_ids).collect():
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length


def test_written_sequences_hold_every_id(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    got = K.sequences(odd_docs, tokenizer_path()).collect()
    want, found = Counter(), Counter()
    for r in odd_rows():
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [1]
        want.update((r[0], tuple(ids[i:i + 2048])) for i in range(0, len(ids), 2048))
    for r in got:
        assert len(r.ids) == r.length == sum(r.lengths) <= 2048
        at = 0
        for doc, n in zip(r.doc_ids, r.lengths, strict=True):
            found[doc, tuple(r.ids[at:at + n])] += 1
            at += n
    assert found == want and len({r.sequence_id for r in got}) == len(got)
    assert K.sequences(no_docs, tokenizer_path()).collect() == []


def test_a_small_cache_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(K, "CACHE_CHUNKS", 5)
    small, rng = K.ChunkIds(tokenizer_path()), random.Random(8)
    for _ in range(50):
        x = words(rng, 40) + rng.choice((".", "!? it's", " #x,", " \u00e9t\u00e9"))
        assert np.frombuffer(small.ids(x.encode()), "<u4").tolist() == small.tokenizer.encode(x, add_special_tokens=False).ids


def test_other_tokenizers_keep_their_ids(tmp_path):
    """One that keeps case, one whose pieces cross white space: tested at load, and encoded whole where they differ."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocab = {c: i for i, c in enumerate([*map(chr, range(33, 127)), " ", "\u00e9", "\t", "\n", "\x0b", "\u00c0", "\u0301"])}
    cased = Tokenizer(models.BPE(vocab=vocab, merges=[]))
    cased.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    across = Tokenizer(models.BPE(vocab=vocab | {"a ": 500, "a b": 501}, merges=[("a", " "), ("a ", "b")]))
    for name, t, by_chunk in (("cased", cased, True), ("across", across, False)):
        t.save(str(tmp_path / name))
        c = K.ChunkIds(str(tmp_path / name))
        assert c.by_chunk == by_chunk and not c.simple
        for x in ("Ab cd!", "a b a b", "Hello, World", " it's"):
            assert np.frombuffer(c.ids(x.encode()), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids


def test_runs_of_texts_look_a_piece_up_once(monkeypatch):
    """Texts are taken in runs; a run asks for each distinct piece once, however often it stands there."""
    import pyarrow as pa

    rng, cache, asked = random.Random(9), K.ChunkIds(tokenizer_path()), []
    known = cache._known
    monkeypatch.setattr(cache, "_known", lambda pieces, simple: asked.append(pieces) or known(pieces, simple))
    texts = [words(rng, rng.randint(0, 30)) + rng.choice(("", " it's", "  Word, word; WORD\x0b", "Été. ", " café2")) for _ in range(60)]
    texts = ["", None, " ", *texts, "long " * 300, None]
    for most in (1, 400, 1 << 23):
        asked.clear()
        found = {}
        for top, run in K._runs(pa.array(texts).slice(1), most):
            ids, at = cache.run_ids(run)
            found |= {top + i: ids[at[i]:at[i + 1]].tolist() for i in range(len(run))}
        assert [found[i] for i in range(len(texts) - 1)] == [cache.tokenizer.encode(x or "", add_special_tokens=False).ids for x in texts[1:]]
        assert all(len(p) == len(set(p)) for p in asked) and len(asked) == {1 << 23: 1}.get(most, len(asked))
