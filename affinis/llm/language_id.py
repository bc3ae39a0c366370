"""Operator 2, language ID: cross-parsing entropy.

Fit: a bounded sample of labelled text per language (``SAMPLE_DOCS``
documents by hash, ``SAMPLE_PIECE`` characters of each, all automata
together at most ``TABLE_CELLS`` cells) is read into one suffix automaton per
language.  The automata are turned into transition tables that are broadcast;
their size does not grow with the data.

Predict: a text is parsed from left to right into longest matches with a
language's sample; a step without transition ends a phrase and starts the
next one at the same character.  The language with the fewest phrases per
character wins.  All texts of a batch take a step at once (numpy); texts are
parsed in windows of ``WINDOW`` characters, each beginning a new phrase, so
memory and time per batch are bounded whatever the length of a text.

Characters are lower-cased letters of the samples, one symbol for all other
letters and one for any run of non-letters.

Cases: a null text or one without a letter is ``und`` with score 0; with no
labelled row every text is ``und``; ties go to the smaller language name;
texts labelled null are predicted but not learned; repeated rows are rows of
their own; other columns, clashing names included, are not read.  Learning
reads text and lang alone, and only of rows whose crc32(doc_id) mod 4 is
not 2; predictions read the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from affinis.llm.common import id_text

SAMPLE_DOCS = 300
SAMPLE_PIECE = 200
SAMPLE_CHARS = 40_000
TABLE_CELLS = 24_000_000
HASH_RANGE = 2 ** 40
WINDOW = 1024
CHARS_AT_ONCE = 2_000_000
UND = "und"


def held_out(doc_id: Column) -> Column:
    """The contract's held-out fold, never learned from."""
    return F.crc32(id_text(doc_id)) % 4 == 2


def _letter_classes() -> np.ndarray:
    """Code point -> lower-case code point of a letter, 0 for anything else."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def _squeezed(text: str) -> str:
    """Lower-cased letters with one blank for each run of other characters."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the start."""
    nexts: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nexts


class Model:
    """Languages, symbols and one table: cell (state, symbol) holds 2 * next row start + (1 if a phrase ends)."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        letters = sorted(set("".join(samples.values())) - {" "})
        self.letters = letters
        width = len(letters) + 2           # blank, others, then the letters
        room = TABLE_CELLS // (2 * width * max(1, len(samples)))
        code = {" ": 0} | {c: i + 2 for i, c in enumerate(letters)}
        parts, starts, base = [], [], 0
        for lang in self.languages:
            nexts = suffix_automaton(samples[lang][:room])
            root = np.full(width, 2 * base * width + 1, np.int64)      # no match at all: the character is a phrase
            for c, t in nexts[0].items():
                root[code[c]] = 2 * (base + t) * width + 1
            cells = np.tile(root, (len(nexts), 1))                     # a step from the start begins a phrase
            for s, row in enumerate(nexts[1:], 1):
                for c, t in row.items():
                    cells[s, code[c]] = 2 * (base + t) * width
            starts.append(base * width)
            parts.append(cells.astype(np.int32 if 2 * TABLE_CELLS + width < 2**31 else np.int64))
            base += len(nexts)
        self.starts = np.array(starts, np.int64)
        self.table = np.concatenate([p.ravel() for p in parts]) if parts else np.zeros(0, np.int32)

    @cached_property
    def symbols(self) -> np.ndarray:
        """Code point -> symbol; made once per Python worker."""
        low = _letter_classes()
        by_low = np.zeros(0x110000, np.uint16)
        by_low[np.unique(low)] = 1
        by_low[0] = 0
        by_low[[ord(c) for c in self.letters]] = np.arange(len(self.letters), dtype=np.uint16) + 2
        return by_low[low]


def _parse(model: Model, sym: np.ndarray, at: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Phrases (language x window) of the windows that begin at ``at`` in ``sym``, longest first."""
    state = np.repeat((2 * model.starts).astype(model.table.dtype)[:, None], len(at), axis=1)
    count = np.zeros(state.shape, np.int32)
    alive = np.searchsorted(-lens, -np.arange(int(lens[0])), side="left")
    for t, k in enumerate(alive.tolist()):
        v = model.table.take((state[:, :k] >> 1) + sym.take(at[:k] + t))
        count[:, :k] += v & 1
        state[:, :k] = v
    return count


def phrase_counts(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language x text) phrases, symbols per text, whether a text has a letter."""
    points = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    sym = model.symbols[points]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths + 1)[:len(sym)]
    blank = sym == 0
    keep = ~blank
    # one blank between two letters of a text: the first blank of a run that follows a letter
    keep[1:] |= blank[1:] & ~blank[:-1]
    sym, owner = sym[keep], owner[keep]
    n = np.bincount(owner, minlength=len(texts))
    letters = np.bincount(owner, weights=sym > 0, minlength=len(texts)) > 0
    total = np.zeros((len(model.languages), len(texts)), np.int64)
    if not len(sym):
        return total, n, letters
    begin = np.concatenate(([0], np.cumsum(n)[:-1]))
    per = -(-n // WINDOW)
    lane_text = np.repeat(np.arange(len(texts)), per)
    lane_no = np.arange(len(lane_text)) - np.repeat(np.cumsum(per) - per, per)
    lane_at = begin[lane_text] + lane_no * WINDOW
    lane_len = np.minimum(n[lane_text] - lane_no * WINDOW, WINDOW)
    order = np.argsort(-lane_len, kind="stable")
    lane_text, lane_at, lane_len = lane_text[order], lane_at[order], lane_len[order]
    phrases = _parse(model, sym, lane_at, lane_len)
    for i in range(len(model.languages)):
        total[i] = np.bincount(lane_text, weights=phrases[i], minlength=len(texts))
    return total, n, letters


def decide(model: Model, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
    """(language, score, whether it has a letter) of each text; score = 1 - fewest / second-fewest phrases."""
    if not model.languages:
        return [UND] * len(texts), [0.0] * len(texts), [any(map(str.isalpha, t)) for t in texts]
    total, _, letters = phrase_counts(model, texts)
    best = total.argmin(axis=0)
    if len(model.languages) > 1:
        low = np.partition(total, 1, axis=0)
        score = 1.0 - low[0] / np.maximum(low[1], 1)
    else:
        score = np.ones(len(texts))
    return ([model.languages[b] if ok else UND for b, ok in zip(best, letters)],
            [float(s) if ok else 0.0 for s, ok in zip(score, letters)], letters.tolist())


def fit(docs: DataFrame) -> Model:
    """Learn from labelled documents outside the held-out fold; the sample that reaches the driver is bounded."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # one row per language; a hash threshold then lets about twice the sample of each language into the shuffle
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model({})
    order = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(HASH_RANGE))
    below = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, HASH_RANGE * 2 * SAMPLE_DOCS // n)])
    sample = (known.where(order < below[F.col("lang")])
              .select("lang", order.alias("h"), F.substring("text", 1, SAMPLE_PIECE).alias("piece"))
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h", "piece")))
              .where(F.col("rank") <= SAMPLE_DOCS).select("lang", "rank", "piece"))
    pieces: dict[str, list[tuple[int, str]]] = {}
    for r in sample.collect():
        pieces.setdefault(r["lang"], []).append((r["rank"], _squeezed(r["piece"])))
    texts = {lang: " ".join(dict.fromkeys(p for _, p in sorted(x) if p))[:SAMPLE_CHARS] for lang, x in pieces.items()}
    return Model({lang: t for lang, t in texts.items() if t})


def predict(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """(rec, text, lang_pred, score, lettered): ``rec`` holds the columns ``carry`` of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("rec"), F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            langs, scores, lettered, part, size = [], [], [], [], 0
            for text in batch.column(1):
                text = text.as_py() or ""
                part.append(text)
                size += len(text) + 1
                if size >= CHARS_AT_ONCE:
                    a, b, c = decide(m, part)
                    langs, scores, lettered, part, size = langs + a, scores + b, lettered + c, [], 0
            if part:
                a, b, c = decide(m, part)
                langs, scores, lettered = langs + a, scores + b, lettered + c
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(lettered, pa.bool_())],
                names=["rec", "text", "lang_pred", "score", "lettered"])

    kind = rows.schema["rec"].dataType.simpleString()
    return rows.mapInArrow(run, f"rec {kind}, text string, lang_pred string, score double, lettered boolean")


def identify(docs: DataFrame) -> DataFrame:
    """Contract columns of every document."""
    return predict(docs, fit(docs), ["doc_id"]).select(
        "rec.doc_id", held_out(F.col("rec.doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that have no letter; a null lang is filled with the prediction, if one was learned."""
    p = predict(docs, fit(docs), [c for c in docs.columns if c != "text"]).where(F.col("lettered"))
    col = {"lang": F.coalesce("rec.lang", F.when(F.col("lang_pred") != UND, F.col("lang_pred"))), "text": F.col("text")}
    return p.select(*[col.get(c, F.col("rec")[c]).alias(c) for c in docs.columns])
