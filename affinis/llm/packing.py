"""Operator 6, packing: first-fit decreasing with a tournament tree of bin capacities.

1. Tokenise: every whole text becomes its ids and an end id.  Arrow splits a
   run of texts (``RUN_BYTES``) at white space, numbers the distinct chunks, cuts
   the simple ones into their two pieces and numbers those.  The ids of each
   piece come through a bounded cache of two generations, so a frequent one is
   encoded once per Python worker; numpy lays them out by the numbers.  Whether
   chunks and pieces give the tokenizer's own ids is tested when it is loaded;
   a tokenizer that fails takes whole chunks, or whole texts.
2. Cut: a document longer than a sequence becomes full pieces and a rest.
   The piece table (no ids) is written to the shared folder.
3. Pack: pieces are dealt to groups at random, by a hash of their written
   place, and each group is packed on its own: by falling length, each into
   the first sequence with room.  The tournament tree holds the largest
   free room of every subtree, so a step costs the logarithm of the bins.

``pack`` decides on lengths alone.  ``sequences`` carries the ids along and
puts out each sequence's ids.

A group is bounded (``GROUP_PIECES`` on average), so no task grows with the
data, and a hot source or a very long document is spread over all groups.

Cases: null and empty texts have the end id alone; repeated rows are
documents of their own; an empty table gives no rows; other input columns
are not read.
"""

from __future__ import annotations

import math
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from affinis.llm.common import rows_a_batch
from affinis.session import stage

# Sequence length and end id of the contract.
CAPACITY = 2048
END_ID = 1
GROUP_PIECES = 8192
#: Entries of each of the two generations of a worker's cache.
CACHE_CHUNKS = 125_000
#: Texts that are on their way to a Python worker at a time; the buffers on both sides grow with them.
BATCH_DOCS = 2000
#: Bytes of the texts that are split at once; a longer text is a run of its own.
RUN_BYTES = 1 << 23

# a chunk of Latin letters (ASCII, or U+00C0 to U+00FF without the two signs), then ASCII punctuation without the
# apostrophe: two pieces at most, whatever stands around it
_SIMPLE = "^(?P<letters>[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]*)(?P<rest>[!-&(-/:-@\\[-`{-~]*)$"
# byte-level BPE spells a byte as the character of its number, bytes without a visible one as those from 256 on
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
_SPELLED = {b: 256 + i for i, b in enumerate(_HIDDEN)}
# what a tokenizer must treat alike whole and by chunks, and by its pieces
_PROBES = ["Hello, world!!! (yes) a_b $5", "ab  cd\tEF\n gh\x0b.", "it's don't -- x", "caf\u00e9 \u00c0\u0301 12 3.4", "z", "word#tag;END", "... a.b.c",
           " ".join(map(chr, range(0xC0, 0x100))), "".join(map(chr, range(0xC0, 0xD7)))]


def _laid_out(table: np.ndarray, size: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of ``table`` (entry k is ``size[k]`` long) in the order of ``number``, and where each ends."""
    long = size[number]
    end = np.cumsum(long)
    first = np.cumsum(size) - size
    return table[np.repeat(first[number] - (end - long), long) + np.arange(long.sum())], end


class ChunkIds:
    """Ids of texts by white-space chunks and their pieces, through a cache: piece (UTF-8) -> its ids as
    little-endian unsigned 32-bit bytes.

    A full generation becomes the old one, from which pieces that are met again return.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        words = [w for p in _PROBES for w in _words(p)]
        self.by_chunk = all(self._whole(p) == b"".join(self._whole(w) for w in _words(p)) for p in _PROBES)
        self.simple = self.by_chunk
        if self.simple:
            ids, at = self.run_ids(pa.array(words))
            self.simple = all(ids[a:b].tobytes() == self._whole(w) for w, a, b in zip(words, at, at[1:], strict=False))
            self.pieces.clear()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _made(self, piece: str) -> bytes:
        """Ids of a lower-cased piece: the model alone, as nothing but its bytes' spelling goes before it."""
        spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_SPELLED)
        found = self.model.tokenize(spelled)
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def _known(self, pieces: list[str], simple: list[bool]) -> list[bytes]:
        out = []
        for piece, plain in zip(pieces, simple, strict=True):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.old.get(piece)
                if ids is None:
                    ids = (self._made(piece) if plain else self._whole(piece)) if piece else b""
                if len(self.pieces) >= CACHE_CHUNKS:
                    self.old, self.pieces = self.pieces, {}
                self.pieces[piece] = ids
            out.append(ids)
        return out

    def ids(self, text: bytes) -> bytes:
        return self.run_ids(pa.array([text.decode()]))[0].tobytes()

    def run_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a run of texts (no nulls), and where each text's begin, with the end of the last."""
        if not self.by_chunk:
            each = [np.frombuffer(self._whole(t.as_py()), "<u4") for t in texts]
            return np.concatenate([np.zeros(0, "<u4"), *each]), np.cumsum([0, *map(len, each)])
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        one = chunks.dictionary
        parts = pc.extract_regex(one, _SIMPLE) if self.simple else pa.nulls(len(one), pa.struct([("letters", one.type), ("rest", one.type)]))
        letters, rest = (pc.struct_field(parts, f) for f in ("letters", "rest"))
        # a chunk is two pieces: letters and rest, or itself and nothing; none of the one sort is one of the other
        pieces = pa.concat_arrays([pc.coalesce(pc.utf8_lower(letters), one), pc.fill_null(rest, "")]).dictionary_encode()
        distinct = pieces.dictionary
        simple = pc.is_valid(pc.extract_regex(distinct, _SIMPLE)) if self.simple else pc.equal(distinct, "")
        known = self._known(distinct.to_pylist(), simple.to_pylist())
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        pair = pieces.indices.to_numpy(zero_copy_only=False).reshape(2, -1)
        table, _ = _laid_out(np.frombuffer(b"".join(known), "<u4"), size, pair.T.ravel())
        ids, end = _laid_out(table, size[pair[0]] + size[pair[1]], chunks.indices.to_numpy(zero_copy_only=False))
        first = split.offsets.to_numpy() - split.offsets[0].as_py()
        return ids, np.concatenate([[0], end])[first]


def _words(text: str) -> list[str]:
    return [w.decode() for w in text.encode().split()]


def _runs(texts: pa.Array, most: int = RUN_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of consecutive rows with about ``most`` bytes together; null is the empty text."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(size) - size) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            yield a, texts.slice(a, b - a)


_WORKER: dict[str, ChunkIds] = {}


def chunk_ids(path: str) -> ChunkIds:
    if path not in _WORKER:
        _WORKER[path] = ChunkIds(path)
    return _WORKER[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): every document's ids in pieces of at most ``capacity``."""
    end = np.array([end_id], "<u4").tobytes()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = chunk_ids(tokenizer_path)
        for batch in batches:
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for top, texts in _runs(batch.column(1)):
                found, at = cache.run_ids(texts)
                for i in range(len(texts)):
                    raw = found[at[i]:at[i + 1]].tobytes() + end
                    n = len(raw) // 4
                    for s in range(0, n, capacity):
                        part = raw[4 * s:4 * (s + capacity)]
                        row.append(top + i)
                        start.append(s)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        total.append(n)
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            cols = [batch.column(0).take(pa.array(row, pa.int64()))]
            cols += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                                             + ["ids"] * with_ids)

    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def first_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each item, items in the given order, each into the first bin with room.

    The tournament tree is an array: leaf ``size + b`` holds bin b's room, an
    inner node the larger room of its two children.
    """
    size = 1
    while size < max(1, len(lengths)):
        size *= 2
    room = [capacity] * (2 * size)
    bins, offsets = [], []
    for n in lengths:
        node = 1
        while node < size:
            node *= 2
            if room[node] < n:
                node += 1
        bins.append(node - size)
        offsets.append(capacity - room[node])
        room[node] -= n
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (any columns with a ``length`` of 1 to ``capacity``) with sequence_id and offset."""
    with rows_a_batch(pieces.sparkSession, BATCH_DOCS):
        placed = stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, math.ceil(placed.count() / group_pieces))

    def pack_group(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "_place"], ascending=[False, True], kind="stable")
        bins, offsets = first_fit(pdf["length"].tolist(), capacity)
        return pdf.drop(columns=["_place", "_group"]).assign(
            sequence_id=np.array(bins, np.int64) + (int(key[0]) << 32), offset=np.array(offsets, np.int64))

    # ids stay where they are until their sequence is known; small columns travel along
    wide = [f.name for f in pieces.schema if not isinstance(f.dataType, (NumericType, StringType))]
    slim = placed.drop(*wide).withColumn("_place", F.xxhash64("_row")).withColumn("_group", F.pmod("_place", F.lit(groups)))
    if not wide:
        slim = slim.drop("_row")
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema if f.name not in ("_place", "_group"))
    packed = slim.groupBy("_group").applyInPandas(pack_group, f"{out}, sequence_id long, offset long")
    return packed.join(placed.select("_row", *wide), "_row").drop("_row") if wide else packed


def sequences(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
              group_pieces: int = GROUP_PIECES) -> DataFrame:
    """(sequence_id, length, ids, doc_ids, lengths): each sequence's ids, with the documents of its pieces in order."""
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id, with_ids=True)
    one = pack(pieces.select("doc_id", "length", "ids"), capacity, group_pieces).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids"))).alias("p"))
    return one.select("sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("length"),
                      F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"),
                      F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"), F.transform("p", lambda x: x["length"]).alias("lengths"))


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    return pack(token_pieces(docs, tokenizer_path))
