"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash over the last ``WINDOW`` bytes says so, so
equal passages of different documents fall into equal chunks.

1. Every chunk's checksum is counted.  Those met twice mark a bitmap of ``SLOTS``
   bits (native bitmap functions; a fixed 8 MB, whatever the input): an unmarked
   chunk is certainly in one place only.
2. Documents are read once more.  One without a marked chunk is encoded and done
   with where it is read.  Of the others, unmarked stretches are encoded there,
   and marked chunks are named by digest; each task gives a chunk's bytes once.
3. Each distinct marked chunk is encoded once and joined to its uses.  The parts
   of a document come together in order, one document at a time.
4. Joins are repaired: where a cut tears a word, the two torn ends (and whole
   chunks between, if they hold no blank) are encoded anew, up to the blanks on
   both sides.  At a blank the chunks' own ids and those of the whole text agree
   exactly: the normaliser and the split never look across one, and a match of
   the pattern holds none.  A cut beside a blank needs no repair.

A bitmap with false marks, or one that is full, moves more chunks but changes no
id.  Ids and text never depend on where the cuts are.

Within a task, pieces between blanks are remembered (at most about
``CACHE_PIECES``, two generations), so the library's merges run for new ones only.

Edge cases: a null text is encoded as the empty text (no ids); special tokens in
a text are what the file makes of them; repeated rows are encoded one by one; an
empty table gives an empty result; columns other than the id and the text are not
read; a text without blanks or cuts is one chunk up to ``MOST_BYTES``, then cut by size.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hackney.llm.common import map_batches, stored, texts
from hackney.llm.token_files import byte_letters

VOCABULARY = "word_bpe_49k.json"
WINDOW = 16                    # bytes the rolling hash looks at
CUT_BITS = 9                   # a cut at one place in 512
LEAST_BYTES, MOST_BYTES = 128, 16_384
SLOTS = 1 << 26                # bits of the bitmap of chunks met twice (a power of two)
CACHE_PIECES = 200_000


# ---- content-defined chunks

@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    v = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(29)
    return (v * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """The hash of the ``WINDOW`` bytes that end at each place."""
    h, width, factor = _byte_values()[data], 1, 0x85EBCA6B
    while width < WINDOW:
        before = h[:-width] * np.uint32(factor)
        h = h.copy()
        h[width:] += before
        width, factor = width * 2, factor * factor & 0xFFFFFFFF
    return h


def cuts(data: bytes, ends: Sequence[int], cut_bits: int = CUT_BITS, least: int = LEAST_BYTES,
         most: int = MOST_BYTES) -> list[list[int]]:
    """For each text (of UTF-8 ``data`` up to its end) the ends of its chunks.
    Chunks begin at characters."""
    raw = np.frombuffer(data, np.uint8)
    places = np.flatnonzero(rolling_hash(raw) >> np.uint32(32 - cut_bits) == 0) + 1
    places = places[places < len(raw)]
    places = places[raw[places] & 0xC0 != 0x80]
    out, at = [], 0
    for end in ends:
        here = []
        k, last = np.searchsorted(places, [at + least, end])
        marks = places[k:last].tolist()
        k = 0
        while True:
            while k < len(marks) and marks[k] < at + least:
                k += 1
            cut = marks[k] if k < len(marks) else end
            if cut - at > most:
                cut = at + most
                while cut < end and raw[cut] & 0xC0 == 0x80:
                    cut += 1
            if cut >= end:
                break
            here.append(cut)
            at = cut
        here.append(end)
        out.append(here)
        at = end
    return out


# ---- ids of pieces between blanks

@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def id_type(path: str) -> str:
    return "<u2" if load(path).get_vocab_size() <= 1 << 16 else "<u4"


# Letters that the normaliser leaves whole, then at most one sign.
_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")


class Pieces(dict):
    """Ids (as bytes) of pieces without ASCII blanks, encoded when first asked for."""

    def __init__(self, path: str, old: dict | None = None):
        super().__init__()
        self.path, self.old = path, old or {}
        self.tokenizer, self.letter = load(path), "H" if id_type(path) == "<u2" else "I"
        self.model, self.letters = self.tokenizer.model, byte_letters()

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self._encode(piece)
        self[piece] = ids
        return ids

    def _encode(self, piece: bytes) -> bytes:
        text = piece.decode()
        word = _WORD.fullmatch(text)
        if word:         # one match of the pattern, perhaps one more for the sign
            ids = [t.id for part in word.groups() if part
                   for t in self.model.tokenize(part.lower().encode().decode("latin-1").translate(self.letters))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}{self.letter}", *ids)

    def renewed(self) -> Pieces:
        return self if len(self) <= CACHE_PIECES else Pieces(self.path, dict(self))


_PIECES: dict[str, Pieces] = {}       # of this worker


def pieces(path: str) -> Pieces:
    _PIECES[path] = _PIECES[path].renewed() if path in _PIECES else Pieces(path)
    return _PIECES[path]


# ---- encoded chunks and their joins

Part = tuple[bytes, bytes | None, bytes | None, int, int]
# ids; the torn first and last piece (None where the chunk begins or ends with a
# blank), each with the bytes of ids it was given.  Of a chunk without blanks the
# first piece is the last.

_BLANKS = b" \t\n\r\x0b\x0c"


def part(chunk: bytes, known: Pieces) -> Part:
    found = chunk.split()
    ids = list(map(known.__getitem__, found))
    if not found:
        return b"", None, None, 0, 0
    head, tail = chunk[0] not in _BLANKS, chunk[-1] not in _BLANKS
    return (b"".join(ids), found[0] if head else None, found[-1] if tail else None,
            len(ids[0]) if head else 0, len(ids[-1]) if tail else 0)


def join(parts: Sequence[Part], blank: Sequence[bool], known: Pieces) -> bytes:
    """Ids of the text whose chunks were encoded as ``parts``; ``blank`` tells
    chunks without a blank (their head is their tail)."""
    out: list[bytes] = []
    torn: list[bytes] = []         # the open piece, and the ids it has so far if only one chunk gave it
    torn_ids = b""

    def close() -> None:
        if torn:
            out.append(torn_ids if len(torn) == 1 else known[b"".join(torn)])
            torn.clear()

    for (ids, head, tail, n_head, n_tail), whole in zip(parts, blank, strict=True):
        if whole:
            torn.append(head)
            torn_ids = ids
            continue
        if head is None:
            close()
        else:
            torn.append(head)
            torn_ids = ids[:n_head]
            close()
        out.append(ids[n_head:len(ids) - n_tail])
        if tail is not None:
            torn.append(tail)
            torn_ids = ids[len(ids) - n_tail:]
    close()
    return b"".join(out)


def no_blank(chunk: bytes) -> bool:
    found = chunk.split(None, 1)
    return len(found) == 1 and len(found[0]) == len(chunk)


# ---- jobs

def _chunked(column: pa.Array, how: dict) -> Iterator[list[bytes]]:
    raw = [t.encode() for t in texts(column)]
    data = b"".join(raw)
    ends = np.cumsum([len(r) for r in raw]).tolist()
    at = 0
    for here in cuts(data, ends, **how):
        out = []
        for end in here:
            out.append(data[at:end])
            at = end
        yield out


def _digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def met_twice(docs: DataFrame, text_col: str, how: dict) -> bytes:
    """The bitmap: bit ``checksum mod SLOTS`` is set for chunks met twice."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums = b"".join(_digest(c)[:8] for chunks in _chunked(batch.column(0), how) for c in chunks if c)
        return pa.RecordBatch.from_arrays([pa.array(np.frombuffer(sums, "<i8"))], ["sum"])

    slots = (map_batches(docs.select(text_col), run, "sum long").groupBy("sum").agg(F.count("*").alias("n")).where("n > 1")
             .select(F.expr(f"pmod(sum, {SLOTS}) + 1").alias("slot")))
    rows = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()   # SLOTS / 8 bytes at most
    out = bytearray(SLOTS // 8)
    for r in rows:
        out[(r.bucket - 1) * len(r.bits):r.bucket * len(r.bits)] = r.bits
    return bytes(out)


_PART = "ids binary, head binary, tail binary, n_head int, n_tail int, whole boolean"
_PART_KINDS = [pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.bool_()]
_PART_NAMES = ["ids", "head", "tail", "n_head", "n_tail", "whole"]


def _columns(rows: Sequence[tuple], kinds: Sequence[pa.DataType]) -> list[pa.Array]:
    return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]


def _encode_part(chunk: bytes, known: Pieces) -> tuple:
    return (*part(chunk, known), no_blank(chunk))


Finish = Callable[[bytes], tuple]      # ids of one document -> its output columns


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, finish: Finish,
             out: Sequence[tuple[str, pa.DataType, str]], how: dict) -> DataFrame:
    """``id`` and the columns ``out`` (name, Arrow and Spark type) that
    ``finish`` gives for each row's ids."""
    spark = docs.sparkSession
    marked = spark.sparkContext.broadcast(met_twice(docs, text_col, how))
    out_names, out_kinds = [f"out_{c}" for c, _, _ in out], [k for _, k, _ in out]
    out_schema = ", ".join(f"`out_{c}` {t}" for c, _, t in out)

    # One row is a finished document (seq -1), a part of a document (encoded, or
    # named by digest), or the bytes of a marked chunk (row null).
    names = ["row", "doc", "seq", "digest", "data", *_PART_NAMES, *out_names]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), *_PART_KINDS, *out_kinds]
    schema = f"row long, doc long, seq int, digest binary, data binary, {_PART}, {out_schema}"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(marked.value, np.uint8)
        row, given = TaskContext.get().partitionId() << 33, set()
        none_part, none_out = (None,) * len(_PART_NAMES), (None,) * len(out_names)
        for batch in batches:
            rows, known = [], pieces(path)
            for doc, chunks in zip(batch.column(0).to_pylist(), _chunked(batch.column(1), how), strict=True):
                digests = [_digest(c) for c in chunks]
                slots = np.frombuffer(b"".join(d[:8] for d in digests), "<i8") & (SLOTS - 1)
                shared = (bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).tolist()
                row += 1
                if not any(shared):
                    ids = b"".join(map(known.__getitem__, b"".join(chunks).split()))
                    rows.append((row, doc, -1, None, None, *none_part, *finish(ids)))
                    continue
                seq, open_ = 0, []
                for chunk, digest, often in zip([*chunks, None], [*digests, None], [*shared, True], strict=True):
                    if not often:
                        open_.append(chunk)
                        continue
                    if open_:
                        rows.append((row, doc, seq, None, None, *_encode_part(b"".join(open_), known), *none_out))
                        seq, open_ = seq + 1, []
                    if chunk is not None:
                        rows.append((row, doc, seq, digest, None, *none_part, *none_out))
                        seq += 1
                        if digest not in given:
                            given.add(digest)
                            rows.append((None, None, None, digest, chunk, *none_part, *none_out))
            yield pa.RecordBatch.from_arrays(_columns(rows, kinds), names)

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = pieces(path)
        rows = [_encode_part(c, known) for c in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), *_columns(rows, _PART_KINDS)], ["digest", *_PART_NAMES])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, doc, parts, whole = None, None, [], []
        for batch in batches:
            done, known = [], pieces(path)
            for r, d, _, *encoded, blank in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r != row:
                    if row is not None:
                        done.append((doc, *finish(join(parts, whole, known))))
                    row, doc, parts, whole = r, d, [], []
                parts.append(tuple(encoded))
                whole.append(blank)
            if done:
                yield pa.RecordBatch.from_arrays(_columns(done, [pa.int64(), *out_kinds]), ["doc", *out_names])
        if row is not None:
            yield pa.RecordBatch.from_arrays(
                _columns([(doc, *finish(join(parts, whole, pieces(path))))], [pa.int64(), *out_kinds]), ["doc", *out_names])

    rows = stored(docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(first, schema), "chunk-parts")
    done = rows.where("seq = -1").select("doc", *out_names)
    chunks = rows.where("row is null").groupBy("digest").agg(F.first("data").alias("data"))
    coded = map_batches(chunks, encode, f"digest binary, {_PART}")
    place = ["row", "doc", "seq"]
    uses = rows.where("seq >= 0 and digest is not null").select(*place, "digest").join(coded, "digest")
    own = rows.where("seq >= 0 and digest is null")
    parts = own.select(*place, *_PART_NAMES).unionByName(uses.select(*place, *_PART_NAMES))
    mended = parts.repartition("row").sortWithinPartitions("row", "seq").mapInArrow(assemble, f"doc long, {out_schema}")
    return done.unionByName(mended).toDF(id_col, *(c for c, _, _ in out))


def _how(cut_bits: int, least: int, most: int) -> dict:
    return {"cut_bits": cut_bits, "least": least, "most": most}


def encode_texts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 cut_bits: int = CUT_BITS, least: int = LEAST_BYTES, most: int = MOST_BYTES) -> DataFrame:
    """``id, ids (array<int>)`` for each row."""
    path = path or public_tokenizers.path(VOCABULARY)
    kind = id_type(path)
    return _encoded(docs, path, id_col, text_col, lambda ids: (np.frombuffer(ids, kind).astype(np.int32),),
                    [("ids", pa.list_(pa.int32()), "array<int>")], _how(cut_bits, least, most))


@lru_cache(maxsize=2)
def token_texts(path: str) -> list[bytes]:
    """What the library's decoder writes for each id.  The file names no
    decoder, so it writes the vocabulary's strings, joined by blanks."""
    tokenizer = load(path)
    if tokenizer.decoder is not None:
        raise ValueError("made for vocabularies without a decoder")
    return [(tokenizer.id_to_token(k) or "").encode() for k in range(tokenizer.get_vocab_size())]


def decoded(ids: np.ndarray, path: str) -> bytes:
    return b" ".join(map(token_texts(path).__getitem__, ids.tolist()))


def decode_ids(tokens: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, text``: what the library's decoder makes of each row's ids, special
    tokens included (null ids: null)."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [None if x is None else decoded(np.asarray(x, np.int64), path).decode() for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], [id_col, "text"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return map_batches(tokens.select(id_col, ids_col), run, f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
               cut_bits: int = CUT_BITS, least: int = LEAST_BYTES, most: int = MOST_BYTES) -> DataFrame:
    """Encode, decode, and return the digests of both: ``id, n_tokens,
    ids_sha256, decoded_sha256``."""
    path = path or public_tokenizers.path(VOCABULARY)
    kind = id_type(path)

    def finish(raw: bytes) -> tuple:
        ids = np.frombuffer(raw, kind)
        return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(decoded(ids, path)).hexdigest())

    return _encoded(docs, path, id_col, text_col, finish,
                    [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string")],
                    _how(cut_bits, least, most))
