"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Long texts are cut at places where the split pattern always ends a token, so
each piece encodes as it would inside the whole text:

- before a blank that follows a non-blank (no match of the pattern holds a
  non-blank and then white space);
- between a letter and a decimal digit, either way round;
- in a run of white space, before its last character.

A very long run of white space without that last character is one match of the
pattern; it goes to the merges directly, as the library's regex engine runs
out of stack on it.  A run with no safe place (one huge word) is passed whole.  Decoding joins the
vocabulary's raw bytes, so any id sequence decodes, valid UTF-8 or not.

Edge cases: a null text is encoded as the empty text (no ids); repeated rows
are encoded one by one; an empty table gives an empty result; columns other
than the id and the text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from hackney.llm.common import map_batches, texts

RANK_FILE = "byte_bpe_50k.tiktoken"
PIECE_CHARS = 1 << 15
_CUT = re.compile(r"(?<=\S)(?=[ \t\n\r])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[ \t\n\r])(?=[ \t\n\r]\S)")
LONG_RUN = 4096
_SPACE = r"[^\S\x1c-\x1f]"     # what the pattern's engine calls white space
_RUN = re.compile(rf"(?<!{_SPACE}){_SPACE}{{{LONG_RUN},}}")


@lru_cache(maxsize=4)
def encoding(rank_path: str, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    with open(rank_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in pieces of ``size`` characters or a little more, cut at safe
    places only."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def encode(text: str, enc: tiktoken.Encoding, size: int = PIECE_CHARS) -> list[int]:
    if len(text) <= min(size, LONG_RUN):
        return enc.encode_ordinary(text)
    ids: list[int] = []
    at = 0
    for run in _RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        for piece in pieces(text[at:run.start()], size):
            ids += enc.encode_ordinary(piece)
        ids += enc._encode_single_piece(text[run.start():end])
        at = end
    for piece in pieces(text[at:], size):
        ids += enc.encode_ordinary(piece)
    return ids


def encode_texts(docs: DataFrame, rank_path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``id, ids (array<int>)`` for each row."""
    path = rank_path or public_tokenizers.path(RANK_FILE)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoding(path)
        ids = [encode(t, enc, piece_chars) for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, ids array<int>")


def decode_ids(tokens: DataFrame, rank_path: str | None = None, id_col: str = "doc_id",
               ids_col: str = "ids") -> DataFrame:
    """``id, data (binary)``: the raw bytes of each row's ids (null ids: null)."""
    path = rank_path or public_tokenizers.path(RANK_FILE)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoding(path)
        data = [None if x is None else enc.decode_bytes(x) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], [id_col, "data"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return map_batches(tokens.select(id_col, ids_col), run, f"`{id_col}` {kind}, data binary")


def round_trip(docs: DataFrame, rank_path: str | None = None, id_col: str = "doc_id",
               text_col: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Encode, decode, and return the digests of both: ``id, n_tokens,
    ids_sha256, decoded_sha256``.  Ids and bytes never leave the task."""
    path = rank_path or public_tokenizers.path(RANK_FILE)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoding(path)
        n, ids_sha, data_sha = [], [], []
        for text in texts(batch.column(1)):
            ids = encode(text, enc, piece_chars)
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
            data_sha.append(hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(data_sha, pa.string())],
            [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run,
                       f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
