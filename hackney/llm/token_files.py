"""Token ids in seekable Zstandard files, in ascending document order.

Documents are range-partitioned and sorted by id, encoded, closed with the end
id and written as little-endian unsigned 16-bit ids (32-bit for a vocabulary
beyond 65,536) in independent frames (see `seekable`).  A document never spans
two frames, and each file's index names every document's frame, offset and
length, so a reader decompresses the frames it asks for and no others.  The
manifest (one row a file) is a table; a file counts only if the manifest of
the committed task names it, so files of failed attempts are never read.

Encoding: the tokenizers library encodes a distinct piece of text once and a
worker remembers it.  Texts are cut before every blank that follows a
non-blank, and around a single line end between non-blanks; the byte-level
pattern ends a match there, so the pieces' ids joined are the whole text's ids.

Edge cases: a null text is encoded as the empty text (the end id alone); rows
with equal ids keep one row each, ordered by their text's hash; null ids sort
first; an empty table gives no file and an empty manifest; columns other than
the id and the text are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hackney.llm.common import open_in, open_out, shared_path, shuffle_partitions, stored, texts
from hackney.llm.seekable import SeekableReader, SeekableWriter, read_records

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
FILE_TOKENS = 1 << 24          # a file is closed at this many ids
CACHE_PIECES = 700_000         # distinct pieces a worker remembers (twice)

# Two white-space characters in a row, as Unicode and Python count them: a cut
# inside would split one match of the pattern.
_RUN = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= )")
# Latin letters, perhaps with full stops or commas behind: one or two matches
# of the byte-level pattern, known without running it.
_WORD = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]*)([.,]*)")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet's rule: printable Latin-1 stands for itself, the
    other bytes for the code points from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = byte_letters()


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    """The file's tokenizer with the library's own settings: the string of a
    special token in a text is that token."""
    return Tokenizer.from_file(path)


class Pieces(dict):
    """Ids (bytes of ``dtype``) of pieces behind a ``lead`` (a blank or
    nothing), encoded when first asked for; ``old`` holds those of before."""

    def __init__(self, tokenizer: Tokenizer, dtype: str, lead: str, old: dict | None = None):
        super().__init__()
        self.tokenizer, self.dtype, self.lead, self.old = tokenizer, dtype, lead, old or {}
        self.model = tokenizer.model

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self._encode(piece)
        self[piece] = ids
        return ids

    def _encode(self, piece: str) -> bytes:
        word = _WORD.fullmatch(piece)
        if word is None or not word[1]:
            return self._bytes(self.tokenizer.encode(self.lead + piece, add_special_tokens=False).ids)
        ids = self._merge(self.lead + word[1]) if not word[2] else self[word[1]]
        return ids + self._merge(word[2]) if word[2] else ids

    def _merge(self, letters: str) -> bytes:
        """The library's BPE model on one match of the pattern."""
        mapped = letters.encode().decode("latin-1").translate(_LETTERS)
        return self._bytes([t.id for t in self.model.tokenize(mapped)])

    def _bytes(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.dtype == '<u2' else 'I'}", *ids)


class Encoder:
    """Ids of texts by their pieces.  A worker keeps at most about ``cache``
    pieces of either of two generations; a full one becomes the old one."""

    def __init__(self, tokenizer: Tokenizer, dtype: str, cache: int = CACHE_PIECES):
        self.cache = cache
        self.heads, self.words, self.wholes = (Pieces(tokenizer, dtype, lead) for lead in ("", " ", ""))
        self.newline = self.wholes["\n"]
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def _renewed(self, known: Pieces) -> Pieces:
        if len(known) <= self.cache:
            return known
        return Pieces(known.tokenizer, known.dtype, known.lead, dict(known))

    def _text(self, text: str) -> bytes:
        if any(token in text for token in self.special):     # it cuts the text where the pieces do not
            return self.heads._bytes(self.heads.tokenizer.encode(text, add_special_tokens=False).ids)
        if _RUN.search(text):
            return b"".join(map(self.wholes.__getitem__, _CUT.split(text)))
        words = self.words.__getitem__
        lines = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            lines.append(self.heads[head] + b"".join(map(words, rest)))
        return self.newline.join(lines)

    def encode(self, batch: Sequence[str]) -> list[bytes]:
        out = list(map(self._text, batch))
        self.heads, self.words, self.wholes = map(self._renewed, (self.heads, self.words, self.wholes))
        return out


_ENCODERS: dict[tuple, Encoder] = {}      # of this worker


def encoder(path: str, dtype: str) -> Encoder:
    if (path, dtype) not in _ENCODERS:
        _ENCODERS[path, dtype] = Encoder(load(path), dtype)
    return _ENCODERS[path, dtype]


class TokenFile:
    """One file being written: frames of ids, then the document index."""

    def __init__(self, uri: str, dtype: str, frame_bytes: int):
        self.uri, self.dtype = uri, dtype
        self.out = SeekableWriter(open_out(uri), frame_bytes)
        self.places: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.n_tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.places.append((*self.out.write(ids), len(ids)))
        self.ids.append(doc_id)
        self.n_tokens += len(ids) // np.dtype(self.dtype).itemsize

    def close(self) -> int:
        places = np.asarray(self.places, "<u4").reshape(-1, 3)
        ids = np.asarray([i or 0 for i in self.ids], "<i8")
        null = np.asarray([i is None for i in self.ids], "u1")
        head = struct.pack("<4sI", np.dtype(self.dtype).str.encode().ljust(4), len(ids))
        return self.out.close(head + ids.tobytes() + null.tobytes() + places.tobytes())


def write(docs: DataFrame, vocabulary: str | None = None, root: str | None = None, id_col: str = "doc_id",
          text_col: str = "text", end_id: int = END_ID, file_tokens: int = FILE_TOKENS,
          frame_bytes: int = 1 << 18) -> DataFrame:
    """Write the token files below ``root`` (default: a new shared folder); the
    manifest: ``part, file_no, path, n_docs, n_tokens, n_bytes``, whose order by
    (part, file_no) is the documents' order."""
    spark = docs.sparkSession
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    root = root or shared_path(spark, "tokens")
    dtype = "<u2" if load(path).get_vocab_size() <= 1 << 16 else "<u4"
    end = np.asarray([end_id], dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt, enc = TaskContext.get().partitionId(), uuid.uuid4().hex, encoder(path, dtype)
        done: list[tuple] = []
        file: TokenFile | None = None

        def close() -> None:
            done.append((part, len(done), file.uri, len(file.ids), file.n_tokens, file.close()))

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode(texts(batch.column(1))), strict=True):
                if file is None:
                    file = TokenFile(f"{root}/part-{part:06d}-{len(done):04d}-{attempt}.tok.zst", dtype, frame_bytes)
                file.add(doc_id, ids + end)
                if file.n_tokens >= file_tokens:
                    close()
                    file = None
        if file is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*done, strict=True),
                 (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["part", "file_no", "path", "n_docs", "n_tokens", "n_bytes"])

    key = [F.col(id_col), F.xxhash64(text_col)]
    sorted_docs = (docs.select(F.col(id_col).cast("long").alias(id_col), text_col)
                   .repartitionByRange(shuffle_partitions(spark), *key).sortWithinPartitions(*key))
    return stored(sorted_docs.mapInArrow(
        run, "part int, file_no int, path string, n_docs long, n_tokens long, n_bytes long"), "token-manifest")


def open_file(uri: str) -> tuple[SeekableReader, str, list[int | None], list[tuple[int, int, int]]]:
    """(reader, dtype, document ids, places) of a token file."""
    source = open_in(uri)
    reader = SeekableReader(source, source.size())
    raw = reader.index()
    kind, n = struct.unpack_from("<4sI", raw)
    ids = np.frombuffer(raw, "<i8", n, 8).tolist()
    null = np.frombuffer(raw, "u1", n, 8 + 8 * n).tolist()
    places = np.frombuffer(raw, "<u4", 3 * n, 8 + 9 * n).reshape(-1, 3).tolist()
    return (reader, kind.decode().strip(), [None if z else i for i, z in zip(ids, null, strict=True)],
            [tuple(p) for p in places])


def read_documents(uri: str, wanted: set[int]) -> list[tuple[int, np.ndarray]]:
    """(id, ids) of the wanted documents of one file, by their frames alone."""
    reader, dtype, ids, places = open_file(uri)
    at = [k for k, i in enumerate(ids) if i in wanted]
    found: dict[int, np.ndarray] = {}
    read_records(reader, [places[k] for k in at], lambda k, raw: found.update({at[k]: np.frombuffer(raw, dtype)}))
    return [(ids[k], found[k]) for k in at]


def digest(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Read every file of the manifest back: ``id, start, n_tokens, ids_crc32``
    for each document; ``start`` counts the ids of all documents before it."""
    before = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader, dtype, ids, places = open_file(uri)
                sizes = np.asarray([p[2] for p in places], np.int64) // np.dtype(dtype).itemsize
                starts = base + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
                crc = [0] * len(ids)

                def take(k: int, raw: bytes, crc=crc, dtype=dtype) -> None:
                    crc[k] = zlib.crc32(np.frombuffer(raw, dtype).astype("<u4").tobytes())

                read_records(reader, places, take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(starts), pa.array(sizes), pa.array(crc, pa.int64())],
                    [id_col, "start", "n_tokens", "ids_crc32"])

    n = shuffle_partitions(manifest.sparkSession)
    return files.repartition(n, "path").mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")
