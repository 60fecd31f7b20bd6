"""Zstandard files of independent frames with a trailing seek table.

The layout is the public seekable format: data frames, then (our addition,
ignored by any decoder) a skippable frame with an index, then the seek table
in a skippable frame: compressed size, raw size and the low 32 bits of XXH64
of each data frame, and a footer.  Decompressing the whole file gives the
concatenated payload; a reader that wants one record reads the footer, the
index and that record's frame only.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import xxhash
import zstandard

# Fixed values of the seekable format.
SEEK_FRAME_MAGIC = 0x184D2A5E
INDEX_FRAME_MAGIC = 0x184D2A5D
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80


class CorruptFile(ValueError):
    pass


class SeekableWriter:
    """Cuts what it is given into frames of about ``frame_bytes`` raw bytes;
    one record never spans two frames."""

    def __init__(self, sink, frame_bytes: int = 1 << 18, level: int = 3):
        self.sink, self.frame_bytes = sink, frame_bytes
        self.codec = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.entries: list[tuple[int, int, int]] = []
        self.parts: list[bytes] = []
        self.raw = 0          # bytes in the open frame
        self.bytes_in = 0
        self.bytes_out = 0

    def write(self, record: bytes) -> tuple[int, int]:
        """Append a record; its (frame number, offset in the raw frame)."""
        if self.raw and self.raw + len(record) > self.frame_bytes:
            self._flush()
        place = len(self.entries), self.raw
        self.parts.append(record)
        self.raw += len(record)
        self.bytes_in += len(record)
        return place

    def _flush(self) -> None:
        raw = b"".join(self.parts)
        packed = self.codec.compress(raw)
        self.sink.write(packed)
        self.bytes_out += len(packed)
        self.entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.parts, self.raw = [], 0

    def close(self, index: bytes = b"") -> int:
        """Write the index and the seek table; the file's size in bytes."""
        if self.raw or not self.entries:
            self._flush()
        packed = self.codec.compress(index)
        seek = b"".join(struct.pack("<III", *e) for e in self.entries)
        seek += struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, FOOTER_MAGIC)
        for magic, body in ((INDEX_FRAME_MAGIC, packed), (SEEK_FRAME_MAGIC, seek)):
            self.sink.write(struct.pack("<II", magic, len(body)) + body)
            self.bytes_out += len(body) + 8
        self.sink.close()
        return self.bytes_out


class SeekableReader:
    """Random access over a seekable file (``source``: seek, read, size)."""

    def __init__(self, source, size: int):
        self.source = source
        self.codec = zstandard.ZstdDecompressor()
        tail = self._at(max(0, size - 9), 9)
        if len(tail) < 9:
            raise CorruptFile("no footer")
        n, flags, magic = struct.unpack("<IBI", tail)
        if magic != FOOTER_MAGIC or flags != CHECKSUM_FLAG:
            raise CorruptFile("no seek table at the end")
        table_at = size - 9 - 12 * n
        table = self._at(table_at, 12 * n)
        self.entries = list(struct.iter_unpack("<III", table))
        self.starts = [0]
        for packed, _, _ in self.entries:
            self.starts.append(self.starts[-1] + packed)
        self.index_at, self.index_end = self.starts[-1], table_at - 8

    def _at(self, pos: int, n: int) -> bytes:
        self.source.seek(pos)
        return self.source.read(n)

    def index(self) -> bytes:
        magic, n = struct.unpack("<II", self._at(self.index_at, 8))
        if magic != INDEX_FRAME_MAGIC or self.index_at + 8 + n != self.index_end:
            raise CorruptFile("no index frame")
        return self.codec.decompress(self._at(self.index_at + 8, n))

    def frame(self, k: int) -> bytes:
        """The raw bytes of one frame, checked against size and checksum."""
        packed, size, check = self.entries[k]
        raw = self.codec.decompress(self._at(self.starts[k], packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise CorruptFile(f"frame {k} does not match its checksum")
        return raw


def read_records(reader: SeekableReader, places: list[tuple[int, int, int]],
                 take: Callable[[int, bytes], None]) -> None:
    """Call ``take(i, raw)`` for each (frame, offset, length) in ``places``,
    decompressing every frame that is asked for once."""
    order = sorted(range(len(places)), key=lambda i: places[i])
    held, raw = -1, b""
    for i in order:
        frame, offset, length = places[i]
        if frame != held:
            held, raw = frame, reader.frame(frame)
        take(i, raw[offset:offset + length])
