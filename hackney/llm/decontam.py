"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: a segment holds the postings (sorted
word positions) of some consecutive documents, at most about ``SEGMENT_WORDS``
words unless one document alone is longer.  Segments are built where their
documents are read, without a shuffle, and stored in the shared folder; a word
that every document holds costs each segment its own postings and nothing
else.

Queries come from the benchmark: every window of 13 words of an item (the
whole item, if it is shorter).  Word counts over all segments rank a query's
words; in each segment the list of the rarest word is taken first and
intersected with the other words' lists, shifted by their offsets, until it is
empty or all words are met.  The benchmark is read in blocks of bounded size
and every block meets all segments; no block is dropped.

`phrases` gives exact phrase matches, `proximity` places where an item's words
follow each other in order with at most ``slop`` words between.

Edge cases: words are runs of A-Z a-z 0-9 and non-ASCII characters, A-Z in
lower case; a null or empty text has no words and is never hit; an item
without words or without an id is no query; repeated items count once (by id);
repeated documents are matched one by one; empty tables give results without
hits; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import apart, batch_rows, drop_keys, named_apart, stored, together

WINDOW = 13
SEGMENT_WORDS = 2_000_000
BLOCK_BYTES = 8 << 20         # of benchmark text in one block of queries

# Every byte that is no word byte becomes a blank; A-Z become a-z.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


# ---- the index

INDEX_SCHEMA = ("segment string, doc_ids array<long>, lengths array<int>, digests array<binary>, terms binary, term_ends binary, "
                "post_ends binary, positions binary")


class SegmentBuilder:
    """Postings of the documents given so far.  A document's words take
    consecutive positions; one position is left free behind each document, so
    no phrase crosses from one into the next."""

    def __init__(self):
        self.codes: dict[bytes, int] = {}
        self.stream: list[np.ndarray] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.digests: list[bytes] = []     # MD5 of each text
        self.n_words = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        found, codes = words(text), self.codes
        ids = [codes.setdefault(w, len(codes)) for w in found]
        self.stream.append(np.asarray([*ids, -1], np.int32))
        self.doc_ids.append(doc_id)
        self.lengths.append(len(found))
        self.digests.append(hashlib.md5((text or "").encode()).digest())
        self.n_words += len(found)

    def row(self, name: str) -> tuple:
        stream = np.concatenate(self.stream)
        order = np.argsort(stream, kind="stable").astype(np.int32)[len(self.lengths):]   # the free ones come first
        by_word = sorted(self.codes)
        counts = np.bincount(stream[stream >= 0], minlength=len(by_word))
        ends = np.cumsum(counts)
        codes = np.fromiter((self.codes[w] for w in by_word), np.int64, len(by_word))
        sizes = counts[codes]
        # Positions word by word in sorted word order.
        take = np.repeat(ends[codes] - sizes, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return (name, self.doc_ids, self.lengths, self.digests, b"".join(by_word),
                np.asarray(list(accumulate(map(len, by_word))), "<u4").tobytes(),
                np.cumsum(sizes).astype("<u4").tobytes(), order[take].astype("<i4").tobytes())


class Segment:
    """A stored segment: `postings` finds a word's positions by bisection."""

    def __init__(self, row: dict):
        self.doc_ids, self.lengths = row["doc_ids"], np.asarray(row["lengths"], np.int64)
        self.terms, self.term_ends = row["terms"], np.frombuffer(row["term_ends"], "<u4")
        self.post_ends = np.frombuffer(row["post_ends"], "<u4")
        self.positions = np.frombuffer(row["positions"], "<i4")
        self.doc_starts = np.cumsum(self.lengths + 1) - (self.lengths + 1)

    def _word(self, k: int) -> bytes:
        return self.terms[self.term_ends[k - 1] if k else 0:self.term_ends[k]]

    def postings(self, word: bytes) -> np.ndarray:
        lo, hi = 0, len(self.term_ends)
        while lo < hi:
            mid = (lo + hi) // 2
            if self._word(mid) < word:
                lo = mid + 1
            else:
                hi = mid
        if lo == len(self.term_ends) or self._word(lo) != word:
            return self.positions[:0]
        return self.positions[self.post_ends[lo - 1] if lo else 0:self.post_ends[lo]]

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, positions, side="right") - 1


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The stored index of ``docs``: one row a segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, open_ = TaskContext.get().partitionId(), 0, SegmentBuilder()

        def out() -> pa.RecordBatch:
            name, ids, lengths, digests, *blobs = open_.row(f"{part}-{n}")
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
                 pa.array([digests], pa.list_(pa.binary())), *(pa.array([b], pa.binary()) for b in blobs)],
                ["segment", "doc_ids", "lengths", "digests", "terms", "term_ends", "post_ends", "positions"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                open_.add(doc_id, text)
                if open_.n_words >= segment_words:
                    yield out()
                    n, open_ = n + 1, SegmentBuilder()
        if open_.doc_ids:
            yield out()

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_col)
    return stored(rows.mapInArrow(run, INDEX_SCHEMA), "index")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows one at a time, so that one segment is in Python at once."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


# ---- queries

@dataclass(frozen=True)
class Block:
    """Distinct queries (word tuples) with the items that hold them."""
    items: dict[tuple[bytes, ...], tuple[int, ...]]

    @property
    def vocabulary(self) -> list[bytes]:
        return sorted({w for q in self.items for w in q})


def windows(item_words: Sequence[bytes], size: int = WINDOW) -> set[tuple[bytes, ...]]:
    if not item_words:
        return set()
    return {tuple(item_words[k:k + size]) for k in range(max(1, len(item_words) - size + 1))}


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int | None = WINDOW,
           block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark's queries in blocks of about ``block_bytes`` of text.
    ``size`` None: each item is one query."""
    held: dict[tuple[bytes, ...], set[int]] = {}
    n = 0
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("i is not null")
    for row in rows.toLocalIterator():
        found = words(row.t)
        for q in windows(found, size or len(found)):
            held.setdefault(q, set()).add(row.i)
        n += len(row.t or "")
        if n >= block_bytes:
            yield Block({q: tuple(sorted(i)) for q, i in held.items()})
            held, n = {}, 0
    if held:
        yield Block({q: tuple(sorted(i)) for q, i in held.items()})


def word_counts(index: DataFrame, vocabulary: Sequence[bytes]) -> dict[bytes, int]:
    """How often each word of a block's vocabulary occurs in all segments."""
    asked = index.sparkSession.sparkContext.broadcast(list(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(asked.value), np.int64)
        for row in _segments(batches):
            ends = np.frombuffer(row["post_ends"], "<u4").astype(np.int64)
            sizes = np.diff(ends, prepend=0)
            at = np.frombuffer(row["term_ends"], "<u4").tolist()
            terms = row["terms"]
            places = {terms[a:b]: k for k, (a, b) in enumerate(zip([0, *at], at, strict=False))}
            for j, w in enumerate(asked.value):
                if (k := places.get(w)) is not None:
                    total[j] += sizes[k]
        (seen,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["k", "n"])

    lists = index.select("terms", "term_ends", "post_ends").mapInArrow(run, "k int, n long")
    counts = {vocabulary[r.k]: r.n for r in lists.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    return {w: counts.get(w, 0) for w in vocabulary}


def phrase_starts(segment: Segment, query: Sequence[bytes], order: Sequence[int],
                  lists: dict[bytes, np.ndarray]) -> np.ndarray:
    """Positions at which ``query`` begins: the lists of its words, shifted by
    their offsets, intersected in ``order`` (rarest first)."""
    starts: np.ndarray | None = None
    for k in order:
        word = query[k]
        if word not in lists:
            lists[word] = segment.postings(word)
        here = lists[word]
        if starts is None:
            starts = here - np.int32(k)
        else:
            at = np.searchsorted(here, starts + np.int32(k))
            at[at == len(here)] = 0
            starts = starts[here[at] == starts + np.int32(k)] if len(here) else here
        if not len(starts):
            return starts
    return starts


def rarest_first(query: Sequence[bytes], counts: dict[bytes, int]) -> list[int]:
    return sorted(range(len(query)), key=lambda k: (counts[query[k]], k))


def _hit_rows(index: DataFrame, block: Block, counts: dict[bytes, int], slop: int | None) -> DataFrame:
    """``segment, doc_no, doc_id, item_id, start, length``: every match."""
    possible = [(q, rarest_first(q, counts), items) for q, items in block.items.items() if all(counts[w] for w in q)]
    asked = index.sparkSession.sparkContext.broadcast(possible)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _segments(batches):
            segment, lists = Segment(row), {}
            out: list[list] = [[], [], [], [], []]
            for query, order, items in asked.value:
                if slop is None:
                    starts = phrase_starts(segment, query, order, lists)
                    lengths = np.full(len(starts), len(query))
                else:
                    starts, lengths = near(segment, query, order, slop, lists)
                if not len(starts):
                    continue
                docs = segment.doc_of(starts)
                for item in items:
                    out[0] += docs.tolist()
                    out[1] += [segment.doc_ids[d] for d in docs.tolist()]
                    out[2] += [item] * len(docs)
                    out[3] += (starts - segment.doc_starts[docs]).tolist()
                    out[4] += lengths.tolist()
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["segment"]] * len(out[0])), pa.array(out[0], pa.int32()),
                     *(pa.array(c, pa.int64()) for c in out[1:])],
                    ["segment", "doc_no", "doc_id", "item_id", "start", "length"])

    return index.mapInArrow(run, "segment string, doc_no int, doc_id long, item_id long, start long, length long")


def near(segment: Segment, query: Sequence[bytes], order: Sequence[int], slop: int,
         lists: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the places where the query's words follow each
    other in order within its length plus ``slop`` words.  The rarest word's
    positions are the only places looked at; each word takes the nearest
    position to the word next to it, which keeps the span shortest."""
    for word in query:
        if word not in lists:
            lists[word] = segment.postings(word)
        if not len(lists[word]):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
    anchor = order[0]
    left = right = lists[query[anchor]].astype(np.int64)
    ok = np.ones(len(left), bool)
    for k in range(anchor + 1, len(query)):
        here = lists[query[k]]
        at = np.searchsorted(here, right, side="right")
        ok &= at < len(here)
        right = here[np.minimum(at, len(here) - 1)].astype(np.int64)
    for k in range(anchor - 1, -1, -1):
        here = lists[query[k]]
        at = np.searchsorted(here, left, side="left") - 1
        ok &= at >= 0
        left = here[np.maximum(at, 0)].astype(np.int64)
    ok &= (right - left + 1 <= len(query) + slop)
    ok &= segment.doc_of(left) == segment.doc_of(right)
    return left[ok], (right - left + 1)[ok]


def _matches(index: DataFrame, benchmark: DataFrame, size: int | None, slop: int | None) -> DataFrame | None:
    found = None
    for block in blocks(benchmark, size=size):
        with batch_rows(index.sparkSession, 2):
            hits = stored(_hit_rows(index, block, word_counts(index, block.vocabulary), slop), "hits")
        found = hits if found is None else found.unionByName(hits)
    return found


EMPTY_HITS = "segment string, doc_no int, doc_id long, item_id long, start long, length long"


def phrases(index: DataFrame, benchmark: DataFrame, size: int | None = None) -> DataFrame:
    """Exact matches of whole items (or of their ``size``-word windows):
    ``doc_id, item_id, start, length`` in words of the document."""
    found = _matches(index, benchmark, size, None)
    return (found if found is not None else index.sparkSession.createDataFrame([], EMPTY_HITS)).drop("segment", "doc_no")


def proximity(index: DataFrame, benchmark: DataFrame, slop: int, size: int | None = None) -> DataFrame:
    """Matches of whole items (or windows) in order with at most ``slop``
    further words between: ``doc_id, item_id, start, length``."""
    found = _matches(index, benchmark, size, slop)
    return (found if found is not None else index.sparkSession.createDataFrame([], EMPTY_HITS)).drop("segment", "doc_no")


# ---- contamination

def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_md5``
    for each row of ``docs``: hit words lie inside an occurring window; a
    document is contaminated if they are a twentieth of its words or more."""
    index = build_index(docs, id_col, text_col)
    listed = (index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "lengths", "digests")).alias("doc_no", "d"))
              .select("segment", "doc_no", F.col("d.doc_ids").alias("doc_id"),
                      F.col("d.lengths").cast("long").alias("n_words"), F.col("d.digests").alias("text_md5")))
    found = _matches(index, benchmark, WINDOW, None)
    if found is None:
        found = index.sparkSession.createDataFrame([], EMPTY_HITS)
    # A document has at most one span a start and query length, so its spans
    # are bounded by its own words, whatever the number of items.
    spans = found.groupBy("segment", "doc_no").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    zero = F.lit(0).cast("long")
    hits = spans.select("segment", "doc_no", "items", F.aggregate(
        "spans", F.struct(zero.alias("n"), zero.alias("end")),
        lambda acc, s: F.struct(
            (acc.n + F.greatest(zero, s.start + s.length - F.greatest(s.start, acc.end))).alias("n"),
            F.greatest(acc.end, s.start + s.length).alias("end")),
        lambda acc: acc.n).alias("n_hit"))
    n_hit = F.coalesce("n_hit", zero)
    return (listed.join(hits, ["segment", "doc_no"], "left")
            .select(F.col("doc_id").alias(id_col), "n_words", n_hit.alias("n_hit"),
                    F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")).cast("binary"), 256).alias("items_sha256"),
                    ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), "text_md5"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` without its contaminated rows, all columns as they are.  The
    verdict is a matter of the text alone, so rows are told by its digest."""
    bad = contamination(docs, benchmark, id_col, text_col).where("contaminated").select("text_md5").distinct()
    digest = F.unhex(F.md5(F.coalesce(F.col(named_apart(docs, text_col)), F.lit("")).cast("binary")))
    return together(drop_keys(apart(docs), digest, bad), docs)
