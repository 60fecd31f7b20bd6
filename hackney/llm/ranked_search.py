"""Ranked lexical search: accumulator-limited, term at a time.

The index is partitioned by document.  A segment holds the postings (document
number, occurrences) of some consecutive documents, at most about
``SEGMENT_WORDS`` words unless one document alone is longer, and per term the
most occurrences and the shortest document of its list, which bound what the
term can add.  Segments are built where their documents are read, without a
shuffle, so a term that every document holds costs each segment its own list.

A query's terms are taken rarest first.  While a document that no earlier term
met could still reach the k best, each posting opens an accumulator.  Once the
bounds of the terms left add up to less than the kth best partial score, no
accumulator is opened any more: the open ones are updated exactly by looking
their documents up in the remaining lists, and those that fall behind for good
are closed.  The kth score of a task's earlier segments counts as well.

Each task gives its k best a query.  The best kth place that any task reached
bounds the k best of all, so only rows at or above it are ranked: about k a
query, whatever the number of tasks.  Queries are read in blocks of bounded
size; every block meets all segments.

All scores are 64-bit integers:
``w = floor(1000 ln((2N + 2) / (2df + 1)))`` for a term, ``m = 50 + 50 n N div L``
for a document, ``sum of w * (10^9 tf div (1000 tf + 20 m))``.

Edge cases: terms are runs of A-Z a-z 0-9 and non-ASCII characters, A-Z in
lower case, whole texts; a null or empty text has none, is not counted in N and
is never found; a query without terms or without an id finds nothing; rows of
one query id are one query (its terms once each); repeated documents are ranked
one by one; a document without an id is ranked behind equal scores with one;
empty tables give an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hackney.llm.common import batch_rows, stored
from hackney.llm.decontam import words

SEGMENT_WORDS = 2_000_000
BLOCK_TERMS = 200_000         # query terms in one block of queries
BLOCK_QUERIES = 20_000        # queries in one block
TOP = 50

INDEX_SCHEMA = ("doc_ids array<long>, lengths binary, terms binary, term_ends binary, post_ends binary, "
                "docs binary, counts binary, most binary, shortest binary")


# ---- the index

class SegmentBuilder:
    """The words of the documents given so far."""

    def __init__(self):
        self.codes: dict[bytes, int] = {}
        self.stream: list[np.ndarray] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.n_words = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        found, codes = words(text), self.codes
        self.stream.append(np.asarray([codes.setdefault(w, len(codes)) for w in found], np.int64))
        self.doc_ids.append(doc_id)
        self.lengths.append(len(found))
        self.n_words += len(found)

    def columns(self) -> list[pa.Array]:
        """One segment as the columns of the index: terms in sorted order, each
        with its documents in ascending order."""
        by_word = sorted(self.codes)
        place = np.empty(len(by_word), np.int64)
        place[np.fromiter((self.codes[w] for w in by_word), np.int64, len(by_word))] = np.arange(len(by_word))
        lengths = np.asarray(self.lengths, np.int64)
        n_docs = max(1, len(lengths))
        keys = place[np.concatenate(self.stream)] if by_word else np.zeros(0, np.int64)
        keys = np.sort(keys * n_docs + np.repeat(np.arange(len(lengths)), lengths))
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        counts = np.diff(first, append=len(keys))
        terms, docs = np.divmod(keys[first], n_docs)
        starts = np.searchsorted(terms, np.arange(len(by_word)))
        most = np.maximum.reduceat(counts, starts) if by_word else counts
        shortest = np.minimum.reduceat(lengths[docs], starts) if by_word else counts
        blobs = [lengths.astype("<i4"), b"".join(by_word), np.fromiter(accumulate(map(len, by_word)), "<u4", len(by_word)),
                 np.append(starts[1:], len(docs)).astype("<u4") if by_word else starts.astype("<u4"),
                 docs.astype("<i4"), counts.astype("<i4"), most.astype("<i4"), shortest.astype("<i4")]
        return [pa.array([self.doc_ids], pa.list_(pa.int64())),
                *(pa.array([b if isinstance(b, bytes) else b.tobytes()], pa.binary()) for b in blobs)]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The stored index of ``docs``: one row a segment."""
    names = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = SegmentBuilder()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                open_.add(doc_id, text)
                if open_.n_words >= segment_words:
                    yield pa.RecordBatch.from_arrays(open_.columns(), names)
                    open_ = SegmentBuilder()
        if open_.doc_ids:
            yield pa.RecordBatch.from_arrays(open_.columns(), names)

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return stored(rows.mapInArrow(run, INDEX_SCHEMA), "ranked-index")


class Segment:
    """A stored segment; `find` gives a term's place by bisection."""

    def __init__(self, row: dict, n: int, total: int):
        self.doc_ids = row["doc_ids"]
        self.terms, self.term_ends = row["terms"], np.frombuffer(row["term_ends"], "<u4")
        self.post_ends = np.frombuffer(row["post_ends"], "<u4")
        self.docs, self.counts = np.frombuffer(row["docs"], "<i4"), np.frombuffer(row["counts"], "<i4")
        self.most, self.shortest = np.frombuffer(row["most"], "<i4"), np.frombuffer(row["shortest"], "<i4")
        lengths = np.frombuffer(row["lengths"], "<i4").astype(np.int64)
        self.n, self.total = n, total
        self.norms = 20 * norm(lengths, n, total)
        self._whole: dict[int, np.ndarray] = {}

    def find(self, word: bytes) -> int:
        lo, hi, ends, terms = 0, len(self.term_ends), self.term_ends, self.terms
        while lo < hi:
            mid = (lo + hi) // 2
            if terms[ends[mid - 1] if mid else 0:ends[mid]] < word:
                lo = mid + 1
            else:
                hi = mid
        return lo if lo < len(ends) and terms[ends[lo - 1] if lo else 0:ends[lo]] == word else -1

    def span(self, k: int) -> tuple[int, int]:
        return (int(self.post_ends[k - 1]) if k else 0), int(self.post_ends[k])

    def bound(self, k: int) -> int:
        """No document's `impact` of term ``k`` is larger."""
        tf = int(self.most[k])
        return 1_000_000_000 * tf // (1000 * tf + 20 * int(norm(int(self.shortest[k]), self.n, self.total)))

    def impacts(self, at: np.ndarray | slice) -> np.ndarray:
        tf = self.counts[at].astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + self.norms[self.docs[at]])

    def whole(self, k: int) -> np.ndarray:
        """`impacts` of a whole list, kept for the block's other queries."""
        if k not in self._whole:
            self._whole[k] = self.impacts(slice(*self.span(k)))
        return self._whole[k]


def norm(n_words, n: int, total: int):
    """A document's length against the mean, 100 at the mean (int or array)."""
    return 50 + 50 * n_words * n // total


# ---- queries

@dataclass(frozen=True)
class Block:
    """Query ids, and each query's distinct terms as numbers into ``terms``."""
    ids: list[int]
    queries: list[list[int]]
    terms: list[bytes]


def blocks(queries: DataFrame, id_col: str, text_col: str, block_terms: int = BLOCK_TERMS,
           block_queries: int = BLOCK_QUERIES) -> Iterator[Block]:
    """The queries in blocks of bounded size.  The driver holds one at a time;
    rows come by id, so that the rows of one id are in one block."""
    held: dict[int, set[int]] = {}
    codes: dict[bytes, int] = {}
    rows = (queries.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
            .where("i is not null and t is not null").orderBy("i"))
    for row in rows.toLocalIterator():
        if row.i not in held and (len(codes) >= block_terms or len(held) >= block_queries):
            yield Block(list(held), [sorted(q) for q in held.values()], list(codes))
            held, codes = {}, {}
        held.setdefault(row.i, set()).update(codes.setdefault(w, len(codes)) for w in words(row.t))
    if held:
        yield Block(list(held), [sorted(q) for q in held.values()], list(codes))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def corpus_size(index: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms in all documents)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(b, "<i4") for b in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int((x > 0).sum()) for x in found], pa.int64()),
                                              pa.array([int(x.sum(dtype=np.int64)) for x in found], pa.int64())], ["n", "total"])

    row = index.select("lengths").mapInArrow(run, "n long, total long").agg(F.sum("n").alias("n"), F.sum("total").alias("l")).first()
    return row.n or 0, row.l or 0


def document_counts(index: DataFrame, terms: list[bytes]) -> np.ndarray:
    """In how many documents each of a block's terms occurs."""
    asked = index.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(asked.value), np.int64)
        for row in _segments(batches):
            sizes = np.diff(np.frombuffer(row["post_ends"], "<u4").astype(np.int64), prepend=0)
            at, text = np.frombuffer(row["term_ends"], "<u4").tolist(), row["terms"]
            for j, (a, b) in enumerate(zip([0, *at], at, strict=False)):
                if (k := asked.value.get(text[a:b])) is not None:
                    total[k] += sizes[j]
        (seen,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["k", "n"])

    counts = np.zeros(len(terms), np.int64)
    found = index.select("terms", "term_ends", "post_ends").mapInArrow(run, "k int, n long")
    for r in found.groupBy("k").agg(F.sum("n").alias("n")).collect():    # at most a block's terms
        counts[r.k] = r.n
    return counts


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


# ---- term at a time

def best(segment: Segment, terms: list[tuple[int, int]], top: int, reached: int) -> tuple[np.ndarray, np.ndarray]:
    """(document numbers, scores) of ``segment`` for a query of ``terms`` (place
    in the segment, weight), rarest first: every document among the segment's
    ``top`` best that scores above 0 and at least ``reached``."""
    left = [w * segment.bound(k) for k, w in terms]
    left = [*list(accumulate(reversed(left)))[::-1], 0]      # what the terms from here on can add
    scores = np.zeros(len(segment.norms), np.int64)
    need, step = max(reached, 1), 0
    while step < len(terms) and left[step] >= need:           # a document not met so far may still get in
        k, w = terms[step]
        scores[segment.docs[slice(*segment.span(k))]] += w * segment.whole(k)
        step += 1
        if len(scores) >= top:
            need = max(need, int(np.partition(scores, -top)[-top]))
    open_ = np.flatnonzero(scores)                             # no accumulator is opened from here on
    held = scores[open_]
    while len(open_):
        if len(open_) >= top:
            need = max(need, int(np.partition(held, -top)[-top]))
        ahead = held + left[step] >= need
        open_, held = open_[ahead], held[ahead]
        if step == len(terms):
            break
        k, w = terms[step]
        lo, hi = segment.span(k)
        docs = segment.docs[lo:hi]
        at = np.searchsorted(docs, open_)
        at[at == len(docs)] = 0
        (hit,) = np.nonzero(docs[at] == open_)
        held[hit] += w * segment.impacts(lo + at[hit])
        step += 1
    return open_, held


def _search_block(index: DataFrame, block: Block, n: int, total: int, top: int) -> DataFrame:
    """``item_id, doc_id, score, kth_score, kth_doc``: each task's ``top`` best a
    query, with its last place (null if it has fewer)."""
    counts = document_counts(index, block.terms)
    weights = [weight(n, df) if df else 0 for df in counts.tolist()]
    queries = [sorted((t for t in q if weights[t] > 0), key=lambda t: (counts[t], t)) for q in block.queries]
    asked = index.sparkSession.sparkContext.broadcast((block.ids, queries, block.terms, weights))

    def order(row: tuple) -> tuple:
        score, doc_id = row
        return (-score, doc_id is None, doc_id or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, terms, weights = asked.value
        used = sorted({t for q in queries for t in q})
        found: list[list[tuple]] = [[] for _ in ids]
        for row in _segments(batches):
            segment = Segment(row, n, total)
            places = {t: segment.find(terms[t]) for t in used}
            for q, query in enumerate(queries):
                here = [(places[t], weights[t]) for t in query if places[t] >= 0]
                reached = found[q][-1][0] if len(found[q]) == top else 0
                docs, scores = best(segment, here, top, reached)
                if len(docs):
                    rows = zip(scores.tolist(), (segment.doc_ids[d] for d in docs.tolist()), strict=True)
                    found[q] = sorted([*found[q], *rows], key=order)[:top]
        for q, rows in enumerate(found):
            if rows:
                kth = rows[-1] if len(rows) == top else (None, None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x] * len(rows), pa.int64()) if k in (0, 3, 4) else pa.array(x, pa.int64())
                     for k, x in enumerate([ids[q], [d for _, d in rows], [s for s, _ in rows], *kth])],
                    ["item_id", "doc_id", "score", "kth_score", "kth_doc"])

    return index.mapInArrow(run, "item_id long, doc_id long, score long, kth_score long, kth_doc long")


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           query_id_col: str = "item_id", query_text_col: str = "text", top: int = TOP,
           segment_words: int = SEGMENT_WORDS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each query with
    a score above 0, equal scores by ascending id."""
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col, segment_words)
    n, total = corpus_size(index)
    ranked = None
    for block in blocks(queries, query_id_col, query_text_col, block_terms) if total else ():
        with batch_rows(spark, 1):
            found = stored(_search_block(index, block, n, total, top), "ranked-best")
        place = F.struct("score", (-F.col("doc_id")).alias("at"))
        last = found.where("kth_score is not null").groupBy("item_id").agg(
            F.max(F.struct(F.col("kth_score").alias("score"), (-F.col("kth_doc")).alias("at"))).alias("last"))
        # At most one row a query of the block.
        near = found.join(F.broadcast(last), "item_id", "left").where(F.col("last").isNull() | (place >= F.col("last")))
        by = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        out = near.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
        out = out.select(F.col("item_id").alias(query_id_col), F.col("rank").cast("int").alias("rank"),
                         F.col("doc_id").alias(id_col), "score")
        ranked = out if ranked is None else ranked.unionByName(out)
    if ranked is None:
        ranked = spark.createDataFrame([], f"`{query_id_col}` long, rank int, `{id_col}` long, score long")
    return ranked
