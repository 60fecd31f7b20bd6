"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends.  Documents are worked on in batches; the words of a
batch are numbered per document, so no two documents share a prefix.  For a
batch, in numpy:

1. suffix array and its inverse ISA by prefix doubling (only suffixes that are
   not yet told apart are sorted again), LCP values from the doubling ranks;
2. the LCP intervals as nearest smaller values on both sides of each LCP value;
   no tree nodes are made.  An interval of several children is split in two at
   each of its LCP values, so each pair of its children is separated once;
3. for each split with LCP value ``d``, every suffix ``i`` of its smaller side:
   if ISA[i + d] or ISA[i - d] lies on the other side, the two suffixes agree in
   exactly ``d`` words, that is, a square of two ``d``-word halves stands there
   and the word behind it breaks the period (a branching tandem).  Each suffix
   is on a smaller side at most log n times;
4. a run with period ``d`` ends with such a square, and with one of halves
   ``2d`` if it holds four periods.  These are rotated to the left as long as the
   word before agrees, and squares of one run (halves ``kd``, equal ends) merge.

`find_runs` returns every run of at least ``least_words`` words and
``least_periods`` (2 or more) periods.  `collapse` drops the words that any run
contains behind its first period.

Memory: a batch holds about ``BATCH_WORDS`` words, unless one document alone is
longer; some 60 bytes a word and 4 more for each doubling round.

Edge cases: words are runs of characters other than the ASCII blanks, whole
texts; null or empty texts have no words and no runs; repeated rows are worked
on one by one; an empty table gives an empty result; columns other than id and
text are not read; a text without an id is not rewritten by `planted`.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_WORDS = 200_000
LEAST_WORDS, LEAST_PERIODS = 6, 4

Run = tuple[int, int, int]       # start, length, period, in words


# ---- the enhanced suffix array of a batch

def numbered(texts: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as one array of codes, numbered per text, and the
    end of each word's text.  Equal words of two texts have unequal codes."""
    codes: list[int] = []
    before = 0
    for words in texts:
        seen: dict[bytes, int] = {}
        codes += [before + seen.setdefault(w, len(seen)) for w in words]
        before += len(seen)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.asarray(codes, np.int64), np.repeat(np.cumsum(sizes), sizes)


def suffix_array(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(suffix array, ISA, ranks).  ``ranks[k]`` numbers the stretches of 2^k
    words from each place on; a text's end sorts before every word."""
    n = len(codes)
    order = np.argsort(codes)
    starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
    sizes = np.diff(starts, append=n)
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(starts, sizes)                        # the first place of a suffix's group
    ranks = [rank]
    open_ = np.flatnonzero(np.repeat(sizes, sizes) > 1)           # places whose group has several suffixes
    width = 1
    while len(open_):
        suffix = order[open_]
        behind = suffix + width
        second = np.where(behind < ends[suffix], rank[np.minimum(behind, n - 1)].astype(np.int64) + 1, 0)
        key = rank[suffix].astype(np.int64) * (n + 1) + second
        by = np.argsort(key)
        key, suffix = key[by], suffix[by]
        order[open_] = suffix                                     # groups stay where they are, sorted within
        new = np.diff(key, prepend=-1) != 0
        first = open_[np.flatnonzero(new)[np.cumsum(new) - 1]]    # a group's first place
        rank = rank.copy()
        rank[suffix] = first
        ranks.append(rank)
        again = np.diff(np.flatnonzero(new), append=len(key)) > 1
        open_ = open_[again[np.cumsum(new) - 1]]
        width *= 2
    return order, rank, ranks


def lcp_values(order: np.ndarray, ends: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """``lcp[r]``: the words that suffixes r - 1 and r of the order share; 0 at r = 0."""
    n = len(order)
    lcp = np.zeros(n, np.int64)
    if n < 2:
        return lcp
    a, b = order[:-1].copy(), order[1:].copy()
    at = np.flatnonzero(ranks[0][a] == ranks[0][b])
    a, b = a[at], b[at]
    for k in range(len(ranks) - 1, -1, -1):
        inside = (a < ends[order[at]]) & (b < ends[order[at + 1]])
        # Equal ranks at a level: the next 2^k words, or all up to the texts' ends, are equal;
        # suffixes of one text never end together, so the former.
        same = inside & (ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)])
        step = same.astype(np.int64) << k
        a, b = a + step, b + step
    lcp[at + 1] = a - order[at]
    return lcp


def nearest_smaller(values: np.ndarray, strict: bool) -> np.ndarray:
    """For each place of a value above 0 the nearest one to its left with a
    smaller value (or, not ``strict``, a smaller or equal one); -1 if there is
    none.  Blocks twice as long are tried as long as all of a block is too
    large, then halves."""
    n = len(values)
    left = np.arange(n) - 1                 # the candidate: nothing between it and the place is small enough
    todo = np.flatnonzero(values)
    table = [values]                        # table[k][i]: least of the 2^k values that end at i

    def larger(k: int, at: np.ndarray, of: np.ndarray) -> np.ndarray:
        found = table[k][np.maximum(at, 0)]
        return (at - (1 << k) + 1 >= 0) & ((found >= values[of]) if strict else (found > values[of]))

    k = 0
    passed: list[np.ndarray] = []
    while len(todo):
        if k:
            half = 1 << (k - 1)
            wide = table[-1].copy()
            wide[half:] = np.minimum(table[-1][half:], table[-1][:-half])
            table.append(wide)
        go = larger(k, left[todo], todo)
        passed.append(todo)
        todo = todo[go]
        left[todo] -= 1 << k
        k += 1
        if 1 << k > n:
            passed.append(todo)
            break
    # A place that stopped at block k still has a rest shorter than that block to pass.
    for j in range(len(table) - 1, -1, -1):
        tried = passed[j]
        go = larger(j, left[tried], tried)
        left[tried[go]] -= 1 << j
    return left


def branching_squares(order: np.ndarray, isa: np.ndarray, lcp: np.ndarray,
                      ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends, halves) of all squares whose next word breaks the period."""
    n = len(order)
    at = np.flatnonzero(lcp)
    if not len(at):
        return at, at
    lo = nearest_smaller(lcp, strict=True)[at]                     # the split's left side is lo .. at - 1
    hi = n - 1 - nearest_smaller(lcp[::-1], strict=False)[n - 1 - at]     # and its right side at .. hi - 1
    half = lcp[at]
    left_small = at - lo <= hi - at
    first = np.where(left_small, lo, at)
    size = np.where(left_small, at - lo, hi - at)
    other_lo, other_hi = np.where(left_small, at, lo), np.where(left_small, hi, at)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # Pieces of some million suffixes, so that memory stays in proportion to the batch.
    total = np.cumsum(size)
    cut = 0
    while cut < len(at):
        stop = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + 4 * BATCH_WORDS)))
        sizes = size[cut:stop]
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - first[cut:stop], sizes)
        i = order[place]
        d, a, b = (np.repeat(x[cut:stop], sizes) for x in (half, other_lo, other_hi))
        after = i + d
        rank = isa[np.minimum(after, n - 1)]
        hit = (after < ends[i]) & (rank >= a) & (rank < b)
        found.append((after[hit] + d[hit], d[hit]))                # the square i .. i + 2d
        before = i - d
        rank = isa[np.maximum(before, 0)]
        hit = (before >= 0) & (rank >= a) & (rank < b)             # ranks of one split are of one text
        found.append((after[hit], d[hit]))                         # the square i - d .. i + d
        cut = stop
    return np.concatenate([e for e, _ in found]), np.concatenate([d for _, d in found])


# ---- runs

def _rotate(codes: np.ndarray, begin: int, start: int, period: int) -> int:
    """The first place from which the words up to ``start`` repeat after ``period``."""
    step = 8
    while start > begin:
        lo = max(begin, start - step)
        (bad,) = np.nonzero(codes[lo:start] != codes[lo + period:start + period])
        if len(bad):
            return lo + int(bad[-1]) + 1
        start, step = lo, step * 4
    return start


def find_runs(texts: Sequence[Sequence[bytes]], least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS) -> list[list[Run]]:
    """The runs of each text (a list of words), by start, then period."""
    out: list[list[Run]] = [[] for _ in texts]
    codes, ends = numbered(texts)
    if len(codes) < 2:
        return out
    order, isa, ranks = suffix_array(codes, ends)
    lcp = lcp_values(order, ends, ranks)
    del ranks
    stops, halves = branching_squares(order, isa, lcp, ends)
    if not len(stops):
        return out
    n = len(codes) + 1
    key = np.unique(stops * n + halves)
    # A run of m periods ends with squares of one and of m div 2 periods a half.
    key = key[np.isin(key // n * n + key % n * (least_periods // 2), key, assume_unique=False)]
    firsts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    doc_of = np.searchsorted(firsts, key // n - 1, side="right") - 1
    last_stop, starts = -1, []
    for k, doc in zip(key.tolist(), doc_of.tolist(), strict=True):
        stop, period = divmod(k, n)
        if stop != last_stop:
            last_stop, starts = stop, []
        # Within a run with a shorter period: the same run, its halves hold several periods.
        if any(stop - 2 * period >= s for s in starts):
            continue
        begin = int(firsts[doc])
        start = _rotate(codes, begin, stop - 2 * period, period)
        starts.append(start)
        if stop - start >= max(least_words, least_periods * period):
            out[doc].append((start - begin, stop - start, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """``words`` without those that a run contains behind its first period."""
    if not runs:
        return list(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, x in zip(words, np.cumsum(drop).tolist(), strict=False) if not x]


# ---- jobs

def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's rewriting: the last words of every tenth document repeat
    with a period that its id and length give."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a:a + p]
    return words[:a] + (part * ((n - a) // p + 1))[:n - a]


def _batches(batches: Iterator[pa.RecordBatch], rewrite: bool) -> Iterator[tuple[list, list[list[bytes]]]]:
    ids: list = []
    texts: list[list[bytes]] = []
    n = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = (text or "").encode().split()
            if rewrite:
                words = planted(doc_id, words)
            if texts and n + len(words) > BATCH_WORDS:
                yield ids, texts
                ids, texts, n = [], [], 0
            ids.append(doc_id)
            texts.append(words)
            n += len(words)
    if texts:
        yield ids, texts


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
         least_periods: int = LEAST_PERIODS) -> DataFrame:
    """``id, runs (array of start, length, period), collapsed`` for each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for ids, texts in _batches(batches, rewrite=False):
            found = find_runs(texts, least_words, least_periods)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in found], kind),
                 pa.array([b" ".join(collapse(w, x)).decode() for w, x in zip(texts, found, strict=True)], pa.string())],
                [id_col, "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, f"`{id_col}` long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def strongest(found: Sequence[Run]) -> Run | None:
    """The run with the most periods; of equal ones the first, then the shortest period."""
    top = None
    for r in found:      # by start, then period
        if top is None or r[1] * top[2] > top[1] * r[2]:
            top = r
    return top


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's digest of each row's runs, after its rewriting: ``doc_id,
    n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256``."""
    schema = (f"`{id_col}` long, n_runs long, start long, length long, period long, exponent_milli long, "
              "runs_sha256 string, collapsed_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _batches(batches, rewrite=True):
            found = find_runs(texts)
            tops = [strongest(x) for x in found]
            longs = [ids, [len(x) for x in found], *([t and t[k] for t in tops] for k in range(3)),
                     [t and 1000 * t[1] // t[2] for t in tops]]
            listed = [hashlib.sha256("".join("%d,%d,%d\n" % r for r in x).encode()).hexdigest() for x in found]
            kept = [hashlib.sha256(b" ".join(collapse(w, x))).hexdigest() for w, x in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in longs), pa.array(listed, pa.string()), pa.array(kept, pa.string())],
                [id_col, "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)
