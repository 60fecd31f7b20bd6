"""Quality rules as a short-circuit cascade.

Each rule's cost and rejection rate are measured on a sample; documents then
meet the rules in the order of rejections per second, and the first rule that
rejects a document ends its run.  The verdict is the same in any order (a
document is kept if no rule rejects it); only the work and the name of the
rejecting rule depend on it.

Edge cases: a null or empty text has no words and fails ``few_words``; a text
of blanks likewise.  Repeated rows are judged one by one.  Columns other than
the id and the text are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import map_batches, texts

# Word separators and symbol characters of the base rules.
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words inside ``window``-word windows that occur twice or more."""
    n = len(words)
    if n <= window:
        return 0
    with np.errstate(over="ignore"):
        h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        m = n - window + 1
        key = np.zeros(m, np.uint64)
        for k in range(window):
            key = (key ^ h[k:k + m]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    first, second = order[:-1][same], order[1:][same]
    starts = np.zeros(n, bool)
    if all(words[i:i + window] == words[j:j + window]
           for i, j in zip(first.tolist(), second.tolist(), strict=True)):
        starts[first] = starts[second] = True
    else:   # two different windows share a 64-bit hash: compare the words
        places: dict[tuple, list[int]] = {}
        for i in range(m):
            places.setdefault(tuple(words[i:i + window]), []).append(i)
        for at in places.values():
            if len(at) > 1:
                starts[at] = True
    covered = starts.copy()
    for k in range(1, window):
        covered[k:] |= starts[:-k]
    return int(covered.sum())


class Doc:
    """A text with its measures, each computed when first asked for."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def data(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - (len(self.data) - len(self.data.translate(None, BLANKS)))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def n_lines(self) -> int:
        return sum(1 for x in self.data.split(b"\n") if x.strip(BLANKS))

    @cached_property
    def n_dup_lines(self) -> int:
        lines = [x for x in self.data.split(b"\n") if x.strip(BLANKS)]
        return len(lines) - len(set(lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)

    @cached_property
    def n_stutters(self) -> int:
        """Words equal to the word before them."""
        return sum(a == b for a, b in zip(self.words, self.words[1:], strict=False))

    @property
    def base_failed(self) -> bool:
        return self.n_words < 10 or 100 * self.n_repeat_words > 20 * self.n_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Doc], bool]


# The production rules.  The thresholds are shares of a document's own words,
# characters or lines, so they mean the same for short and long texts.
RULES = (
    Rule("few_words", lambda d: d.n_words < 10),
    Rule("symbols", lambda d: 10 * d.n_symbols > d.n_words),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 20 * d.n_words),
    Rule("stutter", lambda d: 2 * d.n_stutters > d.n_words),
    Rule("dup_lines", lambda d: 2 * d.n_dup_lines > d.n_lines),
    Rule("repeats", lambda d: 100 * d.n_repeat_words > 20 * d.n_words),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float      # a document
    rejected: float     # share of the sample

    @property
    def rank(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def measure(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text",
            sample_rows: int = 2000, fraction: float = 0.02, seed: int = 7) -> list[Measured]:
    """Cost and selectivity of each rule on a sample of at most ``sample_rows``
    documents.  Every rule meets every sampled document on its own, without the
    measures that an earlier rule has left behind."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, took, hits = 0, [0.0] * len(rules), [0] * len(rules)
        for batch in batches:
            for text in texts(batch.column(0)):
                n += 1
                for k, rule in enumerate(rules):
                    doc = Doc(text)
                    began = time.perf_counter()
                    hits[k] += rule.rejects(doc)
                    took[k] += time.perf_counter() - began
        if n:
            yield pa.RecordBatch.from_pydict({
                "k": pa.array(range(len(rules)), pa.int32()), "n": pa.array([n] * len(rules), pa.int64()),
                "took": pa.array(took, pa.float64()), "hits": pa.array(hits, pa.int64())})

    sample = docs.select(text_col).sample(fraction, seed).limit(sample_rows)
    rows = (sample.mapInArrow(probe, "k int, n long, took double, hits long")
            .groupBy("k").agg(F.sum("n").alias("n"), F.sum("took").alias("took"), F.sum("hits").alias("hits"))
            .collect())   # one row a rule
    if not rows:          # nothing sampled from a small table: the given order
        return [Measured(r, 1e-6, 0.0) for r in rules]
    return [Measured(rules[r.k], r.took / r.n, r.hits / r.n) for r in sorted(rows, key=lambda r: r.k)]


def ordered(measured: Sequence[Measured]) -> list[Rule]:
    """Rules by rejections per second; equal ones keep the given order."""
    return [m.rule for m in sorted(measured, key=lambda m: -m.rank)]


def judge(doc: Doc, rules: Sequence[Rule]) -> tuple[str | None, int]:
    """(the rejecting rule or None, how many rules ran)."""
    for k, rule in enumerate(rules, 1):
        if rule.rejects(doc):
            return rule.name, k
    return None, len(rules)


def cascade(docs: DataFrame, rules: Sequence[Rule] | None = None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``id, kept, rejected_by, rules_run`` for each row.  ``rules``: in the
    order to run them (default: the production rules, measured and ordered)."""
    order = list(rules) if rules is not None else ordered(measure(docs, text_col=text_col))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        said = [judge(Doc(t), order) for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([s[0] is None for s in said], pa.bool_()),
             pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.int32())],
            [id_col, "kept", "rejected_by", "rules_run"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run,
                       f"`{id_col}` {kind}, kept boolean, rejected_by string, rules_run int")


def keep_good(docs: DataFrame, rules: Sequence[Rule] | None = None, text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, all columns as they are."""
    order = list(rules) if rules is not None else ordered(measure(docs, text_col=text_col))
    at = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([judge(Doc(t), order)[0] is None for t in texts(batch.column(at))], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base measures of each row with the cascade's verdict."""
    order = ordered(measure(docs, text_col=text_col))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ds = [Doc(t) for t in texts(batch.column(1))]
        said = [judge(d, order) for d in ds]
        failed = [d.base_failed for d in ds]
        numbers = {n: pa.array([getattr(d, n) for d in ds], pa.int64())
                   for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *numbers.values(), pa.array(failed, pa.bool_()),
             pa.array([not f and s[0] is None for f, s in zip(failed, said, strict=True)], pa.bool_()),
             pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.int32())],
            [id_col, *numbers, "base_failed", "kept", "rejected_by", "rules_run"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(id_col, text_col), run,
                       f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                       "n_repeat_words long, base_failed boolean, kept boolean, rejected_by string, rules_run int")
