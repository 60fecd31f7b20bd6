"""Toxicity of texts behind a noisy channel.

Spellings such as ``1d10t``, ``i d i o t``, ``s.c.u.m``, ``morooon`` or ``ïdiot``
are read as a lattice: each written character may stand for itself, for the
letters it is drawn like, or (a separator, a blank or a repeat) for nothing; a
separator or blank may also part two words.  A Viterbi search over the lattice,
under a character trigram model, restores the likeliest letters; the restored
words join the text's words, and the restored text is scored.

Everything is learned from the corpus.  The character model counts the words
of all documents.  The classifier learns from labelled documents of the
training fold: smoothed log odds of each word between texts with and without
the label (equal texts count once), of which those for the label have a weight,
and a logistic regression over a text's two largest weights.

Decoded are all tokens, and runs of three or more single characters, in which a
letter is repeated or something else than a letter a-z stands between, beside or
for letters, whatever their length; any other word is its own best reading.  The
character model is a table of 27^3 numbers.  Up to ``WORDS_SENT`` word weights
are sent to tasks; a larger table is joined with the texts' words.

Edge cases: a null or empty text has no words and gets the classifier's score
of no evidence; labels of unknown documents are unused; a document labelled
more than once counts as toxic if any label says so; without labels of either
kind every score is the share of toxic labels (or a half without any); rows
with equal ids are scored one by one; columns other than those named are not
read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import BROADCAST_KEYS, map_batches, remainder, stored, texts

WORDS_SENT = 200_000       # a table of more word weights is joined by word, not sent to tasks
MIN_DOCS = 3               # a word in fewer training texts has no weight
FIT_TEXTS = 20_000         # about so many labelled training texts fit the logistic regression

# Letters that characters are drawn like.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
# Letters of other scripts that are drawn like a Latin one.
ALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "ı": "i",
}
SEPARATORS = ".-_*~'"
MARKS = "!|+("             # signs that are punctuation at a word's edge
# Costs in nats: reading a sign as a letter, skipping a separator, taking it as
# the end of a word, dropping one of three or more equal letters, dropping one
# of two, leaving a sign as it is.
READ, SKIP, BREAK, DROP, HALVE, KEEP = 0.7, 0.3, 1.5, 0.6, 2.5, 12.0

# A blank for every ASCII byte that is neither a letter nor an apostrophe.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 or b == 0x27 else 0x20
                 for b in range(256))

# ---- the character model

@dataclass
class CharModel:
    """-log p(letter | two before), 27 x 27 x 27, edges as code 0."""
    cost: np.ndarray

    @cached_property
    def flat(self) -> list[float]:
        return self.cost.ravel().tolist()

    @staticmethod
    def of_counts(counts: np.ndarray) -> CharModel:
        pair = counts.sum(0)
        single = (pair.sum(0) + 1) / (pair.sum() + 27)
        two = (pair + 5 * single) / (pair.sum(1, keepdims=True) + 5)
        three = (counts + 5 * two[None]) / (counts.sum(2, keepdims=True) + 5)
        return CharModel(-np.log(three))


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Letter trigrams of all words of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27 ** 3, np.int64)
        code = np.zeros(256, np.int16)
        code[97:123] = np.arange(1, 27)
        code[65:91] = np.arange(1, 27)
        for batch in batches:
            for text in texts(batch.column(0)):
                c = code[np.frombuffer(b"  " + text.encode() + b" ", np.uint8)].astype(np.int32)
                k = (c[:-2] * 27 + c[1:-1]) * 27 + c[2:]
                total += np.bincount(k[(c[1:-1] > 0) | (c[2:] > 0)], minlength=len(total))
        (seen,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["k", "n"])

    out = np.zeros(27 ** 3)
    for r in docs.select(text_col).mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r.k] = r.n
    out = out.reshape(27, 27, 27)
    out[0, 0, :] += out[1:, 0, :].sum(0)      # a word's first letter knows the edge alone
    out[1:, 0, :] = 0
    return out


# ---- the lattice

_CODES = {chr(96 + k): k for k in range(1, 27)}


@lru_cache(10_000)
def latin(ch: str) -> str:
    """The letter a-z that a lower-case letter is or is drawn like, or ""."""
    if "a" <= ch <= "z":
        return ch
    base = ALIKE.get(ch) or unicodedata.normalize("NFKD", ch)[0]
    return base if "a" <= base <= "z" else ""


def arcs(written: str) -> list[list[tuple[str, float]]]:
    """What each character may be read as, and at which cost: a letter, nothing,
    or a blank (the end of a word)."""
    out, start = [], 0
    for k, ch in enumerate(written):
        if ch != written[start]:
            start = k
        again = k > start
        letter = latin(ch)
        if letter:
            readings = [(letter, 0.0 if letter == ch else READ)]
            if again:
                long = k - start > 1 or written[k + 1:k + 2] == ch
                readings.append(("", DROP if long else HALVE))
        else:
            readings = [(c, READ) for c in LOOKS.get(ch, "")]
            if ch in SEPARATORS or ch == " ":
                readings += [("", SKIP), (" ", BREAK)]
            elif unicodedata.combining(ch):
                readings.append(("", SKIP))
            else:
                readings.append(("", DROP if again else KEEP))
        out.append(readings)
    return out


_THRICE = re.compile(r"(.)\1\1", re.DOTALL)


def restore(written: str, model: CharModel) -> str:
    """The likeliest words behind a disguised spelling."""
    if written.isalpha() and not _THRICE.search(written) and all(letters := list(map(latin, written))):
        return halved(written, letters, model)
    return search(written, model)


def halved(written: str, letters: list[str], model: CharModel) -> str:
    """`search` of letters of which none stands three times in a row.  Only the
    second of two equal ones has two readings, and whichever it takes, the letters
    before and behind the two are the same: so each is decided by itself."""
    cost, out = model.flat, letters[:1]
    for k in range(1, len(letters)):
        if written[k] == written[k - 1]:
            c = _CODES[letters[k]]
            before = _CODES[letters[k - 2]] if k > 1 else 0
            behind = _CODES[letters[k + 1]] if k + 1 < len(letters) else 0
            both = cost[(before * 27 + c) * 27 + c] + cost[(c * 27 + c) * 27 + behind]
            if letters[k] != written[k]:
                both += READ
            if HALVE + cost[(before * 27 + c) * 27 + behind] < both:
                continue
        out.append(letters[k])
    return "".join(out)


def search(written: str, model: CharModel) -> str:
    """The likeliest words, by Viterbi search.  A
    state is the last two letters read; each written character adds the arcs of
    its readings, and a blank starts anew after the cost of a word's end."""
    lattice = arcs(written)
    if all(len(readings) == 1 for readings in lattice):
        return "".join(readings[0][0] for readings in lattice).strip()      # one way through
    cost, looked_up = model.flat, _CODES
    best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}      # by 27 * the letter before last + the last
    for readings in lattice:
        step: dict[int, tuple[float, tuple | None]] = {}
        for state, (total, path) in best.items():
            for letter, price in readings:
                new = total + price
                if not letter:
                    to = state
                elif letter == " ":
                    if not state % 27:
                        continue
                    to, new = 0, new + cost[state * 27]
                else:
                    c = looked_up[letter]
                    to, new = state % 27 * 27 + c, new + cost[state * 27 + c]
                old = step.get(to)
                if old is None or new < old[0]:
                    step[to] = (new, (path, letter) if letter else path)
        best = step
    _, path = min(((total + (cost[state * 27] if state % 27 else 0.0), path) for state, (total, path) in best.items()),
                  key=itemgetter(0))
    out = []
    while path is not None:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out)).strip()


def spellings(token: str) -> list[str]:
    """The parts of a token without the punctuation around them, in lower case;
    twice if a sign at the front may be a letter or punctuation."""
    parts, part = [], ""
    for ch in token.lower() + "\n":
        if ch.isalpha() or ch in LOOKS or ch in SEPARATORS or unicodedata.combining(ch):
            part += ch
        else:
            parts.append(part)
            part = ""
    out = []
    for part in parts:
        core = part.strip(SEPARATORS + "(").rstrip(MARKS + SEPARATORS)
        bare = core.lstrip(MARKS + SEPARATORS)
        out += [bare] if bare == core else [bare, core]
    return [x for x in out if x]


def disguised(spelling: str) -> bool:
    """Whether a spelling of three characters or more, all of whose letters are
    drawn like Latin ones, has something else than single letters a-z."""
    if len(spelling) < 3 or (spelling.isascii() and spelling.isalpha() and all(map(str.__ne__, spelling, spelling[1:]))):
        return False
    letters = [c for c in spelling if c.isalpha()]
    return bool(letters) and all(map(latin, letters))


_TWICE = re.compile(r"(.)\1")
_NOTHING: tuple[list[str], str] = ([], "")


@dataclass
class Restorer:
    """`restore` with the tokens met before (a worker's own, of bounded size)."""
    model: CharModel
    known: dict[str, tuple[list[str], str]] = field(default_factory=dict)

    def words(self, spelling: str) -> list[str]:
        return [w for w in restore(spelling, self.model).split() if len(w) > 2 and w != spelling]

    def look_at(self, token: str) -> tuple[list[str], str]:
        """The words that a token stands for, and its character if it has one
        only, kept for the next time unless it is long."""
        if len(self.known) > 200_000:
            self.known.clear()
        word = token.strip(",.;:?").rstrip("!").lower()
        if len(word) > 1 and word.isascii() and word.isalpha() and not _TWICE.search(word):
            self.known[token] = _NOTHING   # most words: the same as below, sooner
            return _NOTHING
        parts = [word] if word.isalpha() else spellings(token)
        found: list[str] = []
        for x in parts:
            if disguised(x):
                found += [w for w in self.words(x) if w not in found]
        single = parts[0] if len(parts) == 1 and len(parts[0]) == 1 else ""
        out = (found, single) if found or single else _NOTHING
        if len(token) <= 100:
            self.known[token] = out
        return out

    def readings(self, text: str) -> list[str]:
        """Restored words of the disguised ones among ``text``'s."""
        known, out, run = self.known, [], ""
        for token in text.split():
            words, single = known.get(token) or self.look_at(token)
            if words:
                out += words
            if single:
                run += single
            elif run:
                out += self.apart(run)
                run = ""
        return out + self.apart(run)

    def apart(self, run: str) -> list[str]:
        """The words behind a run of characters written apart."""
        if len(run) < 3 or not disguised(spaced := " ".join(run)):
            return []
        key = " " + spaced                 # no token starts with a blank
        if key not in self.known:
            found = self.words(spaced)
            if len(key) > 100:
                return found
            self.known[key] = found, ""
        return self.known[key][0]

    def restored_words(self, text: str) -> tuple[list[bytes], int]:
        """The words of the text and then what its disguised words stand for, if
        that is another word; and the number of the former."""
        plain = {w.strip(b"'") for w in text.encode().translate(_LETTERS).split()} - {b""}
        read = {w.encode() for w in self.readings(text)} - plain
        return sorted(plain) + sorted(read), len(plain)


# ---- the classifier

@dataclass
class Classifier:
    weights: dict[bytes, float]
    theta: tuple[float, float, float]      # bias, largest, second largest

    def evidence(self, words: set[bytes]) -> tuple[float, float]:
        """The two largest weights: a long text gathers many weak ones, which
        say nothing when summed."""
        w = self.weights
        found = sorted((w[x] for x in words if x in w), reverse=True)
        return (found[0] if found else 0.0), (found[1] if len(found) > 1 else 0.0)

    def score(self, words: set[bytes]) -> float:
        return self.of(*self.evidence(words))

    def of(self, first: float, second: float) -> float:
        z = self.theta[0] + self.theta[1] * first + self.theta[2] * second
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Newton's method; the bias is the first column's weight."""
    theta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (p - y) / len(y) + ridge * theta
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(theta))
        move = np.linalg.solve(hess, grad)
        theta -= move
        if np.abs(move).max() < 1e-8:
            break
    return theta


def labelled_words(docs: DataFrame, labels: DataFrame, model: CharModel, id_col: str, text_col: str,
                   label_col: str) -> DataFrame:
    """``label, words, n_plain`` of each different text of the labelled training
    fold; the first ``n_plain`` words are written plainly in it.
    The labels are broadcast if counted few; texts become words before they are
    shuffled."""
    marks = stored(labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__label"))
                   .where("__id is not null and __label is not null").groupBy("__id").agg(F.max("__label").alias("label")), "marks")
    if marks.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        marks = F.broadcast(marks)
    fold = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(remainder("__id", 5) != 0)
    rows = fold.join(marks, "__id").select("label", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            found = [restorer.restored_words(t) for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int32()), batch.column(1), pa.array([w for w, _ in found], pa.list_(pa.binary())),
                 pa.array([n for _, n in found], pa.int32())], ["label", "digest", "words", "n_plain"])

    return stored(rows.mapInArrow(run, "label int, digest binary, words array<binary>, n_plain int").groupBy("digest").agg(
        F.max("label").alias("label"), F.first("words").alias("words"), F.first("n_plain").alias("n_plain")).drop("digest"), "labelled-words")


def word_weights(rows: DataFrame, pos: int, neg: int) -> DataFrame:
    """``word, weight`` of the words that speak for the label, stored: log odds
    shrunk towards no opinion by their standard error, where that leaves any.
    Readings count, but a word that no text has plainly is none."""
    odds = (F.log((F.col("pos") + 0.5) / F.lit(pos + 1.0)) - F.log((F.col("neg") + 0.5) / F.lit(neg + 1.0)))
    error = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    found = rows.select(F.posexplode("words").alias("pos", "word"), "n_plain", (F.col("label") > 0).cast("long").alias("t"))
    return stored(found.groupBy("word").agg(F.sum("t").alias("pos"), F.sum(1 - F.col("t")).alias("neg"),
                                            F.max(F.col("pos") < F.col("n_plain")).alias("plain"))
                  .where(F.col("plain") & (F.col("pos") + F.col("neg") >= MIN_DOCS)).select("word", (odds - 1.64 * error).alias("weight"))
                  .where("weight > 0"), "word-weights")


def joined_evidence(rows: DataFrame, weights: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of the stored ``rows`` (``row``, a number of its own, is
    one) with ``first, second``: the two largest weights of the row's words."""
    top = F.slice(F.sort_array(F.collect_list("weight"), asc=False), 1, 2)
    found = (rows.select("row", F.explode("words").alias("word")).join(weights, "word")
             .groupBy("row").agg(top.alias("top")))
    return rows.select(*keep).join(found, "row", "left").select(
        *keep, *(F.coalesce(F.get("top", F.lit(k)), F.lit(0.0)).alias(n) for k, n in enumerate(("first", "second"))))


def learn(docs: DataFrame, labels: DataFrame, model: CharModel, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> tuple[Classifier, DataFrame | None]:
    """The classifier; and the table of its weights instead of the weights where
    there are more than ``WORDS_SENT``."""
    rows = labelled_words(docs, labels, model, id_col, text_col, label_col)
    n = {r.label: r.n for r in rows.groupBy((F.col("label") > 0).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        share = min(0.999, max(0.001, pos / (pos + neg))) if pos + neg else 0.5
        return Classifier({}, (math.log(share / (1 - share)), 0.0, 0.0)), None
    table = word_weights(rows, pos, neg)
    few = table.limit(WORDS_SENT + 1).count() <= WORDS_SENT
    found = Classifier({bytes(r.word): r.weight for r in table.collect()} if few else {}, (0.0, 0.0, 0.0))
    # About FIT_TEXTS of them, picked by hash: no sort, no gathering of texts.
    parts = 1_000_000
    sample = rows.where(F.pmod(F.xxhash64("words"), F.lit(parts)) < int(parts * min(1.0, FIT_TEXTS / (pos + neg))))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = [found.evidence(set(w)) for w in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([p[k] for p in pairs], pa.float64()) for k in (0, 1))],
                                          ["label", "first", "second"])

    if few:
        sample = map_batches(sample, run, "label int, first double, second double")
    else:
        sample = joined_evidence(stored(sample.withColumn("row", F.monotonically_increasing_id()), "fit"), table, ["row", "label"])
    seen = sample.select("label", "first", "second").collect()     # about FIT_TEXTS rows of three numbers
    # In one order whatever the tasks': sums of doubles depend on it.
    x = np.asarray(sorted((float(r.label > 0), 1.0, r.first, r.second) for r in seen)).reshape(-1, 4)
    theta = logistic(x[:, 1:], x[:, 0])
    return Classifier(found.weights, tuple(theta.tolist())), None if few else table


# ---- the operator

def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> DataFrame:
    """``id, held_out, score, predicted, restored`` of each row; ``restored``:
    what its disguised words were read as."""
    model = CharModel.of_counts(trigram_counts(docs, text_col))
    found, table = learn(docs, labels, model, id_col, text_col, label_col)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, (remainder(id_col, 5) == 0).alias("held_out"), text_col)
    if table is not None:
        return _score_by_join(rows, model, found, table, kind)
    sent = docs.sparkSession.sparkContext.broadcast((model, found))      # 27^3 numbers, at most WORDS_SENT words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, found = sent.value
        restorer, keys = Restorer(model), found.weights.keys()
        for batch in batches:
            said, read = [], []
            for text in texts(batch.column(2)):
                readings = restorer.readings(text)
                words = {w.strip(b"'") for w in text.encode().translate(_LETTERS).split()}
                words.update(w.encode() for w in readings)
                said.append(found.score(words & keys))
                read.append(readings)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(said, pa.float64()), pa.array([int(s >= 0.5) for s in said], pa.int32()),
                 pa.array(read, pa.list_(pa.string()))], [id_col, "held_out", "score", "predicted", "restored"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int, restored array<string>")


def _score_by_join(rows: DataFrame, model: CharModel, found: Classifier, table: DataFrame, kind: str) -> DataFrame:
    """`score` where the weights are too many to be sent: each text's words meet
    the table of weights in a join."""
    id_col = rows.columns[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            said = [(restorer.restored_words(t)[0], restorer.readings(t)) for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([w for w, _ in said], pa.list_(pa.binary())), pa.array([r for _, r in said], pa.list_(pa.string()))],
                ["id", "held_out", "words", "restored"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        said = [found.of(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[1:3], pa.array(said, pa.float64()), pa.array([int(s >= 0.5) for s in said], pa.int32()), batch.column(3)],
            [id_col, "held_out", "score", "predicted", "restored"])

    numbered = stored(rows.mapInArrow(read, f"id {kind}, held_out boolean, words array<binary>, restored array<string>")
                      .withColumn("row", F.monotonically_increasing_id()), "text-words")
    return map_batches(joined_evidence(numbered, table, ["row", "id", "held_out", "restored"]), run,
                       f"`{id_col}` {kind}, held_out boolean, score double, predicted int, restored array<string>")
