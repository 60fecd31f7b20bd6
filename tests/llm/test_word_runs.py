"""Runs of words against a comparison of every place with every other."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from hackney.llm import common, word_runs


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    common.prepare(spark)


def plain(words, least_words=6, least_periods=4):
    n, best = len(words), {}
    for q in range(1, n):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least_words, least_periods * q):
                best.setdefault((i, j - i + q), q)      # smallest period first
            i = max(j, i + 1)
    return sorted(((i, size, q) for (i, size), q in best.items()), key=lambda r: (r[0], r[2]))


def texts(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        k = rng.choice([1, 2, 2, 3, 5])
        words = [b"%d" % rng.randrange(k) for _ in range(rng.randint(0, 40))]
        if words and rng.random() < 0.5:
            at = rng.randrange(len(words))
            words[at:at] = words[at:at + rng.randint(1, 6)] * rng.randint(1, 8)
        out.append(words)
    return out


@pytest.mark.parametrize("least", [(6, 4), (1, 2), (4, 3), (6, 5), (1, 7)])
def test_every_run(least):
    for seed in range(150):
        batch = texts(seed, seed % 7)
        assert word_runs.find_runs(batch, *least) == [plain(x, *least) for x in batch]


def test_known_shapes():
    a, b = b"a", b"b"
    fibonacci = [a], [a, b]
    for _ in range(12):
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    assert word_runs.find_runs([fibonacci[1]], 1, 2) == [plain(fibonacci[1], 1, 2)]
    assert word_runs.find_runs([[a] * 5, [a] * 6, [a] * 3, [a, b] * 3 + [a], [a, b] * 4, []]) == [
        [], [(0, 6, 1)], [], [], [(0, 8, 2)], []]
    assert word_runs.find_runs([[a] * 50_000]) == [[(0, 50_000, 1)]]
    long = [b"%d" % (k % 777) for k in range(30_000)] + [b"end"]
    assert word_runs.find_runs([long, long]) == [[(0, 30_000, 777)]] * 2
    assert word_runs.find_runs([[b"%d" % k for k in range(300_000)]]) == [[]]


def test_squares_are_few_and_right():
    """Every branching square, none twice as often as the test can meet it."""
    words = texts(5, 1)[0] * 3
    codes, ends = word_runs.numbered([words])
    order, isa, ranks = word_runs.suffix_array(codes, ends)
    assert [words[i:] for i in order] == sorted((words[i:] for i in range(len(words))),
                                                key=lambda x: [words.index(w) for w in x])
    assert isa[order].tolist() == list(range(len(words)))
    lcp = word_runs.lcp_values(order, ends, ranks)
    for r in range(1, len(order)):
        i, j = int(order[r - 1]), int(order[r])
        same = next((k for k in range(len(words)) if max(i, j) + k >= len(words) or words[i + k] != words[j + k]))
        assert lcp[r] == same
    found = set(zip(*(x.tolist() for x in word_runs.branching_squares(order, isa, lcp, ends)), strict=True))
    n = len(words)
    assert found == {(e, d) for e in range(n + 1) for d in range(1, e // 2 + 1)
                     if words[e - 2 * d:e - d] == words[e - d:e] and (e == n or words[e] != words[e - d])}


def test_collapse():
    words = b"x a b a b a b a b y y y y y y z".split()
    runs = word_runs.find_runs([words])[0]
    assert runs == [(1, 8, 2), (9, 6, 1)]
    assert b" ".join(word_runs.collapse(words, runs)) == b"x a b y z"


def test_runs_of_a_table(spark):
    docs = spark.createDataFrame([(1, "so\tso so so\x0bso so ok"), (None, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: (r.runs, r.collapsed) for r in word_runs.runs(docs).collect()}
    assert got == {1: ([(0, 6, 1)], "so ok"), None: ([], ""), 3: ([], "")}


def test_report(spark):
    rng = random.Random(9)
    rows = [(k, " \n".join(str(rng.choice((1, 1, 2))) for _ in range(rng.randint(0, 99)))) for k in range(150)]
    rows += [(3, rows[3][1]), (None, "a b " * 9), (900, None), (901, " \t\n"), (902, "é" * 50_000), (903, "no break  here " * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumns({c: F.lit("x") for c in ("start", "length", "period", "n_runs", "words", "id")})
    got = word_runs.report(docs).collect()
    want = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
        runs = plain(words)
        top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        want.append((doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
                     hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
                     hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(r.n_runs > 1 for r in got) > 3
    assert word_runs.report(docs.where("false")).collect() == []
