"""Ranked search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hackney.llm import common, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    common.prepare(spark)


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, top):
    found = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in found), sum(sum(c.values()) for _, c in found)
    df = Counter(w for _, c in found for w in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, query in asked.items():
        scores = []
        for i, c in found:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m))
                        for w in query if c[w])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def search(spark, docs, items, parts=3, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    q = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, ranked_search.search(d, q, **how).collect()), key=str)


def corpus(seed, n, vocabulary):
    rng = random.Random(seed)
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("segment_words, top", [(60, 5), (600, 5), (10**6, 50), (1, 1)])
def test_every_rank_as_by_plain_scoring(spark, segment_words, top):
    vocabulary = [f"W{k}" for k in range(60)]
    docs = corpus(segment_words, 300, vocabulary)
    docs += [(1000 + k, docs[7][1]) for k in range(80)]              # one text many times: ties beyond the last rank
    items = [(k, " ".join(random.Random(k).sample(vocabulary, 1 + k % 12))) for k in range(25)]
    assert search(spark, docs, items, top=top, segment_words=segment_words) == plain(docs, items, top)


def test_blocks_of_queries(spark):
    vocabulary = [f"w{k}" for k in range(40)]
    docs, items = corpus(3, 100, vocabulary), [(k, f"w{k} w{k + 1} w{(k * 7) % 40}") for k in range(39)]
    assert search(spark, docs, items, block_terms=5, top=3) == plain(docs, items, 3)


def test_no_accumulator_is_opened_once_the_rest_cannot_win():
    """Rare term in 3 documents, then one that all 1000 hold: only the three are
    ever scored, and exactly."""
    made = ranked_search.SegmentBuilder()
    for k in range(1000):
        made.add(k, "common common" + (" rare" * (k + 1) if k < 3 else " filler"))
    names = [c.split()[0] for c in ranked_search.INDEX_SCHEMA.split(", ")]
    row = {c: a.to_pylist()[0] for c, a in zip(names, made.columns(), strict=True)}
    segment = ranked_search.Segment(row, 1000, 3003)
    query = [(segment.find(b"rare"), 5000), (segment.find(b"common"), 3)]
    docs, scores = ranked_search.best(segment, query, 3, 0)
    assert docs.tolist() == [0, 1, 2] and segment._whole.keys() == {query[0][0]}
    m = [50 + 50 * n * 1000 // 3003 for n in (3, 4, 5)]
    assert scores.tolist() == [5000 * (10**9 * (k + 1) // (1000 * (k + 1) + 20 * m[k])) + 3 * (2 * 10**9 // (2000 + 20 * m[k]))
                               for k in range(3)]
    assert segment.find(b"absent") == -1 and np.all(segment.norms > 0)


def test_bounds_hold():
    rng = random.Random(1)
    made = ranked_search.SegmentBuilder()
    for k in range(200):
        made.add(k, " ".join(rng.choices("abcdefgh", [2 ** -x for x in range(8)], k=rng.randint(1, 30))))
    names = [c.split()[0] for c in ranked_search.INDEX_SCHEMA.split(", ")]
    segment = ranked_search.Segment({c: a.to_pylist()[0] for c, a in zip(names, made.columns(), strict=True)}, 200, 3000)
    for k in range(len(segment.term_ends)):
        assert segment.whole(k).max() <= segment.bound(k)


def test_awkward_rows(spark):
    text = "Alpha beta; GAMMA delta-alpha Ünïcode 日本"
    docs = [(1, text), (1, text), (2, None), (3, ""), (4, " ;-. "), (None, text), (5, "beta " * 30_000), (6, "ALPHA"), (7, "x" * 100_000)]
    items = [(10, "alpha"), (10, "日本 beta"), (11, None), (12, ""), (None, "alpha"), (13, "absent"), (14, "alpha alpha ünïcode"),
             (14, "alpha alpha ünïcode")]
    assert search(spark, docs, items) == plain(docs, items, 50)
    clash = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("rank", "score", "item_id", "last", "lengths", "kth_score")})
    q = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(0) for c in ("doc_id", "i", "t", "score")})
    got = ranked_search.search(clash, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == len(plain(docs, items, 50))
    assert ranked_search.search(clash.where("false"), q).collect() == []
    assert ranked_search.search(clash, q.where("false")).collect() == []
    assert search(spark, [(1, None), (2, "")], items) == []
