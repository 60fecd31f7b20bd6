"""The MinHash LSH forest: prefix lengths, the walk up the tries, and the join
of texts of few and many shingles against all pairs."""

import random
from collections import Counter

import numpy as np

from hackney.llm import lsh_forest


def test_least_similarity_is_the_least_that_a_size_admits():
    for n in range(1, 40):
        found = [i / (n + m - i) for m in range(1, 3 * n) for i in range(1, min(n, m) + 1) if 10 * i >= 8 * (n + m - i)]
        assert abs(lsh_forest.least_similarity(n) - min(found)) < 1e-12


def test_prefixes_are_shortened_until_the_recall_is_met():
    depth = lsh_forest.depths()
    assert [depth[n] for n in (0, 1, 4, 6, 7, 64)] == [5, 8, 5, 6, 8, 5]
    for n in range(1, lsh_forest.SMALL + 1):
        for k, enough in ((depth[n], True), (depth[n] + 1, False)):
            if k <= lsh_forest.LEVELS:
                p = 1 - (1 - lsh_forest.least_similarity(n) ** float(k)) ** lsh_forest.TREES
                assert (p >= lsh_forest.RECALL) == enough


def test_walk_up_the_tries_against_all_pairs():
    rng = random.Random(8)
    for _ in range(60):
        n = rng.randint(1, 40)
        leaves = np.sort(np.asarray([int.from_bytes(bytes(rng.choice((0, 1, 200)) for _ in range(8))) for _ in range(n)], np.uint64))
        cuts = np.asarray(sorted({0, *rng.sample(range(n), min(n, 2))}))
        group = np.searchsorted(cuts, np.arange(n), side="right")
        depth = np.asarray([rng.randint(2, 8) for _ in range(n)])

        def agree(i, j):
            a, b = (int(leaves[k]).to_bytes(8) for k in (i, j))
            k = max(depth[i], depth[j])
            return i != j and group[i] == group[j] and a[:k] == b[:k]
        want = [any(agree(i, j) for j in range(n)) for i in range(n)]
        assert lsh_forest.ascend(leaves, depth, cuts).tolist() == want
        i, j = lsh_forest._own_pairs(leaves[:, None], depth, group, 0, 1, 1) if len(cuts) == 1 else ((), ())
        if len(cuts) == 1:
            assert set(zip(i.tolist(), j.tolist())) == {(x, y) for x in range(n) for y in range(x + 1, n) if agree(x, y)}


def test_texts_of_few_and_many_shingles_against_all_pairs(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"v{k}" for k in range(300)]
    texts = ["", None, " \n "]
    for n in [*range(1, 25)] * 3 + [60, 150]:
        base = [rng.choice(vocabulary) for _ in range(n)]
        for _ in range(6):
            t = list(base)
            if rng.random() < 0.7:
                t = t[:max(1, n - rng.randint(0, 2))] + [rng.choice(vocabulary) for _ in range(rng.randint(0, 2))]
            texts.append(" ".join(t))
    texts += ["one text in very many copies of itself"] * 40

    def shingles(text):
        w = (text or "").split()
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    sets = [shingles(t) for t in texts]
    words = [(t or "").split() for t in texts]
    def linked(i, j):
        return words[i] == words[j] or 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]) > 0
    links = [[j for j in range(len(texts)) if j != i and linked(i, j)] for i in range(len(texts))]
    group = {}
    for i in range(len(texts)):
        todo = [] if i in group else [i]
        while todo:
            k = todo.pop()
            if k not in group:
                group[k] = i
                todo += links[k]
    sizes = Counter(group.values())
    monkeypatch.setattr(lsh_forest, "HOT", 5)       # most classes and groups take the way of the large ones
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in lsh_forest.join(docs).collect()}
    assert len(got) == len(texts)
    assert {i: got[i].n_links for i in got} == {i: len(v) for i, v in enumerate(links)}
    assert {i: got[i].class_id for i in got} == group
    assert {i: got[i].group_size for i in got} == {i: sizes[group[i]] for i in got}
    assert sorted(r.doc_id for r in lsh_forest.keep_one(docs).collect()) == sorted(set(group.values()))


def test_hot_keys_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "HOT", 10)
    many = spark.createDataFrame([(0, k) for k in range(50)] + [(k, k) for k in range(1, 9)], "key long, row long")
    one = spark.createDataFrame([(0, 50)] + [(k, 1) for k in range(1, 9)], "key long, size long")
    got = lsh_forest.join_hot(many, one, "key", "size")
    assert sorted((r.key, r.row, r.size) for r in got.collect()) == sorted(
        [(0, k, 50) for k in range(50)] + [(k, k, 1) for k in range(1, 9)])
