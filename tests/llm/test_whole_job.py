"""Cases where an operator once did less than its whole job."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hackney.llm import attention_lm, common, licenses, lsh_forest


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    common.prepare(spark)


def _block(texts):
    enc = attention_lm.encoding(attention_lm.public_tokenizers.path(attention_lm.RANK_FILE))
    block = attention_lm._Block()
    for k, text in enumerate(texts):
        block.add(k, text)
    names = ["block", "doc_ids", "held", "lengths", "words", "train", "id_ends", "ids", "codes"]
    return next(attention_lm._rows([pa.RecordBatch.from_pylist([dict(zip(names, block.row(enc), strict=True))])]))


def test_every_id_of_every_training_text_is_a_target_once():
    row = _block(["", None, *(" ".join(f"word{j % (k + 3)}" for j in range(17 * k)) for k in range(60))])
    ids, ends = attention_lm.sequences(row)
    held, starts = attention_lm._list(row["held"]), np.concatenate([[0], ends])
    want, pairs = Counter(), Counter()
    for d in np.flatnonzero(~held):
        own = ids[starts[d]:starts[d + 1]].tolist()
        want.update(own)
        pairs.update(zip([attention_lm.END, *own], own, strict=False))
    windows = np.concatenate(list(attention_lm.training_windows(row)))
    assert held.any() and windows.shape[1] == attention_lm.CONTEXT + 1
    targets = windows[:, 1:]
    assert Counter(targets[targets >= 0].tolist()) == want
    assert Counter(zip(windows[:, :-1][targets >= 0].tolist(), targets[targets >= 0].tolist(), strict=True)) == pairs


def test_texts_scored_in_groups_score_alike(monkeypatch):
    row = _block(["", None, *(" ".join(f"word{j % (k + 3)}" for j in range(7 * k)) for k in range(40)), ""])
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 50, attention_lm.N_IDS).astype(float)
    of = rng.integers(0, attention_lm.CLASSES, attention_lm.N_IDS)
    classes = attention_lm.classes_of(counts, counts + 1e6, of, np.zeros((attention_lm.N_IDS, attention_lm.CLASSES, 3)), rng.integers(0, 2, attention_lm.N_IDS))
    classes.starts[:] = attention_lm.begins_word(attention_lm.encoding(attention_lm.public_tokenizers.path(attention_lm.RANK_FILE)))
    c = np.append(attention_lm._list(row["train"]), 39)
    ids, ends = attention_lm.sequences(row)
    keys, n = np.unique(attention_lm._before(ids, ends) * attention_lm.N_IDS + ids, return_counts=True)
    got = []
    for most in (attention_lm.TEXT_IDS, 1, 300):
        monkeypatch.setattr(attention_lm, "TEXT_IDS", most)
        got.append(attention_lm._tries(attention_lm.initial(classes, counts), classes, row, c, int(c.sum()), keys, n.astype(np.float32)))
    for tries, fits in got[1:]:
        assert np.allclose(tries, got[0][0], rtol=0, atol=1e-4)
        assert all((a is None) == (b is None) and np.allclose(a or 0, b or 0, atol=1e-3) for a, b in zip(fits, got[0][1], strict=True))


def test_words_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(1)
    signs = list(" \t\n\r\x0b\x0c\x00\x1c\x85\xa0\u3000 aAbZ\u00c9\u00e9\u0130\u4e2d\U0001f642")
    texts = [None, "", " ", "  a  B ", *("".join(rng.choice(signs, n)) for n in rng.integers(0, 40, 500))]
    found, lengths = attention_lm.split_words(pa.array(texts, pa.string()))
    want = [attention_lm.words(t) for t in texts]
    assert lengths.tolist() == [len(w) for w in want]
    assert attention_lm._bytes(found) == [w for each in want for w in each]
    assert attention_lm._bytes(found.slice(5, 9)) == found.slice(5, 9).cast(pa.binary()).to_pylist()


def test_places_of_pairs_are_those_of_a_search():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5000):
        keys = np.sort(rng.choice(attention_lm.N_IDS ** 2, n, replace=False))
        wanted = rng.choice(keys, 20_000)
        find = attention_lm.finder(keys, rng.integers(0, 9, n).astype(np.float32))
        assert (find(wanted) == np.searchsorted(keys, wanted)).all()


def test_mixtures_of_texts_longer_than_a_run():
    """Against the sum of each word's logarithm; some words are new."""
    rng = np.random.default_rng(3)
    sizes = np.asarray([1, 100, 2, attention_lm.RUN, attention_lm.RUN + 1, 333, 1])
    n = int(sizes.sum())
    c, total = rng.integers(0, 4, n), 10 ** 18
    c[1:4] = 0
    c[-1] = 0                                        # texts without any known word
    same, said, begun = c + rng.integers(1, 9, n), -rng.exponential(9, n), -rng.exponential(3, n)
    known = c > 0
    want = np.stack([np.bincount(np.repeat(np.arange(len(sizes)), sizes), np.log10(np.where(
        known, m * np.exp(said) + (1 - m) * (b * np.exp(begun) * c / same + (1 - b) * c / total), m * np.exp(said)))) for m, b in attention_lm.MIXES], 1)
    assert np.allclose(attention_lm.mixtures(said, begun, c, same, total, sizes), want, rtol=1e-9)


def test_every_training_text_fits_the_mixture():
    row = _block([f"some words and number{k}" for k in range(50)])
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, attention_lm.N_IDS).astype(float)
    starts = attention_lm.begins_word(attention_lm.encoding(
        attention_lm.public_tokenizers.path(attention_lm.RANK_FILE))).astype(float)
    of = rng.integers(0, attention_lm.CLASSES, attention_lm.N_IDS)
    none = np.zeros((attention_lm.N_IDS, attention_lm.CLASSES, 3))
    classes = attention_lm.classes_of(counts, counts + 1e6, of, none, starts)
    c = np.append(attention_lm._list(row["train"]), 45)
    ids, ends = attention_lm.sequences(row)
    keys = np.unique(attention_lm._before(ids, ends) * attention_lm.N_IDS + ids)
    _, fits = attention_lm._tries(attention_lm.initial(classes, counts), classes, row, c, int(c.sum()),
                                  keys, np.zeros(len(keys), np.float32))
    assert [f is not None for f in fits] == (~attention_lm._list(row["held"])).tolist()


def test_every_pair_of_ids_counts(spark):
    """Against brute force, over several blocks; held-out texts' pairs are
    looked up and not counted."""
    texts = [" ".join(f"word{j * k % 23}" for j in range(3 * k)) for k in range(60)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    blocks = attention_lm.build_blocks(docs, attention_lm.public_tokenizers.path(attention_lm.RANK_FILE), "doc_id", "text",
                                       block_words=500)
    with common.batch_rows(spark, 2):
        pairs = attention_lm.block_pairs(blocks)
        counted = attention_lm.pair_counts(pairs)
        got = {r.key: r.c for r in counted.collect()}
        of = np.arange(attention_lm.N_IDS) % attention_lm.CLASSES
        starts = np.arange(attention_lm.N_IDS) % 2
        by_class = attention_lm.class_pairs(counted, of, starts)
        words = {bytes(r.word): r.c for r in attention_lm.word_counts(blocks).collect()}
        ids, firsts = attention_lm.id_counts(blocks)
    assert pairs.count() > 3
    enc = attention_lm.encoding(attention_lm.public_tokenizers.path(attention_lm.RANK_FILE))
    want, held, each, begin, word = Counter(), set(), Counter(), Counter(), Counter()
    for k, text in enumerate(texts):
        own = attention_lm.words(text)
        seq = [i for w in own for i in enc.encode_ordinary(" " + w.decode())] + [attention_lm.END]
        found = [a * attention_lm.N_IDS + b for a, b in zip([attention_lm.END, *seq], seq, strict=False)]
        held.update(found)
        if not attention_lm.held_out(k):
            want.update(found)
            each.update(seq)
            word.update(own)
            begin.update([enc.encode_ordinary(" " + w.decode())[0] for w in own] + [attention_lm.END])
    assert {k: c for k, c in got.items() if c} == want and set(got) == held
    assert {k: c for k, c in words.items() if c} == word
    assert dict(Counter({k: int(ids[k]) for k in np.flatnonzero(ids)})) == each
    assert {int(k): int(firsts[k]) for k in np.flatnonzero(firsts)} == begin
    last, target = next(iter(want)) // attention_lm.N_IDS, next(iter(want)) % attention_lm.N_IDS
    inside = {k: c for k, c in want.items() if k // attention_lm.N_IDS == last and of[k % attention_lm.N_IDS] == of[target]}
    cell = by_class[last, of[target]]
    assert cell[0] == sum(inside.values()) and cell[1] == len(inside)
    assert np.isclose(cell[2], sum((c - attention_lm.DISCOUNT) * starts[k % attention_lm.N_IDS] for k, c in inside.items()))
    # In later windows an id has at least 8 ids before it.
    assert attention_lm.CONTEXT - attention_lm.STRIDE >= 8 and attention_lm.ROUNDS >= 3


def test_scores_beat_the_base_on_held_out_texts(spark):
    """Words whose order can be learned, and the base columns by brute force."""
    rng = np.random.default_rng(2)
    cycle = [f"{a}{b}" for b in ("alpha", "beta", "gamma", "delta", "omega", "sigma") for a in ("un", "pre", "inter", "over")]
    texts = []
    for _ in range(400):
        at = (rng.integers(24) + np.cumsum(rng.choice([1, 1, 1, 7], 60))) % 24
        texts.append(" ".join(cycle[j] for j in at))
    texts[7], texts[8] = "", "\u00a0A\u2003b C\tc  only once"
    got = attention_lm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)).collect()
    counts = Counter()
    for k, text in enumerate(texts):
        if not attention_lm.held_out(k):
            counts.update([*attention_lm.words(text), None])
    total, distinct = sum(counts.values()), len(counts)
    for r in got:
        own = [*attention_lm.words(texts[r.doc_id]), None]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (attention_lm.held_out(r.doc_id), len(own), total)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert abs(r.base_score - base) < 1e-6
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_one_of_each_group_whatever_the_splits_of_a_scan(spark, monkeypatch):
    rows = [(k, " ".join(f"w{k // 2}x{j}" for j in range(40))) for k in range(400)]
    docs = common.stored(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "splits")
    key = "spark.sql.files.maxPartitionBytes"
    before, drop = spark.conf.get(key), lsh_forest.drop_keys
    partitions = docs.rdd.getNumPartitions()

    def drop_later(*args):
        spark.conf.set(key, "2000")
        return drop(*args)
    monkeypatch.setattr(lsh_forest, "drop_keys", drop_later)
    try:
        got = sorted(r.doc_id for r in lsh_forest.keep_one(docs).collect())
        assert spark.read.schema(docs.schema).parquet(*docs.inputFiles()).rdd.getNumPartitions() > partitions
    finally:
        spark.conf.set(key, before)
    assert got == list(range(0, 400, 2))


def test_each_licence_wins_its_own_notices_and_text():
    given = licenses.all_notices()
    templates = licenses.Templates.of(given)
    assert {n: [templates.best(t)[0] for t in ts] for n, ts in given.items()} == {n: [n] * len(ts) for n, ts in given.items()}
    assert templates.best("Creative Commons Attribution-NonCommercial 4.0 International License") == ("CC-BY-NC-4.0", 1.0)
    bsd = given["BSD-3-Clause"][0].replace("COPYRIGHT HOLDERS AND CONTRIBUTORS", "AUTHORS")
    assert [f[0] for f in licenses.scan_text("Copyright (c) 2020 A. Author\n\n" + bsd, templates)] == ["BSD-3-Clause"]


def test_whole_texts_are_in_the_registered_scan(spark):
    rows = [(1, licenses.all_notices()["BSD-2-Clause"][0]), (2, "plain text")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.licenses for r in got} == {1: "BSD-2-Clause", 2: ""}


def test_a_notice_is_found_wherever_it_stands():
    given = licenses.all_notices()
    templates = licenses.Templates.of(given)

    def names(text):
        found = licenses.scan_text(text, templates)
        assert all(0 <= a < b <= len(text) for _, _, a, b in found)
        return [f[0] for f in found]
    filler = "some other words that say nothing of it at all " * 30
    text = "Some intro sentence comes first here. Released under the MIT License. And more text follows it."
    assert names(text) == ["MIT"] and names(text.replace("MIT License", "menu")) == []
    (_, d, a, b), = licenses.scan_text(text, templates)
    assert d == 1 and text[a:b] == "Released under the MIT License"
    for name in ("AGPL-3.0", "LGPL-2.1", "GPL-2.0", "BSD-2-Clause", "MIT", "CC-BY-NC-4.0"):
        for notice in (given[name][0], given[name][-1]):
            assert names(f"{filler}{' '.join(notice.split())} {filler}") == [name], notice
    assert names(f"{filler}\n/* {filler}\nReleased under the\nMIT License.\n{filler} Licensed under CC BY-NC 4.0. {filler}*/") == ["MIT", "CC-BY-NC-4.0"]
    assert names(filler) == []


def test_counts_go_back_to_every_block(spark):
    """Words and pairs meet once: each count comes with all blocks that hold its
    word or pair, and a block is known by a number of its own."""
    texts = [" ".join(f"word{j * k % 23}" for j in range(3 * k)) for k in range(40)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    blocks = attention_lm.build_blocks(docs, attention_lm.public_tokenizers.path(attention_lm.RANK_FILE), "doc_id", "text",
                                       block_words=300)
    with common.batch_rows(spark, 2):
        own = {r.block: list(map(bytes, r.words)) for r in blocks.select("block", "words").collect()}
        pairs = attention_lm.block_pairs(blocks)
        places = {(p.block, p.at): bytes(r.word) for r in attention_lm.word_counts(blocks).collect() for p in r.places}
        back = {(b, r.key) for r in attention_lm.pair_counts(pairs).collect() for b in r.blocks}
        want = {(r.block, k) for r in pairs.collect() for k in r["keys"]}
    assert len(own) == blocks.count() > 3
    assert places == {(b, at): w for b, words in own.items() for at, w in enumerate(words)}
    assert back == want


def test_counts_travel_as_rows_of_parts(spark):
    """Words and pairs go to their sums and back in one row a block and part, not
    one a word or pair, and a block's counts come in its dictionary's order."""
    texts = [" ".join(f"word{j * k % 23}" for j in range(3 * k)) for k in range(40)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    blocks = attention_lm.build_blocks(docs, attention_lm.public_tokenizers.path(attention_lm.RANK_FILE), "doc_id", "text",
                                       block_words=300)
    with common.batch_rows(spark, 2):
        words, parts = attention_lm.word_sums(blocks), attention_lm.part_number(blocks)
        rows = [(r.block, r.part) for r in words.collect()]
        own = {r.block: list(map(bytes, r.words)) for r in blocks.select("block", "words").collect()}
        back = {r.block: [c for x in r.counts for c in attention_lm._unpacked(x.c).tolist()]
                for r in attention_lm.words_back(words).collect()}
        total = attention_lm.totals(blocks, words)
        pair_rows = [(r.block, r.part) for r in attention_lm.pair_sums(attention_lm.block_pairs(blocks)).collect()]
    want = Counter(w for k, t in enumerate(texts) if not attention_lm.held_out(k) for w in attention_lm.words(t))
    assert {b: [want[w] for w in ws] for b, ws in own.items() if ws} == back
    assert total.train_tokens == sum(want.values()) + total.ends and total.distinct == len(want) + 1
    for found in (rows, pair_rows):
        assert len(set(found)) == len(found) and {b for b, _ in found} <= {None, *own} and all(0 <= k < parts for _, k in found)


def test_packed_numbers():
    for most in (0, 1, 255, 256, 65_535, 65_536, 2 ** 32 - 1, 2 ** 32, 2 ** 50):
        x = np.asarray([0, most, most // 3])
        assert attention_lm._unpacked(attention_lm._packed(x)).tolist() == x.tolist()
        assert len(attention_lm._packed(x)) == 1 + 3 * next(k for k in (1, 2, 4, 8) if most < 1 << 8 * k)
    assert len(attention_lm._unpacked(attention_lm._packed(np.zeros(0, np.int64)))) == 0


def test_mixture_is_fitted_without_a_text_s_own_pairs():
    """A pair that only its own text has counts nothing for it: what is left is
    the id's share of its class, or the discounted pairs of others."""
    rng = np.random.default_rng(6)
    of = rng.integers(0, attention_lm.CLASSES, attention_lm.N_IDS)
    starts, counts = np.ones(attention_lm.N_IDS), rng.integers(0, 50, attention_lm.N_IDS).astype(float)
    ids = np.append(rng.integers(0, 12, 50), attention_lm.END).astype(np.int32)
    ends = np.asarray([len(ids)])
    before = attention_lm._before(ids, ends)

    def inside(at, keys, n):
        """Share of an id among the ids of its class behind the last id, by hand."""
        share = np.exp(c.share[ids[at]])
        same = {int(k): m for k, m in zip(keys, n, strict=True) if m and k // attention_lm.N_IDS == before[at]
                and of[k % attention_lm.N_IDS] == of[ids[at]]}
        if not same:
            return share
        own = max(same.get(int(before[at]) * attention_lm.N_IDS + int(ids[at]), 0) - attention_lm.DISCOUNT, 0)
        return (own + attention_lm.DISCOUNT * len(same) * share) / sum(same.values())

    keys, n = np.unique(before * attention_lm.N_IDS + ids, return_counts=True)
    cell, size = keys // attention_lm.N_IDS * attention_lm.CLASSES + of[keys % attention_lm.N_IDS], attention_lm.N_IDS * attention_lm.CLASSES
    pairs = np.stack([np.bincount(cell, w, size) for w in (n, n > 0, n - attention_lm.DISCOUNT)], 1).reshape(
        attention_lm.N_IDS, attention_lm.CLASSES, 3)
    c = attention_lm.classes_of(counts, counts, of, pairs, starts)
    less = np.zeros(len(ids), np.float32)
    logs, _ = attention_lm.id_logs(attention_lm.initial(c, counts), c, ids, ends, keys, n.astype(np.float32), less=less)
    for at in range(len(ids)):
        fewer = n - (keys == before[at] * attention_lm.N_IDS + ids[at])
        assert abs((less - logs)[at] - np.log(inside(at, keys, fewer) / inside(at, keys, n))) < 1e-3
    assert (n == 1).any() and (n > 1).any()
