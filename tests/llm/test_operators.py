"""Operators against plain versions, round trips and planted cases."""

import hashlib
import random
import re
from collections import Counter
from io import BytesIO

import numpy as np
import public_tokenizers
import pytest

from hackney.llm import (attention_lm, byte_bpe, common, decontam, licenses, lsh_forest, pii, quality_cascade,
                         seekable, token_files, toxicity, warc_bundles)


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    common.prepare(spark)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_seekable_frames_are_independent_and_checked():
    class Sink(BytesIO):
        def close(self):
            self.data = self.getvalue()
    sink = Sink()
    out = seekable.SeekableWriter(sink, frame_bytes=64)
    records = [bytes([k]) * (k * 7 % 50 + 1) for k in range(40)]
    places = [(*out.write(r), len(r)) for r in records]
    out.close(b"index")
    reader = seekable.SeekableReader(BytesIO(sink.data), len(sink.data))
    got = {}
    seekable.read_records(reader, places, lambda i, raw: got.update({i: raw}))
    assert [got[i] for i in range(40)] == records and reader.index() == b"index" and len(reader.entries) > 5
    bad = bytearray(sink.data)
    bad[reader.starts[2] + reader.entries[2][0] // 2] ^= 0xFF
    broken = seekable.SeekableReader(BytesIO(bytes(bad)), len(bad))
    assert broken.frame(1) == reader.frame(1)          # the others are still read
    with pytest.raises(Exception):
        broken.frame(2)
    with pytest.raises(seekable.CorruptFile):
        seekable.SeekableReader(BytesIO(b"no"), 2)


def test_pieces_encode_as_whole_texts():
    enc = byte_bpe.encoding(public_tokenizers.path(byte_bpe.RANK_FILE))
    hf = token_files.load(public_tokenizers.path(token_files.VOCABULARY))
    mine = token_files.Encoder(hf, "<u2")
    rng = random.Random(5)
    alphabet = "ab1 2\n\t'sé  .,\x1c日ñ²A　"
    for _ in range(800):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50)))
        assert byte_bpe.encode(t, enc, rng.randint(1, 9)) == enc.encode_ordinary(t)
        assert np.frombuffer(mine.encode([t])[0], "<u2").tolist() == hf.encode(t, add_special_tokens=False).ids
    assert enc.decode(byte_bpe.encode(" " * 2_000_000 + "x", enc)).endswith(" x")


def test_token_files_reread_only_what_is_asked(spark):
    texts = [f"text number {k} " * (k % 5) for k in range(60)]
    manifest = token_files.write(frame(spark, texts), frame_bytes=256)
    rows = {r.doc_id: r for r in token_files.digest(manifest).collect()}
    hf = token_files.load(public_tokenizers.path(token_files.VOCABULARY))
    want = [[*hf.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert [rows[k].n_tokens for k in range(60)] == [len(w) for w in want]
    assert [rows[k].start for k in range(60)] == [sum(map(len, want[:k])) for k in range(60)]
    found = {}
    for r in manifest.collect():
        found.update({i: ids.tolist() for i, ids in token_files.read_documents(r.path, {7, 33})})
    assert found == {7: want[7], 33: want[33]}


def test_warc_records_by_identifier(spark):
    pages = spark.createDataFrame([(k, f"http://x/{k}", f"<p>{k % 4}</p>" * 30) for k in range(40)], "page_id long, url string, html string")
    manifest = warc_bundles.write(pages, frame_bytes=512).collect()
    found = [rec for m in manifest for rec in warc_bundles.read_record(m.path, 17)]
    warc, http, payload = warc_bundles.parse_record(found[0])
    assert len(found) == 1 and warc["WARC-Type"] == "revisit" and warc["WARC-Refers-To"] == "<urn:page:1>" and payload == b""
    all_response = warc_bundles.read(warc_bundles.write(pages, min_bytes=10_000)).collect()
    assert {r.record_type for r in all_response} == {"response"}


def test_repeated_words_against_counting():
    rng = random.Random(1)
    for _ in range(300):
        w = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))]
        n = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        inside = {j for k in range(len(w) - 4) if n[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
        assert quality_cascade.repeated_words(w) == len(inside)


def test_cascade_verdict_does_not_depend_on_order(spark):
    texts = ["good words " * 3 + "and then some other words follow here", "a b", "### " * 30, "same " * 40]
    docs = frame(spark, texts)
    one = {r.doc_id: r.kept for r in quality_cascade.cascade(docs, quality_cascade.RULES).collect()}
    two = {r.doc_id: r.kept for r in quality_cascade.cascade(docs, quality_cascade.RULES[::-1]).collect()}
    assert one == two and not one[1] and not one[2] and not one[3]
    cheap, dear = (quality_cascade.Measured(quality_cascade.RULES[k], s, r) for k, (s, r) in enumerate([(1e-6, 0.1), (1e-3, 0.5)]))
    assert quality_cascade.ordered([dear, cheap]) == [cheap.rule, dear.rule]


def test_jaccard_join_against_all_pairs(spark):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 40)):           # groups larger than a block of the tiles below
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            texts.append(" ".join(t))
    sets = [{tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    linked = {i: [j for j in range(len(texts)) if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(texts))}
    group = {}
    for i in range(len(texts)):
        if i not in group:
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in group:
                    group[k] = i
                    todo += linked[k]
    block, lsh_forest.BLOCK = lsh_forest.BLOCK, 8
    try:
        got = {r.doc_id: r for r in lsh_forest.join(frame(spark, texts)).collect()}
    finally:
        lsh_forest.BLOCK = block
    assert {i: got[i].n_links for i in got} == {i: len(v) for i, v in linked.items()}
    assert {i: got[i].class_id for i in got} == group


def test_phrases_and_proximity(spark):
    texts = ["the quick brown fox jumps", "the very quick and brown fox", "fox brown quick the", None, "the quick the quick brown fox"]
    index = decontam.build_index(frame(spark, texts), segment_words=6)
    items = spark.createDataFrame([(1, "the quick brown fox"), (2, "absent words")], "item_id long, text string")
    assert {(r.doc_id, r.start, r.length) for r in decontam.phrases(index, items).collect()} == {(0, 0, 4), (4, 2, 4)}
    near = {(r.doc_id, r.start, r.length) for r in decontam.proximity(index, items, slop=2).collect()}
    assert near == {(0, 0, 4), (4, 2, 4), (1, 0, 6)}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7)], "key long, root long")
    got = {r.node: r.label for r in lsh_forest.components(edges).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_model_gradients_and_scores():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, attention_lm.N_IDS).astype(float)
    of = rng.integers(0, attention_lm.CLASSES, attention_lm.N_IDS)
    starts = rng.integers(0, 2, attention_lm.N_IDS).astype(float)
    keys = np.sort(rng.choice(100 * attention_lm.N_IDS, 200_000, replace=False))
    n = rng.integers(0, 4, len(keys))
    size, second = attention_lm.N_IDS * attention_lm.CLASSES, keys % attention_lm.N_IDS
    cell = keys // attention_lm.N_IDS * attention_lm.CLASSES + of[second]
    pairs = np.stack([np.bincount(cell, w, size) for w in (
        n, n > 0, np.maximum(n - attention_lm.DISCOUNT, 0) * starts[second])], 1).reshape(attention_lm.N_IDS, attention_lm.CLASSES, 3)
    c = attention_lm.classes_of(counts, counts, of, pairs, starts)
    p = attention_lm.initial(c, counts)
    rows = rng.integers(0, 100, (3, attention_lm.CONTEXT))
    target = rng.integers(0, attention_lm.CLASSES, rows.size)
    on = np.ones(rows.size, bool)
    g = attention_lm.gradients(p, rows, target, on)

    def loss(q):
        return -attention_lm.forward(q, rows)[0][np.arange(rows.size), target].astype(np.float64).mean()

    for name, at in (("wq", (1, 2)), ("wk", (3, 0)), ("wv", (2, 2)), ("wo", (0, 5)), ("out", (4, 4)), ("embed", (rows[0, 0], 3)), ("place", (1, 1))):
        up, down = ({k: v.astype(np.float64).copy() for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-4
        down[name][at] -= 1e-4
        assert abs((loss(up) - loss(down)) / 2e-4 - g[name][at]) < 1e-3
    whole = attention_lm.forward(p, rows)[0][np.arange(rows.size), target]
    assert np.allclose(attention_lm.target_logs(p, rows, target), whole, atol=1e-4)
    # Probabilities of the next id sum to one, whatever stands before it.
    text, last = np.arange(attention_lm.CONTEXT), 5
    said = attention_lm.forward(p, c.row[np.append(attention_lm.END, text[:5])[None, :].repeat(attention_lm.CONTEXT, 1)[:, :attention_lm.CONTEXT]])
    nexts = np.arange(attention_lm.N_IDS)
    found = np.zeros(attention_lm.N_IDS)
    mine = keys // attention_lm.N_IDS == last
    found[second[mine]] = n[mine]
    z = said[0][0]
    each = np.exp(z[of]) * (np.maximum(found - attention_lm.DISCOUNT, 0) / c.seen[last, of] + c.rest[last, of] * np.exp(c.share[nexts]))
    assert abs(each.sum() - 1) < 1e-3
    assert abs(each[starts > 0].sum() - (np.exp(z) * c.opening[last]).sum()) < 1e-3


def test_model_probabilities_of_a_text_by_hand():
    """`id_logs` over overlapping windows against one window of the last ids each."""
    rng = np.random.default_rng(4)
    of = rng.integers(0, attention_lm.CLASSES, attention_lm.N_IDS)
    starts = rng.integers(0, 2, attention_lm.N_IDS).astype(float)
    counts = rng.integers(0, 50, attention_lm.N_IDS).astype(float)
    ids = np.append(rng.integers(0, 40, 70), attention_lm.END).astype(np.int32)
    ends = np.asarray([len(ids)])
    before = attention_lm._before(ids, ends)
    keys, n = np.unique(before * attention_lm.N_IDS + ids, return_counts=True)
    cell = keys // attention_lm.N_IDS * attention_lm.CLASSES + of[keys % attention_lm.N_IDS]
    size = attention_lm.N_IDS * attention_lm.CLASSES
    pairs = np.stack([np.bincount(cell, w, size) for w in (
        n, n > 0, (n - attention_lm.DISCOUNT) * starts[keys % attention_lm.N_IDS])], 1).reshape(attention_lm.N_IDS, attention_lm.CLASSES, 3)
    c = attention_lm.classes_of(counts, counts, of, pairs, starts)
    p = attention_lm.initial(c, counts)
    logs, opens = attention_lm.id_logs(p, c, ids, ends, keys, n.astype(np.float32), batch=2)
    count = dict(zip(keys.tolist(), n.tolist(), strict=True))
    for at in range(len(ids)):
        start = 0 if at < attention_lm.CONTEXT else ((at - attention_lm.CONTEXT) // attention_lm.STRIDE + 1) * attention_lm.STRIDE
        rows = np.zeros((1, attention_lm.CONTEXT), np.int64)
        rows[0, :at - start + 1] = before[start:at + 1]
        z = attention_lm.forward(p, c.row[rows])[0].reshape(attention_lm.CONTEXT, -1)[at - start]
        t, k = int(ids[at]), of[ids[at]]
        same = {j % attention_lm.N_IDS: m for j, m in count.items() if j // attention_lm.N_IDS == before[at] and of[j % attention_lm.N_IDS] == k}
        inside = (same[t] - attention_lm.DISCOUNT + attention_lm.DISCOUNT * len(same) * np.exp(c.share[t])) / sum(same.values())
        assert abs(logs[at] - z[k] - np.log(inside)) < 1e-3
    assert opens.max() <= 1e-3


def test_words_are_mixed_with_their_share():
    rng = np.random.default_rng(1)
    said, begun, c, sizes = -rng.random(9) * 8, -rng.random(9), rng.integers(0, 4, 9), np.asarray([4, 1, 4])
    same = c + rng.integers(0, 9, 9)
    got = attention_lm.mixtures(said, begun, c, same, 50, sizes)
    with np.errstate(invalid="ignore"):
        first = np.where(c > 0, np.exp(begun) * c / same, 0)
    want = np.log10(np.stack([m * np.exp(said) + (1 - m) * (b * first + (1 - b) * c / 50) for m, b in attention_lm.MIXES], 1))
    assert np.allclose(got, [want[:4].sum(0), want[4:5].sum(0), want[5:].sum(0)])
    assert np.allclose(attention_lm.mixtures(said, begun, c, same, 0, sizes)[2], said[5:].sum() / np.log(10))


def test_odd_white_space_inside_words(spark):
    enc = attention_lm.encoding(attention_lm.public_tokenizers.path(attention_lm.RANK_FILE))
    nb = "\u00a0"
    vocabulary = [w.encode() for w in (nb, nb * 2, "a" + nb, nb + "b", "\u3000", "plain", "it's", "\u00e9t\u00e9")]
    flat, ends = attention_lm.word_ids(vocabulary, enc)
    assert len(ends) == len(vocabulary)
    parts = np.split(flat, ends[:-1])
    assert [enc.decode_bytes(x.tolist()) for x in parts] == [b" " + w for w in vocabulary]
    got = attention_lm.score(frame(spark, [f"x {nb} {nb}{nb} y", f"{nb} {nb} {nb}{nb}", "x y"])).collect()
    assert sorted(r.n_tokens for r in got) == [3, 4, 5] and all(r.score < 0 for r in got)


def test_score_keeps_up_with_the_base(spark):
    """The least share that the attention model gets costs a known word 0.009 digits."""
    rng = random.Random(4)
    vocabulary = [f"term{rng.randrange(10 ** 6)}" for _ in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=40)) for _ in range(120)]
    held = [r for r in attention_lm.score(frame(spark, texts)).collect() if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score - 0.01 * r.n_tokens for r in held)


def test_each_id_is_scored_once():
    for n in (1, 5, attention_lm.CONTEXT, attention_lm.CONTEXT + 1, 200):
        _, k = attention_lm._starts(np.asarray([n]))
        seen = Counter()
        for w in k.tolist():
            first = 0 if w == 0 else w * attention_lm.STRIDE + attention_lm.CONTEXT - attention_lm.STRIDE
            seen.update(range(first, min(n, w * attention_lm.STRIDE + attention_lm.CONTEXT)))
        assert seen == Counter(range(n))


def test_disguised_words_are_restored(spark):
    text = "such an idiot and moron said stupid things about the worthless scum in the trash " * 20
    counts = toxicity.trigram_counts(frame(spark, [text, None, ""]))
    restorer = toxicity.Restorer(toxicity.CharModel.of_counts(counts))
    for written, word in (("1d10t", "idiot"), ("m.o.r.o.n", "moron"), ("s t u p i d", "stupid"), ("scuuuum", "scum"), ("tr@sh!!", "trash")):
        assert restorer.readings(f"you {written}, or so") == [word]
    assert restorer.readings("plain words and 12,345 numbers in 2024!! a b") == []


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(2)
    plain = [f"word{k}" for k in range(200)]
    rows = []
    for k in range(600):
        w = [rng.choice(plain) for _ in range(30)]
        bad = k % 5 == 0
        if bad:
            w[3] = "idiot" if k % 2 else "1d1ot" if k % 10 == 0 and k % 3 == 0 else "idiot"
        rows.append((k, " ".join(w), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {r.doc_id: r for r in toxicity.score(df.drop("toxic"), df.select("doc_id", "toxic")).collect()}
    assert all(got[k].predicted == t for k, _, t in rows) and any(r.held_out for r in got.values())


def test_licence_scan_against_all_templates():
    templates = licenses.Templates.of(licenses.NOTICES)
    rng = random.Random(4)
    notices = [t for ts in licenses.NOTICES.values() for t in ts]
    for _ in range(1500):
        w = rng.choice(notices).split()
        for _ in range(rng.randint(0, 1 + len(w) // 6)):
            w[rng.randrange(len(w))] = rng.choice(["the", "license", "mit", "cc", "foo"])
        words = licenses.normalised(" ".join(w))
        grams = licenses.bigrams(words)
        best = min(((-licenses.dice(grams, g, len(words) - 1, s), n) for n, g, s in zip(templates.names, templates.grams, templates.sizes)
                    if licenses.dice(grams, g, len(words) - 1, s) >= 0.8), default=None)
        assert templates.best(" ".join(w)) == (best and (best[1], -best[0]))
    text = "intro words here\nReleased under the MIT licence.\n\nmore " + "filler words " * 500
    assert [f[0] for f in licenses.scan_text(text, templates)] == ["MIT"]


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_base(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def ok(kind, hit):
        d = re.sub("[^0-9]", "", hit)
        return {"email": True, "ip": all(int(x) <= 255 for x in hit.split(".")) if kind == "ip" else False,
                "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text) if ok(k, m.group())]


def test_base_spans_against_plain_patterns(spark):
    rng = random.Random(6)
    parts = ["a@b.c", "x.y@z-1.com_d@e.f", "1.2.3.4.5.6.7.8", "300.1.1.1", "4111 1111 1111 1111", "+1 (555) 123-4567", "\U0001F600", "é", " ", "-", ".",
             "@", "12", "+", "4111111111111111", "01.002.3.255", "word"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    texts += [("mail%d@x.org " * 1) % k * 300 for k in range(3)] + ["9" * 30_000, "a" * 30_000 + "@", "1." * 5_000, "+1" + "(" * 9_000]
    rows = {r.doc_id: r for r in pii.find(frame(spark, texts)).collect()}
    for k, t in enumerate(texts):
        base = plain_base(t)
        assert rows[k].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), t[:200]
        assert set(base) <= set(rows[k].spans.split(",")) or not base


def test_weak_supervision_adds_and_redacts(spark):
    texts = [f"phone: ({200 + k}) 234-5678 and mail me{k}@x.com ok" for k in range(30)] + ["order 111-111-1111x and part 555.555-5555z"] * 10
    rows = {r.doc_id: r for r in pii.find(frame(spark, texts)).collect()}
    assert rows[0].n_added == 1 and "phone:7:21" in rows[0].spans and rows[35].n_added == 0
    clean = {r.doc_id: r.text for r in pii.redact(frame(spark, texts)).collect()}
    assert clean[0] == "phone: <PHONE> and mail <EMAIL> ok" and clean[35] == texts[35]
