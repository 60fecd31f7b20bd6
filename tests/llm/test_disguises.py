"""Disguised spellings: which are decoded, and the search against all readings."""

import itertools
import random

import numpy as np
import pytest

from hackney.llm import toxicity

CORPUS = "you are such an idiot and a moron who said stupid things about the worthless scum in the trash " * 30
SPELLED = {
    "idiot": ["1 d 1 0 t", "i d 1 o t", "i  d  i  o  t", "iddiioott", "(1d10t)", "1d10t)", "[id10t]", "(idiooot)", "id10t-",
              "ïdiot", "ïdiot", "іdіot", "!diot", "i.d.i.o.t", "IDIOOOT!!", "1" + "d" * 60 + "1ot"],
    "stupid": ["s.t.u.p.i.d-", "$tupid", "s t u p i d", "\"5tup1d\""],
    "moron": ["m0r0n/1d10t", "m.o.r.o.n", "mоrоn"],
    "trash": ["tr@sh!!", "t_r_a_s_h"],
}


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(0, CORPUS), (1, None), (2, "")], "doc_id long, text string")
    return toxicity.CharModel.of_counts(toxicity.trigram_counts(docs))


def test_spellings_are_restored(model):
    restorer = toxicity.Restorer(model)
    for word, written in SPELLED.items():
        for w in written:
            assert word in restorer.readings(f"said {w} , or so"), w
            assert restorer.readings(f"said {w} , or so") == restorer.readings(f"said {w} , or so")
    assert restorer.readings("y o u i d i o t") == ["you", "idiot"]
    assert restorer.readings("m0r0n/1d10t") == ["moron", "idiot"]


def test_plain_text_stays(model):
    restorer = toxicity.Restorer(model)
    for plain in ("", "plain words, (in brackets) and 12,345 numbers in 2024!! a b", "1 2 3 4", "- - -", "привет",
                  "中文中", "...", "!!!! ((((", "̈"):
        assert restorer.readings(plain) == [], plain


def test_long_tokens_take_linear_time(model):
    restorer = toxicity.Restorer(model)
    assert restorer.readings("i" + "d" * 200_000 + "iot 1") == ["idiot"]
    assert restorer.readings("i " * 100_000) is not None
    assert not any(len(k) > 102 for k in restorer.known)


def test_search_against_all_readings():
    rng = random.Random(6)
    draw = np.random.default_rng(6)
    for _ in range(150):
        cost = draw.uniform(0.5, 8, (27, 27, 27))
        written = "".join(rng.choice("aab b1.0!ï\u0308") for _ in range(rng.randint(1, 7)))
        best = None
        for path in itertools.product(*toxicity.arcs(written)):
            total, a, b, out, fits = 0.0, 0, 0, "", True
            for letter, price in path:
                total += price
                if letter == " ":
                    fits &= b > 0
                    total, a, b, out = total + cost[a, b, 0], 0, 0, out + " "
                elif letter:
                    c = ord(letter) - 96
                    total, a, b, out = total + cost[a, b, c], b, c, out + letter
            total += cost[a, b, 0] if b else 0.0
            if fits and (best is None or total < best[0] - 1e-12):
                best = total, out.strip()
        assert toxicity.restore(written, toxicity.CharModel(cost)) == best[1]


def test_many_weights_are_joined_and_score_the_same(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for k in range(400):
        w = [f"word{rng.randrange(80)}" for _ in range(20)]
        if k % 4 == 0:
            w[2] = ("idiot", "1d10t", "moron", "m.o.r.o.n")[k // 4 % 4]
        rows.append((k if k % 50 else None, " ".join(w) if k % 31 else None, int(k % 4 == 0 and k % 31 > 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = df.drop("toxic"), df.select("doc_id", "toxic")
    sent = toxicity.score(docs, labels).toPandas()
    monkeypatch.setattr(toxicity, "WORDS_SENT", 0)
    joined = toxicity.score(docs, labels).toPandas()
    assert list(sent.columns) == list(joined.columns)
    key = lambda f: sorted((-1 if r.doc_id != r.doc_id else r.doc_id, r.held_out, round(r.score, 9), r.predicted, tuple(r.restored))
                           for r in f.itertuples())
    assert key(sent) == key(joined) and len(sent) == 400 and sent.predicted.sum() > 50


def test_letters_alone_need_no_search():
    """Words of letters, doubled or not, are read as the search reads them."""
    rng = random.Random(8)
    model = toxicity.CharModel.of_counts(np.random.default_rng(8).integers(0, 400, (27, 27, 27)).astype(float) ** 2)
    letters, read, asked = "abcdeéöïñçа", 0, []
    search, toxicity.search = toxicity.search, lambda w, m: asked.append(w) or search(w, m)
    try:
        for _ in range(3000):
            word = "".join(c * rng.choice((1, 1, 2)) for c in rng.choices(letters, k=rng.randint(1, 7)))
            got = toxicity.restore(word, model)
            assert got == search(word, model), word
            read += len(got) < len(word)
    finally:
        toxicity.search = search
    assert read > 200 and all(any(a == b == c for a, b, c in zip(w, w[1:], w[2:])) for w in asked)
