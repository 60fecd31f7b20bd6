"""Chunked encoding against the untouched library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hackney.llm import chunk_bpe, common

PATH = public_tokenizers.path(chunk_bpe.VOCABULARY)


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    common.prepare(spark)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


ODD = ["a", "B", "cd ", " ", "\n", "\t\t", "é", "é", "́", "ß", "Σ", "ΟΔΟΣ", "İ", "ﬁ", "日本", "1", "42", ".", ",", "...", "'s", "'T", "'", "don't",
       " ", " ", "\u0085", "\x1c", "\x00", "<|endoftext|>", "<|start", "oftext|>", "\U0001F600", "Å", "Å", "가", "﻿", "x" * 50]


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_repaired_joins_encode_as_whole_texts(library):
    """Cut anywhere between characters, with or without blanks in a chunk."""
    rng = random.Random(2)
    known = chunk_bpe.pieces(PATH)
    for text in texts(1, 1500):
        chunks, rest = [], text
        while rest:
            k = rng.randint(1, 9)
            chunks.append(rest[:k].encode())
            rest = rest[k:]
        ids = chunk_bpe.join([chunk_bpe.part(c, known) for c in chunks], [chunk_bpe.no_blank(c) for c in chunks], known)
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_cuts_follow_the_content():
    rng = random.Random(4)
    passage = "".join(rng.choice("abc déf\n") for _ in range(20_000)).encode()
    whole = chunk_bpe.cuts(passage, [len(passage)])[0]
    moved = chunk_bpe.cuts(b"something else first " + passage, [21 + len(passage)])[0]
    assert len(whole) > 20 and len(set(whole) & {c - 21 for c in moved}) > 0.8 * len(whole)
    for data in (passage, b"x" * 100_000, "日".encode() * 30_000):
        ends = chunk_bpe.cuts(data, [len(data)])[0]
        sizes = np.diff([0, *ends])
        assert ends[-1] == len(data) and sizes[:-1].min() >= chunk_bpe.LEAST_BYTES and sizes.max() <= chunk_bpe.MOST_BYTES + 3
        b"".join(data[a:b].decode().encode() for a, b in zip([0, *ends], ends))       # cut between characters
    two = chunk_bpe.cuts(passage + passage, [len(passage), 2 * len(passage)])
    assert [c - len(passage) for c in two[1]] == two[0] == whole                      # the text before has no say


def check(library, docs, got):
    want = []
    for i, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("cut_bits, least, most", [(3, 4, 64), (5, 1, 20), (9, 128, 16_384)])
def test_documents_that_share_chunks(spark, library, cut_bits, least, most):
    rng = random.Random(cut_bits)
    passages = ["".join(rng.choice(ODD) for _ in range(200)) for _ in range(6)]
    docs = [(k, "".join(rng.choice([*passages, *texts(k, 3)]) for _ in range(rng.randint(0, 5)))) for k in range(120)]
    docs += [(500 + k, passages[0]) for k in range(60)]                               # one text a third of the time
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    check(library, docs, chunk_bpe.round_trip(frame, cut_bits=cut_bits, least=least, most=most).collect())


def test_shared_chunks_are_encoded_once(spark, monkeypatch):
    """Chunks that only one document holds are not marked; those of two are."""
    rng = random.Random(8)
    one, two, three = (" ".join(str(rng.random()) for _ in range(300)) for _ in range(3))
    frame = spark.createDataFrame([(1, one + " " + two), (2, three), (3, two)], "doc_id long, text string").repartition(3)
    how = chunk_bpe._how(6, 32, 4096)
    bits = np.unpackbits(np.frombuffer(chunk_bpe.met_twice(frame, "text", how), np.uint8), bitorder="little")

    def marks(text):
        data, at, out = text.encode(), 0, []
        for end in chunk_bpe.cuts(data, [len(data)], **how)[0]:
            out.append(bits[int.from_bytes(chunk_bpe._digest(data[at:end])[:8], "little") % chunk_bpe.SLOTS])
            at = end
        return out
    assert not any(marks(three)) and sum(marks(two)) > 0.9 * len(marks(two)) and bits.sum() <= len(marks(two))


def test_awkward_rows(spark, library):
    docs = [(1, "One two two"), (1, "One two two"), (2, None), (None, "One two"), (3, ""), (4, " \n\t "), (5, "x" * 100_000), (6, "日本" * 20_000),
            (7, "word and <|endoftext|>more " * 4000), (8, "word and <|endoftext|>more " * 4000 + "end"), (9, "é " * 9000), (10, " " * 70_000 + "a")]
    clash = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("row", "doc", "seq", "digest", "data", "ids", "head", "sum", "slot", "n_tokens")})
    check(library, docs, chunk_bpe.round_trip(clash).collect())
    assert chunk_bpe.round_trip(clash.where("false")).collect() == []


def test_ids_and_back(spark, library):
    docs = [(k, t) for k, t in enumerate(texts(3, 40))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    coded = common.stored(chunk_bpe.encode_texts(frame, cut_bits=4, least=8), "coded")
    got = {r.doc_id: r.ids for r in coded.collect()}
    assert got == {k: library.encode(t, add_special_tokens=False).ids for k, t in docs}
    back = {r.doc_id: r.text for r in chunk_bpe.decode_ids(coded).collect()}
    assert back == {k: library.decode(ids, skip_special_tokens=False) for k, ids in got.items()}
