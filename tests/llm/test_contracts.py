"""Stages held open together, columns with the names operators use, the plain
library's special tokens."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from hackney.llm import common, token_files

WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
DOCS = [(1, WORDS + " mail a@b.example.com", "en", "a", 5), (2, WORDS + " mail a@b.example.com", "en", None, None),
        (3, "other " * 3 + WORDS[::-1] + " and again some more", "en", "a", 1), (4, "few", "en", "a", 1), (5, None, None, None, None)]
CLASH = ("row", "__row", "key", "__key", "__text", "__n", "n", "n_", "__rest", "__base", "base", "loose", "col_0", "col_1", "id", "norm", "group")


@pytest.fixture(scope="module")
def docs(spark):
    common.prepare(spark)
    base = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long")
    return common.stored(base.withColumns({c: F.concat(F.lit(c + ":"), F.col("doc_id").cast("string")) for c in CLASH}), "clash")


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(1, "nothing of it")], "item_id long, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_of_any_name(spark, docs, sf_dir, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{c}:{r.doc_id}" for r in rows for c in CLASH)


def test_two_results_of_a_stage_stay_readable(spark, docs, sf_dir):
    run = dict(corpus_pipeline.STAGES)
    first = run["ngram_jaccard"](spark, docs, sf_dir)
    second = run["ngram_jaccard"](spark, docs.where("doc_id <> 1"), sf_dir)
    third = run["decontamination"](spark, docs, sf_dir)
    assert sorted(r.doc_id for r in first.collect()) == [1, 3, 4, 5]
    assert sorted(r.doc_id for r in second.collect()) == [2, 3, 4, 5]
    assert third.count() == len(DOCS)


def test_run_deletes_its_tables_and_its_result_stays(spark, docs, sf_dir, monkeypatch):
    docs.write.mode("overwrite").parquet(f"{sf_dir}/documents.parquet")
    since = common.stored_so_far()
    out = corpus_pipeline.run(spark, sf_dir)
    left = [p for p in common._STORED[since:] if p]
    assert len(left) == 1 and sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_special_tokens_as_the_untouched_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    texts = ["<|endoftext|> hello", "a  <|endoftext|>  b", "x<|endoftext|>y\n\n<|endoftext|>", "<|endoftext", "plain text", " \n <|endoftext|>",
             "word " * 3000 + "<|endoftext|>" + " word" * 3000]
    mine = token_files.Encoder(token_files.load(public_tokenizers.path(token_files.VOCABULARY)), "<u2")
    assert [np.frombuffer(x, "<u2").tolist() for x in mine.encode(texts)] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in library.encode(texts[0], add_special_tokens=False).ids
