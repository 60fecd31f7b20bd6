"""Corpus cleaning as a chain of stages over the documents table.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet to the shared folder and
reread as the next stage's docs.  All but the last return the columns of
documents, in any number and of any name.  A stage's result is lazy and may read
tables that the stage stored; only `run`, which has written the result, deletes
them.

Edge cases: a null text counts as the empty text and stays null; texts without
ten words go at the first stage; of equal or near-equal documents the one with
the smallest id stays (of rows with that id the first, ids before none), so of
repeated rows one; documents without an id are judged like others; empty tables
give empty results; other columns, nulls included, pass through unchanged, but
for ``n_chars``, which follows the redacted text where it is not null.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.llm import byte_bpe, common, decontam, lsh_forest, pii, quality_cascade


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(f: Stage) -> Stage:
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.prepare(spark)
        return f(spark, docs, sf_dir)
    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_cascade.keep_good(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies and near copies (five-word shingles, 0.8) the
    document with the smallest doc_id stays."""
    return lsh_forest.keep_one(docs)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go if benchmark windows cover a twentieth of their words."""
    return decontam.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


@_stage
def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the new text."""
    length = "n"
    while length in docs.columns:
        length += "_"
    clean = pii.redact(docs).withColumn(length, F.length("text").cast("long"))
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.col(length))).drop(length)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return byte_bpe.round_trip(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontaminate),
    ("pii", redact_pii),
    ("byte_bpe", encode),
]

# Near duplicates and learned span labels have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents of ``sf_dir``."""
    common.prepare(spark)
    docs = common.table(spark, sf_dir, "documents")
    before = None           # the mark of the table that holds docs
    for name, stage in STAGES[:-1]:
        mark = common.stored_so_far()
        out = stage(spark, docs, sf_dir)
        until = common.stored_so_far()
        docs = common.stored(out, name)
        common.release(spark, mark, until)
        if before is not None:
            common.release(spark, before, before + 1)
        before = until
    return STAGES[-1][1](spark, docs, sf_dir)
