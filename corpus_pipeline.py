"""Corpus pipeline: documents without toxic, repeated, nearly repeated and contaminated ones, as tokens.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame; all but
the last return the columns of ``documents``. Clean documents stay. Edge cases are those of the operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import session
from tidegrid.llm import bpe_codec, decontaminate, exact_dedup, minhash, toxicity

TOKENIZER = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from all labelled ones, doesn't call toxic."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of the smallest doc_id."""
    return exact_dedup.first_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similarity 0.8 or more, in shingles of five words, the document of the smallest doc_id.

    These are the values that hold for stages; only the query op6 is bound to three words and 0.85.
    """
    return minhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, with the text that these decode to."""
    out = bpe_codec.round_trip(docs, public_tokenizers.path(TOKENIZER)).withColumn("n_tokens", F.size("token_ids").cast("long"))
    return out.withColumn("round_trip", F.col("decoded") == F.coalesce("text", F.lit(""))).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("bpe_codec", tokenize),
]

#: The classifier, the transducer and the components have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole of ``documents``, each result but the last written to the shared folder.

    The table that the last stage reads stays there as long as the result is wanted.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = session.written(stage(spark, docs, sf_dir), name)
        session.discard(docs)  # of the stage before, once nothing reads it any more
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
