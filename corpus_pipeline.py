"""Training data from documents: languages told apart, copies and private data out, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratawell.llm import langid, packing, privacy, simhash, substrings
from stratawell.llm.common import Steps, id_bucket
from stratawell.llm.queries import WORD_TOKENIZER

#: No SQL states nearest centroids or a packing; tests hold every stage against plain Python.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the documents teach; what is too far from all goes.

    The centroids are fitted on the documents of ``docs`` that op5 learns from.  NULL texts and
    texts without letters go.  How close a text must be depends on its number of words, so short
    texts of a known language stay.
    """
    held_out = F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs.filter(~held_out), "text", "lang", F.xxhash64("doc_id"))
    found = langid.identify(docs, model)
    return found.filter(~F.col(found.columns[-1])).select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return simhash.drop_near_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 35 words that occur anywhere else among them."""
    return substrings.drop_repeated_passages(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return privacy.mask_private(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: the pieces of all documents with their places."""
    return packing.pack(docs, WORD_TOKENIZER, added_tokens=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = Steps(spark)
    for _, stage in STAGES[:-1]:
        docs = steps.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
