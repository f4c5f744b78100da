"""One query per operator, over its whole table and whole texts.

Each takes (spark, sf_dir) and returns the columns that the operator's contract names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratawell.llm import (
    decontaminate,
    fill_middle,
    hard_negatives,
    kdtree,
    kneser_ney,
    langid,
    packing,
    pieces,
    privacy,
    quantised,
    simhash,
    site_quality,
    substrings,
)
from stratawell.llm.common import Steps, id_bucket, lowest_hashes

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, WORD_TOKENIZER, added_tokens=True).select(
        "doc_id",
        "piece",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_bucket("doc_id", 7) == 2, F.lit(False))
    model = kneser_ney.fit(docs.filter(~held_out))
    steps = Steps(spark)
    scored = steps.save(kneser_ney.score(docs, model))
    model.delete(steps)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "perplexity",
    )


def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised.vector_groups(_table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_bucket("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs.filter(~held_out), "text", "lang", F.xxhash64("doc_id"))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out.alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def op6_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return kdtree.largest_products(vectors, F.col("vec_id") % 100 == 0)


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.drop_repeated(docs).select(
        "doc_id",
        "removal.n_words",
        "removal.n_removed",
        F.sha2("removal.kept", 256).alias("kept_sha256"),
    )


def op8_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of documents by text, host and path.

    ``documents`` has no URL, so ``source`` stands for the host and ``lang`` for the path below it:
    the path posterior is that of a language within a source.
    """
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    place = F.xxhash64("doc_id")
    labels = _table(spark, sf_dir, "labels")
    near = lowest_hashes(place, labels.count(), site_quality.SAMPLE)
    sample = labels.filter(near).orderBy(place, "doc_id").limit(site_quality.SAMPLE)
    models = site_quality.fit_text(
        docs.join(F.broadcast(sample), "doc_id"), "text", ["quality", "toxic"], place
    )
    scored = site_quality.site_quality(docs, models, F.col("source"), F.col("lang"))
    good = (F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)
    return scored.select("doc_id", "host", "path", "quality", "toxic", good.alias("kept"))


def _is_a(name: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == name


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = privacy.find_private(docs).select("doc_id", "private")
    base = F.filter("private", lambda s: s["kind"].isin([k.name for k in privacy.BASE]))

    def text(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    return found.select(
        "doc_id",
        *[
            F.size(F.filter("private", _is_a(kind.name))).cast("bigint").alias(f"n_{kind.name}")
            for kind in privacy.BASE
        ],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("private")).alias("spans"),
    )


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_decode(_table(spark, sf_dir, "documents"), PIECE_MODEL)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, items, window=10)
    names = F.array_sort(F.transform("items", lambda item: item.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_middle.rearrange(_table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    moved = (F.col("label") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_simhash_dedup,
        op2_best_fit_packing,
        op3_kneser_ney,
        op4_vector_dedup,
        op5_language_id,
        op6_top_products,
        op7_repeated_passages,
        op8_site_quality,
        op9_personal_data,
        op10_pieces,
        op11_decontamination,
        op12_fill_middle,
        op13_hard_negatives,
    )
}
