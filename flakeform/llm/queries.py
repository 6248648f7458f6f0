"""The operators as queries over whole tables, with the digest columns that checks compare."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flakeform.llm import (
    cascade,
    decoding,
    exact,
    fingerprint,
    jaccard,
    kneser_ney,
    language,
    maxent,
    mixing,
    negatives,
    packing,
    substring,
    whitening,
)
from flakeform.llm.common import crc_fold, documents
from flakeform.llm.vectors import embeddings

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.with_copies(documents(spark, sf_dir))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies"
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_fold(F.col("doc_id"), 4) == 2
    model = language.train(docs.filter(~held_out).select("doc_id", "text", "lang"))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir)).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprint.fingerprints(documents(spark, sf_dir))
    return prints.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        fingerprint.digest(F.col("print")).alias("fingerprint"),
        fingerprint.digest(F.col("edited_print")).alias("edited_fingerprint"),
        fingerprint.likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        fingerprint.likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decoding.scan_secrets(documents(spark, sf_dir))

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in decoding.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = maxent.score_documents(docs, crc_fold(F.col("doc_id"), 7) == 2)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = cascade.run_cascade(documents(spark, sf_dir))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *cascade.MEASURES, failed.alias("base_failed"), "kept")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(embeddings(spark, sf_dir))


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.duplicate_groups(documents(spark, sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(embeddings(spark, sf_dir).withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    name: function for name, function in sorted(globals().items()) if name.startswith("op") and name[2].isdigit()
}
