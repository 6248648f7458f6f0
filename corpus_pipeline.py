"""From raw documents to packed training sequences, in five stages over the whole corpus.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next one's ``docs``. All but the last return the columns of ``documents``. Nulls,
empty texts, repeated rows, empty tables and further columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flakeform.llm import decoding, jaccard, language, mixing, packing
from flakeform.llm.common import crc_fold, documents, importable, small_batches
from flakeform.sources.staging import stage


def _prepare(spark: SparkSession) -> None:
    importable(spark)
    small_batches(spark)


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told; learn from the labelled ones outside the held-out fold."""
    _prepare(spark)
    model = language.train(docs.filter(crc_fold(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang"))
    return language.known_language(docs, model) if model.languages else docs.limit(0)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    _prepare(spark)
    return jaccard.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets, nested ones too, by their kind."""
    _prepare(spark)
    return decoding.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and drop documents so that sources come near their target weights."""
    _prepare(spark)
    return mixing.mix_sources(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all rows, with their places in sequences. ``copy`` tells repeated rows apart."""
    _prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language", told_language),
    ("near_duplicates", one_per_group),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: No SQL states a trained model, decoded layers or bounded-space packing; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
