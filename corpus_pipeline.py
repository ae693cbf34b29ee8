"""From documents to packed training sequences: four stages, each over all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's documents.  All but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennia.llm import bpe, language, minhash, packing, toxicity
from perennia.llm.common import prepare, temporary
from perennia.sources.scratch import stored

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language is not certain enough from text, declaration and source, go."""
    prepare(spark)
    text, declared, host = F.col("text"), F.col("lang"), F.col("source")
    model = language.learn_text(docs, text, declared, F.col("doc_id"))
    if not model.languages:  # nothing is known about languages: letters decide
        return docs.filter(language.has_letters(text))
    model = language.learn_evidence(language.evidence(docs, model, text, declared, host), model)
    letters, found, sure = temporary("letters"), temporary("language"), temporary("confidence")
    columns = docs.columns
    own = {c: temporary(c) for c in ("language", "confidence") if c in columns}  # an input's columns of these names
    rows = docs.withColumnsRenamed(own).withColumn(letters, language.has_letters(text))
    rows = language.identify(rows, model, text, declared, host)
    rows = rows.withColumnsRenamed({"language": found, "confidence": sure})
    rows = rows.filter(language.is_kept(F.col(letters), F.col(sure)))
    return rows.withColumnsRenamed({v: k for k, v in own.items()}).select(*[F.col(f"`{c}`") for c in columns])


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; labels of a third of the rows are held out, as in the operator's own query."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    model, _ = toxicity.fit(docs, labels.filter(~held_out))
    return toxicity.drop_toxic(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least id, once.

    Of rows of one id that differ, the least in the order of the columns stays.
    """
    prepare(spark)
    found = minhash.near_duplicates(docs)
    name = temporary("id")
    gone = stored(found.filter("not kept").select(F.col("doc_id").alias(name)).distinct())
    named = docs.filter("doc_id is not null").join(gone, F.col("doc_id") == F.col(name), "left_anti")
    # rows of one id are one document
    repeated = docs.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select(F.col("doc_id").alias(name))
    once = named.join(repeated, F.col("doc_id") == F.col(name), "left_anti")
    twice = named.join(repeated, F.col("doc_id") == F.col(name), "left_semi")
    row = F.struct("doc_id", *[F.col(f"`{c}`") for c in docs.columns if c != "doc_id"])
    twice = twice.groupBy("doc_id").agg(F.min(row).alias(name)).select(f"{name}.*").select(docs.columns)
    return once.unionByName(twice).unionByName(docs.filter("doc_id is null"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(packing.cut_tokens(docs, bpe.vocabulary(spark, VOCABULARY)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("minhash_near_dedup", near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: The stages hold trained models and hashes that SQL cannot state; the tests compare run() with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
