"""A pipeline over documents; each stage is written as Parquet and read again as the next one's input.

Nulls, empty tables and further columns pass as the operators define. Rows of one doc_id count as one document: they stay
or go together, and equal ones are merged where groups of near copies are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language, mixing, ngrams, pieces, toxicity
from tidemark.llm.common import FOLDS
from tidemark.operators.align import small
from tidemark.session import materialize

#: A text of n bytes may take RATE times the usual phrases per byte, and DEVIATIONS of the deviation that such a rate has over n
#: bytes, for whatever n. A rate of 1, where hardly a match is longer than one byte, is too much for any text.
RATE, DEVIATIONS = 1.5, 4.0
#: The fold of crc32 from whose labelled documents usual rates are read; languages are learned from those in neither it nor fold 0.
USUAL_FOLD = 1
ONE = "doc"


def as_one(docs: DataFrame, *columns: str) -> DataFrame:
    """A document as one column, whatever its columns are called, beside those that a stage reads."""
    return docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias(ONE), *columns)


def usual(docs: DataFrame) -> Column:
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % FOLDS == USUAL_FOLD


def rate_bound(docs: DataFrame, sample: tuple) -> Column:
    """Phrases per byte from which a text is in none of the learned languages, by its length."""
    size = F.octet_length("text")
    new = docs.where(usual(docs) & F.col("lang").isNotNull()).select("doc_id", "text", "lang", size.alias("size"))
    rates = language.identify(new, sample, keep=("lang", "size")).where("lang_pred = lang")
    mean = rates.agg(F.try_divide(F.sum(F.col("phrase_rate") * F.col("size")), F.sum("size"))).first()[0]
    if mean is None:
        return F.lit(1.0)
    spread = rates.agg(F.sqrt(F.avg((F.col("phrase_rate") - mean) ** 2 * F.col("size")))).first()[0]
    # No division fails for an empty text; its bound is the largest.
    return F.least(F.lit(1.0), RATE * mean + F.try_divide(F.lit(DEVIATIONS * spread), F.sqrt(size)))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language: no letters, or too short matches with every learned language, is a rejection."""
    sample = language.learn(docs.where(~F.coalesce(usual(docs), F.lit(False))))
    bounded = as_one(docs, "doc_id", "text").withColumn("bound", rate_bound(docs, sample))
    found = language.identify(bounded, sample, keep=(ONE, "bound"))
    return found.where((F.col("lang_pred") != "und") & (F.col("phrase_rate") < F.col("bound"))).select(f"{ONE}.*")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are not predicted toxic; the classifier learns from the labels of the documents that came here."""
    model = toxicity.learn(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(as_one(docs, "doc_id", "text"), model, keep=(ONE,)).where("predicted = 0").select(f"{ONE}.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group that n-gram links connect, and all documents without words."""
    joined = ngrams.join(docs.select("doc_id", "text")).withColumn("stays", F.expr("n_shingles = 0 OR doc_id <=> component_id"))
    # What goes, and the ids of several rows, are the smaller parts: the texts of the others are not shuffled.
    ids = materialize(joined.groupBy(F.col("doc_id").alias("other")).agg(F.max("stays").alias("stays")), "pipeline-ids")
    several = docs.groupBy(F.col("doc_id").alias("other")).agg(F.count("*").alias("rows")).where("rows > 1")
    several = materialize(several, "pipeline-several")
    own = as_one(docs, F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    kept = own.join(small(ids.where("NOT stays")), F.col("id").eqNullSafe(F.col("other")), "left_anti")
    again = small(several.select(F.col("other").alias("again"), "rows"))
    kept = kept.join(again, F.col("id").eqNullSafe(F.col("again")), "left")
    copies = kept.where("rows IS NOT NULL").dropDuplicates(["id", "text"])
    return kept.where("rows IS NULL").select(f"{ONE}.*").unionByName(copies.select(f"{ONE}.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    return mixing.repeated(as_one(docs, "doc_id", "text", "source"), ONE).select(f"{ONE}.*")


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document of the mix, as digests."""
    return pieces.digests(docs, public_tokenizers.path(pieces.MODEL))


STAGES = [("language ID", language_id), ("toxicity", toxicity_filter), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources", mix_sources), ("SentencePiece", encode_pieces)]
#: No stage but the mix can be stated in SQL; tests/llm/test_pipeline.py compares the pipeline with plain Python stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
