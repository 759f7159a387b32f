"""Corpus preparation: five of the training-data operators, one after another.

Language identification and toxicity reject documents, the n-gram Jaccard join
keeps one document of each group of near duplicates, mixing keeps documents at
the rates that bring the quality domains to their target weights, and packing
turns what is left into training sequences.  Every stage is written as Parquet
and read again by the next; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.llm import jaccard_join, langid, mixing, packing, toxicity
from riskloom.llm.common import small_batches, stored, table, temp_name

MIN_LANGUAGE_SCORE = 0.2    # below it a text resembles no learned language
MIX_TARGETS = {"q1": 0.95, "q0": 0.05}

# SQL cannot express the stages (learned profiles, Viterbi decoding, projected
# gradient, tokenisation); tests/llm compares them with brute-force versions.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts that are far from every language's profile."""
    small_batches(spark)
    x = temp_name(docs, "language")
    found = docs.withColumn(x, langid.fit_profiles(docs).column(F.col("text")))
    return found.where((F.col(f"{x}.lang_pred") != langid.UND) & (F.col(f"{x}.score") >= MIN_LANGUAGE_SCORE)).drop(x)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic."""
    x = temp_name(docs, "toxicity")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.withColumn(x, model.column(F.col("text"))).where(F.col(x) < toxicity.THRESHOLD).drop(x)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each component (and of rows that repeat an id, one)."""
    members = stored(jaccard_join.similar(docs)[0].select("doc_id", "component_id"), "near-duplicates")
    x = temp_name(docs, "dropped")
    dropped = members.where("doc_id <> component_id").select(F.col("doc_id").alias(x)).distinct()
    kept = docs.join(stored(dropped, "dropped"), F.col("doc_id") == F.col(x), "left_anti")
    repeated = members.groupBy("doc_id").count().where("count > 1 and doc_id is not null").limit(1).count()
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null")) if repeated else kept


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps each document with the chance of its rate (at most 1), drawn from its id's hash."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("domain"))
    rows, x = mixing.mix(docs, mixing.fit_domains(docs, labels), MIX_TARGETS, budget="available", most=1.0)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return rows.where(draw < F.col(f"{x}.rate")).drop(x)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
