"""A training-data pipeline over `documents`: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import decontaminate, language, line_dedup, near_dedup, pieces
from tillstream.llm.queries import digest, table, vocabulary
from tillstream.llm.rows import in_small_batches, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go; it learns from the labels of the others it is given."""
    in_small_batches(spark)
    model = language.fit(docs.where(~language.held_out()))
    return language.predict(docs, model).where(~F.col("rejected")).select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; a document that loses all its lines goes."""
    found = line_dedup.dedup_lines(docs)
    kept = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, whatever ids its rows have."""
    in_small_batches(spark)
    return near_dedup.one_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and a digest of what they decode to."""
    in_small_batches(spark)
    found = pieces.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), vocabulary())
    return found.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_repeated_lines),
    ("MinHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("SentencePiece", encode_pieces),
]

#: The stages learn a model, hash and tokenise, which SQL does not express; tests/llm holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
