"""The named queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import (
    conversations, decontaminate, language, line_dedup, near_dedup, neighbours, passages, pieces, quality, sharding, suffix_dedup,
    url_filter, whitening,
)
from tillstream.llm.rows import in_small_batches
from tillstream.session import new_folder

MODEL_FILE = "TOKENIZER_MODEL"
URL_RULES = [
    url_filter.Rule("allow", "org/"), url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"), url_filter.Rule("allow", "com/fr/"), url_filter.Rule("block", "com/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    in_small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def vocabulary() -> pieces.Vocabulary:
    """The public vocabulary, or the model file that the environment names."""
    if MODEL_FILE in os.environ:
        return pieces.Vocabulary.load(os.environ[MODEL_FILE])
    import public_tokenizers

    return pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))


def op1_line_dedup(spark, sf_dir):
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_spans", digest(F.col("text")).alias("kept_sha256"))


def op2_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", digest(F.col("kept")).alias("kept_sha256"))


def op3_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_dedup.near_duplicates(docs, words=2)
    return found.select("doc_id", *near_dedup.RESULTS)


def op4_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", *quality.RESULTS)


def op6_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "contaminated",
        F.size("leaks").cast("long").alias("n_passages"),
        F.array_sort(F.array_distinct(F.col("leaks.item_id"))).alias("item_ids"),
    )


def op7_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.repeated_passages(docs).select("doc_id", *passages.RESULTS)


def op8_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    weights = url_filter.train(url_filter.labelled_by_rules(pages, URL_RULES))
    return url_filter.judge_urls(pages, URL_RULES, weights).drop("url")


def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~language.held_out()))
    found = language.predict(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op10_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode_and_decode(docs, vocabulary())
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        digest(F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


def op11_embedding_whitening(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select(
        F.col("id").alias("vec_id"), "component", "n", F.col("deviation").try_cast("long").alias("deviation"),
        "whitened", "explained", "identity_error", F.col("deviation").alias("deviation_wide"),
    )


def op12_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sharding.shard_records(docs, new_folder(spark, "llm-slot-maps"), shards=24)
    return found.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with the faults that op13 repairs, chosen by a checksum of id and turn; dropped rows are not `present`."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault, text = F.crc32(key.cast("binary")) % 20, F.coalesce(F.col("text"), F.lit(" "))
    copies = F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))
    return turns.select(
        "conv_id", "turn", (fault != 0).alias("present"),
        F.when(fault == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversations.repair_conversations(damaged(turns), present="present")
    return conversations.with_digest(found, "repaired_sha256").drop("repaired").withColumnRenamed("conv", "conv_id")


QUERIES = [
    op1_line_dedup, op2_suffix_dedup, op3_near_dedup, op4_nearest_neighbours, op5_quality,
    op6_decontamination, op7_substring_dedup, op8_url_filter, op9_language_id, op10_sentencepiece,
    op11_embedding_whitening, op12_sharding, op13_conversation_repair,
]


def queries():
    return {query.__name__: query for query in QUERIES}
