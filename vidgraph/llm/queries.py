"""The registered query of each operator: ``opN_<name>(spark, sf_dir)`` over the
whole intended table, with the digest columns that its contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidgraph.llm import (
    chat,
    decontaminate,
    embeddings,
    language,
    lexical,
    licenses,
    lines,
    mixing,
    quality,
    sharding,
    simhash,
    token_files,
    trie,
)
from vidgraph.llm.common import scratch, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources at shares proportional to the square root of their size, one epoch."""
    out = mixing.mix_sources(table(spark, sf_dir, "documents"), alpha=0.5, epochs=1.0, seed=42)
    return out.select("shuffle_key", "doc_id", "copy", "n_copies", "source", "text")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``conversations`` is a record of the turn-row layout."""
    control = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  control.alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    records = rows.select("conv_id", F.col("turn").alias("seq"),
                          F.to_variant_object(F.struct("role", "text")).alias("record"))
    out = scratch(chat.format_chats(records), "chats")
    turns, loss = chat.parse_turns(F.col("formatted")), chat.loss_texts(F.col("formatted"), F.col("loss_spans"))
    read = out.select("conv_id", turns.alias("turns"), F.array_join(loss, "").alias("loss"),
                      F.length("formatted").cast("bigint").alias("formatted_chars"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)
    return out.select("vec_id", "n_links", "component_id", "kept")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.token_folder(spark)
    manifest = token_files.write_tokens(table(spark, sf_dir, "documents"), folder, token_files.default_tokenizer())
    return token_files.read_index(manifest, folder)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                      F.array_join("base_labels", ",").alias("base_labels"),
                      F.array_join("labels", ",").alias("labels"), "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = trie.rebuilt_turns(table(spark, sf_dir, "conversations"), group=100, most=6)
    return trie.prefix_trie(turns, convs)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return out.select("doc_id", *sharding.ADDED)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_mixing, op3_simhash_near_dedup, op4_chat_formatting, op5_embedding_near_dedup,
    op6_language_id, op7_quality_classifier, op8_token_ids, op9_benchmark_decontamination, op10_license_scan,
    op11_prefix_trie, op12_ranked_search, op13_sharding)}
