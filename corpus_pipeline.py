"""The corpus pipeline: stages over ``documents``, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidgraph.llm import decontaminate as decontamination
from vidgraph.llm import mixing, quality, simhash, token_files
from vidgraph.llm.common import quoted, scratch, table, text_hash


def _columns(docs: DataFrame):
    return [quoted(c) for c in docs.columns]


def _kept_by(docs: DataFrame, added: list[str], operator: Callable[[DataFrame], DataFrame], condition: str) -> DataFrame:
    """The rows of ``docs`` that ``operator`` returns and ``condition`` holds for,
    with the documents' own columns, also where an added one has the same name."""
    low = {c.lower() for c in added}
    own = {c: f"__own_{i}" if c.lower() in low else c for i, c in enumerate(docs.columns)}
    out = operator(docs.select(*[quoted(c).alias(name) for c, name in own.items()])).where(condition)
    return out.select(*[quoted(name).alias(c) for c, name in own.items()])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores below 0.5 go; null and empty texts are
    scored like others, repeated rows alike; without labels all score 0.5 and stay;
    an empty table gives an empty one (as in all stages)."""
    labels = table(spark, sf_dir, "labels")
    return _kept_by(docs, quality.ADDED, lambda d: quality.score_quality(d, labels), "predicted = 1")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (3-word shingles, 3 bits) one document stays:
    the smallest id (a null id only where the group has no other), then the
    smallest text hash; of equal rows one."""
    found = simhash.near_duplicates(docs, shingle=3, radius=3).where("representative")
    kept = scratch(found.select(F.col("doc_id").alias("__id"), F.col("xh").alias("__xh")).distinct(), "kept-documents")
    xh = text_hash(F.col("text"))
    named = docs.where(F.col("doc_id").isNotNull()).join(kept, (F.col("doc_id") == F.col("__id")) & (xh == F.col("__xh")))
    named = named.dropDuplicates(["__id", "__xh"]).select(*_columns(docs))
    nameless = docs.where(F.col("doc_id").isNull()).join(kept.where(F.col("__id").isNull()), xh == F.col("__xh"))
    return named.unionByName(nameless.dropDuplicates(["__xh"]).select(*_columns(docs)))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages (one word in twenty or more) go; null and
    empty texts hold none, repeated rows go or stay together, an empty benchmark
    lets all stay; texts are read whole."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _kept_by(docs, decontamination.ADDED, lambda d: decontamination.decontaminate(d, benchmark),
                    "not contaminated")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at shares proportional to the square root of their size, one epoch: a
    document stays as often as it is drawn.  A null source is one of its own, null
    and empty texts are drawn like others, repeated rows are drawn alike."""
    return _kept_by(docs, mixing.ADDED, lambda d: mixing.mix_sources(d, alpha=0.5, epochs=1.0, seed=42), "n_copies > 0")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents in mixed order and, read back from them, their index
    (``start``: the place in that order).  The order is a hash of the id and the
    row's place in the input, so the copies that mixing made lie apart; null and
    empty texts are an end id each."""
    folder = token_files.token_folder(spark)
    order = F.xxhash64(F.lit(42), F.col("doc_id"), F.monotonically_increasing_id())
    manifest = token_files.write_tokens(docs, folder, token_files.default_tokenizer(), order=order)
    return token_files.read_index(manifest, folder, docs.schema["doc_id"].dataType.simpleString())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token ids", token_output),
]
ORACLE_SQL = None  # trains a model, takes XXH64 fingerprints and writes binary files; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each works on what the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
