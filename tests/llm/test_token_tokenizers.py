"""op8: other tokenizers, folders as Spark names them, null and repeated ids, given orders."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from vidgraph.llm import token_files


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name,cuts", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_random_texts_of_every_tokenizer(name, cuts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    library, encoder, rng = Tokenizer.from_file(path), token_files.Encoder(path, escape=False), random.Random(9)
    assert encoder.cuts == cuts
    parts = [", ", ". ", ".\n", "a", "bc", "don't", "É", " ", "  ", "\n", "1", "42", "é", "<|endoftext|>", "<|startoftext|>", "Z"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(6000)]
    assert encoder.encode(texts) == [np.array(ids_of(library, t), dtype="<u2").tobytes() for t in texts]


@pytest.mark.parametrize("folder,expected", [
    ("/data/x", "file:///data/x"), ("file:/data/x", "file:///data/x"), ("file:///data/x/", "file:///data/x"),
    ("s3a://bucket/x", "s3://bucket/x"), ("s3://bucket/x", "s3://bucket/x"), ("gs://bucket/x", "gs://bucket/x"),
    ("hdfs://host:8020/x", "hdfs://host:8020/x"), ("abfss://c@a.dfs.core.windows.net/x", "abfss://c@a.dfs.core.windows.net/x"),
    ("wasbs://c@a.blob.core.windows.net/x", "abfss://c@a.dfs.core.windows.net/x"),
    ("wasb://c@a.blob.core.windows.net/x", "abfs://c@a.dfs.core.windows.net/x")])
def test_folders_as_spark_names_them(folder, expected):
    assert token_files.arrow_uri(folder) == expected


def test_unknown_schemes_fail_before_the_job(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for folder in ("oss://bucket/x", "relative/x"):
        with pytest.raises(ValueError):
            token_files.write_tokens(docs, folder, token_files.default_tokenizer())


def test_null_and_repeated_ids_and_clashing_columns(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_files.default_tokenizer())
    rows = [(None, "no id"), (None, None), (5, "same"), (5, "same"), (5, "other"), (2, "x" * 200_000), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("clash")).withColumn("place", F.lit(1))
    manifest = token_files.write_tokens(docs.repartition(3), f"file:{tmp_path}/out", token_files.default_tokenizer())
    got = sorted(map(tuple, token_files.read_index(manifest, f"{tmp_path}/out").collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 2, 2, 5, 5, 5]
    assert [r[1] for r in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))]
    crc = {(i, zlib.crc32(np.array([*ids_of(library, t), 0], "<u4").tobytes())) for i, t in rows}
    assert {(r[0], r[3]) for r in got} == crc


def test_equal_rows_are_dealt_to_many_files(spark, tmp_path):
    docs = spark.range(4000).select(F.lit(7).alias("doc_id"), F.lit("the same text").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data would fit one
    try:
        manifest = token_files.write_tokens(docs, str(tmp_path / "out"), token_files.default_tokenizer()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(manifest) > 1 and max(m["n_docs"] for m in manifest) < 3500


def test_a_given_order_is_that_of_the_files(spark, tmp_path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    order = F.xxhash64(F.lit(3), "doc_id")
    manifest = token_files.write_tokens(docs, str(tmp_path / "out"), token_files.default_tokenizer(), order=order)
    got = [r["doc_id"] for r in token_files.read_index(manifest, str(tmp_path / "out")).orderBy("start").collect()]
    assert got == [r["doc_id"] for r in docs.orderBy(order).collect()] != sorted(got)
