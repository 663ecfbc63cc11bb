"""Operators that DuckDB can express (1, 2, 4, 5, 9 to 12): SQL agreement and defined cases."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import PASSAGE, SHARED
from vidgraph.llm import chat, decontaminate, licenses, lines, mixing, oracles, queries

SF = "/root/testdata/sf0.001"


def agree(spark, name, folder):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        path = f"{folder}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path if folder == SF else path + '/*.parquet'}')")
    df = queries.QUERIES[name](spark, folder)
    cur = con.execute(oracles.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted((tuple(r) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert [pytest.approx(x) if isinstance(x, float) else x for x in b] == list(a)
    return got


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_sql_agreement(spark, name):
    assert agree(spark, name, SF)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_sql_agreement_on_odd_corpus(spark, odd_dir, name):
    agree(spark, name, odd_dir)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_empty_tables(spark, empty_dir, name):
    rows = queries.QUERIES[name](spark, empty_dir).collect()
    assert len(rows) == (1 if name == "op4_chat_formatting" else 0)


def test_line_dedup_repeated_and_nameless_rows(spark, repeated):
    """Equal ids are one document; rows without an id lose nothing."""
    out = lines.dedup_lines(repeated.withColumn("n_dropped", F.lit("clash"))).collect()
    assert len(out) == 12 and sorted(out[0].asDict()) == ["doc_id", "n_dropped", "n_lines", "source", "text"]
    line = SHARED.strip()
    for r in out:
        held = (r["text"] or "").startswith(line)
        assert held == (r["doc_id"] in (None, 7) and r["text"] != "")
        assert r["n_dropped"] == int(r["doc_id"] in range(1, 7) and r["text"] != "other words here")


def test_line_dedup_with_a_full_filter(spark, odd_dir):
    """A filter far too small lets everything through and changes nothing."""
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    a = lines.dedup_lines(docs).select("doc_id", "text").collect()
    b = lines.dedup_lines(docs, filter_bits=1).select("doc_id", "text").collect()
    assert sorted(a) == sorted(b)


def test_mixing_follows_weights(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"),
                                    F.when(F.col("id") % 4 == 0, "small").otherwise("large").alias("source"))
    weights = spark.createDataFrame([("small", 3.0), ("large", 1.0), ("absent", 5.0)], "source string, weight double")
    weights = weights.where("source <> 'absent'")
    out = mixing.mix_sources(docs, weights, epochs=1.0)
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["small"] / 3000 - 1) < 0.1 and abs(n["large"] / 1000 - 1) < 0.1
    per = out.where("source = 'small'").groupBy("doc_id").count().groupBy("count").count().collect()
    zero = 1 - sum(r[1] for r in per) / 1000
    assert abs(zero - 0.0498) < 0.03  # Poisson with mean 3
    assert out.collect() == mixing.mix_sources(docs, weights, epochs=1.0).collect()


def test_mixing_large_rates_and_nulls(spark, repeated):
    weights = spark.createDataFrame([("a", 1.0), (None, 100000.0)], "source string, weight double")
    out = mixing.mix_sources(repeated.withColumn("copy", F.lit("clash")), weights, epochs=3.0)
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    size = repeated.where("source = 'a' or source is null").agg(F.sum(F.length(F.coalesce("text", F.lit(""))) + 1)).first()[0]
    assert "b" not in n and abs(n[None] / (3 * size) - 1) < 0.15
    assert out.where("source is null").agg(F.max("copy")).first()[0] == n[None]


def record(spark, conv_id, seq, text):
    return spark.range(1).select(F.lit(conv_id).alias("conv_id"), F.lit(seq).alias("seq"),
                                 F.parse_json(F.lit(text)).alias("record"))


def test_chat_layouts(spark):
    """Messages, prompt and instruction layouts give the same canonical turns."""
    texts = [
        '{"id": 7, "messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant", "x": 1}]}',
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}',
        '{"prompt": "q", "response": "a"}', '{"prompt": "q", "completion": "a", "extra": [1]}',
        '{"instruction": "q", "output": "a"}', '{"question": "q", "answer": "a"}',
        '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": null}]}',
        '{"system": "s", "prompt": "q", "response": "a"}', '{"nothing": 1}', '{"messages": []}',
        '{"instruction": "q", "input": "i", "output": "a"}', '"text"', 'null',
    ]
    rows = record(spark, 0, 0, texts[0])
    for i, t in enumerate(texts[1:], 1):
        rows = rows.unionByName(record(spark, i, 0, t))
    out = chat.format_chats(rows)
    got = {r["conv_id"]: r for r in out.select("*", chat.parse_turns(F.col("formatted")).alias("t")).collect()}
    turns = {k: [(x["role"], x["text"]) for x in r["t"]] for k, r in got.items()}
    qa = [("user", "q"), ("assistant", "a")]
    assert all(turns[k] == qa for k in range(6))
    assert turns[6] == [("user", "q"), ("assistant", "")] and turns[7] == [("system", "s"), *qa]
    assert turns[10] == [("user", "q\ni"), ("assistant", "a")]
    for k in (8, 9, 11, 12):
        assert turns[k] == [] and got[k]["n_unknown"] == 1 and got[k]["formatted"] == chat.STOP


def test_chat_escaping_round_trip(spark):
    rng = random.Random(5)
    parts = ["<", "[", "\\", "|im_end|>", "s>", "/s>", "INST]", "/INST]", "SYS>", "|im_start|>", "x", "é", "\n", "$1"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not any(c in r["e"] for c in ("<|im_end|>", "<|im_start|>", "<s>", "</s>", "[INST]", "[/INST]", "<SYS>"))


def test_decontamination_repeated_rows(spark, repeated):
    bench = spark.createDataFrame([("i", PASSAGE), (None, "number 3 of them")], "item_id string, text string")
    out = decontaminate.decontaminate(repeated.withColumn("N_HIT", F.lit("clash")), bench).collect()
    assert len(out) == 12
    for r in out:
        t = r["text"] or ""
        assert r["item_ids"] == (["i"] if PASSAGE in t else [])
        assert r["n_hit"] == (20 if PASSAGE in t else 4 if "number 3" in t else 0)


def test_license_repeated_rows_and_no_templates(spark, repeated):
    docs = repeated.unionByName(spark.createDataFrame([(9, "Released under the MIT License", "z")], repeated.schema))
    out = {(r["doc_id"], r["n_words"]): r for r in licenses.scan_licenses(docs).collect()}
    assert out[(9, 5)]["labels"] == ["mit", "mit-notice"] and out[(9, 5)]["score"] == 1.0
    plain = licenses.scan_licenses(docs, templates={})
    assert plain.count() == 13 and plain.where("doc_id = 9").first()["labels"] == ["mit"]


def test_very_long_text(spark):
    """400,000 words in one row: linear work, whole result."""
    text = " ".join(f"w{i % 5000}x" for i in range(400_000))
    docs = spark.createDataFrame([(1, f"{text} {PASSAGE}\nmit license"), (2, "short")], "doc_id long, text string")
    bench = spark.createDataFrame([("i", PASSAGE)], "item_id string, text string")
    out = {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert out == {1: (400_022, 20), 2: (1, 0)}
    out = {r["doc_id"]: (r["n_base"], r["last_word"]) for r in licenses.scan_licenses(docs).collect()}
    assert out == {1: (1, 400_020), 2: (0, None)}
