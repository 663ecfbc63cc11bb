"""op6: every row's prediction restated from the same dictionaries; training takes whole texts and all labels."""

import math

import pytest
import regex
import zstandard
from pyspark.sql import functions as F

from vidgraph.llm import language, queries

SF = "/root/testdata/sf0.01"


def restated(text, dictionaries):
    """Plain form: whole text, 512-byte pieces, one sum per language."""
    raw = " ".join(regex.findall(r"\p{L}+", (text or "").lower())).encode()
    if not raw:
        return "und", 0.0
    sums = {}
    for lang, content in dictionaries.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        c = zstandard.ZstdCompressor(level=5, dict_data=d, write_content_size=False, write_dict_id=False)
        total, at = 0, 0
        while at < len(raw):
            piece = raw[at:at + 512]
            at += 512
            total += len(c.compress(piece if at < len(raw) else piece + b" " + b"#" * 64))
        sums[lang] = total
    least = min(sums.values())
    best = min(k for k, v in sums.items() if v == least)
    return best, 1 / sum(math.pow(2, -min(4 * (v - least), 1000)) for v in sums.values())


def test_all_rows_restated(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = language.train(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in queries.op6_language_id(spark, SF).collect()}
    assert got.keys() == texts.keys()
    close = 0
    for i, text in texts.items():
        lang, score = restated(text, dictionaries)
        if (got[i]["lang_pred"], pytest.approx(got[i]["score"], abs=1e-9)) != (lang, score):
            close += 1   # the library may compress with a prepared dictionary one byte apart
            assert got[i]["score"] < 0.9999 or got[i]["lang_pred"] == lang
    assert close <= 0.02 * len(texts)


def test_every_label_is_learned(spark):
    """Many labels: none is left out, dictionaries share the model's bytes."""
    rows = [(3 * i, f"x{i % 700}", " ".join(chr(97 + (i % 700 + k * k) % 26) * (2 + i % 5) for k in range(30))) for i in range(2100)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    found = language.train(docs, model=140_000)
    assert len(found) == docs.where(~language.held_out(F.col("doc_id"))).select("lang").distinct().count() > 600
    assert max(map(len, found.values())) <= 200


def test_excerpts_reach_the_end_of_a_text():
    raw = b"".join(b"%07d " % i for i in range(5000))
    got = language.excerpt(raw, 2048)
    assert len(got) == 2048 and got[:7] == b"0000000" and got[-8:] == b"0004999 "
    assert language.excerpt(raw, 100) in raw and language.excerpt(b"ab", 100) == b"ab"
    assert len(language.dictionary([b"short", raw, raw], 1005)) <= 1007


def test_repeated_null_ids_and_equal_sizes(spark):
    docs = spark.createDataFrame([(None, "aa", "abc abd abe"), (None, "bb", "abc abd abe"), (3, "bb", "abc abd abe"),
                                  (3, "bb", "abc abd abe"), (None, None, "abc")], "doc_id long, lang string, text string")
    out = language.identify(docs.withColumn("score", F.lit("clash"))).collect()
    assert len(out) == 5 and {r["lang_pred"] for r in out} == {"aa"}   # equal dictionaries: the smaller name
    assert not any(r["held_out"] for r in out if r["doc_id"] is None)
    assert all(r["rejected"] == (r["score"] < 0.6) for r in out)
