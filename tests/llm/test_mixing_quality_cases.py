"""op2: weights; op7: repeated rows, all rows restated."""

import math

import pytest
from pyspark.sql import functions as F

from vidgraph.llm import mixing, quality, queries

SF = "/root/testdata/sf0.01"


def corpus(spark):
    rows = [(i, f"text {i}" * 5, "abc"[i % 3]) for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_negative_and_infinite_weights_are_errors(spark):
    for bad in (-1.0, float("nan"), float("inf")):
        weights = spark.createDataFrame([("a", 2.0), ("b", bad)], "source string, weight double")
        with pytest.raises(ValueError):
            mixing.mix_sources(corpus(spark), weights)
    twice = spark.createDataFrame([("a", 2.0), ("a", -2.0)], "source string, weight double")
    with pytest.raises(ValueError):
        mixing.mix_sources(corpus(spark), twice)


def test_sources_without_weight_count_in_no_total(spark):
    """Null, zero and absent weights: the other sources share their own bytes."""
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", None), ("d", 5.0)], "source string, weight double")
    rates = {r["__source"]: (r["rate"], r["size"]) for r in mixing.source_rates(corpus(spark), weights).collect()}
    assert rates.keys() == {"a", "b"}
    total = sum(s for _, s in rates.values())
    assert all(rate * size == pytest.approx(total / 2) for rate, size in rates.values())
    none = spark.createDataFrame([("a", None)], "source string, weight double")
    assert mixing.mix_sources(corpus(spark), none).count() == 0


def test_many_sources_are_split(spark, monkeypatch):
    """Rates beyond the broadcast limit: large sources are broadcast, small ones joined; the same rows."""
    def rows():
        found = mixing.mix_sources(corpus(spark), epochs=2.0, seed=7).select("doc_id", "copy", "n_copies", "shuffle_key").collect()
        return sorted(map(tuple, found))

    expected = rows()
    monkeypatch.setattr(mixing, "RATES_BYTES", 1)
    assert rows() == expected and len(expected) > 5000


def test_quality_sample_takes_one_row_per_id(spark):
    rows = [(3, "one text here.")] * 3 + [(3, "another text."), (6, "x"), (6, "x"), (None, "y"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in (3, 6, 9, 12)] + [(3, 0), (None, 1)], "doc_id long, quality int")
    learned = [i for i in (3, 6, 9) if not quality.training_rows(docs.where(F.col("doc_id") == i), labels).isEmpty()]
    sample = quality.training_rows(docs, labels).collect()
    assert len(sample) == len(learned) >= 1
    out = quality.score_quality(docs, labels, quality.RuleModel(0.5, {})).collect()
    assert len(out) == len(rows) and {r["predicted"] for r in out} == {1}


def test_quality_restated_for_all_rows(spark):
    """Every row's score from its own statistics and the rules, in plain Python."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in queries.op7_quality_classifier(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        raw = (text or "").encode()
        marks = ".,;:'\"!?()-"
        words, lines, n = raw.lower().split(), raw.split(b"\n"), max(1, len(raw.split()))
        stats = dict.fromkeys(quality.STATISTICS, 0.0)
        if raw:
            chars = [bytes([b]) for b in raw]
            size = len(raw)
            stats = {
                "log_bytes": math.log(1 + size), "log_words": math.log(1 + len(words)), "word_bytes": size / n,
                "upper": sum(c.isupper() for c in chars) / size, "digits": sum(c.isdigit() for c in chars) / size,
                "marks": sum(c in marks.encode() for c in chars) / size,
                "symbols": sum(32 < c[0] < 127 and not c.isalnum() and c not in marks.encode() for c in chars) / size,
                "bars": raw.count(b"|") / n, "blanks": sum(c.isspace() for c in chars) / size,
                "non_ascii": sum(c[0] > 127 for c in chars) / size, "distinct_words": len(set(words)) / n ** 0.5,
                "distinct_lines": len(set(lines)) / len(lines), "line_bytes": size / len(lines),
                "ends": sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines),
                "top_word": max((words.count(w) for w in set(words)), default=0) / n if len(words) < 3000 else None}
        row = [stats[s] for s in quality.STATISTICS]
        if row[-1] is None:
            row[-1] = quality.text_statistics(raw)[-1]
        total = model.intercept + sum(w for rule, w in model.rules.items() if all(
            row[k] <= v if sign == "<=" else row[k] > v for k, sign, v in rule))
        assert got[i]["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-6)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.5)
