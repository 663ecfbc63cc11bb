"""Quality classifier: a sparse rule ensemble over text statistics.

1. ``statistics`` gives a dozen numbers per whole text.
2. A forest of shallow trees is grown on a bounded sample of labelled rows
   (``SAMPLE_ROWS``, the smallest hashes of the labelled ids outside the held-out
   fold); every path of every tree is a conjunctive rule.
3. A lasso logistic regression over the rules' truth values keeps a few.
4. Rules and weights become one Spark column expression.

Defined cases: null and empty texts have all-zero statistics and get a score;
repeated labels of one id count as the larger; of repeated rows of one id the one
with the smallest text hash is learned from, so the sample is bounded in rows and no
copy weighs twice, and every row is scored; labelled ids without a document are not
used; very long texts are read whole; an empty table gives an empty table; with no or one class to learn from the score is a constant (0.5
without rows); columns that clash with the added ones are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from vidgraph.llm.common import held_out, quoted, scratch, text_hash, without

SAMPLE_ROWS, TREES, DEPTH, LASSO = 20_000, 12, 3, 0.002
ADDED = ["held_out", "score", "predicted"]
STATISTICS = ["log_bytes", "log_words", "word_bytes", "upper", "digits", "marks", "symbols", "bars", "blanks",
              "non_ascii", "distinct_words", "distinct_lines", "line_bytes", "ends", "top_word"]
# Fixed value: punctuation of running text; other ASCII marks count as symbols.
MARKS = b".,;:'\"!?()-"
_KINDS = np.zeros((6, 256), dtype=bool)
for _i in range(256):
    _c = bytes([_i])
    _KINDS[0, _i], _KINDS[1, _i] = _c.isupper(), _c.isdigit()
    _KINDS[2, _i] = _c in MARKS
    _KINDS[3, _i] = 32 < _i < 127 and not _c.isalnum() and _c not in MARKS
    _KINDS[4, _i], _KINDS[5, _i] = _c.isspace(), _i > 127


def text_statistics(text: bytes | None) -> list[float]:
    raw = text or b""
    size = len(raw)
    if not size:
        return [0.0] * len(STATISTICS)
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = (_KINDS @ histogram / size).tolist()
    words = raw.lower().split()
    lines = raw.split(b"\n")
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    n = max(1, len(words))
    ends = sum(line.rstrip().endswith((b".", b"!", b"?")) for line in lines)
    return [math.log1p(size), math.log1p(len(words)), size / n, kinds[0], kinds[1], kinds[2], kinds[3],
            float(histogram[ord("|")]) / n, kinds[4], kinds[5], len(counts) / math.sqrt(n), len(set(lines)) / len(lines),
            size / len(lines), ends / len(lines), max(counts.values(), default=0) / n]


@F.pandas_udf(ArrayType(DoubleType()))
def _statistics(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([text_statistics(t) for t in texts])


def statistics(text: Column) -> Column:
    """The numbers of ``STATISTICS`` of a text, in that order."""
    return _statistics(text.cast("binary"))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``stats, label`` of at most ``rows`` labelled documents."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col("quality").cast("double")).alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    if not texts.groupBy("doc_id").count().where("count > 1").isEmpty():  # rows of one id: the smallest hash of their texts
        one = texts.groupBy("doc_id", "label").agg(F.min(text_hash(F.col("text"))).alias("h"))
        texts = texts.join(F.broadcast(one.select("doc_id", "h")), "doc_id").where(text_hash(F.col("text")) == F.col("h"))
        texts = texts.groupBy("doc_id", "label").agg(F.first("text").alias("text"))
    return scratch(texts.select(statistics(F.col("text")).alias("stats"), "label"), "quality-sample")


Rule = tuple[tuple[int, str, float], ...]


def tree_rules(text: str) -> list[Rule]:
    """All paths below the root of one tree, from its printed form."""
    rules, path = [], []
    for line in text.splitlines():
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if m:
            depth = len(m[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (int(m[2]), m[3], float(m[4]))))
            rules.append(tuple(sorted({p[1] for p in path})))
    return rules


def _holds(stats: Column, rule: Rule) -> Column:
    found = F.lit(True)
    for i, sign, value in rule:
        x = F.get(stats, F.lit(i))
        found = found & (x <= value if sign == "<=" else x > value)
    return found


class RuleModel:
    """``intercept`` and ``rules`` (conjunction -> weight)."""

    def __init__(self, intercept: float, rules: dict[Rule, float]):
        self.intercept, self.rules = intercept, rules

    def column(self, stats: Column) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in sorted(self.rules.items()):
            total = total + F.when(_holds(stats, rule), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score(self, stats: list[float]) -> float:
        total = self.intercept + sum(
            w for rule, w in sorted(self.rules.items())
            if all(stats[i] <= v if sign == "<=" else stats[i] > v for i, sign, v in rule))
        return 1.0 / (1.0 + math.exp(-total))

    def __str__(self) -> str:
        lines = [f"{w:+.3f}  " + " and ".join(f"{STATISTICS[i]} {s} {v:.4g}" for i, s, v in r)
                 for r, w in sorted(self.rules.items(), key=lambda x: -abs(x[1]))]
        return "\n".join([f"{self.intercept:+.3f}", *lines])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, trees: int = TREES, depth: int = DEPTH,
          lasso: float = LASSO, seed: int = 42) -> RuleModel:
    sample = training_rows(docs, labels, rows)
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    good, total = counts.get(1.0, 0), sum(counts.values())
    if not 0 < good < total:
        share = (good + 0.5) / (total + 1.0)
        return RuleModel(math.log(share / (1 - share)), {})
    numbers = sample.select("label", *[F.get("stats", F.lit(i)).alias(f"s{i}") for i in range(len(STATISTICS))])
    numbers = VectorAssembler(inputCols=[f"s{i}" for i in range(len(STATISTICS))], outputCol="features").transform(numbers)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=seed).fit(
        numbers.select("label", "features"))
    rules = sorted({r for t in forest.trees for r in tree_rules(t.toDebugString)})
    names = [f"r{i}" for i in range(len(rules))]
    truth = sample.select("label", *[_holds(F.col("stats"), r).cast("double").alias(n) for r, n in zip(rules, names)])
    truth = VectorAssembler(inputCols=names, outputCol="features").transform(truth).select("label", "features")
    fit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False).fit(truth)
    return RuleModel(float(fit.intercept), {r: float(w) for r, w in zip(rules, fit.coefficients) if w})


def score_quality(docs: DataFrame, labels: DataFrame, model: RuleModel | None = None) -> DataFrame:
    """``docs`` (``doc_id, text``, any further columns) plus ``held_out``,
    ``score`` and ``predicted`` (1: good)."""
    model = model or train(docs, labels)
    base = without(docs, *ADDED)
    out = base.withColumn("__stats", statistics(F.col("text")))
    out = out.select(*[quoted(c) for c in base.columns], held_out(F.col("doc_id")).alias("held_out"),
                     model.column(F.col("__stats")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
