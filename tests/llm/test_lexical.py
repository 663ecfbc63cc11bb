"""Dual-tree search against brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vidgraph.llm import lexical


def brute(docs, items, k):
    held = [(i, Counter(w), len(w)) for i, t in docs if (w := lexical.terms_of(t and t.encode()))]
    n, length = len(held), sum(h[2] for h in held)
    df = Counter(t for h in held for t in h[1])
    rows = []
    for item, text in items:
        q = Counter(lexical.terms_of(text and text.encode()))
        found = []
        for i, tf, size in held:
            m = 25 + 75 * size * n // length
            score = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t, c in q.items() if t in tf)
            if score > 0:
                found.append((-score, i is None, i or 0))
        rows += [(item, r + 1, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return sorted(rows, key=repr)


def corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"{'xyzw'[i % 4]}{i}" for i in range(300)]
    docs = []
    for i in range(n):
        lang = i % 4
        size = rnd.choice([0, 1, 5, 30, 200])
        docs.append((i, " ".join(rnd.choice(words[lang::4][:20 + rnd.randrange(55)]) for _ in range(size))))
    docs += [(i, docs[7][1] + " x4 x8") for i in range(n, n + 60)]  # equal scores
    docs += [(None, "x4 x8 X4"), (None, None), (3, "x4, x8; x4"), (3, "x4, x8; x4"), (n + 70, "long " * 30_000 + "y1")]
    items = [(i, " ".join(rnd.choice(words[i % 4::4]) for _ in range(rnd.choice([1, 3, 40])))) for i in range(40)]
    items += [(5, "x4 x8 x4"), (5, "x4 x8 x4"), (None, "É y1 z2!"), (90, None), (91, "?"), (92, "unheard"), (93, "LONG")]
    return docs, items


def run(spark, docs, items, k):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    d = d.withColumn("score", F.lit("clash")).withColumn("rank", F.lit(0)).withColumn("n", F.lit(1))
    i = spark.createDataFrame(items, "item_id bigint, text string").withColumn("term", F.lit("clash"))
    out = lexical.ranked_search(d, i, k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("k", [1, 10])
def test_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(lexical, "CHUNK_POSTINGS", 3000)
    monkeypatch.setattr(lexical, "LEAF", 8)
    monkeypatch.setattr(lexical, "NODE", 32)
    docs, items = corpus(k, 900)
    assert run(spark, docs, items, k) == brute(docs, items, k)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 9)
    docs, items = corpus(3, 200)
    assert run(spark, docs, items, 10) == brute(docs, items, 10)


def test_empty_sides(spark):
    docs, items = corpus(4, 20)
    assert run(spark, [], items, 10) == [] and run(spark, docs, [], 10) == []
    assert run(spark, [(1, None), (2, "?")], items, 10) == []


def test_pruning_drops_most_pairs(spark, monkeypatch):
    """Bounds keep most documents from being scored once an item has its k best."""
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(0)
    n, width = 8192, 64
    topic = np.repeat(np.arange(width), n // width)
    of = np.repeat(np.arange(n), 2)
    term = np.stack([topic, (topic + 1) % width], 1).ravel()
    val = rng.integers(1, 1000, len(term))
    w = np.ones(width, np.int64)
    tree = lexical.ItemTree(np.arange(8), np.arange(8), np.arange(8) * 8, np.ones(8, np.int64), w)
    best = lexical._Best(8, 10, np.full(8, 900))
    seen = []
    add = best.add
    best.add = lambda item, scores, docs, ids: (seen.append(len(docs)), add(item, scores, docs, ids))
    lexical._visit((pa.array(np.arange(n)), of, term, val), tree, best, False)
    assert seen and max(seen) <= n // 4  # 16 of 64 topics
    assert all(len(r) == 10 for r in best.rows)


def test_weights_and_terms():
    assert lexical.terms_of("Ab-c9 É_é\x7fZ".encode()) == [b"ab", b"c9", "É".encode(), "é".encode(), b"z"]
    assert lexical.terms_of(None) == []
