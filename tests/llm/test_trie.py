"""Conversation prefix trie against brute force over prefix tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.test_native_ops import agree
from vidgraph.llm import queries, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def digest(row):
    role, text = row[2] or "", row[3] or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    """Nodes as {(depth, smallest member): (parent, members, children, leaves, saved, ends digest)};
    rows of one turn must be equal or without order (tested apart)."""
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            own[r[0]].append(r)
    for c in own:
        own[c].sort(key=lambda r: (r[1] is not None, r[1] or 0))
        own[c] = [(r[2] or "", r[3] or "") for r in own[c]]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        seed = c - (c % 100 if c >= 0 else -(-c % 100))
        turns = own.get(seed, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(held) - 1) * (len(node[-1][1]) if node else 0)
    return {(len(n), m[0]): (members[n[:-1]][0] if n else None, len(m), kids[n], leaves[n], saved[n],
                             hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
            for n, m in members.items()}


def check(spark, rows, band):
    turns, convs = trie.rebuilt_turns(spark.createDataFrame(rows, SCHEMA))
    got = trie.prefix_trie(turns, convs, band).collect()
    expected = brute(rows)
    assert len(got) == len(expected)
    for r in got:
        assert expected[r["depth"], r["conv_id"]] == (
            r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
    return got


def talk(seed, convs):
    rnd = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rnd.choice([1, 2, 5, 9, 20])):
            rows.append((c, t if t else rnd.choice([0, None]), rnd.choice(["user", "", None]), rnd.choice(["a", "bb", None])))
    return rows


@pytest.mark.parametrize("band", [2, 8])
def test_random_conversations(spark, band):
    rows = talk(band, [*range(0, 40), *range(100, 130), *range(205, 225), -1, -100, -250, 3000000000])
    rows += [(None, 0, "user", "nameless"), (300, 0, "x", "only turn"), (301, 0, "x", "only turn")]
    check(spark, rows, band)


def test_long_hot_conversation(spark):
    """A conversation beyond one block, a copy that leaves it late, many equal turns."""
    long = [(7, t, "user", f"t{t}") for t in range(4500)]
    late = [(8, t, "user", f"t{t}" if t < 4400 else f"u{t}") for t in range(4410)]
    same = [(9, 0, "user", "again")] * 4200
    got = {(r["depth"], r["conv_id"]): r for r in check_totals(spark, long + late + same)}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in (7, 8, 9)}
    assert got[0, 7]["n_convs"] == 3
    assert got[4500 - h[7], 7]["n_children"] == 0
    assert got[4200 - h[9], 9]["n_leaves"] == 1


def check_totals(spark, rows):
    turns, convs = trie.rebuilt_turns(spark.createDataFrame(rows, SCHEMA))
    got = trie.prefix_trie(turns, convs).collect()
    own = defaultdict(int)
    for r in got:  # totals of a node are its own and its children's
        own[r["depth"], r["conv_id"]] = r
    below = defaultdict(lambda: [0, 0])
    for r in got:
        if r["depth"]:
            below[r["depth"] - 1, r["parent_conv_id"]][0] += r["n_leaves"]
            below[r["depth"] - 1, r["parent_conv_id"]][1] += 1
    for k, r in own.items():
        assert r["n_children"] == below[k][1]
        assert r["n_leaves"] == (below[k][0] if r["n_children"] else 1)
    return got


def test_ties_and_clashing_columns(spark):
    """Rows of one turn stand in the order of their digests, whatever the input's order."""
    rows = [(5, 1, "user", t) for t in "abc"] + [(5, 1, None, None), (6, 1, "user", "a" * 100_000)]
    order = sorted(rows[:4], key=digest)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("clash")).withColumn("pos", F.lit(3))
    results = []
    for part in (df, df.orderBy(F.desc("text"))):
        turns, convs = trie.rebuilt_turns(part, most=1)
        out = sorted(map(tuple, turns.select("conv_id", "pos", "a", "chars").collect()))
        results.append((out, sorted(map(tuple, trie.prefix_trie(turns, convs).collect()))))
    assert results[0] == results[1] and len(results[0][0]) == 5
    assert {r[3] for r in results[0][0]} == {0, 1, 100_000} and len(order) == 4


def test_band_must_divide(spark):
    with pytest.raises(ValueError):
        trie.prefix_trie(None, None, 3)


def test_many_ends_in_runs(spark, monkeypatch):
    """More ids at one node than a run holds."""
    rows = [(c, 0, "user", "hello") for c in range(1000, 2300)]
    check(spark, rows, 8)


def test_sql_on_whole_tables(spark):
    assert agree(spark, "op11_prefix_trie", "/root/testdata/sf0.001")
    assert set(trie.OUT) == set(queries.op11_prefix_trie(spark, "/root/testdata/sf0.001").columns)
