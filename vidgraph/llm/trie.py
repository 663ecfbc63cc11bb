"""Conversation prefix trie with a depth-band rollup.

Every distinct sequence of the first d turns (role, text) of some conversation is
a node of depth d; the conversations that start with it are its members.

1. **Turns** become lean rows (digest, code points); texts are never shuffled.
   Equal rows are counted before they move.  Positions come from a range
   partitioning by (conversation, turn): counts per conversation and partition give
   each piece its start, so one very long conversation is spread over many tasks.
2. **Node keys** are 128-bit combinations (xor) of position-tagged turn digests.
   Xor is associative, so a prefix key is the key of the blocks before plus the
   running key inside the block: no task holds a whole conversation.
3. **Rollup** (``_rollup``): depths are cut into bands of ``band`` levels.  A node
   is exploded only to its ancestors inside its band.  The totals of the bands'
   top nodes form a trie ``band`` times flatter, which is rolled up in the same
   way; the completed totals of the tops are then added to the bottom nodes they
   hang from and travel up inside that band.  Rounds: logarithm of the depth to
   base ``band``; explosion: at most ``band`` rows a node.
4. **Ends**: ids of the conversations that end at a node are joined in sorted runs
   of ``RUN_IDS`` in parallel, and a node's SHA-256 streams over its runs.

Groups are met by partial sums; the one lookup that cannot be pre-aggregated (the
parent's conversation) broadcasts the parents of more than a thousandth of all
nodes, at most 1,000 rows, and shuffles the rest.

Defined cases: a null ``conv_id`` names no conversation and is left out; null role
or text is the empty string; turns are ordered by ``turn`` (null first), rows of one
turn by the digest of their role and text, equal rows count as turns of their own;
a conversation without turns is a member of the root only; texts are taken
whole whatever their length; other columns are ignored, also those named like an
added one; an empty table gives no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidgraph.llm.common import scratch

BAND = 8
BLOCK = 4096  # positions of one conversation in one window group; a multiple of any band used
RUN_IDS = 512  # ids joined in one run of the end lists
KEY = ["pos", "k1", "k2"]
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _xor(a, b):
    return F.col(a).bitwiseXOR(F.col(b)) if isinstance(a, str) else a.bitwiseXOR(b)


def _before(order: str):
    return Window.partitionBy("conv_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def lean_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, a, b, chars, n`` (equal rows counted) and the range
    partition ``part`` that holds the row."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        digest.alias("d"), F.length(text).cast("bigint").alias("chars"))
    rows = rows.select("conv_id", "turn", F.xxhash64("d").alias("a"), F.xxhash64(F.lit(7), "d").alias("b"), "chars")
    rows = rows.groupBy("conv_id", "turn", "a", "b", "chars").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.repartitionByRange("conv_id", "turn", "a", "b").withColumn("part", F.spark_partition_id())
    return scratch(rows, "trie-turns")


def rebuilt_turns(conversations: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt around shared heads: c takes the first h turns of
    conversation ``c - c % group`` (h = crc32 of c's decimal text, modulo ``most``)
    and its own turns after its first h.  Returns the turns (``conv_id, pos, n, a,
    b, chars``) and the conversations (``conv_id, n``)."""
    rows = lean_turns(conversations)
    parts = rows.groupBy("conv_id", "part").agg(F.sum("n").alias("n"))
    sizes = scratch(parts.groupBy("conv_id").agg(F.sum("n").alias("own")), "trie-sizes")
    convs = sizes.withColumn("seed", F.col("conv_id") - F.col("conv_id") % group)
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    heads = sizes.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("seed"), F.col("own").alias("held"))
    convs = convs.join(heads, "seed", "left").withColumn("m", F.least("h", F.coalesce("held", F.lit(0))))
    convs = scratch(convs.select("conv_id", "seed", "h", "m", (
        F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")), "trie-conversations")
    starts = parts.select("conv_id", "part", F.coalesce(F.sum("n").over(_before("part")), F.lit(0)).alias("start"))
    starts = starts.join(convs.select("conv_id", "h", "m", F.col("n").alias("total")), "conv_id")
    inside = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    own = rows.join(starts, ["conv_id", "part"])
    own = own.withColumn("end", F.col("start") + F.sum("n").over(inside)).withColumn("first", F.col("end") - F.col("n"))
    # A row that stands for very many equal turns is unfolded in two steps of bounded arrays.
    own = own.withColumn("lump", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(BLOCK))))
    own = own.withColumn("p", F.explode(F.sequence("lump", F.least(F.col("lump") + BLOCK, F.col("n")) - 1)))
    own = own.withColumn("p", F.col("first") + F.col("p"))
    own = scratch(own.select("conv_id", "p", "h", "m", "total", "a", "b", "chars"), "trie-own-turns")
    tails = own.where("p >= h").select("conv_id", (F.col("p") - F.col("h") + F.col("m")).alias("pos"),
                                       F.col("total").alias("n"), "a", "b", "chars")
    lent = own.where((F.col("conv_id") % group == 0) & (F.col("p") < most - 1))
    lent = lent.select(F.col("conv_id").alias("seed"), F.col("p").alias("pos"), "a", "b", "chars")
    lent = convs.join(lent, "seed").where("pos < h").select("conv_id", "pos", "n", "a", "b", "chars")
    return tails.unionByName(lent), convs.select("conv_id", "n")


def prefix_rows(turns: DataFrame, band: int = BAND) -> DataFrame:
    """One row per turn with the key of the prefix that it ends (``k1, k2``), of the
    prefix before (``p1, p2``), and ``path``: the keys inside its band, itself last."""
    tagged = turns.withColumn("g1", F.xxhash64("pos", "a", "b")).withColumn("g2", F.xxhash64("b", "a", "pos"))
    tagged = scratch(tagged.select("conv_id", "pos", "n", "chars", "g1", "g2", F.expr(f"pos div {BLOCK}").alias("block")),
                     "trie-tagged")
    blocks = tagged.where(F.col("n") > BLOCK).groupBy("conv_id", "block").agg(
        F.bit_xor("g1").alias("b1"), F.bit_xor("g2").alias("b2"))
    blocks = blocks.select("conv_id", "block", F.bit_xor("b1").over(_before("block")).alias("o1"),
                           F.bit_xor("b2").over(_before("block")).alias("o2")).where("block > 0")
    rows = tagged.join(blocks, ["conv_id", "block"], "left")
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    for i in "12":
        rows = rows.withColumn(f"k{i}", _xor(F.bit_xor(f"g{i}").over(inside), F.coalesce(f"o{i}", F.lit(0))))
        rows = rows.withColumn(f"p{i}", _xor(f"k{i}", f"g{i}"))
    rows = rows.withColumn("band", F.expr(f"pos div {band}"))
    path = Window.partitionBy("conv_id", "block", "band").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("path", F.collect_list(F.struct("k1", "k2")).over(path))
    return scratch(rows.select("conv_id", *KEY, "n", "chars", "p1", "p2", "path"), "trie-rows")


def _next_level(rows: DataFrame, band: int) -> DataFrame:
    """The rows of the bands' top nodes, numbered by band, with keys and paths of that level."""
    tops = rows.where(F.col("pos") % band == 0).select("conv_id", F.expr(f"pos div {band}").alias("pos"), "k1", "k2")
    tops = tops.withColumn("band", F.expr(f"pos div {band}"))
    path = Window.partitionBy("conv_id", "band").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    tops = scratch(tops.withColumn("path", F.collect_list(F.struct("k1", "k2")).over(path)), "trie-tops")
    bottoms = tops.where(F.col("pos") % band == band - 1).select(
        "conv_id", (F.col("pos") + 1).alias("pos"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    inner = tops.where((F.col("pos") % band != 0) | (F.col("pos") == 0))
    crossing = tops.where((F.col("pos") % band == 0) & (F.col("pos") > 0)).join(bottoms, ["conv_id", "pos"])
    rows = inner.withColumn("p1", F.lit(None).cast("bigint")).withColumn("p2", F.lit(None).cast("bigint"))
    return scratch(rows.unionByName(crossing).drop("band"), "trie-level")


def _rollup(rows: DataFrame, nodes: DataFrame, band: int, depth: int) -> DataFrame:
    """Subtree totals (``pos, k1, k2, leaf, saved``) of ``nodes`` (``pos, k1, k2, p1,
    p2, path, leaf, saved``); ``rows`` are the same level's rows by conversation."""
    sums = [F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")]
    if depth > band:
        top = F.get("path", F.lit(0))
        own = nodes.groupBy(F.expr(f"pos div {band}").alias("pos"), top["k1"].alias("k1"), top["k2"].alias("k2")).agg(*sums)
        above = _next_level(rows, band)
        found = above.groupBy(*KEY).agg(F.first("path").alias("path"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
        done = _rollup(above, scratch(found.join(own, KEY), "trie-band-tops"), band, -(-depth // band))
        hung = nodes.where((F.col("pos") % band == 0) & (F.col("pos") > 0))
        hung = hung.select(F.expr(f"pos div {band}").alias("pos"), "k1", "k2", "p1", "p2").join(done, KEY)
        hung = hung.groupBy((F.col("pos") * band - 1).alias("pos"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        hung = hung.agg(F.sum("leaf").alias("more_leaf"), F.sum("saved").alias("more_saved"))
        nodes = nodes.join(hung, KEY, "left")
        for c in ("leaf", "saved"):
            nodes = nodes.withColumn(c, F.col(c) + F.coalesce(f"more_{c}", F.lit(0)))
    base = F.expr(f"pos - pos % {band}")
    out = nodes.select(base.alias("base"), "leaf", "saved", F.posexplode("path").alias("i", "at"))
    out = out.select((F.col("base") + F.col("i")).alias("pos"), "at.k1", "at.k2", "leaf", "saved")
    return scratch(out.groupBy(*KEY).agg(*sums), "trie-totals")


def _join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of a partition as comma-joined runs of one node."""
    key, ids = None, []

    def run():
        return pa.RecordBatch.from_pylist([dict(zip([*KEY, "first", "ids"], [*key, ids[0], ",".join(map(str, ids))]))])

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:3] != key or len(ids) == RUN_IDS:
                if ids:
                    yield run()
                key, ids = row[:3], []
            ids.append(row[3])
    if ids:
        yield run()


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the runs of each node, in order; holds one hash state."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    out = []
    for key, runs in groupby(rows, lambda r: r[:3]):
        sha = hashlib.sha256()
        for i, run in enumerate(runs):
            sha.update((("," if i else "") + run[4]).encode())
        out.append(dict(zip([*KEY, "ends_sha256"], [*key, sha.hexdigest()])))
        if len(out) == 10_000:
            yield pa.RecordBatch.from_pylist(out)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out)


def end_lists(ends: DataFrame) -> DataFrame:
    """``pos, k1, k2, ends_sha256`` from one row per conversation and end node."""
    runs = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInArrow(
        _join_runs, "pos bigint, k1 bigint, k2 bigint, first bigint, ids string")
    return runs.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(
        _hash_runs, "pos bigint, k1 bigint, k2 bigint, ends_sha256 string")


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Adds ``parent_conv_id``: parents of more than a thousandth of all nodes (fewer
    than 1,000) are broadcast, so no key of the shuffled lookup is hot."""
    total = nodes.count()
    parent = [(F.col("pos") + 1).alias("pos"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
              F.col("conv_id").alias("parent_conv_id")]
    busy = F.col("n_children") * 1000 > total
    hot, cold = nodes.where(busy).select(*parent), nodes.where(~busy & (F.col("n_children") > 0)).select(*parent)
    link = ["pos", "p1", "p2"]
    near = nodes.join(F.broadcast(hot), link)
    far = nodes.join(F.broadcast(hot.drop("parent_conv_id")), link, "left_anti").join(cold, link, "left")
    return near.unionByName(far)


def prefix_trie(turns: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """The trie of ``turns`` (``conv_id, pos, n, a, b, chars``: positions from 0, n the
    conversation's turns, two digest halves) and ``convs`` (``conv_id, n``): one
    row per node with the columns ``OUT``; totals cover a node and all below it."""
    if band < 2 or BLOCK % band:
        raise ValueError(f"band must divide {BLOCK}")
    rows = prefix_rows(turns, band)
    zero = F.lit(0).cast("bigint")
    nodes = rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.first("path").alias("path"))
    nodes = scratch(nodes, "trie-nodes")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(F.lit(-1).cast("bigint").alias("pos"), zero.alias("k1"), zero.alias("k2"), "n_convs", "conv_id",
                       zero.alias("chars"), F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"),
                       F.lit(None).cast(nodes.schema["path"].dataType).alias("path"))
    children = nodes.groupBy((F.col("pos") - 1).alias("pos"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    nodes = nodes.unionByName(root).join(children.agg(F.count(F.lit(1)).alias("n_children")), KEY, "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", zero))
    nodes = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("bigint"))
    nodes = scratch(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "trie-own")
    depth = (rows.agg(F.max("pos")).first()[0] or 0) + 1
    below = nodes.where("pos >= 0").select(*KEY, "p1", "p2", "path", "leaf", "saved")
    totals = _rollup(rows, below, band, depth)
    whole = nodes.agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")).where("leaf is not null")
    totals = totals.unionByName(whole.select(F.lit(-1).cast("bigint").alias("pos"), zero.alias("k1"), zero.alias("k2"),
                                             "leaf", "saved"))
    ends = rows.where("pos = n - 1").select(*KEY, "conv_id").unionByName(convs.where("n = 0").select(
        F.lit(-1).cast("bigint").alias("pos"), zero.alias("k1"), zero.alias("k2"), "conv_id"))
    out = _with_parents(nodes.drop("leaf", "saved", "path")).join(totals, KEY).join(end_lists(ends), KEY, "left")
    return out.select("conv_id", (F.col("pos") + 1).alias("depth"), "parent_conv_id", "n_convs", "n_children",
                      F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
