"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint bit is 1 when it is set in over half of the XXH64 values of a
text's word shingles.  Distinct fingerprints are linked at ``radius`` or fewer
differing bits.  Covering family: bit ``i`` gets a non-zero vector of
``radius + 1`` bits; each of the ``2 ** (radius + 1) - 1`` non-zero vectors ``v``
gives a table whose mask keeps the bits with an odd product with ``v``.  At most
``radius`` differing bits leave a ``v`` orthogonal to all of them, so such a
pair agrees under that mask: no link is lost.

A bucket is compared inside one task and leaves a spanning forest, never its
pairs.  A bucket of more than ``BUCKET`` fingerprints is split again: of
``radius + 1`` blocks of the bits outside its mask one must agree too, so its
rows go to one bucket per block, and again, until at most ``SMALL_BITS`` bits are
outside the mask; then it can't hold more than ``2 ** SMALL_BITS``.  Copies share a fingerprint, so a group
of copies is one row here however large it is.

Defined cases: texts without words (null and empty ones too) have fingerprint
zero and link like any other; texts of fewer words than a shingle are one
shingle; repeated rows share a component; a null ``doc_id`` never names one
(a component of null ids only has a null id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidgraph.llm.common import scratch, text_hash
from vidgraph.llm.components import components

SHINGLE, RADIUS, SEED = 3, 3, 42
BUCKET, SMALL_BITS = 1024, 13
CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text's UTF-8 bytes (unsigned)."""
    parts = (text or b"").lower().split()  # bytes: A-Z and ASCII blanks only
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    size = min(shingle, len(parts))
    stops = ends[size - 1:].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(stops), CHUNK):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[i:i + CHUNK], stops[i:i + CHUNK])])
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(stops)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps.view(np.int64))], names=["doc_id", "xh", "fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, xh, fp`` per row: a hash of the text that tells rows of one
    ``doc_id`` apart, and the fingerprint's 64 bits as a signed number."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_hash(F.col("text")).alias("xh"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(lambda it: _fingerprints(it, shingle), f"doc_id {kind}, xh bigint, fp bigint")


def masks(radius: int = RADIUS) -> list[int]:
    """The masks of the covering family, as signed 64-bit numbers."""
    vectors = range(1, 1 << (radius + 1))
    given = [1 + i % (len(vectors)) for i in range(64)]
    found = [sum(1 << i for i in range(64) if (given[i] & v).bit_count() % 2) for v in vectors]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def _finer(mask: int, radius: int) -> list[int]:
    """Masks that add one of ``radius + 1`` blocks of the bits outside ``mask``."""
    free = [i for i in range(64) if not mask >> i & 1]
    blocks = [free[j::radius + 1] for j in range(radius + 1)]
    found = {(mask & (1 << 64) - 1) | sum(1 << i for i in block) for block in blocks}
    return sorted(m - (1 << 64) if m >> 63 else m for m in found)


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(node, root) of the links within one bucket: a spanning forest.  What is
    reached leaves the rest, so a dense group costs little more than its size."""
    links, rest = [], fps
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        front = [root]
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= radius
            if near.any():
                reached, rest = rest[near], rest[~near]
                front.extend(reached)
                links.extend((int(x), int(root.view(np.int64))) for x in reached.view(np.int64))
    return links


def _links_within(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of the buckets in a partition sorted by (mask, key)."""
    held: list[int] = []
    last = None

    def flush() -> pa.RecordBatch | None:
        links = _forest(np.array(held, dtype=np.int64).view(np.uint64), radius) if len(held) > 1 else []
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())],
            names=["a", "b"]) if links else None

    for batch in batches:
        masks_, keys, fps = (batch.column(i).to_pylist() for i in range(3))
        for bucket, fp in zip(zip(masks_, keys), fps):
            if bucket != last:
                out = flush()
                if out is not None:
                    yield out
                held, last = [], bucket
            held.append(fp)
    out = flush()
    if out is not None:
        yield out


def _bucketed(fps: DataFrame, mask_list: list[int]) -> DataFrame:
    # A literal array keeps the plan small; every fingerprint meets every mask.
    rows = fps.select("fp", F.explode(F.array(*[F.lit(m) for m in mask_list])).alias("mask"))
    return rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def near_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: a spanning forest of every bucket's links over the distinct
    fingerprints ``fp``; joined up, they connect exactly what all pairs within
    ``radius`` connect."""
    spark, found, at_masks = fps.sparkSession, [], masks(radius)
    rows = scratch(_bucketed(fps, at_masks), "buckets")
    while True:
        finer = [(m, x) for m in at_masks if 64 - (m & (1 << 64) - 1).bit_count() > SMALL_BITS for x in _finer(m, radius)]
        # At most as many rows as the family has masks at this depth.
        steps = F.broadcast(spark.createDataFrame(finer, "mask bigint, finer bigint"))
        big = rows.groupBy("mask", "key").count().where(F.col("count") > bucket).select("mask", "key")
        big = scratch(big.join(steps.select("mask").distinct(), "mask", "left_semi"), "large-buckets")
        if big.isEmpty():
            found.append(rows)
            break
        found.append(rows.join(big, ["mask", "key"], "left_anti"))
        wide = rows.join(big, ["mask", "key"], "left_semi").select("mask", "fp").join(steps, "mask")
        wide = wide.select(F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("key"), "fp")
        rows, at_masks = scratch(wide.distinct(), "buckets"), sorted({x for _, x in finer})
    links = []
    for part in found:
        dealt = part.repartition("mask", "key").sortWithinPartitions("mask", "key")
        links.append(dealt.mapInArrow(lambda it: _links_within(it, radius), "a bigint, b bigint"))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, xh, fp, component_id, representative`` per row of ``docs``
    (``doc_id, text``): the smallest ``doc_id`` reachable by links of ``radius`` or
    fewer bits, and whether the row is the one that stands for its component
    (smallest id, then text hash; equal rows all are)."""
    rows = scratch(fingerprints(docs, shingle), "fingerprints")
    lowest = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "xh")
    nodes = scratch(rows.groupBy("fp").agg(F.min(lowest).alias("low")), "distinct-fingerprints")
    roots = components(near_links(nodes.select("fp"), radius))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("low"))
    named = scratch(named.select("fp", "root").join(lows, "root").select("fp", "low"), "fingerprint-components")
    first = F.col("doc_id").eqNullSafe(F.col("low.doc_id")) & (F.col("xh") == F.col("low.xh"))
    return rows.join(named, "fp").select(
        "doc_id", "xh", "fp", F.col("low.doc_id").alias("component_id"), first.alias("representative"))
