"""Line dedup with two Bloom filters.

A line's key is the line without ASCII blanks at both ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points that stand in at least ``min_docs``
documents lose all their lines but those of the largest ``doc_id`` holding them.

1. Every task fills a pair of filters with the hashes of its documents' keys:
   *once* (seen) and *twice* (seen again in another document).  Pairs fold
   together segment by segment (twice = twice or twice' or (once and once')), so
   what is moved is filter words, and what is kept is ``FILTER_BITS`` per filter
   whatever the input; only that much is sent to the driver and broadcast.
2. Lines whose key is in *twice* are suspects; only they shuffle, by exact key:
   distinct documents are counted and the largest ``doc_id`` is chosen.
3. Documents that lose lines meet their dropped keys and are written anew; a third
   filter, of their ids, lets all others pass without a shuffle.

A filter that gets full only lets more lines through to the exact count; the
result is the same.  ``filter_bits`` should be about 16 per distinct key.

Defined cases: a null or empty text is one empty line; a null ``doc_id`` counts
as no document and loses nothing; rows of one ``doc_id`` count as one document
and keep or lose a key together; columns that clash with the added ones are
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from vidgraph.llm.common import lower_ascii, quoted, scratch, without

MIN_CHARS, MIN_DOCS = 40, 5
FILTER_BITS = 1 << 27
SEGMENT = 1 << 15  # filter words of 64 bits
BLANKS = " \t\n\v\f\r"
ADDED = ["n_lines", "n_dropped"]


def line_keys(text: bytes | None, min_chars: int = MIN_CHARS) -> set[bytes]:
    """The distinct long keys of a text."""
    found = set()
    for line in (text or b"").split(b"\n"):
        key = line.strip().lower()
        if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
            found.add(key)
    return found


def _spots(keys: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Filter word and four bits of it for every key."""
    raw = b"".join([xxhash.xxh3_64_digest(k) for k in keys])
    h = np.frombuffer(raw, dtype=">u8").astype(np.uint64)
    word = (h >> np.uint64(24)) % np.uint64(words)
    bits = np.zeros(len(h), dtype=np.uint64)
    for shift in (0, 6, 12, 18):
        bits |= np.uint64(1) << ((h >> np.uint64(shift)) & np.uint64(63))
    return word.astype(np.int64), bits


def _fill(batches: Iterator[pa.RecordBatch], keys_of: Callable[[bytes | None], set[bytes]],
          words: int) -> Iterator[pa.RecordBatch]:
    """One pair of filters for the partition, as its non-empty words by segment."""
    once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
    for batch in batches:
        for value in batch.column(0):
            keys = list(keys_of(value.as_py()))
            if not keys:
                continue
            at, bits = _spots(keys, words)
            seen = (once[at] & bits) == bits
            np.bitwise_or.at(twice, at[seen], bits[seen])
            np.bitwise_or.at(once, at, bits)
    used = np.flatnonzero(once)
    for segment in range(0, words, SEGMENT):
        i = used[np.searchsorted(used, segment):np.searchsorted(used, segment + SEGMENT)]
        if len(i):
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment // SEGMENT], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in (
                    (i - segment).astype(np.uint16), once[i], twice[i])]], names=["segment", "at", "once", "twice"])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold the pairs of a partition's segments; yields each segment's pair."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            once, twice = held.setdefault(row["segment"], (np.zeros(SEGMENT, np.uint64), np.zeros(SEGMENT, np.uint64)))
            at = np.frombuffer(row["at"], np.uint16)
            more = np.frombuffer(row["once"], np.uint64)
            twice[at] |= np.frombuffer(row["twice"], np.uint64) | (once[at] & more)
            once[at] |= more
    for segment, pair in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in pair]],
            names=["segment", "once", "twice"])


def bloom(values: DataFrame, keys_of: Callable[[bytes | None], set[bytes]], which: str,
          filter_bits: int = FILTER_BITS) -> np.ndarray:
    """The filter *once* or *twice* of a binary column's keys (``filter_bits`` in
    all on the driver, whatever the input)."""
    words = max(SEGMENT, filter_bits // 64 // SEGMENT * SEGMENT)
    parts = values.mapInArrow(lambda it: _fill(it, keys_of, words), "segment int, at binary, once binary, twice binary")
    folded = parts.repartition("segment").mapInArrow(_fold, "segment int, once binary, twice binary")
    found = np.zeros(words, np.uint64)
    for segment, filled in folded.select("segment", which).collect():  # one row per segment
        found[segment * SEGMENT:(segment + 1) * SEGMENT] = np.frombuffer(filled, np.uint64)
    return found


def _held(keys: list[bytes], filled: np.ndarray) -> np.ndarray:
    at, bits = _spots(keys, len(filled))
    return (filled[at] & bits) == bits


def _suspects(batches: Iterator[pa.RecordBatch], twice, min_chars: int) -> Iterator[pa.RecordBatch]:
    filled = twice.value
    for batch in batches:
        rows, keys = [], []
        for i, text in enumerate(batch.column(1)):
            held = list(line_keys(text.as_py(), min_chars))
            if held:
                for k in np.flatnonzero(_held(held, filled)):
                    rows.append(i)
                    keys.append(held[k])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(keys, pa.binary())], names=["doc_id", "key"])


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS))).cast("binary")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` (``doc_id, text``, any further columns) with the kept lines in
    ``text``, and ``n_lines`` (before) and ``n_dropped``."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.where(F.col("doc_id").isNotNull()).select(F.col("text").cast("binary").alias("text"))
    twice = spark.sparkContext.broadcast(bloom(named, lambda t: line_keys(t, min_chars), "twice", filter_bits))
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.col("text").cast("binary").alias("text"))
    found = rows.mapInArrow(lambda it: _suspects(it, twice, min_chars), f"doc_id {kind}, key binary")
    found = scratch(found, "suspected-lines")
    counts = (found.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
              .groupBy("key").agg(F.count("doc_id").alias("n"), F.max("doc_id").alias("last")))
    repeated = scratch(counts.where(F.col("n") >= min_docs).select("key", "last"), "repeated-lines")
    drops = found.join(repeated, "key").where(F.col("doc_id") < F.col("last"))
    drops = scratch(drops.groupBy("doc_id").agg(F.collect_set("key").alias("__drops")), "dropped-lines")
    # Documents that lose nothing are told by a filter of the others' ids and stay where they are.
    ids = drops.select(F.col("doc_id").cast("string").cast("binary").alias("id"))
    losing = spark.sparkContext.broadcast(bloom(ids, lambda i: {i}, "once", filter_bits))

    @F.pandas_udf(BooleanType())
    def loses(values: pd.Series) -> pd.Series:
        keys = [b"" if v is None else bytes(v) for v in values]
        return pd.Series(_held(keys, losing.value) if keys else [], dtype=bool)

    base = without(docs, *ADDED)
    base = base.withColumn("__loses", loses(F.col("doc_id").cast("string").cast("binary")))
    none = F.lit(None).cast(drops.schema["__drops"].dataType)
    whole = base.where(F.col("doc_id").isNull() | ~F.col("__loses")).withColumn("__drops", none)
    part = base.where(F.col("doc_id").isNotNull() & F.col("__loses"))
    part = part.join(drops.withColumnRenamed("doc_id", "__id"), F.col("doc_id") == F.col("__id"), "left").drop("__id")
    out = whole.unionByName(part)
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    kept = F.filter(lines, lambda line: ~F.array_contains("__drops", line_key(line)))
    out = out.withColumn("__kept", F.when(F.col("__drops").isNull(), lines).otherwise(kept))
    names = [c for c in base.columns if c != "__loses"]
    return out.select(
        *[F.array_join("__kept", "\n").alias(c) if c.lower() == "text" else quoted(c) for c in names],
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size("__kept")).cast("bigint").alias("n_dropped"))
