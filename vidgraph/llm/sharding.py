"""Sharding by vector bin packing.

All rows go to ``shards`` shards whose bytes, tokens and rows are balanced together.
Rows of equal text are one group and stay together unless the group alone exceeds a
shard's fair share.

1. **Groups**: bytes, tokens (maximal runs without ASCII blanks) and rows summed by
   text digest; one lean row per distinct text moves.
2. **Units** are what is placed.  A group of more than 1/``LARGE`` of a fair share (in
   any of the three) is a unit of its own: at most 3 x ``LARGE`` x shards of them.  A
   group above a whole fair share is cut into pieces by a hash of ``doc_id``, each
   about 1/``PIECE`` of it.  All other groups share ``BUNDLES`` x shards units by
   digest.  So the driver sees a number of units bounded by these constants and the
   number of shards, whatever the input; it never sees documents.
3. **Packing** (``pack``): units, largest first, go to the shard with the highest dot
   product of unit and residual capacity, among the shards that still have room for
   the unit's bytes; if none has, to the one with the most room.  Room for bytes comes
   first, so the law ``bytes`` holds; tokens and rows follow as far as groups allow.
4. **Files**: a row finds its shard by its digest in two broadcast tables of units
   (bounded as above), moves once, and is written to its shard's folder.  A shard is
   many files, dealt by row hash, so no task holds a shard or a group.  A row's slot
   is its place in its file plus the rows of the shard's files before it.

Defined cases: a null text is the empty text (size 16); repeated rows are rows of
their own with slots of their own; a null ``doc_id`` is an id like any other; equal
sizes are placed in digest order, so the result does not depend on the input's order;
a text larger than a fair share makes its shard larger than the others; columns that
clash with the added ones are replaced; an empty table gives empty tables.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from vidgraph.llm.common import quoted, scratch, without
from vidgraph.session import scratch_path

ROW_BYTES = 16
LARGE, PIECE, BUNDLES = 256, 64, 512
FILE_BYTES = 128 << 20
DIMENSIONS = ["bytes", "tokens", "rows"]
ADDED = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, ``__tokens`` and the text's digest ``__d1, __d2``."""
    text = F.coalesce("text", F.lit(""))
    sha = F.sha2(text.cast("binary"), 256)
    base = without(docs, "size", "__tokens", "__sha", "__d1", "__d2").withColumn("__sha", sha)
    tokens = F.size(F.split(F.btrim(text, F.lit(" \t\n\v\f\r")), r"[\x20\x09-\x0D]+")).cast("bigint")
    return base.select("*", (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"), tokens.alias("__tokens"),
                       F.xxhash64("__sha").alias("__d1"), F.xxhash64(F.lit(7), "__sha").alias("__d2")).drop("__sha")


def _sums(rows: DataFrame, *keys) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("size").alias("bytes"), F.sum("__tokens").alias("tokens"),
                                   F.count(F.lit(1)).alias("rows"))


def _share(fair: dict[str, float]) -> Column:
    """The largest of a group's three parts of a fair share."""
    return F.greatest(*[F.col(c) / F.lit(fair[c]) for c in DIMENSIONS])


def _bundle(shards: int) -> Column:
    return F.pmod("__d1", F.lit(BUNDLES * shards))


def pack(units: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every unit (rows of ``bytes, tokens, rows``), placed in the given order."""
    parts = units / np.maximum(1, units.sum(axis=0)) * shards  # in fair shares
    room = np.ones((shards, parts.shape[1]))
    chosen = np.zeros(len(units), np.int64)
    for i, unit in enumerate(parts):
        fits = room[:, 0] >= unit[0] - 1e-12
        chosen[i] = np.where(fits, room @ unit, -np.inf).argmax() if fits.any() else room[:, 0].argmax()
        room[chosen[i]] -= unit
    return chosen


def plan(docs: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """The unit tables: ``__d1, __d2, __piece, __pieces, __own`` of large groups and
    ``__bundle, __shared`` of bundles, each with its shard."""
    spark = docs.sparkSession
    rows = measured(docs)
    groups = scratch(_sums(rows, "__d1", "__d2"), "shard-groups")
    total = groups.agg(*[F.sum(c).alias(c) for c in DIMENSIONS]).first()
    fair = {c: max(1.0, (total[c] or 0) / shards) for c in DIMENSIONS}
    share = _share(fair)
    large = groups.where(share > 1 / LARGE).withColumn("share", share)
    pieces = F.when(F.col("share") > 1, F.ceil(F.col("share") * PIECE)).otherwise(1).cast("bigint")
    large = large.withColumn("__pieces", F.least(pieces, "rows"))
    large = scratch(large, "shard-large-groups")  # at most 3 x LARGE x shards rows
    whole = large.where(F.col("__pieces") == 1).select("__d1", "__d2", "__pieces", F.lit(0).cast("bigint").alias("__piece"),
                                                       *DIMENSIONS)
    split = large.where(F.col("__pieces") > 1).select("__d1", "__d2", "__pieces")
    cut = rows.select("doc_id", "size", "__tokens", "__d1", "__d2").join(F.broadcast(split), ["__d1", "__d2"])
    cut = _sums(cut, "__d1", "__d2", "__pieces", F.pmod(F.xxhash64("doc_id"), F.col("__pieces")).alias("__piece"))
    small = groups.where(share <= 1 / LARGE).groupBy(_bundle(shards).alias("__bundle"))
    small = small.agg(*[F.sum(c).alias(c) for c in DIMENSIONS])
    own = whole.unionByName(cut).collect()  # at most 3 x LARGE x shards groups and 3 x (PIECE + 1) x shards pieces
    shared = small.collect()  # at most BUNDLES x shards
    units = np.array([[r[c] for c in DIMENSIONS] for r in [*own, *shared]], float).reshape(-1, 3)
    keys = [(r["__d1"], r["__d2"], r["__piece"]) for r in own] + [(0, 0, r["__bundle"]) for r in shared]
    order = sorted(range(len(units)), key=lambda i: (-max(units[i] / [fair[c] for c in DIMENSIONS]), keys[i]))
    shard = np.zeros(len(units), np.int64)
    shard[order] = pack(units[order], shards)
    own_rows = [(r["__d1"], r["__d2"], r["__piece"], r["__pieces"], int(s)) for r, s in zip(own, shard)]
    shared_rows = [(r["__bundle"], int(s)) for r, s in zip(shared, shard[len(own):])]
    return (spark.createDataFrame(own_rows, "__d1 bigint, __d2 bigint, __piece bigint, __pieces bigint, __own int"),
            spark.createDataFrame(shared_rows, "__bundle bigint, __shared int"))


def assign(docs: DataFrame, shards: int) -> DataFrame:
    """``docs`` with ``size`` and ``shard``; no row moves."""
    if shards < 1:
        raise ValueError("shards must be positive")
    own, shared = plan(docs, shards)
    pieces = own.select("__d1", "__d2", "__pieces").distinct()
    rows = measured(without(docs, *ADDED)).join(F.broadcast(pieces), ["__d1", "__d2"], "left")
    rows = rows.withColumn("__piece", F.pmod(F.xxhash64("doc_id"), F.col("__pieces"))).drop("__pieces")
    rows = rows.join(F.broadcast(own.drop("__pieces")), ["__d1", "__d2", "__piece"], "left")
    rows = rows.withColumn("__bundle", _bundle(shards)).join(F.broadcast(shared), "__bundle", "left")
    return rows.withColumn("shard", F.coalesce("__own", "__shared")).drop("__bundle", "__piece", "__own", "__shared")


def write_shards(docs: DataFrame, folder: str, shards: int) -> None:
    """Writes ``docs`` (``doc_id, text``, any further columns) with ``size`` to
    ``folder/shard=N/``, files of about ``FILE_BYTES``."""
    rows = assign(docs, shards)
    size = docs.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
    files = max(1, math.ceil(size / shards / FILE_BYTES))
    rows = rows.withColumn("__file", F.col("shard") * files + F.pmod(F.xxhash64("doc_id", "__d2"), F.lit(files)).cast("int"))
    rows = rows.repartitionById(shards * files, F.col("__file"))
    rows.drop("__file", "__tokens", "__d1", "__d2").write.partitionBy("shard").parquet(folder)


def read_shards(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    """The written rows with ``shard``, ``slot``, ``text_crc32``, ``law`` and ``grown_shard``."""
    rows = spark.read.schema(schema).parquet(folder) if schema else spark.read.parquet(folder)
    rows = rows.select(*[quoted(c) for c in rows.columns], F.xxhash64("_metadata.file_path").alias("__file"),
                       F.col("_metadata.row_index").alias("__row"))
    counts = rows.groupBy("shard", "__file").agg(F.count(F.lit(1)).alias("n"))  # one row per file
    before = Window.partitionBy("shard").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    counts = scratch(counts.select("__file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start")), "shard-files")
    rows = rows.join(counts, "__file")
    return rows.select(
        *[quoted(c) for c in rows.columns if c not in ("__file", "__row", "__start")],
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        (F.col("__start") + F.col("__row")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int, folder: str | None = None) -> DataFrame:
    """Writes the shards (to a new scratch folder by default) and reads them back."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "llm-shards")
    write_shards(docs, folder, shards)
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in without(docs, *ADDED).schema)
    return read_shards(spark, folder, f"{fields}, size bigint, shard int")
