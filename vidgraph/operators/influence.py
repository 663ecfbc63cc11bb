"""Influence analysis: PageRank to convergence, stored results, top lists.

PageRank semantics (dynamic, delta-based form of GraphX ``runUntilConvergence``,
which the reference reaches through its graph library):

1. edges with an endpoint that is not a vertex are dropped; weight(u->v) =
   (number of parallel u->v edges) / outdeg(u);
2. every vertex starts with delta = reset (0.15) and rank = delta;
3. each superstep, vertices whose last delta is > tol send delta * weight
   along their out-edges; a vertex receiving mass gets
   delta' = (1 - reset) * sum and rank += delta'; the others fall silent;
4. stop when no vertex receives mass; then scale ranks by N / sum(rank)
   (sinks leak mass otherwise).

Plan at scale
* The weighted edge table is built once, de-duplicated (parallel edges become
  a multiplicity), and stored as a table bucketed by ``(src, salt)``, one folder
  (``block``) per bucket: no superstep shuffles it again (a merge join sorts each
  bucket where it lies).
* Skew: a source with many out-edges is split into ``ceil(targets / salt_size)``
  salt buckets (edges spread by a hash of their target); its delta is exploded
  to one row per bucket on the (small) frontier side, so no task holds more
  than about ``salt_size`` edges of one source.  Targets with many in-edges
  are summed by a partial aggregate.
* Vertices are numbered once; edges and frontiers carry numbers, not IDs.
* A superstep is one job: it joins the frontier (read back from storage, so Spark
  knows its size and broadcasts it or not by the session's own threshold) with the
  edge table, sums the mass by target and writes the next frontier; the counts come
  from the write itself (``observe``).
* Late supersteps have few senders: where they are fewer than the blocks, the blocks
  they fall into prune the edge table's folders at run time (dynamic partition
  pruning), so files read fall with the frontier.
* All that is stored lies in one folder (by default a new one under the shared
  checkpoint folder; it survives lost executors).  Every ``FOLD`` supersteps the ranks so
  far are folded into one table, and what is no longer read is deleted.  With
  ``state_path`` a run that broke off, driver included, is resumed by the same call:
  outputs that are complete are read instead of made.  Folder and table are removed
  at the end, and after an error unless ``state_path`` is given.  Only scalars reach
  the driver: counts, and N and the rank sum for the final scaling.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidgraph.schema import VIDEO_COLUMNS
from vidgraph.session import hadoop_path, scratch_path

SALT_SIZE = 200_000
# Edge rows per bucket of the weighted edge table (about 40 bytes each).
EDGES_PER_BUCKET = 4_000_000
# Supersteps between two foldings of the ranks.
FOLD = 10


def _check(reset: float, tol: float, max_iter: int | None) -> None:
    if not 0.0 < reset < 1.0:
        raise ValueError("reset probability must be in (0, 1)")
    if not tol > 0.0:
        raise ValueError("tol must be positive")
    if max_iter is not None and max_iter < 0:
        raise ValueError("max_iter must be >= 0")


def distinct_edges(vertex_ids: DataFrame, edges: DataFrame) -> DataFrame:
    """``src, dst, mult``: edges between known vertices, parallel ones counted.

    Counted first (partial aggregate: repeated pairs collapse map-side), then
    the targets are checked on distinct pairs; nothing after that needs its
    partitioning, so AQE may split a hot target.  Sources are checked by the
    later join with their weights (``weighted_edges``), which only vertices have.
    """
    ids = vertex_ids.select("id").where(F.col("id").isNotNull())
    return (
        edges.select("src", "dst")
        .where(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("mult"))
        .join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
        .select("src", "dst", "mult")
    )


def vertex_salts(vertex_ids: DataFrame, dedup: DataFrame, salt_size: int = SALT_SIZE) -> DataFrame:
    """``id, num, salts, outdeg`` for every vertex: a number of its own (to be stored before
    it is used), salts = ceil(targets / salt_size), at least 1."""
    deg = dedup.groupBy(F.col("src").alias("id")).agg(
        F.sum("mult").alias("outdeg"), F.count(F.lit(1)).alias("targets")
    )
    return (
        vertex_ids.select("id").where(F.col("id").isNotNull()).distinct()
        .join(deg, "id", "left")
        .select(
            "id", F.monotonically_increasing_id().alias("num"),
            F.greatest(F.lit(1), F.ceil(F.coalesce(F.col("targets"), F.lit(0)) / F.lit(salt_size)))
            .cast("int").alias("salts"),
            F.coalesce(F.col("outdeg"), F.lit(0)).alias("outdeg"),
        )
    )


def weighted_edges(dedup: DataFrame, vx: DataFrame) -> DataFrame:
    """``src, salt, dst, w, dstSalts``, ends as vertex numbers: weight = mult /
    outdeg(src); the salt spreads a source's edges over its buckets by a hash of the target."""
    src_side = vx.select(F.col("id").alias("src"), F.col("num").alias("srcNum"), F.col("salts").alias("srcSalts"), "outdeg")
    dst_side = vx.select(F.col("id").alias("dst"), F.col("num").alias("dstNum"), F.col("salts").alias("dstSalts"))
    return (
        dedup.join(src_side, "src")
        .join(dst_side, "dst")
        .select(
            F.col("srcNum").alias("src"),
            F.pmod(F.xxhash64("dst"), F.col("srcSalts")).cast("int").alias("salt"),
            F.col("dstNum").alias("dst"),
            (F.col("mult") / F.col("outdeg")).alias("w"),
            "dstSalts",
        )
    )


class _State:
    """What a run has stored under ``path``; complete outputs (Spark marks them) are not made again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def done(self, name: str) -> bool:
        path, fs = hadoop_path(self.spark, f"{self.path}/{name}/_SUCCESS")
        return fs.exists(path)

    def names(self) -> list[str]:
        path, fs = hadoop_path(self.spark, self.path)
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []

    def numbered(self, prefix: str) -> list[int]:
        """The numbers N of complete outputs ``prefix-N``, ascending."""
        found = [n for n in self.names() if n.startswith(prefix + "-") and self.done(n)]
        return sorted(int(n.rsplit("-", 1)[1]) for n in found)

    def delete(self, name: str = "") -> None:
        path, fs = hadoop_path(self.spark, f"{self.path}/{name}" if name else self.path)
        fs.delete(path, True)

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def store(self, df: DataFrame, name: str, *counts) -> tuple[DataFrame, dict]:
        """Write ``df`` (one job, observing the aggregates ``counts``) and read it back."""
        if self.done(name):
            stored = self.read(name, df.schema)
            return stored, stored.agg(*counts).first().asDict() if counts else {}
        seen = Observation()
        out = df.observe(seen, *counts) if counts else df
        out.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.read(name, df.schema), dict(seen.get) if counts else {}


def _block(buckets: int):
    """The bucket Spark puts a ``(src, salt)`` row into."""
    return F.pmod(F.hash("src", "salt"), F.lit(buckets))


def _edge_table(state: _State, make, name: str, n_edges, edges_per_bucket: int) -> tuple[DataFrame, int]:
    """The weighted edges as table ``name``: one folder ``block=B`` per bucket of
    ``(src, salt)``.  A complete one is only registered again."""
    spark, held = state.spark, state.numbered("edges")
    if held:
        buckets = held[-1]
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in make().schema)
        spark.sql(f"create table {name} ({columns}, block int) using parquet partitioned by (block) clustered by (src, salt) "
                  f"sorted by (src, salt) into {buckets} buckets location '{state.path}/edges-{buckets}'")
        spark.sql(f"alter table {name} recover partitions")
    else:
        for broken in [f for f in state.names() if f.startswith("edges-")]:
            state.delete(broken)
        buckets = max(spark.sparkContext.defaultParallelism, -(-n_edges() // edges_per_bucket))
        rows = make().repartition(buckets, "src", "salt").withColumn("block", _block(buckets))
        (rows.write.partitionBy("block").bucketBy(buckets, "src", "salt").sortBy("src", "salt")
         .option("path", f"{state.path}/edges-{buckets}").format("parquet").saveAsTable(name))
    return spark.table(name), buckets


def superstep(frontier: DataFrame, w: DataFrame, reset: float, tol: float, buckets: int, prune: bool) -> DataFrame:
    """The next frontier (``num, delta, salts``); ``prune``: read only the blocks of the senders."""
    sends = frontier.where(F.col("delta") > F.lit(tol)).select(
        F.col("num").alias("src"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "delta")
    if prune:
        blocks = sends.select(_block(buckets).alias("block")).distinct()  # at most one row per bucket
        w = w.join(F.broadcast(blocks), "block", "left_semi")
    return (
        sends.join(w, ["src", "salt"])
        .groupBy("dst")
        .agg(F.sum(F.col("delta") * F.col("w")).alias("mass"), F.max("dstSalts").alias("salts"))
        .select(F.col("dst").alias("num"), (F.lit(1.0 - reset) * F.col("mass")).alias("delta"), "salts")
    )


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    reset_probability: float = 0.15,
    tol: float = 0.01,
    *,
    max_iter: int | None = None,
    id_col: str = "videoId",
    src_col: str = "srcVideoId",
    dst_col: str = "dstVideoId",
    salt_size: int = SALT_SIZE,
    edges_per_bucket: int = EDGES_PER_BUCKET,
    fold: int = FOLD,
    trusted_edges: bool = False,
    state_path: str | None = None,
) -> DataFrame:
    """Vertices (``id_col`` renamed ``id``, other columns kept) + ``pagerank``.

    Each distinct ID is one vertex (a repeated vertex row gets the same rank).
    ``max_iter`` (default: none, run to convergence) bounds the supersteps; if
    mass is still being sent then, that is an error, not a result.
    ``trusted_edges=True`` states that ``edges`` are distinct pairs of known
    vertices (a catalogue's edge table is), which skips their clean-up; out-degrees
    are wrong if the statement is.  ``state_path`` (shared storage) keeps the state of
    a run that breaks off; a call with the same inputs and path goes on from there.
    """
    _check(reset_probability, tol, max_iter)
    spark = vertices.sparkSession
    verts = vertices.withColumnRenamed(id_col, "id")
    e = edges.select(F.col(src_col).alias("src"), F.col(dst_col).alias("dst"))
    state = _State(spark, state_path.rstrip("/") if state_path else scratch_path(spark, "pagerank"))
    table, n = f"vidgraph_edges_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n")
    converged = False
    try:
        if trusted_edges:
            dedup = e.select("src", "dst", F.lit(1).cast("bigint").alias("mult"))
        else:
            dedup = distinct_edges(verts.select("id"), e)
        dedup, pairs = state.store(dedup, "pairs", n)
        vx, _ = state.store(vertex_salts(verts.select("id"), dedup, salt_size), "vertices")
        w, buckets = _edge_table(state, lambda: weighted_edges(dedup, vx), table, lambda: pairs["n"], edges_per_bucket)
        ranks = _run(state, vx, w, buckets, reset_probability, tol, max_iter, fold)
        path = scratch_path(spark, "pagerank-ranks")
        ranks = ranks.join(vx.select("num", "id"), "num").select("id", "delta")
        ranks.write.parquet(path)
        ranks = spark.read.schema(ranks.schema).parquet(path)
        converged = True
    finally:
        spark.sql(f"drop table if exists {table}")
        if converged or not state_path:
            state.delete()
    stats = ranks.agg(F.count(F.lit(1)).alias("n"), F.sum("delta").alias("total")).first()
    factor = (stats["n"] / stats["total"]) if stats["total"] else 1.0
    return verts.join(ranks.select("id", (F.col("delta") * F.lit(factor)).alias("pagerank")), "id")


def _run(state: _State, vx: DataFrame, w: DataFrame, buckets: int, reset: float, tol: float, max_iter: int | None,
         fold: int) -> DataFrame:
    """Supersteps from the state's newest folded ranks (or the start) to convergence: the rank sums."""
    schema = T.StructType([vx.schema["num"], T.StructField("delta", T.DoubleType()), T.StructField("salts", T.IntegerType())])
    senders = F.count(F.when(F.col("delta") > F.lit(tol), 1)).alias("senders")
    folded = state.numbered("ranks")
    step = folded[-1] if folded else 0
    if step:
        frontier = state.read(f"frontier-{step}", schema)
        seen = frontier.agg(senders).first().asDict()
        parts = [state.read(f"ranks-{step}", T.StructType(schema.fields[:2]))]
    else:
        start = vx.select("num", F.lit(reset).cast("double").alias("delta"), "salts")
        frontier, seen = state.store(start, "frontier-0", senders)
        parts = [frontier.select("num", "delta")]
    stored = [f"frontier-{step}"]
    while seen["senders"]:
        if max_iter is not None and step >= max_iter:
            raise RuntimeError(f"PageRank has not converged after {max_iter} supersteps")
        step += 1
        received = superstep(frontier, w, reset, tol, buckets, seen["senders"] < buckets)
        frontier, seen = state.store(received, f"frontier-{step}", senders)
        parts.append(frontier.select("num", "delta"))
        stored.append(f"frontier-{step}")
        if len(parts) > fold:
            ranks, _ = state.store(_summed(parts), f"ranks-{step}")
            for old in [f"ranks-{r}" for r in state.numbered("ranks")[:-1]] + stored[:-1]:
                state.delete(old)
            parts, stored = [ranks], stored[-1:]
    return _summed(parts)


def _summed(parts: list[DataFrame]) -> DataFrame:
    """The ranks so far: the sum of each vertex's deltas."""
    union = parts[0]
    for more in parts[1:]:
        union = union.unionByName(more)
    return union.groupBy("num").agg(F.sum("delta").alias("delta"))


def influence_top(results: DataFrame, k: int = 10, by: str = "pagerank", key: str = "id") -> DataFrame:
    """The k rows with the highest ``by``; null and NaN last, ties by ``key``."""
    if not isinstance(k, int) or k <= 0:
        raise ValueError("k must be a positive integer")
    c = F.col(by)
    sort_val = F.when(~F.isnan(c), c) if isinstance(results.schema[by].dataType, (T.DoubleType, T.FloatType)) else c
    return (
        results.withColumn("_s", sort_val)
        .orderBy(F.desc_nulls_last("_s"), F.asc(key))
        .limit(k)
        .drop("_s")
    )


def to_property_map(df: DataFrame, column: str = "video") -> DataFrame:
    """One ``MAP<STRING,STRING>`` per row (a property-graph node read back);
    null attributes are left out of the map, as a node has no such property."""
    pairs = F.map_filter(
        F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]),
        lambda k, v: v.isNotNull(),
    )
    return df.select(pairs.alias(column))


def flatten_properties(df: DataFrame, schema: T.StructType, column: str = "video") -> DataFrame:
    """Map column -> one typed column per ``schema`` field (missing key or a value
    that is not of its type -> null)."""
    m = F.col(column)
    return df.select(*[F.try_element_at(m, F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields])


RESULT_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType())]
    + [T.StructField(c, t) for c, t in [
        ("uploader", T.StringType()), ("age", T.LongType()), ("category", T.StringType()),
        ("length", T.LongType()), ("views", T.LongType()), ("rating", T.DoubleType()),
        ("ratingCount", T.LongType()), ("commentCount", T.LongType()),
    ]]
    + [T.StructField("pagerank", T.DoubleType())]
)
assert [f.name for f in RESULT_SCHEMA.fields][1:-1] == VIDEO_COLUMNS[1:]
