"""Skew experiment for PageRank's salted edge table (a measurement, not a query).

The graph is derived from the driver's tables: every order is a vertex, every
line item an edge.  Line items with line number <= 2 are re-pointed to come
from one hub order (``o0``) to their own order, so at sf0.1 the hub holds 29%
of the edge rows and 19% of the distinct edges; the other line items link their
order to another order.  Prints the partition sizes of the weighted edge
table with and without salting, and checks that PageRank's ranks sum to N.
Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import functions as F

    from vidgraph.operators import influence
    from vidgraph.session import local_session, scratch_path

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    n_orders = orders.count()
    v = orders.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"))
    hub_row = F.col("l_linenumber") <= 2
    e = lineitem.select(
        F.when(hub_row, F.lit("o0"))
        .otherwise(F.concat(F.lit("o"), F.col("l_orderkey").cast("string"))).alias("src"),
        F.when(hub_row, F.concat(F.lit("o"), F.col("l_orderkey").cast("string")))
        .otherwise(F.concat(F.lit("o"), F.pmod(F.col("l_orderkey") + F.col("l_partkey") * 7,
                                                F.lit(n_orders)).cast("string"))).alias("dst"),
    )
    salt_size, parts = 20_000, 8
    dedup = influence.distinct_edges(v, e).persist()
    state = influence._State(spark, scratch_path(spark, "skew_check"))
    vx, _ = state.store(influence.vertex_salts(v, dedup, salt_size=salt_size), "vertices")  # numbers are stored before use
    w = influence.weighted_edges(dedup, vx).persist()
    hub = dedup.where("src = 'o0'").count()
    hub_buckets = vx.where("id = 'o0'").first()["salts"]
    print(f"edge rows {e.count()} | distinct edges {w.count()} | hub distinct edges {hub} | "
          f"hub buckets {hub_buckets}")

    def sizes(df):
        return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())

    print("partition sizes with salt   ", sizes(w.repartition(parts, "src", "salt")))
    print("partition sizes without salt", sizes(w.repartition(parts, "src")))
    t = time.perf_counter()
    res = influence.pagerank(v.withColumnRenamed("id", "videoId"), e.toDF("srcVideoId", "dstVideoId"),
                             salt_size=salt_size, edges_per_bucket=80_000)
    total = res.agg(F.sum("pagerank")).first()[0]
    print(f"pagerank: {res.count()} rows, rank sum {total:.6f} (N = {n_orders}), {time.perf_counter() - t:.1f}s")
    spark.stop()


if __name__ == "__main__":
    main()
