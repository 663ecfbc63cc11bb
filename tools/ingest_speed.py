"""Ingest throughput on crawl lines derived from the driver's ``lineitem`` table
(a measurement, not a query): one crawl line per line item, with quoted,
blank-padded and related-ID fields.  Usage: python tools/ingest_speed.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def crawl_lines(spark, sf_dir: str):
    """One crawl line per line item."""
    from pyspark.sql import functions as F

    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    s = lambda c: F.col(c).cast("string")
    return li.select(
        F.lit(1).alias("batch"),
        F.monotonically_increasing_id().alias("line_no"),
        F.concat_ws("\t", F.concat(F.lit("v"), s("l_partkey")), F.concat(F.lit(" Brand#"), s("l_suppkey"), F.lit(" ")),
                    s("l_linenumber"), F.concat(F.lit('"'), F.col("l_returnflag"), F.lit('"')), s("l_quantity"),
                    s("l_extendedprice"), s("l_discount"), s("l_tax"), s("l_orderkey"),
                    F.concat(F.lit("v"), s("l_suppkey")), F.concat(F.lit('"v'), s("l_orderkey"), F.lit('"'))).alias("value"),
    )


def main() -> None:
    from vidgraph.operators import ingest
    from vidgraph.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    raw = crawl_lines(spark, sf_dir)
    cores = spark.sparkContext.defaultParallelism
    # the test files are one row group each: spread the lines over all cores first
    raw = raw.repartition(cores).persist()
    n = raw.count()
    for _ in range(3):
        t = time.perf_counter()
        ingest.parse_videos(raw).write.format("noop").mode("overwrite").save()
        tv = time.perf_counter() - t
        t = time.perf_counter()
        ingest.parse_related(raw).write.format("noop").mode("overwrite").save()
        tr = time.perf_counter() - t
        print(f"{n} lines on {cores} cores: videos {tv:.2f}s ({n / tv / cores / 1000:.0f}k lines/s/core), "
              f"related {tr:.2f}s ({n / tr / cores / 1000:.0f}k lines/s/core)")
    spark.stop()


if __name__ == "__main__":
    main()
