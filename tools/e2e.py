"""End-to-end run of the production path on a stand-in crawl.

Spark writes the raw-lines fixture of ``sf_dir`` as crawl folders (one per
batch) under the session's scratch folder, then: ``CatalogTables.import_crawl``
-> ``network_job`` -> ``influence_job``.  Prints one line per stage with its
time and output size.  Usage: python tools/e2e.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from vidgraph.plans import fixtures as fx
    from vidgraph.plans.jobs import CatalogTables, influence_job, network_job
    from vidgraph.session import local_session, scratch_path

    spark = local_session()
    crawl_root = scratch_path(spark, "e2e_crawl")
    fx.raw_lines_fx(spark, sf_dir).select("batch", "value").write.partitionBy("batch").text(crawl_root)
    store = CatalogTables(spark, scratch_path(spark, "e2e_catalog"))

    t = time.perf_counter()
    report = store.import_crawl(crawl_root)
    cat = store.read()
    print(f"import      {time.perf_counter() - t:6.2f}s  {report}")

    t = time.perf_counter()
    out = scratch_path(spark, "e2e_network")
    network_job(cat.videos, cat.related, out, check_nonempty=True)
    print(f"network     {time.perf_counter() - t:6.2f}s  -> {out}")

    t = time.perf_counter()
    top = influence_job(cat, scratch_path(spark, "e2e_pagerank")).collect()
    print(f"influence   {time.perf_counter() - t:6.2f}s  top={top[0]['id']} {top[0]['pagerank']:.4f}")
    spark.stop()


if __name__ == "__main__":
    main()
