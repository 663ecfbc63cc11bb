"""Print the physical plans of the key operators (for PLANS.md).

Usage: python tools/plans.py [sf_dir] > /tmp/plans.txt
Shows the operator tree of ``explain("formatted")`` plus the scan lines with
pushed filters and read schema.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep = [line for line in details.splitlines()
            if line.startswith("(") or line.startswith("PushedFilters") or line.startswith("ReadSchema")]
    return tree.strip() + "\n" + "\n".join(keep)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from vidgraph.operators import catalog, ingest, network, search
    from vidgraph.plans import fixtures as fx
    from vidgraph.plans.jobs import CatalogTables
    from vidgraph.session import local_session, scratch_path

    spark = local_session()
    store = CatalogTables(spark, scratch_path(spark, "plans_catalog"))
    videos = fx.videos_fx(spark, sf_dir)
    store.merge(videos, lambda: fx.related_fx(spark, sf_dir))
    cat = store.read()
    raw = fx.raw_lines_fx(spark, sf_dir)
    new_rows = ingest.parse_videos(raw)
    res = network.run_network(cat.videos, cat.related)
    plans = {
        "search_top_k(views, 10) over the stored catalogue": search.search_top_k(cat.videos, "views", 10),
        "search_range(views, 20000, 60000)": search.search_range(cat.videos, "views", 20000, 60000),
        "search_top_k(category, 3)": search.search_top_k(cat.videos, "category", 3),
        "node_degrees": network.node_degrees(network.aggregation_videos(cat.videos), cat.related),
        "category_summary (over persisted node_degrees)": res.category_summary,
        "global_metrics": res.global_metrics,
        "upsert_videos: crawl lines merged into the catalogue": catalog.upsert_videos(
            new_rows, ["batch", "line_no"], existing=cat.videos),
        "upsert_related: raw edges -> catalogue edges": catalog.upsert_related(
            ingest.parse_related(raw), cat.videos, existing=cat.related),
    }
    for title, df in plans.items():
        print(f"### {title}\n\n```\n{formatted(df)}\n```\n")
    res.unpersist()

    # One PageRank superstep on the merge-join path (the shape at scale): the
    # frontier is read from storage, the edge table from its buckets.
    from pyspark.sql import functions as F

    from vidgraph.operators import influence

    verts = cat.videos.select(F.col("videoId").alias("id"))
    edges = cat.related.select(F.col("srcVideoId").alias("src"), F.col("dstVideoId").alias("dst"))
    dedup = influence.distinct_edges(verts, edges)
    vx = influence.vertex_salts(verts, dedup)
    state = influence._State(spark, scratch_path(spark, "plans_pagerank"))
    vx, _ = state.store(vx, "vertices")
    w, buckets = influence._edge_table(state, lambda: influence.weighted_edges(dedup, vx), "plans_edges", edges.count, 4_000)
    frontier, _ = state.store(vx.select("num", F.lit(0.15).alias("delta"), "salts"), "frontier-0")
    for title, prune in (("merge-join path", False), ("few senders: their blocks prune the edge table", True)):
        step = influence.superstep(frontier, w if prune else w.hint("merge"), 0.15, 0.01, buckets, prune)
        print(f"### PageRank superstep ({title})\n\n```\n{formatted(step)}\n```\n")
    spark.sql("drop table plans_edges")
    spark.stop()


if __name__ == "__main__":
    main()
