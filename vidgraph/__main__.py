"""Command line: ``python -m vidgraph <command> ...`` (or ``spark-submit vidgraph/__main__.py ...``).

Commands
  to-csv        --crawl DIR [--crawl DIR ...] --videos-out DIR --related-out DIR [--layout files|folders]
  import        --crawl DIR [--crawl DIR ...] --catalog DIR [--layout folders|files] [--skip FILE] [--aggregates]
  summary       --catalog DIR   (the category summary that imports with --aggregates keep up to date)
  check         --catalog DIR   (duplicate IDs, duplicate edges, edges to unknown videos)
  cluster       --catalog DIR --out DIR   (a copy of the videos whose range searches read less)
  import-csv    --videos CSV --related CSV --catalog DIR [--skip FILE]   (FILE: one video ID per line)
  network-csv   --videos CSV --related CSV --out DIR
  network       --catalog DIR --out DIR
  top           --catalog DIR --field F [--k 10]
  range         --catalog DIR --field F --start S --end E [--n 10]
  pagerank      --catalog DIR --results DIR [--reset 0.15] [--tol 0.01] [--top 20] [--state DIR]
                (DIR keeps a run that breaks off; the same command goes on from there)
  results-top   --results DIR [--k 10]

The session comes from ``SparkSession.builder.getOrCreate()`` (spark-submit or
spark-defaults settings apply); this entry point is the only place that
creates one.  Results are printed with ``show``; outputs go to the given folders.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vidgraph")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("to-csv")
    s.add_argument("--crawl", action="append", required=True)
    s.add_argument("--videos-out", required=True)
    s.add_argument("--related-out", required=True)
    s.add_argument("--layout", choices=["folders", "files"], default="files")
    s = sub.add_parser("import")
    s.add_argument("--crawl", action="append", required=True)
    s.add_argument("--catalog", required=True)
    s.add_argument("--layout", choices=["folders", "files"], default="folders")
    s.add_argument("--skip")
    s.add_argument("--aggregates", action="store_true")
    for name in ("summary", "check"):
        sub.add_parser(name).add_argument("--catalog", required=True)
    s = sub.add_parser("cluster")
    s.add_argument("--catalog", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("import-csv")
    s.add_argument("--videos", required=True)
    s.add_argument("--related", required=True)
    s.add_argument("--catalog", required=True)
    s.add_argument("--skip")
    s = sub.add_parser("network-csv")
    s.add_argument("--videos", required=True)
    s.add_argument("--related", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("network")
    s.add_argument("--catalog", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("top")
    s.add_argument("--catalog", required=True)
    s.add_argument("--field", required=True)
    s.add_argument("--k", type=int, default=10)
    s = sub.add_parser("range")
    s.add_argument("--catalog", required=True)
    s.add_argument("--field", required=True)
    s.add_argument("--start", type=float, required=True)
    s.add_argument("--end", type=float, required=True)
    s.add_argument("--n", type=int, default=10)
    s = sub.add_parser("pagerank")
    s.add_argument("--catalog", required=True)
    s.add_argument("--results", required=True)
    s.add_argument("--reset", type=float, default=0.15)
    s.add_argument("--tol", type=float, default=0.01)
    s.add_argument("--top", type=int, default=20)
    s.add_argument("--state")
    s = sub.add_parser("results-top")
    s.add_argument("--results", required=True)
    s.add_argument("--k", type=int, default=10)
    return p


def _catalogue(spark, path):
    from vidgraph.plans.catalog_tables import CatalogTables

    cat = CatalogTables(spark, path).read()
    if cat is None:
        raise SystemExit(f"no catalogue under {path}")
    return cat


def _print_report(report, path: str) -> None:
    print(f"read {report.lines} lines ({report.skipped} skipped, {report.bad_bytes} with invalid UTF-8), "
          f"{report.videos} video rows, {report.edges} edge rows")
    print(f"merged {report.merged_videos} videos, added {report.added_edges} edges under {path}")


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from vidgraph.operators import influence, search
    from vidgraph.plans import jobs
    from vidgraph.plans.network_state import NetworkState
    from vidgraph.sources import tables

    spark = SparkSession.builder.appName(f"vidgraph-{args.command}").getOrCreate()
    if args.command == "to-csv":
        jobs.crawl_to_csv(spark, args.crawl, args.videos_out, args.related_out, layout=args.layout)
        print(f"wrote {args.videos_out} and {args.related_out}")
    elif args.command == "import":
        store = jobs.CatalogTables(spark, args.catalog)
        _print_report((NetworkState(store) if args.aggregates else store).import_crawl(
            args.crawl, layout=args.layout, skip_ids=spark.read.text(args.skip) if args.skip else None), args.catalog)
    elif args.command == "summary":
        NetworkState(jobs.CatalogTables(spark, args.catalog)).category_summary().show(1000, truncate=False)
    elif args.command == "check":
        jobs.CatalogTables(spark, args.catalog).constraint_report().show()
    elif args.command == "cluster":
        jobs.cluster_job(_catalogue(spark, args.catalog).videos, args.out)
        print(f"clustered videos written to {args.out}")
    elif args.command == "import-csv":
        _print_report(jobs.CatalogTables(spark, args.catalog).import_csv(
            args.videos, args.related, skip_ids=spark.read.text(args.skip) if args.skip else None), args.catalog)
    elif args.command == "network-csv":
        jobs.network_from_csv(spark, args.videos, args.related, args.out)
        print(f"outputs written under {args.out}")
    elif args.command == "network":
        jobs.network_from_catalog(jobs.CatalogTables(spark, args.catalog), args.out)
        print(f"outputs written under {args.out}")
    elif args.command == "top":
        search.search_top_k(_catalogue(spark, args.catalog).videos, args.field, args.k).show(args.k, truncate=False)
    elif args.command == "range":
        search.search_range(_catalogue(spark, args.catalog).videos, args.field, args.start, args.end,
                            args.n).show(max(args.n, 1), truncate=False)
    elif args.command == "pagerank":
        top = jobs.influence_job(_catalogue(spark, args.catalog), args.results, reset=args.reset, tol=args.tol,
                                 top=args.top, state_path=args.state)
        top.show(args.top, truncate=False)
    elif args.command == "results-top":
        stored = tables.read_table(spark, args.results, schema=influence.RESULT_SCHEMA)
        influence.influence_top(stored, args.k).show(args.k, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
