"""vidgraph: recommendation-network analytics on Spark DataFrames.

Crawl lines (one video with its attributes, then the IDs of related videos)
become a typed video catalogue and a de-duplicated edge table; search,
network aggregation and PageRank influence analysis run over them.

Every public operator takes and returns DataFrames, never creates or stops a
SparkSession, and uses built-in column expressions (no Python UDFs).

Main entry points (also importable from their modules)::

    from vidgraph import CatalogTables, read_crawl, search_top_k, search_range
    from vidgraph import run_network, network_job, pagerank, influence_job, influence_top
"""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

_EXPORTS = {
    "read_crawl": "vidgraph.sources.crawl",
    "parse_videos": "vidgraph.operators.ingest",
    "parse_related": "vidgraph.operators.ingest",
    "upsert_videos": "vidgraph.operators.catalog",
    "upsert_related": "vidgraph.operators.catalog",
    "complete_videos": "vidgraph.operators.search",
    "top_k": "vidgraph.operators.search",
    "find_in_range": "vidgraph.operators.search",
    "search_top_k": "vidgraph.operators.search",
    "search_range": "vidgraph.operators.search",
    "node_degrees": "vidgraph.operators.network",
    "global_metrics": "vidgraph.operators.network",
    "category_summary": "vidgraph.operators.network",
    "run_network": "vidgraph.operators.network",
    "pagerank": "vidgraph.operators.influence",
    "influence_top": "vidgraph.operators.influence",
    "CatalogTables": "vidgraph.plans.catalog_tables",
    "network_job": "vidgraph.plans.jobs",
    "network_from_csv": "vidgraph.plans.jobs",
    "influence_job": "vidgraph.plans.jobs",
    "start_incremental_import": "vidgraph.streaming.incremental",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'vidgraph' has no attribute {name!r}")
