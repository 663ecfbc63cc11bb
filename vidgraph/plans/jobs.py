"""End-to-end jobs built from the operators.

* ``crawl_to_csv``  - crawl files -> ``videos`` / ``related`` CSV (the converter).
* ``import_crawl``  - crawl folders -> typed ``videos`` + ``related`` catalogue
  (optionally merged into an existing one, with a skip list), not stored; the
  stored catalogue is ``plans.catalog_tables.CatalogTables``.
* ``network_job``   - the three aggregation outputs as header CSV; the two
  small tables as one file each, ``node_degrees`` written by all tasks.
* ``cluster_job``   - the catalogue clustered for range searches over any metric.
* ``influence_job`` - PageRank over the catalogue, results stored, top list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vidgraph.operators import catalog, clustering, influence, ingest, network
from vidgraph.plans.catalog_tables import Catalogue, CatalogTables
from vidgraph.schema import RELATED_TEXT, VIDEOS_TEXT
from vidgraph.sources import crawl, tables


def import_crawl(
    spark: SparkSession,
    roots: str | list[str],
    *,
    layout: str = "folders",
    existing: Catalogue | None = None,
    skip_ids: DataFrame | None = None,
) -> Catalogue:
    """Parse every crawl line under ``roots`` and merge it into ``existing``.

    Lines are ordered by (file rank, split, position): a later line wins.
    Both results are lazy and share the video merge; to store them, use
    ``CatalogTables.import_crawl``, which stages the writes so it runs once.
    """
    lines = ingest.parse_lines(crawl.read_crawl(spark, roots, layout=layout))
    videos = catalog.upsert_videos(
        ingest.videos_from_fields(lines),
        order=crawl.ORDER_COLUMNS,
        existing=existing.videos if existing else None,
        skip_ids=skip_ids,
    )
    related = catalog.upsert_related(
        ingest.related_from_fields(lines), videos, existing=existing.related if existing else None
    )
    return Catalogue(videos, related)


def network_job(videos: DataFrame, edges: DataFrame, out_dir: str, *, check_nonempty: bool = False) -> None:
    """Write ``global_metrics/``, ``category_summary/`` and ``node_degrees/`` under ``out_dir``."""
    if not out_dir:
        raise ValueError("out_dir must not be empty")
    res = network.run_network(videos, edges, check_nonempty=check_nonempty)
    try:
        tables.write_csv(res.global_metrics, f"{out_dir}/global_metrics", single_file=True)
        tables.write_csv(res.category_summary, f"{out_dir}/category_summary", single_file=True)
        tables.write_csv(res.node_degrees, f"{out_dir}/node_degrees")
    finally:
        res.unpersist()


def cluster_job(videos: DataFrame, path: str, *, row_group_bytes: int = 16 << 20) -> None:
    """Write ``videos`` to ``path`` in the order of a curve through the search metrics:
    range searches over it skip the row groups that cannot hold a match."""
    clustering.clustered(videos).write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)


def influence_job(cat: Catalogue, results_path: str, *, reset: float = 0.15, tol: float = 0.01,
                  top: int = 20, format: str = "parquet", options: dict | None = None,
                  state_path: str | None = None) -> DataFrame:
    """PageRank over the catalogue, stored at ``results_path``; returns the top list.
    With ``state_path`` a run that broke off is resumed by the same call.

    The catalogue's edges are distinct and endpoint-checked by construction, so
    PageRank skips re-checking them.
    """
    pr = influence.pagerank(cat.videos, cat.related, reset, tol, trusted_edges=True, state_path=state_path)
    tables.write_table(pr, results_path, format=format, options=options)
    stored = tables.read_table(cat.videos.sparkSession, results_path, schema=influence.RESULT_SCHEMA,
                               format=format, options=options)
    return influence.influence_top(stored, top)


def network_from_csv(spark: SparkSession, videos_path: str, related_path: str, out_dir: str) -> None:
    """Text entry: ``videos.csv`` + ``related.csv`` (all strings, header) -> three outputs.

    Uses the raw edge multiset (duplicates and edges to unknown videos count).
    Extra ``categoryId`` / ``metric1`` columns are carried along when present.
    """
    extra = [c for c in tables.csv_columns(spark, videos_path) if c not in VIDEOS_TEXT.fieldNames()]
    present = [c for c in tables.csv_columns(spark, videos_path) if c in VIDEOS_TEXT.fieldNames()]
    videos = tables.read_csv(spark, videos_path, T.StructType([T.StructField(c, T.StringType()) for c in present + extra]))
    related = tables.read_csv(spark, related_path, RELATED_TEXT)
    network_job(videos, related, out_dir)


def network_from_catalog(store: CatalogTables, out_dir: str) -> None:
    """Catalogue entry: de-duplicated, endpoint-checked edges; empty inputs raise."""
    cat = store.read()
    if cat is None:
        raise ValueError("no catalogue found")
    network_job(cat.videos, cat.related, out_dir, check_nonempty=True)


def crawl_to_csv(spark: SparkSession, roots: str | list[str], videos_out: str, related_out: str, *,
                 layout: str = "files") -> None:
    """Converter: crawl files -> ``videos`` and ``related`` header CSV (text rows,
    duplicates kept, as the converter writes them; outputs overwritten)."""
    lines = ingest.parse_lines(crawl.read_crawl(spark, roots, layout=layout))
    tables.write_csv(ingest.videos_from_fields(lines).select(*VIDEOS_TEXT.fieldNames()), videos_out)
    tables.write_csv(ingest.related_from_fields(lines).select(*RELATED_TEXT.fieldNames()), related_out)
