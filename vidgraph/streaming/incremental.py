"""Incremental crawl import with Structured Streaming.

New crawl files arriving under a watched folder are parsed by the same column
expressions as the batch import and merged into the stored catalogue once per
micro-batch (``foreachBatch``).  A small table beside the catalogue keeps the last
batch that each streaming query has merged, so a batch replayed after a failure is
recognised; a batch that broke off half-way is merged again, which changes nothing
that was done.  Batch imports and several queries (one writer at a time) can share a
catalogue.  Line order inside a batch is (file rank, split, position), and later
batches win.
"""

from __future__ import annotations

from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vidgraph.plans.catalog_tables import CatalogTables, ImportReport
from vidgraph.sources import crawl
from vidgraph.sources.files import with_rank


def crawl_stream(spark: SparkSession, watch_dir: str, *, layout: str = "files",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``folder, file, block, value`` rows of new crawl files."""
    root = crawl.resolve_root(spark, watch_dir)
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return crawl.crawl_lines(reader.load(root.uri), root, layout)


def merge_batch(store: CatalogTables, batch: DataFrame, batch_id: int, query_id: str) -> ImportReport | None:
    """Merge one micro-batch of crawl lines into ``store``; returns its report, or
    None if this batch of this query has been merged already."""
    if batch_id <= store.last_batch(query_id):
        return None
    files = [r["file"] for r in batch.select("file").distinct().collect()]  # the files of one trigger
    report = store.merge_raw(with_rank(crawl.with_position(batch), "file", files), crawl.ORDER_COLUMNS)
    store.note_batch(query_id, batch_id)
    return report


def start_incremental_import(spark: SparkSession, watch_dir: str, catalog_path: str, checkpoint_location: str,
                             *, layout: str = "files", available_now: bool = False,
                             processing_time: str | None = None,
                             max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the streaming import; ``available_now`` processes what is there and stops."""
    store = CatalogTables(spark, catalog_path)
    started, query_id = Event(), []

    def merge(df: DataFrame, batch_id: int) -> None:
        started.wait()
        merge_batch(store, df, batch_id, query_id[0])

    writer = (
        crawl_stream(spark, watch_dir, layout=layout, max_files_per_trigger=max_files_per_trigger)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    query_id.append(query.id)  # kept in the checkpoint: the same after a restart
    started.set()
    return query
