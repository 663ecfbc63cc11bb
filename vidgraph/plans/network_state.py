"""Network aggregates stored beside a catalogue and kept up to date by its imports.

* ``network/degrees/bucket=B``: degrees of the videos that have edges;
* ``network/sums``: signed per-category sums, a few rows appended by each import.

``open`` is a folder that exists while an import runs.  An import that broke off
leaves it behind; the next one then recomputes the state from the stored tables
instead of changing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidgraph.operators import incremental, network
from vidgraph.plans.catalog_tables import BucketedTable, CatalogTables, ImportReport
from vidgraph.session import hadoop_path, scratch_path
from vidgraph.sources import crawl, tables

DEGREES = T.StructType([T.StructField("videoId", T.StringType()), T.StructField("outDegree", T.LongType()),
                        T.StructField("inDegree", T.LongType())])


class NetworkState:
    """The aggregates of ``store``, changed by ``merge_raw`` / ``import_crawl``."""

    def __init__(self, store: CatalogTables):
        self.store, self.spark = store, store.spark
        self.path = f"{store.path}/network"
        self.degrees = BucketedTable(self.spark, f"{self.path}/degrees", DEGREES, ["videoId"], store.videos.bucket_bytes)

    def _exists(self, name: str) -> bool:
        path, fs = hadoop_path(self.spark, f"{self.path}/{name}")
        return fs.exists(path)

    def state(self) -> DataFrame:
        if not self._exists("sums"):
            return self.spark.createDataFrame([], incremental.STATE)
        return self.spark.read.schema(incremental.STATE).parquet(f"{self.path}/sums")

    def category_summary(self) -> DataFrame:
        return incremental.category_summary(self.state())

    def global_metrics(self) -> DataFrame:
        return incremental.global_metrics(self.state())

    def _clear(self, name: str) -> None:
        path, fs = hadoop_path(self.spark, f"{self.path}/{name}")
        fs.delete(path, True)

    def rebuild(self) -> None:
        """Recompute everything from the stored tables."""
        videos, edges = self.store.videos.read(), self.store.related.read()
        staged = scratch_path(self.spark, "degrees")
        tables.write_table(network.degrees(edges), staged)
        degrees = tables.read_table(self.spark, staged, schema=DEGREES)
        self._clear("degrees")
        if not degrees.isEmpty():
            self.degrees.replace(degrees, max(1, self.store.videos.count()), max(1, self.store.videos.count()))
        tables.write_table(incremental.summary_state(videos, degrees), f"{self.path}/sums")

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        tables.write_table(df, path)
        return tables.read_table(self.spark, path, schema=df.schema)

    def _apply(self, changes) -> None:
        touched = self._staged(incremental.touched_ids(changes.latest, changes.added), "touched-videos")
        n = touched.count()
        if not n:
            return
        degrees, store = self.degrees, self.store
        delta = incremental.summary_delta(touched, n, changes.latest, changes.old, store.videos.read(), degrees.read())
        delta = self._staged(delta, "category-delta")
        new = self._staged(incremental.changed_degrees(touched, n, degrees.read()), "changed-degrees")
        if not new.isEmpty():
            before, buckets = degrees.count(), max(1, store.videos.count())
            hit = None
            if before == buckets:  # at most ``buckets`` numbers
                hit = [r[0] for r in new.select(degrees.place(buckets)).distinct().collect()]
            kept = degrees.read(hit).join(new.select("videoId"), "videoId", "left_anti")
            degrees.replace(kept.unionByName(new), max(before, buckets), len(hit) if hit is not None else buckets)
        tables.write_table(delta.coalesce(1), f"{self.path}/sums", mode="append")

    def merge_raw(self, raw: DataFrame, order: list[str], *, skip_ids: DataFrame | None = None) -> ImportReport:
        """``CatalogTables.merge_raw``, and the aggregates follow."""
        broken = self._exists("open") or (not self._exists("sums") and bool(self.store.videos.buckets()))
        path, fs = hadoop_path(self.spark, f"{self.path}/open")
        fs.mkdirs(path)
        report, changes = self.store.merge_raw(raw, order, skip_ids=skip_ids, track=True)
        if broken:
            self.rebuild()
        else:
            self._apply(changes)
        fs.delete(path, True)
        return report

    def import_crawl(self, roots: str | list[str], *, layout: str = "folders",
                     skip_ids: DataFrame | None = None) -> ImportReport:
        raw = crawl.read_crawl(self.spark, roots, layout=layout)
        return self.merge_raw(raw, crawl.ORDER_COLUMNS, skip_ids=skip_ids)

    def compact(self) -> None:
        """Add up the appended rows (one per category and import) to one per category."""
        summed = self._staged(incremental._summed(self.state()).where("numVideos <> 0"), "category-sums")
        tables.write_table(summed.coalesce(1), f"{self.path}/sums")
