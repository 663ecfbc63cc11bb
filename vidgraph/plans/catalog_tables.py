"""The stored catalogue: two ordinary Parquet tables that any reader can open.

* ``videos/bucket=B``: one row per video, ``B`` the hash of its ID modulo the bucket
  count;
* ``related/bucket=B``: one row per edge, ``B`` from its source;
* ``imports/query=Q``: the last micro-batch that streaming query ``Q`` has merged.

The bucket count is a power of two taken from the table's size (one bucket for every
``bucket_bytes``, doubled as the table grows), so it needs no record of its own: the
smallest power of two above the largest bucket finds every row, whichever buckets
are empty.  An import reads and replaces only the buckets of videos that it touches
(dynamic partition overwrite) and appends the edges that are new.

Every step can be repeated: a later row of a video wins again, an edge that is there
is not added again.  So an import that broke off is simply run again; nothing of it
but whole replaced buckets and whole appended files can be seen before.  One writer
at a time.  The job that writes videos or edges checks that keys are unique and
fails before its commit, leaving the stored rows as they were.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidgraph.operators import catalog, ingest
from vidgraph.operators.membership import KeyFilter
from vidgraph.schema import RELATED_COLUMNS, RELATED_TEXT, VIDEOS_TEXT, VIDEOS_TYPED
from vidgraph.session import hadoop_path, scratch_path, stored_bytes
from vidgraph.sources import crawl, tables

BUCKET_BYTES = 256 << 20


@dataclass
class Catalogue:
    videos: DataFrame
    related: DataFrame


@dataclass(frozen=True)
class ImportReport:
    """What an import read (lines, skipped ones, ones with invalid UTF-8, video rows,
    edge rows) and changed (videos merged, edges added)."""

    lines: int
    skipped: int
    bad_bytes: int
    videos: int
    edges: int
    merged_videos: int = 0
    added_edges: int = 0


@dataclass(frozen=True)
class Changes:
    """What an import changed: the videos it brought, those of them that were there as
    they were, and the edges it added (all stored aside)."""

    latest: DataFrame
    old: DataFrame
    added: DataFrame


class BucketedTable:
    """A Parquet table under ``path`` partitioned by ``bucket``, from the hash of ``keys[0]``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], bucket_bytes: int):
        self.spark, self.path, self.schema, self.keys, self.bucket_bytes = spark, path, schema, keys, bucket_bytes

    def buckets(self) -> list[int]:
        """The buckets that have rows (folder names, one per bucket)."""
        path, fs = hadoop_path(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("bucket="))

    def count(self) -> int:
        """The bucket count: the smallest power of two above the largest bucket (0: no table)."""
        held = self.buckets()
        return 1 << held[-1].bit_length() if held else 0

    def count_with(self, more_bytes: int) -> int:
        """The bucket count once ``more_bytes`` have come: never less than now."""
        wanted = -(-(stored_bytes(self.spark, self.path) + more_bytes) // self.bucket_bytes)
        return max(1, self.count(), 1 << max(0, wanted - 1).bit_length())

    def place(self, buckets: int):
        return F.pmod(F.xxhash64(self.keys[0]), F.lit(buckets)).cast("int")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows (of some buckets only: other folders are not read)."""
        if not self.buckets():
            return self.spark.createDataFrame([], self.schema)
        layout = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(layout).parquet(self.path)
        rows = rows if buckets is None else rows.where(F.col("bucket").isin(buckets))
        return rows.select(*self.schema.fieldNames())

    def _checked(self, rows: DataFrame, tasks: int) -> DataFrame:
        """Rows by bucket, sorted by key; a repeated key fails the job that writes them."""
        order = Window.partitionBy("bucket").orderBy(*self.keys)
        again = F.lit(True)
        for k in self.keys:
            again = again & (F.lag(k).over(order) == F.col(k))
        rows = rows.repartition(max(1, tasks), "bucket").withColumn("_again", again)
        error = F.concat(F.lit("more than one row for "), F.concat_ws(" -> ", *self.keys))
        first = F.when(F.col("_again"), F.raise_error(error)).otherwise(F.col(self.keys[0]))
        return rows.withColumn(self.keys[0], first).drop("_again")

    def replace(self, rows: DataFrame, buckets: int, touched: int) -> None:
        """Overwrite the buckets that ``rows`` fall into (about ``touched`` of them).
        ``rows`` must hold all that these buckets are to hold; where the bucket
        count grows, all rows of the table."""
        before = self.count()
        out = self._checked(rows.withColumn("bucket", self.place(buckets)), touched)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path))
        if 0 < before < buckets:  # a bucket all of whose rows have moved up was not overwritten
            layout = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
            left = self.spark.read.schema(layout).parquet(self.path).where(F.col("bucket") != self.place(buckets))
            for row in left.select("bucket").distinct().collect():
                path, fs = hadoop_path(self.spark, f"{self.path}/bucket={row['bucket']}")
                fs.delete(path, True)

    def append(self, rows: DataFrame, buckets: int, touched: int) -> None:
        out = self._checked(rows.withColumn("bucket", self.place(buckets)), touched)
        out.write.mode("append").partitionBy("bucket").parquet(self.path)

    def compact(self, max_files: int = 32) -> list[int]:
        """Rewrite the buckets that many appends have left in more than ``max_files``
        files; returns them."""
        files: dict[int, int] = {}
        held = self.buckets()
        for f in self.read().inputFiles() if held else []:
            bucket = int(f.rsplit("bucket=", 1)[1].split("/")[0])
            files[bucket] = files.get(bucket, 0) + 1
        many = sorted(b for b, n in files.items() if n > max_files)
        if many:
            self.replace(self.read(many), self.count(), len(many))
        return many


class CatalogTables:
    """The catalogue stored under ``path`` (see the module's text)."""

    def __init__(self, spark: SparkSession, path: str, bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.path = spark, path.rstrip("/")
        self.videos = BucketedTable(spark, f"{self.path}/videos", VIDEOS_TYPED, ["videoId"], bucket_bytes)
        self.related = BucketedTable(spark, f"{self.path}/related", RELATED_TEXT, RELATED_COLUMNS, bucket_bytes)

    def read(self) -> Catalogue | None:
        """The stored tables; None where nothing has been imported."""
        if not self.videos.buckets():
            return None
        return Catalogue(self.videos.read(), self.related.read())

    def constraint_report(self) -> DataFrame:
        """One row: ``duplicateIds``, ``duplicateEdges``, ``danglingEdges`` (an endpoint
        that is no video) of the stored tables."""
        videos, related = self.videos.read(), self.related.read()
        ids = catalog.unique_violations(videos).agg(F.count(F.lit(1)).alias("duplicateIds"))
        twice = related.groupBy(*RELATED_COLUMNS).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        twice = twice.agg(F.count(F.lit(1)).alias("duplicateEdges"))
        distinct = catalog.distinct_related(related)
        loose = distinct.join(catalog.known_related(distinct, videos), RELATED_COLUMNS, "left_anti")
        loose = loose.agg(F.count(F.lit(1)).alias("danglingEdges"))
        parts = ids.unionByName(twice, True).unionByName(loose, True)
        return parts.agg(*[F.max(c).alias(c) for c in ("duplicateIds", "duplicateEdges", "danglingEdges")])

    def _merge_videos(self, staged: str, latest: DataFrame, n_latest: int, track: bool) -> DataFrame | None:
        table = self.videos
        before, buckets = table.count(), table.count_with(stored_bytes(self.spark, staged))
        touched = None
        if buckets == before:  # at most ``buckets`` numbers
            touched = [r[0] for r in latest.select(table.place(buckets)).distinct().collect()]
        old = None
        if track:
            held = KeyFilter(latest, ["videoId"], n_latest).maybe(table.read(touched), ["videoId"])
            old = self._aside(held.join(latest.select("videoId"), "videoId", "left_semi"), "old-videos")
        merged = catalog.merge_videos(table.read(touched), latest)
        table.replace(merged, buckets, buckets if touched is None else len(touched))
        return old

    def _aside(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        tables.write_table(df, path)
        return tables.read_table(self.spark, path, schema=df.schema)

    def _add_related(self, fresh: DataFrame, n_fresh: int) -> tuple[int, DataFrame]:
        """Append the fresh distinct edges between stored videos that are new; returns how many and which."""
        table, checked, seen = self.related, scratch_path(self.spark, "new-related"), Observation()
        before, buckets = table.count(), table.count_with(0)
        stored = table.read([r[0] for r in fresh.select(table.place(before)).distinct().collect()]) if before else None
        new = catalog.known_related(fresh, self.videos.read(), n_fresh)
        new = catalog.unknown_related(new, stored, n_fresh) if before else new
        tables.write_table(new.observe(seen, F.count(F.lit(1)).alias("n")), checked)
        new = tables.read_table(self.spark, checked, schema=RELATED_TEXT)
        buckets = table.count_with(stored_bytes(self.spark, checked))
        if seen.get["n"] and before in (0, buckets):
            table.append(new, buckets, buckets)
        elif seen.get["n"]:
            table.replace(table.read().unionByName(new), buckets, buckets)
        return int(seen.get["n"]), new

    def merge(self, latest: DataFrame, edges: Callable[[], DataFrame], track: bool = False) -> tuple[int, int, int, Changes]:
        """Merge typed ``latest`` videos (one row per ID, it wins, nulls included) and
        then the text ``edges`` between known videos; returns how many videos were
        merged, distinct edges given, and edges added, and with ``track`` the changes.

        Only the buckets that ``latest`` falls into are read and written; of the
        stored edges only the buckets of the import's sources are read, tested in
        the scan against a bitmap of the new edges, and none is written again.
        """
        staged, rows = scratch_path(self.spark, "new-videos"), Observation()
        tables.write_table(latest.observe(rows, F.count(F.lit(1)).alias("n")), staged)
        brought, n_videos = tables.read_table(self.spark, staged, schema=VIDEOS_TYPED), int(rows.get["n"])
        old = self._merge_videos(staged, brought, n_videos, track) if n_videos else None
        staged, pairs = scratch_path(self.spark, "new-pairs"), Observation()
        tables.write_table(catalog.distinct_related(edges()).observe(pairs, F.count(F.lit(1)).alias("n")), staged)
        fresh, n = tables.read_table(self.spark, staged, schema=RELATED_TEXT), int(pairs.get["n"])
        added, new = self._add_related(fresh, n) if n else (0, fresh)
        old = self.spark.createDataFrame([], VIDEOS_TYPED) if old is None else old
        return n_videos, n, added, Changes(brought, old, new)

    def merge_raw(self, raw: DataFrame, order: list[str], *, skip_ids: DataFrame | None = None, track: bool = False):
        """Merge raw crawl lines (``value`` and the ``order`` columns); returns the
        report, with ``track`` also the changes.  The text is scanned once for its
        videos and once for its edges; the counts are observed in these two jobs."""
        lines, pairs = Observation(), Observation()
        seen = raw.observe(lines, *ingest.line_counts("value"))
        latest = catalog.upsert_videos(ingest.parse_videos(seen), order=order, skip_ids=skip_ids)
        merged, distinct, added, changes = self.merge(
            latest, lambda: ingest.parse_related(raw).observe(pairs, F.count(F.lit(1)).alias("edges")), track)
        # Where nothing is left after the first exchange, the rest of that job is not run and observes nothing.
        read = lines.get if merged else raw.agg(*ingest.line_counts("value")).first().asDict()
        edges = pairs.get["edges"] if distinct else ingest.parse_related(raw).count()
        report = ImportReport(read["lines"], read["skipped"], read["badBytes"], read["lines"] - read["skipped"],
                              edges, merged, added)
        return (report, changes) if track else report

    def import_crawl(self, roots: str | list[str], *, layout: str = "folders",
                     skip_ids: DataFrame | None = None) -> ImportReport:
        """Merge crawl files; later lines win, in the natural order of folder and file names."""
        return self.merge_raw(crawl.read_crawl(self.spark, roots, layout=layout), crawl.ORDER_COLUMNS, skip_ids=skip_ids)

    def import_csv(self, videos_path: str, related_path: str, *, skip_ids: DataFrame | None = None) -> ImportReport:
        """Merge ``videos.csv`` and ``related.csv`` (header, columns by name);
        a later row of a video wins, also with nulls."""
        rows, pairs = Observation(), Observation()
        videos = tables.read_csv(self.spark, videos_path, VIDEOS_TEXT, with_order=True)
        seen = videos.observe(rows, F.count(F.lit(1)).alias("n"))
        latest = catalog.upsert_videos(seen, order=tables.ROW_ORDER, skip_ids=skip_ids)
        related = tables.read_csv(self.spark, related_path, RELATED_TEXT)
        merged, distinct, added, _ = self.merge(latest, lambda: related.observe(pairs, F.count(F.lit(1)).alias("n")))
        n_rows, n_pairs = rows.get["n"] if merged else videos.count(), pairs.get["n"] if distinct else related.count()
        return ImportReport(n_rows, 0, 0, n_rows, n_pairs, merged, added)

    def last_batch(self, query: str) -> int:
        """The last micro-batch that streaming query ``query`` has merged (-1: none)."""
        path, fs = hadoop_path(self.spark, f"{self.path}/imports")
        if not fs.exists(path):
            return -1
        done = self.spark.read.schema("batch bigint, query string").parquet(f"{self.path}/imports")
        last = done.where(F.col("query") == query).agg(F.max("batch")).first()[0]
        return -1 if last is None else last

    def note_batch(self, query: str, batch: int) -> None:
        row = self.spark.range(1).select(F.lit(batch).cast("bigint").alias("batch"), F.lit(query).alias("query"))
        (row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("query")
         .parquet(f"{self.path}/imports"))
