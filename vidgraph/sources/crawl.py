"""Read crawl folders as one distributed text scan.

Layouts
* ``"files"``   - every file directly inside each given folder (sub-folders
  skipped), or a given file itself;
* ``"folders"`` - every file one level below each root (``root/<crawl>/<file>``),
  so several crawls can reuse file names; deeper files are skipped, and so are
  files named ``log.txt`` (the crawler's log; ``skip_log`` changes that).

A root is resolved by Hadoop's ``Path`` and must exist; which files belong to
it follows from the number of path segments alone, so ``//``, ``.``, ``..``, a
scheme or a bucket root make no difference.  A root without any data file at
the layout's depth is an error, never an empty crawl.  As everywhere in Spark,
files whose names start with ``_`` or ``.`` (commit markers, checksums) are not
listed.  Nothing is moved, renamed or deleted.  Each line keeps its provenance:
``folder`` (crawl folder name), ``file`` (full path), ``rank`` (the file's place in
the natural order of folder and file names, see ``sources.files``), ``block`` (start
offset of its split) and ``pos`` (``monotonically_increasing_id`` taken on the scan,
increasing within a split), so ``(rank, block, pos)`` orders lines as they are in the
files, by integers.

The text reader splits on ``\\n``, ``\\r\\n`` and lone ``\\r`` and drops a BOM at
the start of a file.  Values keep invalid UTF-8 bytes as read; ``parse_lines``
turns them into U+FFFD and ``ingest_report`` counts such lines.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidgraph.session import hadoop_path
from vidgraph.sources.files import with_rank

# Fixed value: the crawler's log file, which is not data.
LOG_FILE = "log.txt"
ORDER_COLUMNS = ["rank", "block", "pos"]
LEVELS = {"files": 1, "folders": 2}
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


@dataclass(frozen=True)
class Root:
    """A resolved root: its URI, its number of path segments, and whether it is a file."""

    uri: str
    segments: int
    is_file: bool


def resolve_root(spark: SparkSession, root: str) -> Root:
    """Resolve ``root`` through its Hadoop file system; it must exist.  A root
    without a scheme that is not absolute starts at the working directory."""
    if not re.match(_SCHEME, root) and not root.startswith("/"):
        root = os.path.abspath(root)
    path, fs = hadoop_path(spark, root)
    if not fs.exists(path):
        raise FileNotFoundError(f"no such crawl root: {root} (glob patterns are not roots)")
    path = fs.makeQualified(path)
    return Root(path.toString(), segments(path), fs.getFileStatus(path).isFile())


def segments(path) -> int:
    """Number of segments of a Hadoop path (a bucket root has none)."""
    return len([x for x in path.toUri().getPath().split("/") if x])


def _layout_levels(layout: str, is_file: bool = False) -> int:
    if layout not in LEVELS:
        raise ValueError("layout must be 'files' or 'folders'")
    if is_file and layout == "folders":
        raise ValueError("a file cannot be the root of crawl folders")
    return 0 if is_file else LEVELS[layout]


def check_has_files(spark: SparkSession, root: Root, layout: str, skip_log: bool) -> None:
    """Raise unless a data file stands at the layout's depth below ``root``."""
    path, fs = hadoop_path(spark, root.uri)
    depth = root.segments + _layout_levels(layout, root.is_file)
    files = fs.listFiles(path, True)
    while files.hasNext():
        file = files.next().getPath()
        name = file.getName()
        if segments(file) == depth and name[0] not in "_." and not (skip_log and name == LOG_FILE):
            return
    raise ValueError(f"no data file for layout {layout!r} below {root.uri}")


def _decoded(c: Column) -> Column:
    """Undo percent-encoding, keeping ``+`` (form decoding would make it a blank)."""
    return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def lines_at(df: DataFrame, segments: int, skip_log: bool) -> DataFrame:
    """Keep the lines of files whose path has ``segments`` segments and add
    ``folder, file, block``; cheap string functions on ``_metadata`` only."""
    uri = F.col("_metadata.file_path")
    slashes = F.length(uri) - F.length(F.replace(uri, F.lit("/"), F.lit("")))
    # "scheme://authority/a/b" has two slashes more than its path "/a/b".
    keep = slashes - F.when(F.instr(uri, "://") > 0, 2).otherwise(0) == segments
    if skip_log:
        keep = keep & (F.col("_metadata.file_name") != LOG_FILE)
    folder = F.substring_index(F.substring_index(uri, "/", -2), "/", 1)
    folder = F.when(F.instr(folder, "%") > 0, _decoded(folder)).otherwise(folder)
    return df.where(keep).select(
        folder.alias("folder"),
        uri.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value"),
    )


def crawl_lines(df: DataFrame, root: str | Root, layout: str, skip_log: bool | None = None) -> DataFrame:
    """The data lines of a text scan (batch or streaming) of ``root``."""
    root = resolve_root(df.sparkSession, root) if isinstance(root, str) else root
    skip_log = layout == "folders" if skip_log is None else skip_log
    return lines_at(df, root.segments + _layout_levels(layout, root.is_file), skip_log)


def with_position(lines: DataFrame) -> DataFrame:
    """Add ``pos``: increasing within each file split (taken before any shuffle)."""
    return lines.select("folder", "file", "block", F.monotonically_increasing_id().alias("pos"), "value")


def read_crawl(spark: SparkSession, roots: str | list[str], layout: str = "folders",
               skip_log: bool | None = None) -> DataFrame:
    """``folder, file, block, pos, value, rank`` for every data line under ``roots``
    (a root given twice is read once)."""
    given = [roots] if isinstance(roots, str) else list(roots)
    if not given:
        raise ValueError("no crawl folder given")
    skip_log = layout == "folders" if skip_log is None else skip_log
    by_depth: dict[int, list[str]] = {}
    for root in dict.fromkeys(resolve_root(spark, r) for r in given):
        check_has_files(spark, root, layout, skip_log)
        by_depth.setdefault(root.segments + _layout_levels(layout, root.is_file), []).append(root.uri)
    out, files = None, []
    for segments, uris in by_depth.items():
        scan = spark.read.option("recursiveFileLookup", "true").text(uris)
        files += scan.inputFiles()
        part = with_position(lines_at(scan, segments, skip_log))
        out = part if out is None else out.unionByName(part)
    return with_rank(out, "file", files)
