"""Crawl lines -> ``videos`` text rows and ``related`` edge rows.

All steps are built-in column expressions over one distributed text scan (no
Python row parser):

1. ``strip_outer_quotes`` on the line, lines empty after it are skipped;
2. split on literal tabs, trailing empty fields kept;
3. field 0 is the video ID (``clean_id``), fields 1..8 are its attributes
   (``clean_cell``, missing ones padded with ''), fields 9.. are related IDs
   (``clean_id``, empty ones dropped, duplicates kept).

Provenance columns of the input (for example ``batch, line_no`` or the
``rank, block, pos`` of ``read_crawl``) are carried through, so that a
later upsert can order rows (last write wins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidgraph.functions.text import clean_cell, clean_id, split_fields, strip_outer_quotes
from vidgraph.schema import N_VIDEO_FIELDS, VIDEO_COLUMNS


def _carry(df: DataFrame, *drop: str) -> list[str]:
    return [c for c in df.columns if c not in drop]


def parse_lines(raw: DataFrame, value: str = "value") -> DataFrame:
    """Provenance columns + ``fields`` (array of raw strings) for non-empty lines.

    A line is empty after unquoting exactly when, without its trailing CR/LF,
    it is '' or ``""``; that cheap test is the filter, so the unquoting itself
    runs once per kept line.  Invalid UTF-8 byte sequences become U+FFFD
    (``make_valid_utf8``) instead of ending the import; ``ingest_report``
    counts such lines.
    """
    kept = raw.where(~F.rtrim(F.col(value), F.lit("\r\n")).isin("", '""'))
    line = strip_outer_quotes(F.make_valid_utf8(F.col(value)))
    return kept.select(*_carry(raw, value), split_fields(line).alias("fields"))


def videos_from_fields(lines: DataFrame) -> DataFrame:
    """One text row per line: the nine video columns (short rows padded)."""
    f = F.col("fields")
    cols = [clean_id(F.get(f, 0)).alias(VIDEO_COLUMNS[0])]
    cols += [clean_cell(F.get(f, i)).alias(VIDEO_COLUMNS[i]) for i in range(1, N_VIDEO_FIELDS)]
    return lines.select(*_carry(lines, "fields"), *cols)


def related_from_fields(lines: DataFrame) -> DataFrame:
    """One row per non-empty related ID of a line (duplicates kept)."""
    f = F.col("fields")
    tail = F.slice(f, N_VIDEO_FIELDS + 1, F.greatest(F.size(f) - N_VIDEO_FIELDS, F.lit(0)))
    return (
        lines.select(
            *_carry(lines, "fields"),
            clean_id(F.get(f, 0)).alias("srcVideoId"),
            F.explode(tail).alias("_dst"),
        )
        .select(*_carry(lines, "fields"), "srcVideoId", clean_id("_dst").alias("dstVideoId"))
        .where(F.col("dstVideoId") != "")
    )


def parse_videos(raw: DataFrame, value: str = "value") -> DataFrame:
    return videos_from_fields(parse_lines(raw, value))


def parse_related(raw: DataFrame, value: str = "value") -> DataFrame:
    return related_from_fields(parse_lines(raw, value))


def line_counts(value: str = "value") -> list[Column]:
    """Aggregates over raw lines: ``lines``, ``skipped`` (empty after unquoting) and
    ``badBytes`` (lines with invalid UTF-8); cheap enough to be observed in a write."""
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.rtrim(F.col(value), F.lit("\r\n")).isin("", '""'), 1)).alias("skipped"),
        F.count(F.when(~F.is_valid_utf8(F.col(value)), 1)).alias("badBytes"),
    ]


def ingest_report(raw: DataFrame, value: str = "value") -> DataFrame:
    """One row of counts: lines, skipped (empty after unquoting), lines with
    invalid UTF-8 (``badBytes``), videos and related edges."""
    line = strip_outer_quotes(F.make_valid_utf8(F.col(value)))
    fields = split_fields(line)
    n_rel = F.size(
        F.filter(
            F.slice(fields, N_VIDEO_FIELDS + 1, F.greatest(F.size(fields) - N_VIDEO_FIELDS, F.lit(0))),
            lambda x: clean_id(x) != "",
        )
    )
    return raw.agg(
        *line_counts(value),
        F.count(F.when(line != "", 1)).alias("videos"),
        F.coalesce(F.sum(F.when(line != "", n_rel)), F.lit(0)).cast("bigint").alias("edges"),
    )
