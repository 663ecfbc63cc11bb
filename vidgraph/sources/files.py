"""Files in the natural order of their names, as integers.

``part-99999`` stands before ``part-100000`` and ``9.tsv`` before ``10.tsv``: runs of
digits compare as numbers.  The order is computed once per scan, from the list of
files that Spark has made anyway; rows get it by a lookup of 16 bytes a file, so what
a later shuffle carries and compares is an integer, not a path.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Above this many files (32 MB of looked-up pairs) the lookup is no longer broadcast.
BROADCAST_FILES = 2_000_000


def plain_uri(uri: str) -> str:
    """``file:///a`` and ``file:/a`` name the same file; Spark uses both."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*:)///", r"\1/", uri)


def natural_key(path: str) -> tuple:
    """Folder name, then path, with runs of digits as numbers; equal keys (``01`` and ``1``) by path."""
    def parts(text: str) -> list:
        return [int(x) if i % 2 else x for i, x in enumerate(re.split(r"([0-9]+)", text))]

    folder = path.rsplit("/", 2)[-2] if path.count("/") > 1 else ""
    return parts(folder), parts(path), path


def _key(uri: Column) -> Column:
    return F.xxhash64(F.regexp_replace(uri, r"^([A-Za-z][A-Za-z0-9+.-]*:)///", "$1/"))


def file_ranks(spark: SparkSession, files: list[str]) -> DataFrame:
    """``key, rank``: one row per file, ranks from 0 in natural order."""
    ordered = sorted({plain_uri(f) for f in files}, key=natural_key)
    ranks = spark.createDataFrame(list(enumerate(ordered)), "rank int, uri string")
    return ranks.groupBy(_key(F.col("uri")).alias("key")).agg(F.min("rank").alias("rank"))


def with_rank(rows: DataFrame, uri: str, files: list[str], name: str = "rank") -> DataFrame:
    """``rows`` with the rank of the file that column ``uri`` names."""
    ranks = file_ranks(rows.sparkSession, files).select("key", F.col("rank").alias(name))
    ranks = F.broadcast(ranks) if len(files) <= BROADCAST_FILES else ranks
    return rows.join(ranks, _key(F.col(uri)) == F.col("key"), "left").drop("key")
