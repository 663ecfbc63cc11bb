"""Clustering of the catalogue for range searches over any of its numeric metrics.

A stored table can be sorted by one column only; sorted along a space-filling curve
(Z-order) through all five search metrics, every row group covers a narrow range of
each, so a pushed range filter skips most row groups by their statistics, whichever
metric it names.

Each metric becomes its place among ``2 ** BITS`` quantiles (so skewed metrics split
evenly too), the places' bits are interleaved, and rows are range-partitioned and
sorted by the result.  Quantiles are a bounded summary (``approxQuantile``); a value
that fills many quantiles, or null, only makes its row groups wider.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidgraph.schema import NUMERIC_SEARCH_FIELDS

BITS = 5
QUANTILE_ERROR = 0.002


def quantiles(rows: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list[float]]:
    """The inner bounds of ``2 ** bits`` equally filled parts of every column."""
    parts = 1 << bits
    found = rows.select(*[F.col(c).cast("double").alias(c) for c in columns]).approxQuantile(
        columns, [i / parts for i in range(1, parts)], QUANTILE_ERROR)
    return dict(zip(columns, found))


def curve_key(bounds: dict[str, list[float]], bits: int = BITS) -> Column:
    """The row's place on the curve: bit j of metric m is bit ``j * metrics + m``."""
    key = F.lit(0).cast("bigint")
    for m, (column, cuts) in enumerate(bounds.items()):
        value = F.col(column).cast("double")
        place = F.coalesce(F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < value)), F.lit(0)) if cuts else F.lit(0)
        place = F.greatest(place, F.lit(0)).cast("bigint")  # size(null) may be -1
        for j in range(bits):
            bit = F.shiftright(place, j).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(bit, j * len(bounds) + m))
    return key


def clustered(videos: DataFrame, columns: list[str] | None = None, bits: int = BITS) -> DataFrame:
    """``videos`` in curve order: range-partitioned and sorted, ready to be written."""
    columns = columns or NUMERIC_SEARCH_FIELDS
    rows = videos.withColumn("_curve", curve_key(quantiles(videos, columns, bits), bits))
    return rows.repartitionByRange("_curve", F.xxhash64(*columns)).sortWithinPartitions("_curve").drop("_curve")
