"""Search: complete rows, top-k by a metric or by category, open-range search.

Top-k is ``orderBy(...).limit(k)``, which Spark plans as
``TakeOrderedAndProject``: each task keeps its own k best rows and only those
reach the final merge, so nothing large is gathered in one place.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidgraph.schema import MENU_FIELDS, NUMERIC_SEARCH_FIELDS, SEARCH_FIELDS


def complete_videos(videos: DataFrame) -> DataFrame:
    """Rows without a null in any column (``dropna(how="any")``).

    Written as a conjunction of ``isNotNull`` so that it reaches the Parquet
    scan as pushed filters; NaN in float columns counts as null, as in ``dropna``.
    """
    cond = F.lit(True)
    for f in videos.schema.fields:
        c = F.col(f"`{f.name}`")
        cond = cond & c.isNotNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cond = cond & ~F.isnan(c)
    return videos.where(cond)


def _check_field(field: str) -> str:
    field = MENU_FIELDS.get(field, field)
    if field not in SEARCH_FIELDS:
        raise ValueError(f"unknown search field {field!r}; choose one of {SEARCH_FIELDS}")
    return field


def top_k(videos: DataFrame, field: str, k: int) -> DataFrame:
    """The k rows with the largest ``field`` (ties: lowest videoId first).

    For ``category`` it is the k categories with the most videos
    (``category, count``; ties: category ascending).  Menu wording such as
    "Rated" is accepted and mapped to its field (Rated = ratingCount).
    """
    field = _check_field(field)
    if not isinstance(k, int) or k <= 0:
        raise ValueError("k must be a positive integer")
    if field == "category":
        return (
            videos.groupBy("category")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first("category"))
            .limit(k)
        )
    return videos.orderBy(F.desc_nulls_last(field), F.asc("videoId")).limit(k)


def find_in_range(videos: DataFrame, field: str, start, end, n: int = 10) -> DataFrame:
    """Rows with ``start < field < end`` (both bounds exclusive), largest first,
    at most ``n`` (ties: lowest videoId first)."""
    field = _check_field(field)
    if field not in NUMERIC_SEARCH_FIELDS:
        raise ValueError(f"range search needs a numeric field, not {field!r}")
    if start is None or end is None or start < 0 or not start < end:
        raise ValueError("range needs 0 <= start < end")
    if not isinstance(n, int) or n < 0:
        raise ValueError("n must be a non-negative integer")
    c = F.col(field)
    if isinstance(videos.schema[field].dataType, T.IntegralType):
        # Whole bounds, which select the same whole numbers and reach the Parquet scan as pushed filters.
        start, end = (f(x) if isinstance(x, float) and math.isfinite(x) else x
                      for f, x in ((math.floor, start), (math.ceil, end)))
    return (
        videos.where((c > F.lit(start)) & (c < F.lit(end)))
        .orderBy(F.desc(field), F.asc("videoId"))
        .limit(n)
    )


def search_top_k(videos: DataFrame, field: str, k: int) -> DataFrame:
    """Search entry: top-k over complete rows only (the catalogue as stored)."""
    return top_k(complete_videos(videos), field, k)


def search_range(videos: DataFrame, field: str, start, end, n: int = 10) -> DataFrame:
    """Search entry: open-range search over complete rows only; ``n`` defaults to 10."""
    return find_in_range(complete_videos(videos), field, start, end, n)
