"""Typed catalogue: typing, last-write-wins upserts, edge upserts, checks.

Upsert semantics (graph-store MERGE): one node per ``videoId``; a later row
overwrites *all* attributes, nulls included; rows without an ID or with an ID
in the skip list are not loaded.  Edges: at most one per (src, dst), both
endpoints must be catalogued videos, self-loops stay.

Scale notes
* Last-write-wins is ``groupBy(videoId).agg(max_by(row, order))``: a partial
  aggregate, so a video re-crawled in a third of all lines is reduced inside
  each map task; no window sorts a hot key in one task.
* The merge with an existing catalogue is a full outer join of two sides that
  are both unique per key (no multiplication, no skew).
* Edge de-duplication is a partial aggregate on (src, dst); the endpoint
  checks are semi joins over the new edges only, split by AQE when one source
  holds a large share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidgraph.functions.convert import to_float, to_integer
from vidgraph.operators.membership import KeyFilter
from vidgraph.operators.network import aggregation_videos
from vidgraph.schema import VIDEO_COLUMNS

ATTRS = VIDEO_COLUMNS[1:]
# A key in more than one row of this many is dealt to several partitions of a join.
BUSY_SHARE = 1000


def _nonempty(c: str):
    return F.when(F.col(c) != "", F.col(c))


def type_videos_double(videos_text: DataFrame) -> DataFrame:
    """Aggregation typing: numeric columns as doubles via ``try_cast`` (bad text,
    NaN and infinities -> null)."""
    return aggregation_videos(videos_text)


def type_videos_graph(videos_text: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Graph-store typing of text rows (an empty field is null):
    ``toInteger(trim(x))`` for age, length, views, ratingCount, commentCount,
    ``toFloat(trim(x))`` for rating; strings unchanged."""
    keep = keep or []
    return videos_text.select(
        *keep,
        _nonempty("videoId").alias("videoId"),
        _nonempty("uploader").alias("uploader"),
        to_integer(_nonempty("age")).alias("age"),
        _nonempty("category").alias("category"),
        to_integer(_nonempty("length")).alias("length"),
        to_integer(_nonempty("views")).alias("views"),
        to_float(_nonempty("rating")).alias("rating"),
        to_integer(_nonempty("ratingCount")).alias("ratingCount"),
        to_integer(_nonempty("commentCount")).alias("commentCount"),
    )


def skip_listed(videos: DataFrame, skip_ids: DataFrame | None) -> DataFrame:
    """Drop rows whose ``videoId`` is in ``skip_ids`` (a one-column frame;
    null entries match nothing)."""
    if skip_ids is None:
        return videos
    ids = skip_ids.select(F.col(skip_ids.columns[0]).alias("videoId")).where(F.col("videoId").isNotNull())
    return videos.join(ids, "videoId", "left_anti")


def latest_per_video(rows: DataFrame, order: list[str]) -> DataFrame:
    """One row per ``videoId``: the row with the largest ``order`` tuple."""
    attrs = [c for c in VIDEO_COLUMNS[1:] if c in rows.columns]
    win = (
        rows.groupBy("videoId")
        .agg(F.max_by(F.struct(*attrs), F.struct(*order)).alias("_w"))
    )
    return win.select("videoId", *[F.col(f"_w.{c}").alias(c) for c in attrs])


def upsert_videos(
    new_text: DataFrame,
    order: list[str],
    existing: DataFrame | None = None,
    skip_ids: DataFrame | None = None,
) -> DataFrame:
    """Merge crawl rows (text, with ordering columns ``order``) into a typed catalogue.

    Later rows (larger ``order``) win over earlier ones and over ``existing``.
    """
    typed = type_videos_graph(new_text, keep=list(order))
    typed = typed.where(F.col("videoId").isNotNull())
    # Skipping is per ID, so it runs after the partial aggregate, on one row per
    # video: a hot video is collapsed map-side before any shuffle by videoId.
    latest = skip_listed(latest_per_video(typed, list(order)), skip_ids)
    if existing is None:
        return latest
    return merge_videos(existing, latest)


def merge_videos(existing: DataFrame, latest: DataFrame) -> DataFrame:
    """``existing`` with every video of ``latest`` replaced, nulls included (both
    one row per ID)."""
    joined = (
        existing.select(*VIDEO_COLUMNS).alias("o")
        .join(latest.withColumn("_new", F.lit(True)).alias("n"), "videoId", "full_outer")
    )
    return joined.select(
        "videoId",
        *[
            F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
            for c in ATTRS
        ],
    )


def distinct_related(edges: DataFrame) -> DataFrame:
    """Distinct (srcVideoId, dstVideoId) pairs without nulls."""
    pair = ["srcVideoId", "dstVideoId"]
    return edges.select(*pair).where(F.col(pair[0]).isNotNull() & F.col(pair[1]).isNotNull()).dropDuplicates(pair)


def known_related(fresh: DataFrame, videos: DataFrame, n_fresh: int | None = None) -> DataFrame:
    """The ``fresh`` distinct edges whose both endpoints are ``videos``.

    With ``n_fresh`` (how many they are, roughly) the stored videos are first
    tested against a bitmap of the endpoints, in their scan's stage: of a large
    catalogue only the videos that the fresh edges may name are shuffled.
    """
    ids = videos.select("videoId").where(F.col("videoId").isNotNull())
    if n_fresh is not None:
        ends = fresh.select(F.explode(F.array("srcVideoId", "dstVideoId")).alias("videoId"))
        ids = KeyFilter(ends, ["videoId"], 2 * n_fresh).maybe(ids, ["videoId"])
    return (
        fresh.join(ids.withColumnRenamed("videoId", "srcVideoId"), "srcVideoId", "left_semi")
        .join(ids.withColumnRenamed("videoId", "dstVideoId"), "dstVideoId", "left_semi")
        .select("srcVideoId", "dstVideoId")
    )


def upsert_related(
    edges: DataFrame, videos: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Distinct (srcVideoId, dstVideoId) pairs whose both endpoints are videos.

    Only the new ``edges`` are checked against ``videos``: ``existing`` catalogue
    edges already satisfy the rule (videos are never removed), so the existing
    edge table is shuffled once, by the final de-duplication, not by the joins.
    """
    e = known_related(distinct_related(edges), videos)
    if existing is None:
        return e
    return existing.select("srcVideoId", "dstVideoId").unionByName(e).dropDuplicates(["srcVideoId", "dstVideoId"])


def unknown_related(fresh: DataFrame, existing: DataFrame, n_fresh: int | None = None) -> DataFrame:
    """The ``fresh`` edges that ``existing`` does not hold.

    The large existing table is only the streamed side of a semi join with the
    fresh edges.  With ``n_fresh`` it is first tested against their bitmap, so
    that most stored edges never reach an exchange, also where the fresh edges
    are too many to be broadcast.
    """
    pair = ["srcVideoId", "dstVideoId"]
    stored = existing.select(*pair)
    if n_fresh is not None:
        stored = KeyFilter(fresh, pair, n_fresh).maybe(stored, pair)
    again = stored.join(fresh.select(*pair), pair, "left_semi")
    return fresh.select(*pair).join(again, pair, "left_anti")


def unique_violations(videos: DataFrame) -> DataFrame:
    """``videoId, count`` for every ID held by more than one row (empty when unique)."""
    return (
        videos.groupBy("videoId")
        .agg(F.count(F.lit(1)).alias("count"))
        .where(F.col("count") > 1)
    )


def busy_keys(rows: DataFrame, key: str, share: int) -> DataFrame:
    """``_busy, _salts`` for every value of ``key`` in more than 1/``share`` of the rows:
    fewer than ``share`` values, whose salts sum up to less than twice that."""
    total = rows.count()
    counts = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_busy")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") * share > total).select(
        "_busy", F.ceil(F.col("_n") * F.lit(share) / F.lit(max(total, 1))).cast("int").alias("_salts"))


def _with_properties(rows: DataFrame, key: str, spread: str, videos: DataFrame, prefix: str) -> DataFrame:
    """``rows`` left-joined with the video that ``key`` names, its columns as ``prefix.*``.

    A busy key is dealt to ``_salts`` partitions by the hash of ``spread``, its one
    video copied to each; rows without a key are dealt in the same way.
    """
    busy = F.broadcast(busy_keys(rows, key, BUSY_SHARE))
    salted = rows.join(busy, F.col(key) == F.col("_busy"), "left")
    salts = F.when(F.col(key).isNull(), F.lit(BUSY_SHARE)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = salted.withColumn("_salt", F.pmod(F.xxhash64(spread), salts).cast("int")).drop("_busy", "_salts")
    known = videos.where(F.col("videoId").isNotNull()).select(
        F.col("videoId").alias("_key"), *[F.col(c).alias(f"{prefix}.{c}") for c in VIDEO_COLUMNS])
    known = known.join(busy, F.col("_key") == F.col("_busy"), "left")
    known = known.withColumn("_at", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_busy", "_salts")
    joined = salted.join(known, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_at")), "left")
    return joined.drop("_key", "_salt", "_at")


def related_with_properties(edges: DataFrame, videos: DataFrame) -> DataFrame:
    """Edges as a graph store's connector gives them: ``srcVideoId, dstVideoId`` and all
    properties of both ends as ``source.<name>`` and ``target.<name>`` (literal column
    names).  Every edge row is kept; an end that is null or no video has null
    properties.  ``videos`` has one row per ID."""
    rows = edges.select("srcVideoId", "dstVideoId")
    rows = _with_properties(rows, "srcVideoId", "dstVideoId", videos, "source")
    return _with_properties(rows, "dstVideoId", "srcVideoId", videos, "target")


def endpoints(edges: DataFrame, src: str = "source.videoId", dst: str = "target.videoId",
              names: tuple[str, str] = ("srcVideoId", "dstVideoId")) -> DataFrame:
    """Project a connector edge frame (columns literally named ``source.<prop>``)
    to two endpoint columns; rows with a null endpoint are kept (see
    ``drop_null_endpoints``)."""
    return edges.select(F.col(f"`{src}`").alias(names[0]), F.col(f"`{dst}`").alias(names[1]))
