"""Network aggregates kept up to date from what an import changed.

The state is, per category, exact sums: videos, views, ratings (with how many are
given) and degrees.  An import changes it by signed rows: a video that was there is
taken out of its old category with its old numbers and degrees and put into its new
one with the new; so is a video that only gained an edge.  Sums are decimals
(``SUM``), so what is taken out is exactly what was put in; a views or rating value
that does not fit counts as not given.

Only what changed is shuffled: stored videos and degrees are tested against a bitmap
of the changed IDs in their scan's stage (``membership``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidgraph.operators import network
from vidgraph.operators.membership import KeyFilter

SUM = "decimal(38,9)"
SUMS = ["numVideos", "sumViews", "nViews", "sumRating", "nRating", "sumOut", "sumIn"]
STATE = ("category string, numVideos bigint, sumViews decimal(38,9), nViews bigint, sumRating decimal(38,9), "
         "nRating bigint, sumOut bigint, sumIn bigint")


def _signed(rows: DataFrame, sign: int, category: str, views: str, rating: str, out: Column, into: Column) -> DataFrame:
    one = F.lit(sign).cast("bigint")

    def given(c):
        value = F.col(c).try_cast(SUM)
        return (F.coalesce(value, F.lit(0)) * sign).cast(SUM), F.when(value.isNotNull(), one).otherwise(0)

    (v, nv), (r, nr) = given(views), given(rating)
    columns = [F.col(category).alias("category"), one.alias("numVideos"), v.alias("sumViews"), nv.alias("nViews"),
               r.alias("sumRating"), nr.alias("nRating"), (out * sign).alias("sumOut"), (into * sign).alias("sumIn")]
    return rows.select(*columns)


def _summed(rows: DataFrame) -> DataFrame:
    out = rows.groupBy("category").agg(*[F.sum(c).alias(c) for c in SUMS])
    return out.select("category", *[F.col(c).cast(SUM if c in ("sumViews", "sumRating") else "bigint").alias(c)
                                    for c in SUMS])


def summary_state(videos: DataFrame, degrees: DataFrame) -> DataFrame:
    """The state (``STATE``) of whole tables: ``videos`` typed, ``degrees`` as of ``network.degrees``."""
    rows = videos.join(degrees, "videoId", "left")
    none = F.lit(0).cast("bigint")
    return _summed(_signed(rows, 1, "category", "views", "rating", F.coalesce("outDegree", none), F.coalesce("inDegree", none)))


def touched_ids(latest: DataFrame, added: DataFrame) -> DataFrame:
    """``videoId, moreOut, moreIn``: the videos that an import brought or gave edges."""
    none = F.lit(0).cast("bigint")
    more = network.degrees(added).select("videoId", F.col("outDegree").alias("moreOut"), F.col("inDegree").alias("moreIn"))
    brought = latest.select("videoId", none.alias("moreOut"), none.alias("moreIn"))
    return more.unionByName(brought).groupBy("videoId").agg(F.sum("moreOut").alias("moreOut"), F.sum("moreIn").alias("moreIn"))


def summary_delta(touched: DataFrame, n_touched: int, latest: DataFrame, old: DataFrame, videos: DataFrame,
                  degrees: DataFrame) -> DataFrame:
    """Signed sums per category (``STATE``) of one import.

    ``touched``: ``touched_ids`` of the import; ``latest`` and ``old``: the videos it
    brought, as they are now and, where they were there, as they were; ``videos``:
    the stored videos now (or before: only those not brought are looked up);
    ``degrees``: the stored degrees before (``videoId, outDegree, inDegree``).
    """
    ids = KeyFilter(touched, ["videoId"], n_touched)
    fields = ["category", "views", "rating"]
    stay = ids.maybe(videos.select("videoId", *fields), ["videoId"]).join(latest.select("videoId"), "videoId", "left_anti")
    before = old.select("videoId", *fields).unionByName(stay)
    after = latest.select("videoId", *fields).unionByName(stay)
    deg = touched.join(ids.maybe(degrees, ["videoId"]), "videoId", "left")
    none = F.lit(0).cast("bigint")
    out, into = F.coalesce("outDegree", none), F.coalesce("inDegree", none)
    gone = _signed(deg.join(before, "videoId"), -1, "category", "views", "rating", out, into)
    come = _signed(deg.join(after, "videoId"), 1, "category", "views", "rating",
                   out + F.col("moreOut"), into + F.col("moreIn"))
    return _summed(gone.unionByName(come))


def changed_degrees(touched: DataFrame, n_touched: int, degrees: DataFrame) -> DataFrame:
    """The degrees after the import of the IDs that gained edges."""
    more = touched.where("moreOut > 0 or moreIn > 0")
    held = KeyFilter(more, ["videoId"], n_touched).maybe(degrees, ["videoId"])
    none = F.lit(0).cast("bigint")
    return more.join(held, "videoId", "left").select(
        "videoId", (F.coalesce("outDegree", none) + F.col("moreOut")).alias("outDegree"),
        (F.coalesce("inDegree", none) + F.col("moreIn")).alias("inDegree"))


def category_summary(state: DataFrame) -> DataFrame:
    """``network.category_summary`` from the state's rows (any number per category)."""
    total = _summed(state).where("numVideos > 0")

    def mean(value: str, n: str) -> Column:
        return F.when(F.col(n) > 0, F.col(value).cast("double") / F.col(n))

    return total.select(
        "category", "numVideos", F.when(F.col("nViews") > 0, F.col("sumViews").cast("double")).alias("totalViews"),
        mean("sumViews", "nViews").alias("avgViews"), mean("sumRating", "nRating").alias("avgRating"),
        mean("sumOut", "numVideos").alias("avgOutDegree"), mean("sumIn", "numVideos").alias("avgInDegree"),
    ).orderBy(F.desc_nulls_last("totalViews"), F.asc_nulls_first("category"))


def global_metrics(state: DataFrame) -> DataFrame:
    """``network.global_metrics`` from the state's rows: every stored edge starts at a stored video."""
    sums = state.agg(*[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in ("numVideos", "sumOut", "sumIn")])
    return sums.select(
        "numVideos", F.col("sumOut").alias("numEdges"),
        F.when(F.col("numVideos") > 0, F.col("sumOut") / F.col("numVideos")).alias("avgOutDegree"),
        F.when(F.col("numVideos") > 0, F.col("sumIn") / F.col("numVideos")).alias("avgInDegree"))
