"""Registered queries: ``name -> (spark callable, DuckDB oracle SQL or None)``.

Each Spark callable takes ``(spark, sf_dir)`` and runs the library's operators
over inputs derived from the whole driver tables (see ``fixtures``).  Doubles
are rounded to 6 digits on both sides so that summation order cannot change a
value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidgraph.functions import text as tx
from vidgraph.operators import catalog, influence, ingest, network, search
from vidgraph.plans import duck, jobs
from vidgraph.plans import fixtures as fx
from vidgraph.plans.catalog_tables import CatalogTables
from vidgraph.plans.network_state import NetworkState
from vidgraph.schema import RELATED_TEXT, VIDEOS_TEXT, VIDEOS_TYPED
from vidgraph.session import scratch_path
from vidgraph.sources import crawl, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for order-insensitive value hashing)."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# ---------------------------------------------------------------- network

_RAW_EDGES = """
raw_edges as (select srcVideoId, dstVideoId from related_fx
              where srcVideoId is not null and dstVideoId is not null),
od as (select srcVideoId as videoId, count(*) as outDegree from raw_edges group by srcVideoId),
idg as (select dstVideoId as videoId, count(*) as inDegree from raw_edges group by dstVideoId),
node_deg as (
  select v.videoId, v.uploader, v.category,
         cast(v.views as double) as views, cast(v.rating as double) as rating,
         cast(v.ratingCount as double) as ratingCount, cast(v.commentCount as double) as commentCount,
         coalesce(od.outDegree, 0) as outDegree, coalesce(idg.inDegree, 0) as inDegree
  from videos_fx v left join od on v.videoId = od.videoId left join idg on v.videoId = idg.videoId)
"""

_CATALOG_EDGES = """
cat_edges as (select distinct r.srcVideoId, r.dstVideoId from related_fx r
              where r.srcVideoId in (select videoId from videos_fx)
                and r.dstVideoId in (select videoId from videos_fx)),
cod as (select srcVideoId as videoId, count(*) as outDegree from cat_edges group by srcVideoId),
cidg as (select dstVideoId as videoId, count(*) as inDegree from cat_edges group by dstVideoId),
cat_node_deg as (
  select v.videoId, v.uploader, v.category,
         cast(v.views as double) as views, cast(v.rating as double) as rating,
         cast(v.ratingCount as double) as ratingCount, cast(v.commentCount as double) as commentCount,
         coalesce(cod.outDegree, 0) as outDegree, coalesce(cidg.inDegree, 0) as inDegree
  from videos_fx v left join cod on v.videoId = cod.videoId left join cidg on v.videoId = cidg.videoId)
"""


def _net_sql(body: str, catalog: bool = False) -> str:
    ctes = _CATALOG_EDGES if catalog else _RAW_EDGES
    return fx.with_fixtures("", "videos_fx", "related_fx").rstrip() + ",\n" + ctes.strip() + "\n" + body


def _raw_inputs(spark, sf_dir):
    v = network.aggregation_videos(fx.videos_fx(spark, sf_dir))
    e = network.drop_null_endpoints(fx.related_fx(spark, sf_dir))
    return v, e


def _catalog_inputs(spark, sf_dir):
    videos = fx.videos_fx(spark, sf_dir)
    edges = catalog.upsert_related(fx.related_fx(spark, sf_dir), videos)
    return network.aggregation_videos(videos), edges


@register("out_degree", _net_sql("select videoId, outDegree from od"))
def q_out_degree(spark, sf_dir):
    return network.out_degree(_raw_inputs(spark, sf_dir)[1])


@register("in_degree", _net_sql("select videoId, inDegree from idg"))
def q_in_degree(spark, sf_dir):
    return network.in_degree(_raw_inputs(spark, sf_dir)[1])


_ND_COLS = ("videoId, uploader, category, round(views, 6) as views, round(rating, 6) as rating, "
            "round(ratingCount, 6) as ratingCount, round(commentCount, 6) as commentCount, outDegree, inDegree")


@register("node_degrees", _net_sql(f"select {_ND_COLS} from node_deg"))
def q_node_degrees(spark, sf_dir):
    return rounded(network.node_degrees(*_raw_inputs(spark, sf_dir)))


def _global_sql(nd: str, edges: str) -> str:
    return (f"select (select count(*) from {nd}) as numVideos, (select count(*) from {edges}) as numEdges, "
            f"(select round(avg(outDegree), 6) from {nd}) as avgOutDegree, "
            f"(select round(avg(inDegree), 6) from {nd}) as avgInDegree")


_CAT_SQL = """select category, count(*) as numVideos, round(sum(views), 6) as totalViews,
  round(avg(views), 6) as avgViews, round(avg(rating), 6) as avgRating,
  round(avg(outDegree), 6) as avgOutDegree, round(avg(inDegree), 6) as avgInDegree
from {nd} group by category"""


@register("global_metrics", _net_sql(_global_sql("node_deg", "raw_edges")))
def q_global_metrics(spark, sf_dir):
    v, e = _raw_inputs(spark, sf_dir)
    deg = network.degrees(e)
    return rounded(network.global_metrics(network.node_degrees(v, degree_table=deg), degree_table=deg))


@register("category_summary", _net_sql(_CAT_SQL.format(nd="node_deg")))
def q_category_summary(spark, sf_dir):
    return rounded(network.category_summary(network.node_degrees(*_raw_inputs(spark, sf_dir))))


@register("global_metrics_catalog", _net_sql(_global_sql("cat_node_deg", "cat_edges"), catalog=True))
def q_global_metrics_catalog(spark, sf_dir):
    v, e = _catalog_inputs(spark, sf_dir)
    deg = network.degrees(e)
    return rounded(network.global_metrics(network.node_degrees(v, degree_table=deg), degree_table=deg))


@register("category_summary_catalog", _net_sql(_CAT_SQL.format(nd="cat_node_deg"), catalog=True))
def q_category_summary_catalog(spark, sf_dir):
    return rounded(network.category_summary(network.node_degrees(*_catalog_inputs(spark, sf_dir))))


@register("row_counts", _net_sql(
    "select (select count(*) from videos_fx) as numVideos, (select count(*) from raw_edges) as numEdges"))
def q_row_counts(spark, sf_dir):
    return network.row_counts(*_raw_inputs(spark, sf_dir))


@register("nonempty_guard", _net_sql(
    "select 'all' as input, (select count(*) from videos_fx) = 0 or (select count(*) from raw_edges) = 0 as refused "
    "union all select 'no videos', true union all select 'no edges', true"))
def q_nonempty_guard(spark, sf_dir):
    """Which inputs the catalogue entry's guard refuses: the tables, and each one emptied."""
    v, e = _raw_inputs(spark, sf_dir)
    none = F.lit(False)
    found = []
    for name, videos, edges in (("all", v, e), ("no videos", v.where(none), e), ("no edges", v, e.where(none))):
        try:
            network.require_nonempty(videos, edges)
            found.append((name, False))
        except ValueError:
            found.append((name, True))
    return spark.createDataFrame(found, "input string, refused boolean")


@register("category_summary_top3", _net_sql(
    _CAT_SQL.format(nd="node_deg") + " order by sum(views) desc nulls last, category asc nulls first limit 3"))
def q_category_summary_top3(spark, sf_dir):
    """The summary's own order decides which three rows come first."""
    return rounded(network.category_summary(network.node_degrees(*_raw_inputs(spark, sf_dir))).limit(3))


# ---------------------------------------------------------------- search

_V_COLS = ["videoId", "uploader", "age", "category", "length", "views", "rating", "ratingCount", "commentCount"]
_COMPLETE = ("complete as (select * from videos_fx where "
             + " and ".join(f"{c} is not null" for c in _V_COLS) + " and not isnan(rating))")
_V_OUT = ", ".join(c if c != "rating" else "round(rating, 6) as rating" for c in _V_COLS)


def _search_sql(body: str) -> str:
    return fx.with_fixtures("", "videos_fx").rstrip() + ",\n" + _COMPLETE + "\n" + body


@register("complete_videos", _search_sql(f"select {_V_OUT} from complete"))
def q_complete_videos(spark, sf_dir):
    return rounded(search.complete_videos(fx.videos_fx(spark, sf_dir)))


TOPK_FIELDS = ["views", "ratingCount", "commentCount", "age", "length"]
TOPK_K = 10
# Fixed query parameters: (start, end) of each registered range search.
RANGES = {
    "views": (20000, 60000),
    "ratingCount": (500, 3000),
    "commentCount": (200, 1500),
    "age": (100, 500),
    "length": (600, 1800),
}
RANGE_N = 10


def _topk_query(field):
    def q(spark, sf_dir):
        return rounded(search.top_k(search.complete_videos(fx.videos_fx(spark, sf_dir)), field, TOPK_K))

    return q


def _range_query(field):
    start, end = RANGES[field]

    def q(spark, sf_dir):
        videos = search.complete_videos(fx.videos_fx(spark, sf_dir))
        return rounded(search.find_in_range(videos, field, start, end, RANGE_N))

    return q


for _f in TOPK_FIELDS:
    register(f"topk_{_f}", _search_sql(
        f"select {_V_OUT} from complete order by {_f} desc, videoId asc limit {TOPK_K}"))(_topk_query(_f))
for _f, (_s, _e) in RANGES.items():
    register(f"range_{_f}", _search_sql(
        f"select {_V_OUT} from complete where {_f} > {_s} and {_f} < {_e} "
        f"order by {_f} desc, videoId asc limit {RANGE_N}"))(_range_query(_f))

def _clustered_range_query(field):
    start, end = RANGES[field]

    def q(spark, sf_dir):
        """The range search over the catalogue stored in curve order."""
        path = scratch_path(spark, "clustered_videos")
        jobs.cluster_job(fx.videos_fx(spark, sf_dir), path)
        stored = tables.read_table(spark, path, schema=VIDEOS_TYPED)
        return rounded(search.search_range(stored, field, start, end, RANGE_N))

    return q


for _f in RANGES:
    register(f"range_clustered_{_f}", ORACLES[f"range_{_f}"])(_clustered_range_query(_f))

TOPK_CATEGORY_K = 3


@register("topk_category", _search_sql(
    f"select category, count(*) as count from complete group by category "
    f"order by count(*) desc, category asc limit {TOPK_CATEGORY_K}"))
def q_topk_category(spark, sf_dir):
    return search.top_k(search.complete_videos(fx.videos_fx(spark, sf_dir)), "category", TOPK_CATEGORY_K)


# ---------------------------------------------------------------- ingest


_ORDER = ["batch", "line_no"]


@register("ingest_strip_outer_quotes", duck.with_lines("select batch, line_no, line from unq"))
def q_ingest_strip_outer_quotes(spark, sf_dir):
    rl = fx.raw_lines_fx(spark, sf_dir)
    return rl.select("batch", "line_no", tx.strip_outer_quotes("value").alias("line"))


@register("ingest_split_lines", duck.with_lines(
    "select batch, line_no, len(f) as numFields, f[1] as firstField from lines"))
def q_ingest_split_lines(spark, sf_dir):
    lines = ingest.parse_lines(fx.raw_lines_fx(spark, sf_dir))
    return lines.select("batch", "line_no", F.size("fields").cast("bigint").alias("numFields"),
                        F.col("fields")[0].alias("firstField"))


@register("ingest_clean_id", duck.with_lines(
    f"select batch, line_no, {duck.clean_id('f[1]')} as videoId, {duck.clean_id('f[10]')} as firstRelated, "
    f"{duck.clean_id('f[11]')} as secondRelated from lines"))
def q_ingest_clean_id(spark, sf_dir):
    lines = ingest.parse_lines(fx.raw_lines_fx(spark, sf_dir))
    f = F.col("fields")
    return lines.select("batch", "line_no", tx.clean_id(F.get(f, 0)).alias("videoId"),
                        tx.clean_id(F.get(f, 9)).alias("firstRelated"),
                        tx.clean_id(F.get(f, 10)).alias("secondRelated"))


@register("ingest_clean_cell", duck.with_lines(
    f"select batch, line_no, {duck.clean_cell('f[2]')} as uploader, {duck.clean_cell('f[4]')} as category, "
    f"{duck.clean_cell('f[6]')} as views from lines"))
def q_ingest_clean_cell(spark, sf_dir):
    lines = ingest.parse_lines(fx.raw_lines_fx(spark, sf_dir))
    f = F.col("fields")
    return lines.select("batch", "line_no", tx.clean_cell(F.get(f, 1)).alias("uploader"),
                        tx.clean_cell(F.get(f, 3)).alias("category"),
                        tx.clean_cell(F.get(f, 5)).alias("views"))


@register("ingest_videos", duck.with_lines("select * from vt"))
def q_ingest_videos(spark, sf_dir):
    return ingest.parse_videos(fx.raw_lines_fx(spark, sf_dir))


@register("ingest_related", duck.with_lines("select * from rt"))
def q_ingest_related(spark, sf_dir):
    return ingest.parse_related(fx.raw_lines_fx(spark, sf_dir))


@register("ingest_crawl_folders", duck.with_lines(
    "select 'batch=' || cast(v.batch as varchar) as folder, v.numVideos, coalesce(r.numEdges, 0) as numEdges "
    "from (select batch, count(*) as numVideos from vt group by batch) v "
    "left join (select batch, count(*) as numEdges from rt group by batch) r on v.batch = r.batch"))
def q_ingest_crawl_folders(spark, sf_dir):
    """Crawl lines written by Spark as text files into one folder per batch
    (same file names in each), then read back as crawl folders and parsed."""
    root = scratch_path(spark, "crawl")
    fx.raw_lines_fx(spark, sf_dir).select("batch", "value").write.partitionBy("batch").text(root)
    raw = crawl.read_crawl(spark, root, layout="folders")
    lines = ingest.parse_lines(raw)
    v = ingest.videos_from_fields(lines).groupBy("folder").agg(F.count(F.lit(1)).alias("numVideos"))
    e = ingest.related_from_fields(lines).groupBy("folder").agg(F.count(F.lit(1)).alias("numEdges"))
    return (v.join(e, "folder", "left")
            .select("folder", "numVideos", F.coalesce("numEdges", F.lit(0)).cast("bigint").alias("numEdges")))


@register("ingest_crawl_files", duck.with_lines(
    "select (select count(*) from vt) as numVideos, (select count(*) from rt) as numEdges"))
def q_ingest_crawl_files(spark, sf_dir):
    """Crawl lines written as text files into one folder, read back in the ``files`` layout."""
    root = scratch_path(spark, "crawl_files")
    fx.raw_lines_fx(spark, sf_dir).select("value").write.text(root)
    lines = ingest.parse_lines(crawl.read_crawl(spark, root, layout="files"))
    return network.row_counts(ingest.videos_from_fields(lines), ingest.related_from_fields(lines))


def _nulled(cols):
    return ", ".join(f"nullif({c}, '') as {c}" for c in cols)


@register("csv_roundtrip_videos", duck.with_lines(f"select {_nulled(VIDEOS_TEXT.fieldNames())} from vt"))
def q_csv_roundtrip_videos(spark, sf_dir):
    path = scratch_path(spark, "videos_csv")
    tables.write_csv(ingest.parse_videos(fx.raw_lines_fx(spark, sf_dir)).select(*VIDEOS_TEXT.fieldNames()), path)
    return tables.read_csv(spark, path, VIDEOS_TEXT)


@register("csv_roundtrip_related", duck.with_lines(f"select {_nulled(RELATED_TEXT.fieldNames())} from rt"))
def q_csv_roundtrip_related(spark, sf_dir):
    path = scratch_path(spark, "related_csv")
    tables.write_csv(ingest.parse_related(fx.raw_lines_fx(spark, sf_dir)).select(*RELATED_TEXT.fieldNames()), path)
    return tables.read_csv(spark, path, RELATED_TEXT)


# ---------------------------------------------------------------- catalogue

@register("typed_videos_double", duck.with_lines(
    "select videoId, uploader, category, "
    + ", ".join(f"round({duck.finite_double(c)}, 6) as {c}" for c in ["views", "rating", "ratingCount", "commentCount"])
    + " from vt"))
def q_typed_videos_double(spark, sf_dir):
    return rounded(catalog.type_videos_double(ingest.parse_videos(fx.raw_lines_fx(spark, sf_dir))))


_GT_OUT = ", ".join(c if c != "rating" else "round(rating, 6) as rating" for c in _V_COLS)


@register("typed_videos_graph", duck.with_lines(f"select batch, line_no, {_GT_OUT} from gt"))
def q_typed_videos_graph(spark, sf_dir):
    return rounded(catalog.type_videos_graph(ingest.parse_videos(fx.raw_lines_fx(spark, sf_dir)), keep=_ORDER))


_LATEST = """
select {cols} from (
  select *, row_number() over (partition by videoId order by batch desc, line_no desc) as rn
  from gt where videoId is not null {skip}) where rn = 1"""

# Fixture parameter: the skip list holds the IDs of small parts.
SKIP_SQL = "select 'v' || cast(p_partkey as string) as videoId from {part} where p_size <= 5"


@register("upsert_videos", duck.with_lines(_LATEST.format(cols=_GT_OUT, skip="")))
def q_upsert_videos(spark, sf_dir):
    return rounded(catalog.upsert_videos(ingest.parse_videos(fx.raw_lines_fx(spark, sf_dir)), order=_ORDER))


@register("upsert_videos_skip_list", duck.with_lines(_LATEST.format(
    cols=_GT_OUT, skip="and videoId not in (" + SKIP_SQL.format(part="part") + ")")))
def q_upsert_videos_skip_list(spark, sf_dir):
    skip = spark.sql(SKIP_SQL, part=fx.table(spark, sf_dir, "part"))
    return rounded(catalog.upsert_videos(ingest.parse_videos(fx.raw_lines_fx(spark, sf_dir)),
                                         order=_ORDER, skip_ids=skip))


@register("upsert_related", _net_sql("select srcVideoId, dstVideoId from cat_edges", catalog=True))
def q_upsert_related(spark, sf_dir):
    return catalog.upsert_related(fx.related_fx(spark, sf_dir), fx.videos_fx(spark, sf_dir))


_KNOWN = """,
ids1 as (select videoId from gt where batch = 1 and videoId is not null),
ids2 as (select videoId from gt where videoId is not null)
"""
_IN = "srcVideoId in (select videoId from {0}) and dstVideoId in (select videoId from {0})"
# An edge's endpoints must be known after the import that brings it.
_RELATED_TWICE = duck.with_lines("").rstrip() + _KNOWN + (
    f"select distinct srcVideoId, dstVideoId from rt where (batch = 1 and {_IN.format('ids1')}) "
    f"or (batch = 2 and {_IN.format('ids2')})")
_RELATED_ONCE = duck.with_lines("").rstrip() + _KNOWN + (
    f"select distinct srcVideoId, dstVideoId from rt where {_IN.format('ids2')}")


def _merged_twice(spark, sf_dir):
    """Batch 1 stored, then batch 2 merged into it."""
    store = CatalogTables(spark, scratch_path(spark, "merged_catalog"))
    raw = fx.raw_lines_fx(spark, sf_dir)
    for batch in (1, 2):
        store.merge_raw(raw.where(F.col("batch") == batch), _ORDER)
    return store


@register("upsert_videos_existing", duck.with_lines(_LATEST.format(cols=_GT_OUT, skip="")))
def q_upsert_videos_existing(spark, sf_dir):
    return rounded(_merged_twice(spark, sf_dir).read().videos)


@register("upsert_related_existing", _RELATED_TWICE)
def q_upsert_related_existing(spark, sf_dir):
    return _merged_twice(spark, sf_dir).read().related


def _imported_csv(spark, sf_dir):
    """The converter's two CSV tables (rows of later batches come later), imported."""
    out = scratch_path(spark, "import_csv")
    raw = fx.raw_lines_fx(spark, sf_dir)
    tables.write_csv(ingest.parse_videos(raw).select(*VIDEOS_TEXT.fieldNames()), f"{out}/videos")
    tables.write_csv(ingest.parse_related(raw).select(*RELATED_TEXT.fieldNames()), f"{out}/related")
    store = CatalogTables(spark, f"{out}/catalog")
    store.import_csv(f"{out}/videos", f"{out}/related")
    return store.read()


@register("import_from_csv", duck.with_lines(_LATEST.format(cols=_GT_OUT, skip="")))
def q_import_from_csv(spark, sf_dir):
    return rounded(_imported_csv(spark, sf_dir).videos)


@register("import_from_csv_related", _RELATED_ONCE)
def q_import_from_csv_related(spark, sf_dir):
    return _imported_csv(spark, sf_dir).related


_LATEST_NETWORK = duck.with_lines("").rstrip() + _KNOWN + (
    ", latest as (" + _LATEST.format(cols="videoId, uploader, category, cast(views as double) as views, "
    "cast(rating as double) as rating", skip="") + "), cat_edges as (select distinct srcVideoId, dstVideoId "
    f"from rt where (batch = 1 and {_IN.format('ids1')}) or (batch = 2 and {_IN.format('ids2')})), "
    "nd as (select l.*, coalesce(o.n, 0) as outDegree, coalesce(i.n, 0) as inDegree from latest l "
    "left join (select srcVideoId as videoId, count(*) as n from cat_edges group by 1) o on l.videoId = o.videoId "
    "left join (select dstVideoId as videoId, count(*) as n from cat_edges group by 1) i on l.videoId = i.videoId)\n")


def _kept_aggregates(spark, sf_dir):
    """Two imports; the second changes categories of known videos and adds edges to others."""
    state = NetworkState(CatalogTables(spark, scratch_path(spark, "kept_catalog")))
    raw = fx.raw_lines_fx(spark, sf_dir)
    for batch in (1, 2):
        state.merge_raw(raw.where(F.col("batch") == batch), _ORDER)
    return state


@register("category_summary_incremental", _LATEST_NETWORK + _CAT_SQL.format(nd="nd"))
def q_category_summary_incremental(spark, sf_dir):
    return rounded(_kept_aggregates(spark, sf_dir).category_summary())


@register("global_metrics_incremental", _LATEST_NETWORK + _global_sql("nd", "cat_edges"))
def q_global_metrics_incremental(spark, sf_dir):
    return rounded(_kept_aggregates(spark, sf_dir).global_metrics())


@register("stored_constraints", duck.with_lines("").rstrip() + _KNOWN + (
    ", latest as (" + _LATEST.format(cols="videoId", skip="") + "), stored as (select distinct srcVideoId, dstVideoId "
    f"from rt where (batch = 1 and {_IN.format('ids1')}) or (batch = 2 and {_IN.format('ids2')})) "
    "select (select count(*) from (select videoId from latest group by 1 having count(*) > 1)) as duplicateIds, "
    "(select count(*) from (select 1 from stored group by srcVideoId, dstVideoId having count(*) > 1)) as duplicateEdges, "
    f"(select count(*) from stored where not ({_IN.format('latest')})) as danglingEdges"))
def q_stored_constraints(spark, sf_dir):
    """Uniqueness and endpoint rules counted over the stored tables after two imports."""
    return _merged_twice(spark, sf_dir).constraint_report()


def _bad_bytes(raw: DataFrame) -> DataFrame:
    """Crawl lines whose uploader field holds a byte that is no UTF-8, for every
    replacement character of the fixture's lines."""
    bad = F.unhex(F.lit("FF")).cast("string")
    return raw.withColumn("value", F.replace("value", F.lit("\ufffd"), bad))


_IMPORTED = duck.with_lines("").rstrip() + _KNOWN + (
    "select (select count(*) from raw_lines_fx) as lines, (select count(*) from unq where line = '') as skipped, "
    "(select count(*) from raw_lines_fx where contains(value, chr(65533))) as badBytes, "
    "(select count(*) from lines) as videos, (select count(*) from rt) as edges, "
    "(select count(distinct videoId) from ids2) as mergedVideos, "
    f"(select count(*) from (select distinct srcVideoId, dstVideoId from rt where {_IN.format('ids2')})) as addedEdges")


@register("import_report", _IMPORTED)
def q_import_report(spark, sf_dir):
    """The counts that one import's write jobs observe (no second scan)."""
    store = CatalogTables(spark, scratch_path(spark, "report_catalog"))
    report = store.merge_raw(_bad_bytes(fx.raw_lines_fx(spark, sf_dir)), _ORDER)
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in (
        ("lines", report.lines), ("skipped", report.skipped), ("badBytes", report.bad_bytes), ("videos", report.videos),
        ("edges", report.edges), ("mergedVideos", report.merged_videos), ("addedEdges", report.added_edges))])


@register("unique_violations", duck.with_lines(
    "select videoId, count(*) as count from vt group by videoId having count(*) > 1"))
def q_unique_violations(spark, sf_dir):
    return catalog.unique_violations(ingest.parse_videos(fx.raw_lines_fx(spark, sf_dir)))


@register("drop_null_endpoints", fx.with_fixtures(
    "select srcVideoId, dstVideoId from related_fx where srcVideoId is not null and dstVideoId is not null",
    "related_fx"))
def q_drop_null_endpoints(spark, sf_dir):
    return network.drop_null_endpoints(fx.related_fx(spark, sf_dir))


@register("related_endpoints", fx.with_fixtures("select srcVideoId, dstVideoId from related_fx", "related_fx"))
def q_related_endpoints(spark, sf_dir):
    """Edges shaped like a graph-connector frame (``source.videoId``,
    ``target.videoId`` as literal column names), projected back."""
    r = fx.related_fx(spark, sf_dir)
    conn = r.select(F.col("srcVideoId").alias("source.videoId"), F.col("dstVideoId").alias("target.videoId"))
    return catalog.endpoints(conn)


def _side(prefix: str, alias: str) -> str:
    return ", ".join((f'round({alias}.{c}, 6)' if c == "rating" else f"{alias}.{c}") + f' as "{prefix}.{c}"' for c in _V_COLS)


@register("related_endpoints_full", fx.with_fixtures(
    f"select r.srcVideoId, r.dstVideoId, {_side('source', 's')}, {_side('target', 't')} from related_fx r "
    "left join videos_fx s on r.srcVideoId = s.videoId left join videos_fx t on r.dstVideoId = t.videoId",
    "videos_fx", "related_fx"))
def q_related_endpoints_full(spark, sf_dir):
    """All edges, null and unknown endpoints included, with the nine properties of both ends."""
    return rounded(catalog.related_with_properties(fx.related_fx(spark, sf_dir), fx.videos_fx(spark, sf_dir)))


_V_FX_OUT = fx.with_fixtures(f"select {_V_OUT} from videos_fx", "videos_fx")


@register("videos_catalog", _V_FX_OUT)
def q_videos_catalog(spark, sf_dir):
    path = scratch_path(spark, "videos_catalog")
    tables.write_table(fx.videos_fx(spark, sf_dir), path)
    return rounded(tables.read_table(spark, path, schema=VIDEOS_TYPED))


# ---------------------------------------------------------------- influence


PR_RESET, PR_TOL, PR_TOP = 0.15, 0.01, 20
_PR_OUT = ("v.videoId as id, v.uploader, v.age, v.category, v.length, v.views, round(v.rating, 6) as rating, "
           "v.ratingCount, v.commentCount, round(r.pr * (select n from tot) / (select s from tot), 6) as pagerank")


def _pagerank_sql(tail: str = "", distinct: str = "distinct") -> str:
    return f"""with recursive videos_fx as ({fx.duck('videos_fx')}),
related_fx as ({fx.duck('related_fx')}),
ce as (select {distinct} srcVideoId as src, dstVideoId as dst from related_fx
       where srcVideoId in (select videoId from videos_fx) and dstVideoId in (select videoId from videos_fx)),
od as (select src, count(*) as deg from ce group by src),
w as (select ce.src, ce.dst, cast(count(*) as double) / od.deg as w from ce join od on ce.src = od.src
      group by ce.src, ce.dst, od.deg),
it(step, id, delta) as (
  select 0, videoId, cast({PR_RESET} as double) from videos_fx
  union all
  select it.step + 1, w.dst, {1 - PR_RESET} * sum(it.delta * w.w)
  from it join w on it.id = w.src where it.delta > {PR_TOL} group by it.step + 1, w.dst),
r as (select id, sum(delta) as pr from it group by id),
tot as (select sum(pr) as s, count(*) as n from r),
res as (select {_PR_OUT} from videos_fx v join r on v.videoId = r.id)
select * from res {tail}"""


def _pagerank_results(spark, sf_dir):
    videos = fx.videos_fx(spark, sf_dir)
    edges = catalog.upsert_related(fx.related_fx(spark, sf_dir), videos)
    # upsert_related leaves distinct pairs of known videos
    return influence.pagerank(videos, edges, PR_RESET, PR_TOL, trusted_edges=True)


@register("pagerank", _pagerank_sql())
def q_pagerank(spark, sf_dir):
    return rounded(_pagerank_results(spark, sf_dir))


@register("pagerank_raw_edges", _pagerank_sql(distinct=""))
def q_pagerank_raw_edges(spark, sf_dir):
    """Over the raw edge rows: parallel edges weigh more, null and unknown endpoints are left out."""
    return rounded(influence.pagerank(fx.videos_fx(spark, sf_dir), fx.related_fx(spark, sf_dir), PR_RESET, PR_TOL))


@register("pagerank_top", _pagerank_sql(f"order by pagerank desc, id asc limit {PR_TOP}"))
def q_pagerank_top(spark, sf_dir):
    return rounded(influence.influence_top(_pagerank_results(spark, sf_dir), PR_TOP))


@register("pagerank_sink_roundtrip", _pagerank_sql())
def q_pagerank_sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "pagerank_results")
    tables.write_table(_pagerank_results(spark, sf_dir), path)
    return rounded(tables.read_table(spark, path, schema=influence.RESULT_SCHEMA))


@register("influence_top10", _pagerank_sql("order by pagerank desc, id asc limit 10"))
def q_influence_top10(spark, sf_dir):
    """Stored results read back as one property map per node, flattened, top 10."""
    path = scratch_path(spark, "pagerank_results")
    tables.write_table(influence.to_property_map(_pagerank_results(spark, sf_dir)), path)
    flat = influence.flatten_properties(tables.read_table(spark, path), influence.RESULT_SCHEMA)
    return rounded(influence.influence_top(flat, 10))


@register("property_map_flatten", _V_FX_OUT)
def q_property_map_flatten(spark, sf_dir):
    maps = influence.to_property_map(fx.videos_fx(spark, sf_dir))
    return rounded(influence.flatten_properties(maps, VIDEOS_TYPED))


@register("property_map_dirty", fx.with_fixtures(
    "select videoId, case when rating >= 1 then age end as age, views from videos_fx", "videos_fx"))
def q_property_map_dirty(spark, sf_dir):
    """Values that are not of their field's type, and missing keys, come back as null."""
    maps = influence.to_property_map(fx.videos_fx(spark, sf_dir), "video")
    dirty = F.transform_values("video", lambda k, v: F.when(
        (k == "age") & (F.try_element_at(F.col("video"), F.lit("rating")).cast("double") < 1), F.lit("n/a")).otherwise(v))
    schema = T.StructType([T.StructField("videoId", T.StringType()), T.StructField("age", T.LongType()),
                           T.StructField("views", T.LongType())])
    return influence.flatten_properties(maps.select(dirty.alias("video")), schema)


# ---------------------------------------------------------------- outputs


CATEGORY_SUMMARY_SCHEMA = T.StructType([
    T.StructField("category", T.StringType()), T.StructField("numVideos", T.LongType()),
    T.StructField("totalViews", T.DoubleType()), T.StructField("avgViews", T.DoubleType()),
    T.StructField("avgRating", T.DoubleType()), T.StructField("avgOutDegree", T.DoubleType()),
    T.StructField("avgInDegree", T.DoubleType()),
])


NODE_DEGREES_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("videoId", "uploader", "category")]
    + [T.StructField(c, T.DoubleType()) for c in ("views", "rating", "ratingCount", "commentCount")]
    + [T.StructField(c, T.LongType()) for c in ("outDegree", "inDegree")])
GLOBAL_METRICS_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("numVideos", "numEdges")]
    + [T.StructField(c, T.DoubleType()) for c in ("avgOutDegree", "avgInDegree")])


def _network_output(spark, sf_dir, name, schema):
    """The network job's three CSV outputs written, one of them read back."""
    out = scratch_path(spark, "network_out")
    jobs.network_job(fx.videos_fx(spark, sf_dir), fx.related_fx(spark, sf_dir), out)
    return rounded(tables.read_csv(spark, f"{out}/{name}", schema))


@register("network_outputs_roundtrip", _net_sql(_CAT_SQL.format(nd="node_deg")))
def q_network_outputs_roundtrip(spark, sf_dir):
    return _network_output(spark, sf_dir, "category_summary", CATEGORY_SUMMARY_SCHEMA)


@register("network_outputs_global", _net_sql(_global_sql("node_deg", "raw_edges")))
def q_network_outputs_global(spark, sf_dir):
    return _network_output(spark, sf_dir, "global_metrics", GLOBAL_METRICS_SCHEMA)


@register("network_outputs_degrees", _net_sql(
    "select videoId, uploader, category, views, round(rating, 6) as rating, ratingCount, commentCount, "
    "outDegree, inDegree from node_deg"))
def q_network_outputs_degrees(spark, sf_dir):
    return _network_output(spark, sf_dir, "node_degrees", NODE_DEGREES_SCHEMA)


@register("network_from_csv_reordered", _net_sql(_CAT_SQL.format(nd="node_deg")))
def q_network_from_csv_reordered(spark, sf_dir):
    """The CSV entry on files whose columns stand in reverse order."""
    out = scratch_path(spark, "network_csv")
    tables.write_csv(fx.videos_fx(spark, sf_dir).select(*reversed(VIDEOS_TEXT.fieldNames())), f"{out}/videos")
    tables.write_csv(fx.related_fx(spark, sf_dir).select(*reversed(RELATED_TEXT.fieldNames())), f"{out}/related")
    jobs.network_from_csv(spark, f"{out}/videos", f"{out}/related", f"{out}/network")
    return rounded(tables.read_csv(spark, f"{out}/network/category_summary", CATEGORY_SUMMARY_SCHEMA))


@register("ingest_report", duck.with_lines(
    "select (select count(*) from raw_lines_fx) as lines, (select count(*) from unq where line = '') as skipped, "
    "(select count(*) from raw_lines_fx where contains(value, chr(65533))) as badBytes, "
    "(select count(*) from lines) as videos, (select count(*) from rt) as edges"))
def q_ingest_report(spark, sf_dir):
    return ingest.ingest_report(_bad_bytes(fx.raw_lines_fx(spark, sf_dir)))


# ---------------------------------------------------------------- streaming


def _streamed(spark, sf_dir):
    """Crawl lines written by Spark as text, imported by the Structured Streaming
    job: batch 1 arrives, then batch 2, each as one micro-batch of the same query."""
    from vidgraph.streaming import start_incremental_import

    watch, store_path, state = (scratch_path(spark, x) for x in ("watch", "stream_catalog", "stream_state"))
    raw = fx.raw_lines_fx(spark, sf_dir)
    for batch in (1, 2):
        raw.where(F.col("batch") == batch).select("value").write.text(f"{watch}/{batch}")
        q = start_incremental_import(spark, watch, store_path, state, layout="folders", available_now=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"streaming import failed: {q.exception()}")
    return CatalogTables(spark, store_path).read()


@register("streaming_import", duck.with_lines(_LATEST.format(cols=_GT_OUT, skip="")))
def q_streaming_import(spark, sf_dir):
    return rounded(_streamed(spark, sf_dir).videos)


@register("streaming_import_related", _RELATED_TWICE)
def q_streaming_import_related(spark, sf_dir):
    return _streamed(spark, sf_dir).related
