"""Edges with properties (S5) and aggregates kept up to date by imports (A1-A5)."""

import os
import random

import pytest
from pyspark.sql import functions as F

from vidgraph.operators import catalog, incremental, network
from vidgraph.plans.catalog_tables import CatalogTables
from vidgraph.plans.network_state import NetworkState
from vidgraph.schema import VIDEO_COLUMNS, VIDEOS_TYPED

ORDER = ["line_no"]


def raw(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "line_no bigint, value string")


def line(rnd, n):
    cells = [f"v{rnd.randrange(n)}", "u", "1", rnd.choice(["Music", "Film", "", "News"]), "60",
             rnd.choice(["10", "7.9", "n/a", "", "12345678901"]), rnd.choice(["4.5", "0.1", "x", "NaN", "1e300"]), "7", "3"]
    return "\t".join(cells + [f"v{rnd.randrange(n)}" for _ in range(rnd.randrange(4))])


def recomputed(store):
    cat = store.read()
    nd = network.node_degrees(network.aggregation_videos(cat.videos), cat.related)
    # ratings that do not fit the exact sums count as not given
    nd = nd.withColumn("rating", F.when(F.col("rating") < 1e28, F.col("rating")))
    return ({r["category"]: r.asDict() for r in network.category_summary(nd).collect()},
            network.global_metrics(nd, cat.related).first().asDict())


def same(state):
    summary, overall = recomputed(state.store)
    got = {r["category"]: r.asDict() for r in state.category_summary().collect()}
    assert got.keys() == summary.keys()
    for c, row in summary.items():
        assert got[c] == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in row.items()}
    assert state.global_metrics().first().asDict() == pytest.approx(overall)


def test_aggregates_follow_imports(spark, tmp_dir):
    """Re-crawled videos change category, edges arrive late, an import without news, a break-off."""
    rnd = random.Random(5)
    state = NetworkState(CatalogTables(spark, f"{tmp_dir}/cat", bucket_bytes=3000))
    for n in (40, 60):
        state.merge_raw(raw(spark, [line(rnd, n) for _ in range(70)]), ORDER)
        same(state)
    assert state.merge_raw(raw(spark, ["", '""']), ORDER).merged_videos == 0
    state.compact()
    same(state)
    os.makedirs(f"{tmp_dir}/cat/network/open")   # an import that broke off after changing the tables
    state.store.merge_raw(raw(spark, [line(rnd, 80) for _ in range(30)]), ORDER)
    state.merge_raw(raw(spark, [line(rnd, 80) for _ in range(30)]), ORDER)
    same(state)
    assert not os.path.exists(f"{tmp_dir}/cat/network/open")


def test_state_of_a_catalogue_imported_without_it(spark, tmp_dir):
    rnd = random.Random(6)
    store = CatalogTables(spark, f"{tmp_dir}/cat")
    store.merge_raw(raw(spark, [line(rnd, 20) for _ in range(30)]), ORDER)
    state = NetworkState(store)
    assert state.category_summary().count() == 0
    state.merge_raw(raw(spark, [line(rnd, 20)]), ORDER)
    same(state)


def test_only_the_delta_is_shuffled(spark, tmp_dir):
    """Of stored videos and degrees only those that an import touches reach an exchange."""
    videos = spark.range(50_000).select(F.concat(F.lit("v"), "id").alias("videoId"), *[
        F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("category", "views") else
        (F.lit("c") if f.name == "category" else F.col("id")).alias(f.name) for f in VIDEOS_TYPED.fields[1:]])
    degrees = videos.select("videoId", F.lit(1).cast("bigint").alias("outDegree"), F.lit(1).cast("bigint").alias("inDegree"))
    videos.write.parquet(f"{tmp_dir}/videos")
    degrees.write.parquet(f"{tmp_dir}/degrees")
    latest = videos.where("videoId in ('v7', 'v8')").withColumn("category", F.lit("d"))
    added = spark.createDataFrame([("v7", "v9")], "srcVideoId string, dstVideoId string")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    touched = incremental.touched_ids(latest, added)
    touched.write.parquet(f"{tmp_dir}/touched")
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = incremental.summary_delta(spark.read.parquet(f"{tmp_dir}/touched"), 3, latest, videos.where("videoId in ('v7', 'v8')"),
                                        spark.read.parquet(f"{tmp_dir}/videos"), spark.read.parquet(f"{tmp_dir}/degrees"))
        rows = {r["category"]: (r["numVideos"], r["sumViews"], r["sumOut"], r["sumIn"]) for r in out.collect()}
        assert rows == {"c": (-2, -15, -2, -1), "d": (2, 15, 3, 2)}
        moved = []

        def walk(node):
            if node.nodeName() == "Exchange":
                moved.append(node.metrics().apply("shuffleRecordsWritten").value())
            for i in range(node.children().length()):
                walk(node.children().apply(i))

        walk(out._jdf.queryExecution().executedPlan())
        assert moved and max(moved) < 2_500
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_edges_with_properties(spark, monkeypatch):
    """Hot targets, null and unknown ends, repeated edges; every edge once."""
    monkeypatch.setattr(catalog, "BUSY_SHARE", 10)
    rnd = random.Random(1)
    ids = [f"v{i}" for i in range(30)]
    videos = spark.createDataFrame([(i, f"u{i}", 1, "c", 2, None, 4.5, 7, n) for n, i in enumerate(ids)] + [
        (None, "nobody", 1, "c", 2, 3, 4.5, 7, 3)], VIDEOS_TYPED)
    edges = [(rnd.choice(ids), "v0") for _ in range(300)] + [(None, rnd.choice(ids)) for _ in range(200)]
    edges += [(rnd.choice(ids + ["x", None]), rnd.choice(ids + ["x", None])) for _ in range(200)]
    df = spark.createDataFrame(edges, "srcVideoId string, dstVideoId string")
    out = catalog.related_with_properties(df, videos)
    assert out.columns == ["srcVideoId", "dstVideoId"] + [f"{p}.{c}" for p in ("source", "target") for c in VIDEO_COLUMNS]
    got = sorted(((r[0], r[1], r["source.uploader"], r["target.videoId"], r["target.commentCount"]) for r in out.collect()), key=repr)
    known = {i: n for n, i in enumerate(ids)}
    assert got == sorted(((s, d, f"u{s}" if s in known else None, d if d in known else None, known.get(d)) for s, d in edges), key=repr)
    busy = {r["_busy"]: r["_salts"] for r in catalog.busy_keys(df, "dstVideoId", 10).collect()}
    assert "v0" in busy and busy["v0"] >= 4 and len(busy) < 10
    assert catalog.related_with_properties(df.where("false"), videos).count() == 0
    ends = catalog.endpoints(out)
    assert ends.where("srcVideoId is null").count() == sum(s not in known for s, _ in edges)
