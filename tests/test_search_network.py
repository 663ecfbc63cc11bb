"""Search (F1, F2, T1-T4) and network aggregation (A1-A7, J1, P13, F6)."""

import contextlib
import io

import pytest

from vidgraph.operators import network, search
from vidgraph.schema import VIDEOS_TYPED

V = [("a", "u", 1, "Music", 10, 100, 4.0, 5, 1),
     ("b", "u", 2, "Music", 10, 100, 3.0, 6, 2),
     ("c", "u", 3, None, 10, 50, 2.0, 7, 3),
     ("d", None, 4, "Film", 10, 500, 1.0, 8, 4),
     ("e", "u", 5, "Film", 10, None, 1.0, 9, 5),
     ("f", "u", 6, "Film", 10, 70, float("nan"), 9, 5)]


@pytest.fixture
def videos(spark):
    return spark.createDataFrame(V, VIDEOS_TYPED)


def test_complete_rows(videos):
    assert sorted(r.videoId for r in search.complete_videos(videos).collect()) == ["a", "b"]


def test_complete_rows_pushdown(spark, tmp_dir, videos):
    videos.write.parquet(f"{tmp_dir}/v")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        search.complete_videos(spark.read.parquet(f"{tmp_dir}/v")).explain("formatted")
    pushed = [line for line in buf.getvalue().splitlines() if "PushedFilters" in line]
    assert pushed and "IsNotNull(views)" in pushed[0] and "IsNotNull(category)" in pushed[0]


def test_top_k_ties_and_nulls(videos):
    got = [r.videoId for r in search.top_k(videos, "views", 3).collect()]
    assert got == ["d", "a", "b"]
    assert [r.videoId for r in search.top_k(videos, "Rated", 1).collect()] == ["e"]
    with pytest.raises(ValueError):
        search.top_k(videos, "views", 0)
    with pytest.raises(ValueError):
        search.top_k(videos, "bogus", 3)


def test_top_k_category(videos):
    got = [tuple(r) for r in search.top_k(videos, "category", 2).collect()]
    assert got == [("Film", 3), ("Music", 2)]


def test_range_exclusive(videos):
    got = [r.videoId for r in search.find_in_range(videos, "views", 50, 500).collect()]
    assert got == ["a", "b", "f"]
    for bad in [(5, 5), (6, 5), (-1, 5)]:
        with pytest.raises(ValueError):
            search.find_in_range(videos, "views", *bad)
    with pytest.raises(ValueError):
        search.find_in_range(videos, "category", 1, 5)


def test_degrees_and_metrics(spark, videos):
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "x"), ("y", "a"), ("c", None)],
                                  "srcVideoId string, dstVideoId string")
    res = network.run_network(videos, edges)
    nd = {r.videoId: r for r in res.node_degrees.collect()}
    assert (nd["a"].outDegree, nd["a"].inDegree, nd["b"].inDegree, nd["d"].outDegree) == (3, 1, 2, 0)
    g = res.global_metrics.first()
    assert (g.numVideos, g.numEdges) == (6, 4)
    assert g.avgOutDegree == pytest.approx(3 / 6) and g.avgInDegree == pytest.approx(3 / 6)
    cats = {r.category: r for r in res.category_summary.collect()}
    assert cats[None].numVideos == 1 and cats["Music"].totalViews == 200.0
    assert cats["Film"].avgViews == pytest.approx(285.0)
    assert [r.category for r in res.category_summary.collect()][0] == "Film"
    sum_out = sum(r.outDegree for r in nd.values())
    assert sum_out == edges.where("srcVideoId in ('a','b','c','d','e','f') and dstVideoId is not null").count()
    res.unpersist()


def test_no_edges_and_guards(spark, videos):
    empty = spark.createDataFrame([], "srcVideoId string, dstVideoId string")
    nd = network.run_network(videos, empty).node_degrees.collect()
    assert all(r.outDegree == 0 and r.inDegree == 0 for r in nd)
    with pytest.raises(ValueError):
        network.run_network(videos, empty, check_nonempty=True)
    with pytest.raises(ValueError):
        network.run_network(videos.limit(0), empty, check_nonempty=True)


def _physical(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_top_k_plans_as_take_ordered(spark, tmp_dir, videos):
    videos.write.parquet(f"{tmp_dir}/tk")
    plan = _physical(search.search_top_k(spark.read.parquet(f"{tmp_dir}/tk"), "views", 3))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_degrees_aggregate_edges_once(spark, tmp_dir, videos):
    spark.createDataFrame([("a", "b"), ("b", "c")], "srcVideoId string, dstVideoId string").write.parquet(f"{tmp_dir}/e")
    edges = spark.read.parquet(f"{tmp_dir}/e")
    plan = _physical(network.node_degrees(network.aggregation_videos(videos), edges))
    assert sum("partial_sum" in line for line in plan.splitlines()) == 1
    assert plan.count("Scan parquet") == 1
