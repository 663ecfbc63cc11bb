"""Typed catalogue: upserts (U1/U2), skip list (F5), checks (U3), endpoints (P11)."""

from vidgraph.operators import catalog
from vidgraph.schema import VIDEOS_TEXT, VIDEO_COLUMNS

TEXT_COLS = "batch int, line_no long, " + ", ".join(f"{c} string" for c in VIDEO_COLUMNS)


def _rows(spark, rows):
    return spark.createDataFrame(rows, TEXT_COLS)


def test_last_write_wins_with_null(spark):
    rows = [(1, 1, "v1", "u", "12", "Music", "60", "100", "4.5", "7", "3"),
            (2, 5, "v1", "u2", "13", "", "61", "999", "3.5", "8", "4"),
            (1, 2, "", "x", "1", "c", "1", "1", "1", "1", "1")]
    out = {r.videoId: r for r in catalog.upsert_videos(_rows(spark, rows), ["batch", "line_no"]).collect()}
    assert set(out) == {"v1"}
    assert out["v1"].uploader == "u2" and out["v1"].category is None and out["v1"].views == 999


def test_upsert_into_existing_is_idempotent(spark):
    rows = [(1, 1, "v1", "u", "12", "Music", "60", "100", "4.5", "7", "3"),
            (1, 2, "v2", "w", "12.9", "Film", "60", "n/a", "4.5", "7", "3")]
    first = catalog.upsert_videos(_rows(spark, rows), ["batch", "line_no"])
    again = catalog.upsert_videos(_rows(spark, rows), ["batch", "line_no"], existing=first)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    newer = [(3, 1, "v2", "z", "1", "", "", "", "", "", "")]
    merged = {r.videoId: r for r in catalog.upsert_videos(_rows(spark, newer), ["batch", "line_no"],
                                                          existing=first).collect()}
    assert merged["v1"].uploader == "u" and merged["v2"].uploader == "z" and merged["v2"].category is None
    assert merged["v2"].age == 1


def test_skip_list(spark):
    rows = [(1, 1, "v1", "u", "", "", "", "", "", "", ""), (1, 2, "v2", "u", "", "", "", "", "", "", "")]
    df = _rows(spark, rows)

    def ids(skip):
        sk = spark.createDataFrame([(s,) for s in skip], "videoId string")
        return sorted(r.videoId for r in catalog.upsert_videos(df, ["batch", "line_no"], skip_ids=sk).collect())

    assert ids(["v1"]) == ["v2"]
    assert ids(["v9"]) == ["v1", "v2"]
    assert ids([]) == ["v1", "v2"]
    assert ids([None]) == ["v1", "v2"]


def test_upsert_related(spark):
    videos = spark.createDataFrame([("a",), ("b",), ("c",)], "videoId string")
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "zz"), ("c", "c"), (None, "a"), ("b", None)],
                                  "srcVideoId string, dstVideoId string")
    out = sorted(map(tuple, catalog.upsert_related(edges, videos).collect()))
    assert out == [("a", "b"), ("c", "c")]
    more = spark.createDataFrame([("b", "a"), ("a", "b")], "srcVideoId string, dstVideoId string")
    out2 = sorted(map(tuple, catalog.upsert_related(more, videos, existing=catalog.upsert_related(edges, videos)).collect()))
    assert out2 == [("a", "b"), ("b", "a"), ("c", "c")]


def test_unique_violations_and_endpoints(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "videoId string")
    assert [tuple(r) for r in catalog.unique_violations(df).collect()] == [("a", 2)]
    conn = spark.createDataFrame([("x", "y")], "`source.videoId` string, `target.videoId` string")
    assert [tuple(r) for r in catalog.endpoints(conn).collect()] == [("x", "y")]


def test_graph_typing(spark):
    rows = [(1, 1, "v1", "", " 12 ", "", "12.7", "-3.9", "NaN", "9007199254740993", "abc")]
    r = catalog.type_videos_graph(_rows(spark, rows)).first()
    assert (r.uploader, r.age, r.category, r.length, r.views, r.rating, r.ratingCount, r.commentCount) == (
        None, 12, None, 12, -3, None, 9007199254740993, None)
    assert VIDEOS_TEXT.fieldNames() == VIDEO_COLUMNS
