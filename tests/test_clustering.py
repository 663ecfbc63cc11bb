"""Curve order: the interleaving rule, and row groups skipped by range filters on any metric."""

import pytest
from pyspark.sql import functions as F

from vidgraph.operators import clustering, search
from vidgraph.plans import jobs
from vidgraph.schema import NUMERIC_SEARCH_FIELDS, VIDEOS_TYPED


def catalogue(spark, n):
    """Five metrics that do not depend on each other, one skewed, one with nulls."""
    rows = spark.range(n).select(F.concat(F.lit("v"), "id").alias("videoId"), *[
        F.pmod(F.xxhash64("id", F.lit(f.name)), F.lit(100_000)).cast(f.dataType).alias(f.name) for f in VIDEOS_TYPED.fields[1:]])
    rows = rows.withColumn("views", (F.col("views") * F.col("views")).cast("bigint"))
    return rows.withColumn("age", F.when(F.col("age") > 1_000, F.col("age")))


def test_interleaving(spark):
    rows = spark.createDataFrame([(1, 10), (3, 10), (None, 30), (9, None)], "a long, b long")
    bounds = {"a": [2.0, 4.0, 6.0], "b": [15.0, 20.0, 25.0]}   # places a: 0 1 0 3, b: 0 0 3 0
    got = [r[0] for r in rows.select(clustering.curve_key(bounds, 2)).collect()]
    assert got == [0b0000, 0b0001, 0b1010, 0b0101]
    assert rows.select(clustering.curve_key({"a": [], "b": []}, 2)).distinct().count() == 1


def scanned_rows(df):
    def walk(node):
        kind = node.nodeName()
        if kind == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if kind.endswith("QueryStage"):
            return walk(node.plan())
        if kind.startswith("Scan parquet"):
            return node.metrics().apply("numOutputRows").value()
        return sum(walk(node.children().apply(i)) for i in range(node.children().length()))

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("start,end,ids", [(1.5, 4.5, "234"), (2.0, 4.0, "3"), (1, 3, "2"), (0.0, float("inf"), "12345")])
def test_fractional_bounds_are_pushed(spark, tmp_dir, start, end, ids):
    spark.createDataFrame([(str(i), i) for i in range(6)], "videoId string, views long").write.parquet(f"{tmp_dir}/t")
    out = search.find_in_range(spark.read.parquet(f"{tmp_dir}/t"), "views", start, end)
    assert sorted(r.videoId for r in out.collect()) == list(ids)
    if end != float("inf"):
        assert "GreaterThan(views" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("field", NUMERIC_SEARCH_FIELDS)
def test_range_filters_skip_row_groups(spark, tmp_path_factory, field):
    base = tmp_path_factory.getbasetemp() / "clustering"
    if not base.exists():
        rows = catalogue(spark, 120_000)
        rows.repartition(8).write.option("parquet.block.size", 64 << 10).parquet(f"{base}/plain")
        jobs.cluster_job(rows, f"{base}/curve", row_group_bytes=64 << 10)
    plain, curve = spark.read.parquet(f"{base}/plain"), spark.read.parquet(f"{base}/curve")
    low, high = plain.approxQuantile(field, [0.90, 0.97], 0.001)
    found = [search.search_range(t, field, low, high, 50) for t in (plain, curve)]
    assert [r.videoId for r in found[0].collect()] == [r.videoId for r in found[1].collect()]
    every, some = scanned_rows(found[0]), scanned_rows(found[1])
    assert every > 100_000 and some < 0.6 * every


def test_all_rows_and_empty_tables(spark, tmp_dir):
    rows = catalogue(spark, 500)
    assert sorted(map(tuple, clustering.clustered(rows).collect())) == sorted(map(tuple, rows.collect()))
    jobs.cluster_job(rows.where("false"), f"{tmp_dir}/none")
    assert search.search_range(spark.read.schema(VIDEOS_TYPED).parquet(f"{tmp_dir}/none"), "views", 1, 2).count() == 0
