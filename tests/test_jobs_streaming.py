"""Import job, stored catalogue, network outputs, streaming import."""

import os

import pytest

from vidgraph.plans import jobs
from vidgraph.streaming import start_incremental_import


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


LINE = "{id}\tu{n}\t1\tMusic\t60\t{views}\t4.5\t7\t3{rel}"


def _line(id_, n, views, rel=()):
    return LINE.format(id=id_, n=n, views=views, rel="".join("\t" + r for r in rel))


def test_import_twice(spark, tmp_dir):
    root = f"{tmp_dir}/prep"
    _write(f"{root}/a/0.tsv", "\n".join([_line("v1", 1, 10, ["v2", "v9"]), _line("v2", 1, 20, ["v1"])]) + "\n")
    _write(f"{root}/b/0.tsv", _line("v1", 2, 30, ["v2", "v2"]) + "\n")
    _write(f"{root}/b/log.txt", "not data\n")
    store = jobs.CatalogTables(spark, f"{tmp_dir}/catalog")
    report = store.import_crawl(root)
    assert (report.lines, report.videos, report.edges, report.merged_videos, report.added_edges) == (3, 3, 5, 2, 2)
    cat = store.read()
    vids = {r.videoId: r for r in cat.videos.collect()}
    assert vids["v1"].views == 30 and vids["v1"].uploader == "u2"   # folder b after a
    assert sorted(map(tuple, cat.related.collect())) == [("v1", "v2"), ("v2", "v1")]
    _write(f"{tmp_dir}/more/c/0.tsv", _line("v3", 3, 5, ["v1"]) + "\n")
    assert store.import_crawl(f"{tmp_dir}/more").added_edges == 1
    cat = store.read()
    assert cat.videos.count() == 3 and cat.related.count() == 3
    plain = spark.read.parquet(f"{tmp_dir}/catalog/videos")   # an ordinary table, whatever reads it
    assert plain.count() == 3 and plain.columns[-1] == "bucket"


def test_network_job_outputs(spark, tmp_dir):
    store = jobs.CatalogTables(spark, f"{tmp_dir}/catalog")
    _write(f"{tmp_dir}/prep/a/0.tsv", "\n".join([_line("v1", 1, 10, ["v2"]), _line("v2", 1, 20, ["v1"])]) + "\n")
    store.import_crawl(f"{tmp_dir}/prep")
    cat = store.read()
    jobs.network_job(cat.videos, cat.related, f"{tmp_dir}/out", check_nonempty=True)
    for name in ("global_metrics", "category_summary", "node_degrees"):
        files = [f for f in os.listdir(f"{tmp_dir}/out/{name}") if f.endswith(".csv")]
        assert files
    top = jobs.influence_job(cat, f"{tmp_dir}/results", top=1).collect()
    assert len(top) == 1 and abs(top[0].pagerank - 1.0) < 1e-9


def test_streaming_import(spark, tmp_dir):
    watch = f"{tmp_dir}/watch"
    _write(f"{watch}/0.tsv", "\n".join([_line("v1", 1, 10, ["v2"]), _line("v2", 1, 20)]) + "\n")
    q = start_incremental_import(spark, watch, f"{tmp_dir}/cat", f"{tmp_dir}/ck", available_now=True)
    q.awaitTermination()
    _write(f"{watch}/1.tsv", _line("v1", 9, 99, ["v2", "v3"]) + "\n")
    q = start_incremental_import(spark, watch, f"{tmp_dir}/cat", f"{tmp_dir}/ck", available_now=True)
    q.awaitTermination()
    cat = jobs.CatalogTables(spark, f"{tmp_dir}/cat").read()
    vids = {r.videoId: r for r in cat.videos.collect()}
    assert vids["v1"].views == 99 and vids["v2"].views == 20
    assert sorted(map(tuple, cat.related.collect())) == [("v1", "v2")]


def test_network_from_csv_with_optional_columns(spark, tmp_dir):
    _write(f"{tmp_dir}/videos.csv",
           "videoId,uploader,categoryId,category,metric1,views,rating,ratingCount,commentCount\n"
           "v1,u,10,Music,2.5,100,4.5,7,3\nv2,u,10,Music,x,n/a,3.5,8,4\n")
    _write(f"{tmp_dir}/related.csv", "srcVideoId,dstVideoId\nv1,v2\nv1,v2\nv2,v9\n,v1\n")
    jobs.network_from_csv(spark, f"{tmp_dir}/videos.csv", f"{tmp_dir}/related.csv", f"{tmp_dir}/out")
    nd = spark.read.options(header="true").csv(f"{tmp_dir}/out/node_degrees")
    assert "categoryId" in nd.columns and "metric1" in nd.columns
    rows = {r.videoId: r for r in nd.collect()}
    assert rows["v1"].outDegree == "2" and rows["v2"].inDegree == "2" and rows["v2"].metric1 is None
    gm = spark.read.options(header="true").csv(f"{tmp_dir}/out/global_metrics").first()
    assert (gm.numVideos, gm.numEdges) == ("2", "3")


def test_network_from_catalog_guard(spark, tmp_dir):
    store = jobs.CatalogTables(spark, f"{tmp_dir}/empty")
    with pytest.raises(ValueError):
        jobs.network_from_catalog(store, f"{tmp_dir}/out")
    _write(f"{tmp_dir}/prep/a/0.tsv", _line("v1", 1, 10) + "\n")
    store.import_crawl(f"{tmp_dir}/prep")
    with pytest.raises(ValueError):
        jobs.network_from_catalog(store, f"{tmp_dir}/out")   # no edges


def test_format_options_passthrough(spark, tmp_dir):
    from vidgraph.operators import influence
    from vidgraph.sources import tables

    store = jobs.CatalogTables(spark, f"{tmp_dir}/catalog")
    _write(f"{tmp_dir}/prep/a/0.tsv", "\n".join([_line("v1", 1, 10, ["v2"]), _line("v2", 1, 20, ["v1"])]) + "\n")
    store.import_crawl(f"{tmp_dir}/prep")
    top = jobs.influence_job(store.read(), f"{tmp_dir}/results_json", format="json",
                             options={"compression": "none"}, top=2).collect()
    assert [r.id for r in top] == ["v1", "v2"]
    assert any(f.endswith(".json") for f in os.listdir(f"{tmp_dir}/results_json"))
    back = tables.read_table(spark, f"{tmp_dir}/results_json", schema=influence.RESULT_SCHEMA, format="json")
    assert back.count() == 2


def _batch(spark, folder):
    from vidgraph.sources import crawl

    return crawl.crawl_lines(spark.read.option("recursiveFileLookup", "true").text(folder), folder, "files")


def test_micro_batch_replay_is_recognised(spark, tmp_dir):
    from vidgraph.streaming.incremental import merge_batch

    _write(f"{tmp_dir}/w/0.tsv", "\n".join([_line("v1", 1, 10, ["v2"]), _line("v2", 1, 20)]) + "\n")
    _write(f"{tmp_dir}/w2/1.tsv", _line("v1", 2, 30, ["v2", "v2"]) + "\n")
    store = jobs.CatalogTables(spark, f"{tmp_dir}/cat")
    assert merge_batch(store, _batch(spark, f"{tmp_dir}/w"), 0, "q").added_edges == 1
    assert merge_batch(store, _batch(spark, f"{tmp_dir}/w"), 0, "q") is None   # replay after a failure
    assert merge_batch(store, _batch(spark, f"{tmp_dir}/w2"), 1, "q").merged_videos == 1
    assert merge_batch(store, _batch(spark, f"{tmp_dir}/w2"), 0, "other").added_edges == 0   # another query's batch 0
    assert (store.last_batch("q"), store.last_batch("other"), store.last_batch("none")) == (1, 0, -1)
    cat = store.read()
    vids = {r.videoId: r for r in cat.videos.collect()}
    assert vids["v1"].views == 30 and vids["v2"].views == 20
    assert sorted(map(tuple, cat.related.collect())) == [("v1", "v2")]


def test_batch_and_streaming_imports_share_a_store(spark, tmp_dir):
    """No committed row is lost: batch imports, a stream, and the stream with a new checkpoint."""
    store = jobs.CatalogTables(spark, f"{tmp_dir}/cat")
    for n, ids in enumerate((["v1", "v2"], ["v3"])):
        _write(f"{tmp_dir}/prep{n}/a/0.tsv", "".join(_line(i, 1, 10) + "\n" for i in ids))
        assert store.import_crawl(f"{tmp_dir}/prep{n}").merged_videos == len(ids)
    for n, state in enumerate(("ck", "ck", "new_ck")):
        _write(f"{tmp_dir}/watch/{n}.tsv", _line(f"s{n}", n, 50 + n, ["v1"]) + "\n")
        q = start_incremental_import(spark, f"{tmp_dir}/watch", f"{tmp_dir}/cat", f"{tmp_dir}/{state}",
                                     available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    assert {r.videoId for r in store.read().videos.collect()} == {"v1", "v2", "v3", "s0", "s1", "s2"}
    assert sorted(map(tuple, store.read().related.collect())) == [("s0", "v1"), ("s1", "v1"), ("s2", "v1")]


def _rows_of(store):
    cat = store.read()
    return ({r.videoId: (r.uploader, r.views) for r in cat.videos.collect()},
            sorted(map(tuple, cat.related.collect())))


def test_unreadable_table_is_not_an_empty_store(spark, tmp_dir):
    store = jobs.CatalogTables(spark, f"{tmp_dir}/cat")
    assert store.read() is None and store.videos.count() == 0
    _write(f"{tmp_dir}/prep/a/0.tsv", _line("v1", 1, 10) + "\n")
    store.import_crawl(f"{tmp_dir}/prep")
    for f in os.listdir(f"{tmp_dir}/cat/videos/bucket=0"):
        with open(f"{tmp_dir}/cat/videos/bucket=0/{f}", "wb") as out:
            out.write(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        store.import_crawl(f"{tmp_dir}/prep")


def _modified(folder):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def test_import_writes_only_changes(spark, tmp_dir):
    """Buckets that an import does not touch stay; of the stored edges nothing is written again."""
    store = jobs.CatalogTables(spark, f"{tmp_dir}/cat", bucket_bytes=1000)
    _write(f"{tmp_dir}/p0/a/0.tsv", "".join(_line(f"v{i}", 1, i, [f"v{i + 1}"]) + "\n" for i in range(200)))
    _write(f"{tmp_dir}/p1/a/0.tsv", _line("v5", 2, 7, ["v6", "v9"]) + "\n")
    store.import_crawl(f"{tmp_dir}/p0")
    n = store.videos.count()
    assert n >= 4 and n & (n - 1) == 0
    store.videos.bucket_bytes = store.related.bucket_bytes = 1 << 20
    videos, related = _modified(f"{tmp_dir}/cat/videos"), _modified(f"{tmp_dir}/cat/related")
    assert store.import_crawl(f"{tmp_dir}/p1").added_edges == 1
    after = _modified(f"{tmp_dir}/cat/videos")
    assert len(set(videos.items()) - set(after.items())) == 1 and len(after) == len(videos)
    after = _modified(f"{tmp_dir}/cat/related")
    assert related.items() <= after.items() and len(after) == len(related) + 1
    got, edges = _rows_of(store)
    assert len(got) == 200 and len(edges) == 200 and got["v5"] == ("u2", 7) and ("v5", "v9") in edges


def test_bucket_count_follows_the_size(spark, tmp_dir):
    """Growing the bucket count, also where a bucket is left empty, keeps every row once."""
    store = jobs.CatalogTables(spark, f"{tmp_dir}/cat", bucket_bytes=1 << 20)
    expected = {}
    for step, size in enumerate((1 << 20, 3000, 1500, 700)):
        store.videos.bucket_bytes = store.related.bucket_bytes = size
        rows = [(f"v{step}_{i}", step, i, [f"v0_{i % 3}"]) for i in range(8 if step else 3)]
        _write(f"{tmp_dir}/p{step}/a/0.tsv", "".join(_line(*r) + "\n" for r in rows))
        store.import_crawl(f"{tmp_dir}/p{step}")
        expected |= {r[0]: (f"u{r[1]}", r[2]) for r in rows}
        got, edges = _rows_of(store)
        assert got == expected and len(edges) == len(expected)
        assert tuple(store.constraint_report().first()) == (0, 0, 0)
    assert store.videos.count() > 4


def test_compact_keeps_rows(spark, tmp_dir):
    store = jobs.CatalogTables(spark, f"{tmp_dir}/cat")
    for n in range(4):
        _write(f"{tmp_dir}/p{n}/a/0.tsv", _line("v1", n, n, ["v1"] if n == 0 else [f"w{n}"]) + "\n" + _line(f"w{n}", 1, 1) + "\n")
        store.import_crawl(f"{tmp_dir}/p{n}")
    before = _rows_of(store)
    assert store.related.compact(max_files=5) == [] and store.related.compact(max_files=2) == [0]
    assert len(store.related.read().inputFiles()) == 1 and _rows_of(store) == before


def test_a_repeated_key_fails_before_the_commit(spark, tmp_dir):
    """A table that another writer has given a second row of a video, and a merge with two rows of one."""
    store = jobs.CatalogTables(spark, f"{tmp_dir}/cat")
    _write(f"{tmp_dir}/p/a/0.tsv", _line("v1", 1, 10, ["v2"]) + "\n" + _line("v2", 1, 20) + "\n")
    store.import_crawl(f"{tmp_dir}/p")
    before, files = _rows_of(store), _modified(f"{tmp_dir}/cat")
    twice = store.read().videos.where("videoId = 'v1'")
    with pytest.raises(Exception, match="more than one row for v1"):
        store.merge(twice.unionByName(twice), lambda: store.read().related)
    assert _rows_of(store) == before and _modified(f"{tmp_dir}/cat") == files
    assert tuple(store.constraint_report().first()) == (0, 0, 0)
    spark.read.parquet(f"{tmp_dir}/cat/videos").where("videoId = 'v2'").write.mode("append").partitionBy("bucket").parquet(
        f"{tmp_dir}/cat/videos")
    loose = spark.createDataFrame([("v1", "gone", 0), ("v1", "v2", 0)], "srcVideoId string, dstVideoId string, bucket int")
    loose.write.mode("append").partitionBy("bucket").parquet(f"{tmp_dir}/cat/related")
    assert tuple(store.constraint_report().first()) == (1, 1, 1)
    with pytest.raises(Exception, match="more than one row for v2"):
        store.import_crawl(f"{tmp_dir}/p")


def test_files_rank_in_natural_order(spark, tmp_dir):
    """10.tsv after 9.tsv, part-100000 after part-99999, whatever the digits' length; order keys are integers."""
    from pyspark.sql import types as T

    from vidgraph.schema import VIDEOS_TEXT
    from vidgraph.sources import crawl, tables
    from vidgraph.sources.files import natural_key

    names = ["9.tsv", "10.tsv", "part-99999", "part-100000", "a 2.tsv", "a 10.tsv", "ü%2.tsv"]
    for n, name in enumerate(names):
        _write(f"{tmp_dir}/prep/c{'9' if n % 2 == 0 else '10'}/{name}", _line("v1", n, n) + "\n")
    raw = crawl.read_crawl(spark, f"{tmp_dir}/prep")
    assert all(isinstance(raw.schema[c].dataType, (T.IntegerType, T.LongType)) for c in crawl.ORDER_COLUMNS)
    got = [r.file.rsplit("/", 1)[1] for r in raw.orderBy("rank").collect()]
    assert [g.replace("%20", " ").replace("%25", "%") for g in got] == [
        "9.tsv", "a 2.tsv", "part-99999", "ü%2.tsv", "10.tsv", "a 10.tsv", "part-100000"]
    assert natural_key("x/a1b02") < natural_key("x/a1b2") < natural_key("x/a1b10")
    store = jobs.CatalogTables(spark, f"{tmp_dir}/cat")
    store.import_crawl(f"{tmp_dir}/prep")
    assert _rows_of(store)[0] == {"v1": ("u3", 3)}   # folder c10 after c9, there part-100000 last
    for n, name in enumerate(("part-99999.csv", "part-100000.csv")):
        _write(f"{tmp_dir}/csv/{name}", "videoId,uploader,age,category,length,views,rating,ratingCount,commentCount\n"
               f"v1,w{n},1,c,1,{n},1,1,1\n")
    rows = tables.read_csv(spark, f"{tmp_dir}/csv", VIDEOS_TEXT, with_order=True)
    assert [r.uploader for r in rows.orderBy(*tables.ROW_ORDER).collect()] == ["w0", "w1"]
    assert all(isinstance(rows.schema[c].dataType, (T.IntegerType, T.LongType)) for c in tables.ROW_ORDER)


def test_import_report_counts_bad_bytes(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/prep/a")
    with open(f"{tmp_dir}/prep/a/0.tsv", "wb") as f:
        f.write(b'v1\tu\xff\t1\n\n""\nv2\tu\t1\tM\t1\t1\t1\t1\t1\tv1\tv1\tv9\n')
    store = jobs.CatalogTables(spark, f"{tmp_dir}/cat")
    r = store.import_crawl(f"{tmp_dir}/prep")
    assert (r.lines, r.skipped, r.bad_bytes, r.videos, r.edges, r.merged_videos, r.added_edges) == (4, 2, 1, 2, 3, 2, 1)
    assert _rows_of(store) == ({"v1": ("u\ufffd", None), "v2": ("u", 1)}, [("v2", "v1")])
    r = store.merge_raw(spark.createDataFrame([], "value string, rank int, block long, pos long"), ["rank", "block", "pos"])
    assert r.lines == 0 and len(_rows_of(store)[0]) == 2


ROOTS = ["{d}/prep", "{d}/prep/", "{d}//prep", "{d}/./prep", "{d}/prep/../prep", "file:{d}/prep", "file://{d}/prep"]


@pytest.mark.parametrize("root", ROOTS)
def test_root_spellings(spark, tmp_dir, root):
    from vidgraph.sources import crawl

    _write(f"{tmp_dir}/prep/a/0.tsv", "v1\tx\n")
    _write(f"{tmp_dir}/prep/a/log.txt", "log\n")
    _write(f"{tmp_dir}/prep/top.tsv", "top\n")
    _write(f"{tmp_dir}/prep/log.txt", "a line of log.txt\n")
    _write(f"{tmp_dir}/prep/a/deep/1.tsv", "deep\n")
    root = root.format(d=tmp_dir)
    assert [r.value for r in crawl.read_crawl(spark, root).collect()] == ["v1\tx"]
    files = sorted(r.value for r in crawl.read_crawl(spark, root, layout="files").collect())
    assert files == ["a line of log.txt", "top"]


def test_roots_without_data_are_errors(spark, tmp_dir):
    from vidgraph.sources import crawl

    _write(f"{tmp_dir}/one/0.tsv", "v1\n")
    assert crawl.read_crawl(spark, f"{tmp_dir}/one/0.tsv", layout="files").count() == 1   # a file as root
    os.makedirs(f"{tmp_dir}/empty")
    _write(f"{tmp_dir}/hidden/a/_SUCCESS", "")
    for root, layout, error in ((f"{tmp_dir}/none", "files", FileNotFoundError), (f"{tmp_dir}/empty", "files", ValueError),
                                (f"{tmp_dir}/o*", "files", FileNotFoundError), (f"{tmp_dir}/one", "folders", ValueError),
                                (f"{tmp_dir}/hidden", "folders", ValueError), (f"{tmp_dir}/one/0.tsv", "folders", ValueError)):
        with pytest.raises(error):
            crawl.read_crawl(spark, root, layout=layout)
    with pytest.raises(ValueError):
        crawl.read_crawl(spark, [])


@pytest.mark.parametrize("root,file", [
    ("s3a://bkt", "s3a://bkt/a/0.tsv"), ("s3a://videos/videos", "s3a://videos/videos/a/0.tsv"),
    ("hdfs://crawl/crawl", "hdfs://crawl/crawl/a/0.tsv"), ("file:/data", "file:///data/a/0.tsv"),
    ("file:/data", "file:/data/a/0.tsv"), ("viewfs://s/in", "viewfs://s/in/a/0.tsv")])
def test_depth_of_cloud_paths(spark, root, file):
    """The depth rule on hand-made metadata of file systems that are not here."""
    from pyspark.sql import functions as F

    from vidgraph.sources import crawl

    depth = crawl.segments(spark._jvm.org.apache.hadoop.fs.Path(root))
    meta = F.struct(F.col("f").alias("file_path"), F.element_at(F.split("f", "/"), -1).alias("file_name"),
                    F.lit(0).alias("file_block_start"))
    df = spark.createDataFrame([(f, "x") for f in (file, file + "/deep", file.replace("/a/", "/"))], "f string, value string")
    got = crawl.lines_at(df.select(meta.alias("_metadata"), "value"), depth + 2, True).collect()
    assert [(r.folder, r.file) for r in got] == [("a", file)]


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    from vidgraph.schema import RELATED_TEXT
    from vidgraph.sources import tables

    _write(f"{tmp_dir}/r.csv", "dstVideoId,more,srcVideoId\nb,1,a\n")
    assert [tuple(r) for r in tables.read_csv(spark, f"{tmp_dir}/r.csv", RELATED_TEXT).collect()] == [("a", "b")]
    _write(f"{tmp_dir}/bad.csv", "src,dst\na,b\n")
    with pytest.raises(ValueError, match="srcVideoId"):
        tables.read_csv(spark, f"{tmp_dir}/bad.csv", RELATED_TEXT)
    _write(f"{tmp_dir}/mixed/0.csv", "srcVideoId,dstVideoId\na,b\n")
    _write(f"{tmp_dir}/mixed/1.csv", "dstVideoId,srcVideoId\nb,a\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv(spark, f"{tmp_dir}/mixed", RELATED_TEXT).collect()


def test_import_csv_last_row_wins_and_skip_list(spark, tmp_dir, capsys):
    from vidgraph.__main__ import main

    _write(f"{tmp_dir}/videos.csv", "views,videoId,uploader,age,category,length,rating,ratingCount,commentCount\n"
           " 10 ,v1,u,1,Music,60,4.5,7,3\n20,v2,,n/a,Film,61.9,x,8,4\n,v1,,,,,,,\n5,,u,1,c,1,1,1,1\n1,v3,u,1,c,1,1,1,1\n")
    _write(f"{tmp_dir}/related.csv", "dstVideoId,srcVideoId\nv2,v1\nv2,v1\nv3,v1\nv9,v2\n,v2\n")
    _write(f"{tmp_dir}/skip.txt", "v3\n")
    main(["import-csv", "--videos", f"{tmp_dir}/videos.csv", "--related", f"{tmp_dir}/related.csv",
          "--catalog", f"{tmp_dir}/cat", "--skip", f"{tmp_dir}/skip.txt"])
    assert "merged 2 videos, added 1 edges" in capsys.readouterr().out
    cat = jobs.CatalogTables(spark, f"{tmp_dir}/cat").read()
    got = {r.videoId: (r.views, r.uploader, r.age, r.length, r.rating) for r in cat.videos.collect()}
    assert got == {"v1": (None,) * 5, "v2": (20, None, None, 61, None)}
    assert [tuple(r) for r in cat.related.collect()] == [("v1", "v2")]


def test_import_retry_after_a_crash(spark, tmp_dir):
    """An import that broke off after its videos, or in the middle of its edges, is run again."""
    store = jobs.CatalogTables(spark, f"{tmp_dir}/catalog")
    _write(f"{tmp_dir}/prep/a/0.tsv", _line("v1", 1, 10, ["v2", "v1"]) + "\n" + _line("v2", 1, 20) + "\n")

    def broken():
        raise RuntimeError("lost")

    latest = spark.createDataFrame([("v1", "u1", 1, "Music", 60, 10, 4.5, 7, 3)], store.videos.schema)
    with pytest.raises(RuntimeError):
        store.merge(latest, broken)
    assert len(_rows_of(store)[0]) == 1
    store.related.append(spark.createDataFrame([("v1", "v1")], store.related.schema), 1, 1)
    assert store.import_crawl(f"{tmp_dir}/prep").added_edges == 1
    assert _rows_of(store) == ({"v1": ("u1", 10), "v2": ("u1", 20)}, [("v1", "v1"), ("v1", "v2")])
