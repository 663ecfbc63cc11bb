"""Command line entry points, run in-process against the test session."""

import os

import pytest

from vidgraph.__main__ import main


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_cli_commands(spark, tmp_dir, capsys):
    _write(f"{tmp_dir}/prep/a/0.tsv",
           "v1\tu\t1\tMusic\t60\t100\t4.5\t7\t3\tv2\tv3\n"
           "v2\tw\t2\tFilm\t70\t200\t3.5\t8\t4\tv1\n"
           "v3\tz\t3\tFilm\t80\t300\t2.5\t9\t5\tv1\tv2\n")
    cat = f"{tmp_dir}/cat"
    assert main(["import", "--crawl", f"{tmp_dir}/prep", "--catalog", cat]) == 0
    assert "merged 3 videos, added 5 edges" in capsys.readouterr().out
    main(["top", "--catalog", cat, "--field", "views", "--k", "2"])
    out = capsys.readouterr().out
    assert "v3" in out and "v2" in out and "v1" not in out
    main(["range", "--catalog", cat, "--field", "length", "--start", "60", "--end", "80"])
    out = capsys.readouterr().out
    assert "v2" in out and "v1" not in out and "v3" not in out
    main(["network", "--catalog", cat, "--out", f"{tmp_dir}/net"])
    assert os.path.isdir(f"{tmp_dir}/net/category_summary")
    main(["pagerank", "--catalog", cat, "--results", f"{tmp_dir}/res", "--top", "3"])
    main(["results-top", "--results", f"{tmp_dir}/res", "--k", "1"])
    assert "pagerank" in capsys.readouterr().out
    _write(f"{tmp_dir}/videos.csv", "videoId,uploader,age,category,length,views,rating,ratingCount,commentCount\n"
                                    "v1,u,1,Music,60,100,4.5,7,3\n")
    _write(f"{tmp_dir}/related.csv", "srcVideoId,dstVideoId\nv1,v1\n")
    main(["network-csv", "--videos", f"{tmp_dir}/videos.csv", "--related", f"{tmp_dir}/related.csv",
          "--out", f"{tmp_dir}/net_csv"])
    assert os.path.isdir(f"{tmp_dir}/net_csv/node_degrees")
    with pytest.raises(SystemExit):
        main(["top", "--catalog", f"{tmp_dir}/nothing", "--field", "views"])


def test_cli_to_csv(spark, tmp_dir, capsys):
    from vidgraph.schema import RELATED_TEXT, VIDEOS_TEXT
    from vidgraph.sources import tables

    _write(f"{tmp_dir}/input/0.tsv", '"v1\tu, x\t1\tMusic\t60\t100\t4.5\t7\t3\tv2\tv2"\n\nv2\n')
    main(["to-csv", "--crawl", f"{tmp_dir}/input", "--videos-out", f"{tmp_dir}/v", "--related-out", f"{tmp_dir}/r"])
    videos = {r.videoId: r for r in tables.read_csv(spark, f"{tmp_dir}/v", VIDEOS_TEXT).collect()}
    assert videos["v1"].uploader == "u, x" and videos["v2"].uploader is None
    assert sorted(map(tuple, tables.read_csv(spark, f"{tmp_dir}/r", RELATED_TEXT).collect())) == [("v1", "v2")] * 2


def test_cli_aggregates_check_and_cluster(spark, tmp_dir, capsys):
    line = "v{0}\tu\t1\t{1}\t60\t{2}\t4.5\t7\t3\tv1\n"
    _write(f"{tmp_dir}/a/x/0.tsv", line.format(1, "Music", 10) + line.format(2, "Film", 20))
    _write(f"{tmp_dir}/b/x/0.tsv", line.format(1, "Film", 30))
    cat = f"{tmp_dir}/cat"
    for crawl in "ab":
        main(["import", "--crawl", f"{tmp_dir}/{crawl}", "--catalog", cat, "--aggregates"])
    capsys.readouterr()
    main(["summary", "--catalog", cat])
    out = capsys.readouterr().out
    assert "Music" not in out and "Film" in out and "50.0" in out
    main(["check", "--catalog", cat])
    assert capsys.readouterr().out.count("|           0|") == 1
    main(["pagerank", "--catalog", cat, "--results", f"{tmp_dir}/pr", "--state", f"{tmp_dir}/pr_state"])
    assert "pagerank" in capsys.readouterr().out and not os.path.exists(f"{tmp_dir}/pr_state")
    main(["cluster", "--catalog", cat, "--out", f"{tmp_dir}/curve"])
    assert spark.read.parquet(f"{tmp_dir}/curve").count() == 2
