"""Randomized end-to-end check of ingest and upsert.  Rows are made clean first, then
written as dirty crawl lines, so what must come out is known without parsing: the last
row of an ID wins, nulls included; edges are distinct and both endpoints known."""

import os
import random

from vidgraph.operators import catalog, ingest
from vidgraph.plans.catalog_tables import CatalogTables
from vidgraph.schema import VIDEO_COLUMNS
from vidgraph.sources import crawl
from vidgraph.streaming.incremental import merge_batch

IDS = ["", *[f"v{i}" for i in range(12)], "-x_9"]
TEXTS = [None, "Music", "People & Blogs", 'the "best"', "a, b", "\u00e9t\u00e9"]


def clean_row(rnd):
    """(id, attributes, related IDs) as they must be read."""
    number = lambda: rnd.choice([None, rnd.randint(0, 10**6)])
    attrs = (rnd.choice(TEXTS), number(), rnd.choice(TEXTS), number(), number(),
             rnd.choice([None, rnd.randint(0, 50) / 10]), number(), number())
    return rnd.choice(IDS), attrs, [rnd.choice(IDS[1:]) for _ in range(rnd.randint(0, 4))]


def dirty_line(rnd, row):
    vid, attrs, related = row

    def id_cell(v):
        return rnd.choice(["", " ", "\ufeff"]) + rnd.choice([v, f'"{v}"', f'""{v}']) + rnd.choice(["", "\u00a0"])

    def cell(v):
        if v is None:
            return rnd.choice(["", " ", '""'])
        if isinstance(v, str):
            quoted = '"' + v.replace('"', '""') + '"'
            return rnd.choice([quoted, f" {quoted}"]) if '"' in v else rnd.choice([v, f" {v} ", quoted])
        whole = isinstance(v, int)
        return rnd.choice([str(v), f" {v} ", f'"{v}"', f"{v}.7" if whole else f"{v}0"])

    def number(v):
        return rnd.choice(["", "n/a", "NaN"]) if v is None else cell(v)

    cells = [id_cell(vid)] + [cell(v) if i in (0, 2) else number(v) for i, v in enumerate(attrs)]
    for r in related:
        cells += [rnd.choice(["", " ", '""'])] * rnd.randint(0, 1) + [id_cell(r)]
    while not related and cells and len(cells) > 1 and cells[-1] == "" and rnd.random() < 0.7:
        cells.pop()  # a short line
    line = "\t".join(cells)
    return f'"{line}"' if rnd.random() < 0.3 or (line[0] == line[-1] == '"') else line


def expected(batches):
    videos, edges = {}, set()
    for rows in batches:
        videos.update({vid: attrs for vid, attrs, _ in rows if vid})
        edges |= {(vid, r) for vid, _, related in rows for r in related if vid in videos and r in videos}
    return videos, edges


def lines_of(rnd, rows):
    lines = []
    for row in rows:
        lines += rnd.choice([[], [], [""], ['""']]) + [dirty_line(rnd, row)]
    return [x for x in lines if x is not None]


def rows_of(rnd, n):
    rows = [clean_row(rnd) for _ in range(n)]
    return [(v, a, r) for v, a, r in rows if v or any(x is not None for x in a) or r]


def check(cat_videos, cat_related, batches):
    want_v, want_e = expected(batches)
    got = {r.videoId: tuple(r[c] for c in VIDEO_COLUMNS[1:]) for r in cat_videos.collect()}
    assert got == want_v
    assert sorted(map(tuple, cat_related.collect())) == sorted(want_e)


def test_ingest_and_upsert_of_known_rows(spark):
    rnd = random.Random(21)
    rows = rows_of(rnd, 400)
    raw = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines_of(rnd, rows))],
                                "batch int, line_no long, value string")
    videos = catalog.upsert_videos(ingest.parse_videos(raw), ["batch", "line_no"])
    check(videos, catalog.upsert_related(ingest.parse_related(raw), videos), [rows])


def test_micro_batches_equal_one_import(spark, tmp_path):
    rnd = random.Random(11)
    batches = [rows_of(rnd, 60) for _ in range(3)]
    known = (None,) * 8
    batches[0].append(("w1", known, ["late"]))   # target crawled only in batch 2: this edge must stay out
    batches[2].append(("late", known, []))
    store = CatalogTables(spark, str(tmp_path / "cat"), bucket_bytes=2000)
    for b, rows in enumerate(batches):
        folder = tmp_path / f"in{b}"
        os.makedirs(folder)
        (folder / "0.tsv").write_text("\n".join(lines_of(rnd, rows)) + "\n", encoding="utf-8")
        df = spark.read.option("recursiveFileLookup", "true").text(str(folder))
        assert merge_batch(store, crawl.crawl_lines(df, str(folder), "files"), b, "q").merged_videos > 0
    assert store.videos.count() > 1  # the bucket count has followed the table's size
    cat = store.read()
    check(cat.videos, cat.related, batches)
