"""Benchmark decontamination: prefix-filtered set join on word shingles.

A window is 13 consecutive words of a benchmark item (an item of fewer words is
one window).  A window occurs in a document where its words stand consecutively.

1. Windows become sets of positioned shingles (5 words; a shorter window is one
   shingle).  A table of the benchmark's shingle hashes, about eight places for
   each (``MAX_SLOTS`` at most), travels in the plan; positions of a document that
   miss one of their two places are dropped inside the row, so only suspected
   shingles leave the text scan, with their exact words.
2. A join on the exact words leaves real benchmark shingles; their number of
   occurrences in the whole corpus is the global order (rarest first).
3. A window that is contained as a whole must hold its rarest shingle, so the
   necessary prefix has length one: only that shingle is joined, and a
   candidate start follows from the two positions (length bound: the window
   must fit between the first and the last word).
4. A candidate counts if every other shingle of its window stands at its place,
   which is equality of all words.

Defined cases: a null or empty text has no words; null or wordless items give
no window; an item id on several rows is one item; a null item id is never
listed or counted, but its words hit; repeated document rows get equal results;
very long texts are searched whole; an empty table gives an empty table; columns of the documents that clash with the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vidgraph.llm.common import bind, broadcast_if_small, quoted, scratch, text_hash, without, words

WINDOW, SHINGLE = 13, 5
MIN_SLOTS, MAX_SLOTS = 1 << 16, 1 << 24  # bytes of the table in the plan
ADDED = ["n_words", "n_hit", "item_ids", "n_items", "contaminated"]
OCCURRENCE = "doc_id {id}, xh bigint, n_words int, pos int, sid bigint"


def _hash(w: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(w, at + i) for i in range(size)])


def _starts(n: Column, size: int) -> Column:
    """0 .. n - size, empty when the text is shorter."""
    return F.when(n >= size, F.sequence(F.lit(0), F.greatest(F.lit(0), n - size))).otherwise(
        F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: ``window_id, len, win`` (array of words) and their ``items``."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    w = w.where(F.size("w") > 0)
    cut = bind(F.col("w"), lambda a: F.transform(
        _starts(F.greatest(F.size(a), F.lit(window)), window), lambda p: F.slice(a, p + 1, F.lit(window))))
    w = w.select("item", F.explode_outer(cut).alias("win"))
    w = w.groupBy("win").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return scratch(w.select(F.monotonically_increasing_id().alias("window_id"), F.size("win").alias("len"),
                            "win", "items"), "windows")


def _item_sets(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``window_id, set_id`` and ``set_id, item``: windows of the same items share a set,
    so a document that holds many of them meets their items once."""
    sets = windows.select("items").distinct().withColumn("set_id", F.monotonically_increasing_id())
    sets = scratch(sets, "item-sets")
    of = windows.select("window_id", "items").join(sets, "items").select("window_id", "set_id")
    return scratch(of, "window-sets"), sets.select("set_id", F.explode("items").alias("item"))


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """``window_id, len, off, size, sh`` for every shingle of every window."""
    size = F.least(F.col("len"), F.lit(shingle))
    parts = bind(F.col("win"), lambda a: F.transform(
        F.sequence(F.lit(0), F.size(a) - F.least(F.size(a), F.lit(shingle))),
        lambda p: F.array_join(F.slice(a, p + 1, F.least(F.size(a), F.lit(shingle))), " ")))
    return windows.select("window_id", "len", size.alias("size"), F.posexplode_outer(parts).alias("off", "sh"))


def _slots(h: Column, slots: int) -> list[Column]:
    """The two places of a hash."""
    return [x.bitwiseAND(F.lit(slots - 1).cast("bigint")) for x in (h, F.shiftrightunsigned(h, 32))]


def _table_of(names: DataFrame, sizes: list[int]) -> bytes:
    """One byte per slot, 01 where a benchmark shingle falls; what reaches the driver
    is a bitmap of at most ``MAX_SLOTS`` bits."""
    slots = min(MAX_SLOTS, max(MIN_SLOTS, 1 << (8 * names.count() - 1).bit_length()))
    h = F.coalesce(*[F.when(F.col("size") == s, _hash(F.split("sh", " "), F.lit(0), s)) for s in sizes])
    at = names.select(F.explode(F.array(*_slots(h, slots))).alias("at"))
    bits = at.groupBy(F.expr("bitmap_bucket_number(at + 1)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(at + 1))").alias("bits"))
    width = 1 << 15  # bits of one bitmap, lowest bit first
    spread = [bytes(b >> i & 1 for i in range(8)) for b in range(256)]
    flags = bytearray(max(slots, width))
    for r in bits.collect():
        start = (r["bucket"] - 1) * width
        flags[start:start + width] = b"".join([spread[b] for b in r["bits"]])
    return bytes(flags[:slots])


def _occurrences(docs: DataFrame, names: DataFrame) -> DataFrame:
    """``doc_id, xh, n_words, pos, sid`` of every benchmark shingle in a document."""
    sizes = sorted(r[0] for r in names.select("size").distinct().collect())  # at most SHINGLE numbers
    if not sizes:
        kind = docs.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], OCCURRENCE.format(id=kind))
    return scratch(_suspects(docs, names, sizes).join(broadcast_if_small(names.select("sh", "sid")), "sh").drop("sh").distinct(),
                   "occurrences")


def _suspects(docs: DataFrame, names: DataFrame, sizes: list[int]) -> DataFrame:
    """``doc_id, xh, n_words, pos, sh`` of the shingles that the table lets through."""
    held = _table_of(names, sizes)
    flags, slots = F.lit(held), len(held)

    def suspected(w: Column, s: int) -> Column:
        def hit(p: Column) -> Column:
            one, two = [F.substring(flags, x.cast("int") + 1, F.lit(1)) == F.lit(b"\x01") for x in _slots(_hash(w, p, s), slots)]
            return one & two

        at = F.filter(_starts(F.size(w), s), hit)
        return F.transform(at, lambda p: F.struct(
            F.size(w).alias("n_words"), p.alias("pos"), F.array_join(F.slice(w, p + 1, F.lit(s)), " ").alias("sh")))

    found = bind(words(F.col("text")), lambda w: F.concat(*[suspected(w, s) for s in sizes]))
    rows = docs.select("doc_id", text_hash(F.col("text")).alias("xh"), F.explode_outer(found).alias("o"))
    # Repeated document rows give equal occurrences: one of each is enough.
    return rows.select("doc_id", "xh", "o.*").where(F.col("sh").isNotNull())


def window_hits(docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, xh, start, len, window_id`` of every occurrence of a window."""
    parts = scratch(_window_shingles(windows, shingle), "window-shingles")
    names = scratch(parts.groupBy("sh").agg(F.first("size").alias("size"))
                    .withColumn("sid", F.monotonically_increasing_id()), "shingles")
    occ = _occurrences(docs, names)
    freq = occ.groupBy("sid").agg(F.count(F.lit(1)).alias("freq"))
    parts = scratch(parts.join(names.select("sh", "sid"), "sh").join(freq, "sid").drop("sh"), "ranked")
    prefix = parts.groupBy("window_id", "len", "size").agg(
        F.min(F.struct("freq", "sid", "off")).alias("p"), F.count(F.lit(1)).alias("known"))
    # A window with a shingle that occurs nowhere occurs nowhere.
    prefix = prefix.where(F.col("known") == F.col("len") - F.col("size") + 1)
    prefix = scratch(prefix.select("window_id", "len", "size", "p.sid", "p.off"), "prefixes")
    cand = occ.join(broadcast_if_small(prefix), "sid").withColumn("start", F.col("pos") - F.col("off"))
    cand = cand.where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
    cand = scratch(cand.select("doc_id", "xh", "start", "len", "size", "window_id"), "candidates")
    need = cand.join(broadcast_if_small(parts.select("window_id", "sid", "off")), "window_id")
    need = need.withColumn("pos", F.col("start") + F.col("off"))
    same = (F.col("n.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("n.xh") == F.col("o.xh"))
            & (F.col("n.pos") == F.col("o.pos")) & (F.col("n.sid") == F.col("o.sid")))
    seen = need.alias("n").join(occ.alias("o"), same, "left_semi")
    return (seen.groupBy("doc_id", "xh", "start", "len", "size", "window_id").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") == F.col("len") - F.col("size") + 1)
            .select("doc_id", "xh", "start", "len", "window_id"))


def _covered(hits: DataFrame) -> DataFrame:
    """``doc_id, xh, n_hit``: words inside the union of the occurrences."""
    end = F.col("start") + F.col("len")
    before = Window.partitionBy("doc_id", "xh").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.select("doc_id", "xh", "start", end.alias("end")).distinct()
    spans = spans.withColumn("from", F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    return spans.groupBy("doc_id", "xh").agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.col("from"))).alias("n_hit"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  ratio: int = 20) -> DataFrame:
    """``docs`` (``doc_id, text``, any further columns) plus ``n_words``, ``n_hit``,
    ``item_ids`` (sorted strings), ``n_items`` and ``contaminated``: at least one
    word in ``ratio`` is hit.  No row is dropped."""
    windows = benchmark_windows(benchmark, window)
    hits = scratch(window_hits(docs, windows, shingle), "hits")
    of, sets = _item_sets(windows)
    items = (hits.join(broadcast_if_small(of), "window_id").select("doc_id", "xh", "set_id").distinct()
             .join(broadcast_if_small(sets), "set_id")
             .groupBy("doc_id", "xh").agg(F.array_sort(F.collect_set("item")).alias("item_ids")))
    found = _covered(hits).alias("a").join(
        items.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.xh") == F.col("b.xh")), "left")
    found = scratch(found.select(F.col("a.doc_id").alias("__id"), F.col("a.xh").alias("__xh"), "n_hit", "item_ids"),
                    "hit-documents")
    base = without(docs, *ADDED)
    out = base.join(broadcast_if_small(found), base["doc_id"].eqNullSafe(found["__id"])
                    & (text_hash(base["text"]) == found["__xh"]), "left")
    n_words = F.coalesce(F.size(words(base["text"])), F.lit(0)).cast("bigint")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("bigint")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    out = out.select(*[quoted(c) for c in base.columns], n_words.alias("n_words"), n_hit.alias("n_hit"),
                     ids.alias("item_ids"), F.size(ids).cast("bigint").alias("n_items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (ratio * F.col("n_hit") >= F.col("n_words")))
