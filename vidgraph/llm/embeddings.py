"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Vectors of equal label (and length) are linked at cosine ``threshold`` or more.

1. Equal vectors become one row with a multiplicity, so a group of copies of any
   size is one row from here on.
2. Spherical k-means on a bounded sample of each label (about ``SAMPLE`` rows, a
   documented bound of the fit) gives centres.  Of 2, 4, 8, ... ``FAN`` centres
   that number is taken whose copies and products, by the sample, cost least.
3. Every vector lives in its nearest cell and visits each cell whose border
   plane (the points as near to one centre as to the other) is at most half of
   ``sqrt(2 - 2 * threshold)`` away.  Of two linked vectors in different cells
   their distances to the border add up to at most their own distance, so one
   of them visits the other: no link is lost, whatever the centres are.
4. A cell above one block is split in the same way, residents and visitors alike,
   as long as the sample says that it pays and cells get smaller: the number of
   cells has no limit, a task never holds more than ``FAN`` centres.  Rows carry
   their homes and visits of all levels, by which a pair that meets in several
   cells is counted in one.
5. A cell is compared in blocks of ``BLOCK`` vectors (``BLOCK_BYTES`` at most),
   block against block, some rows of a block at a time; a task leaves link counts
   and a spanning forest, never the pairs.
6. Components of the forests; the smallest ``vec_id`` of each is kept.

Defined cases: a vector that is null, empty or zero or holds nulls or non-finite
numbers links with nothing, nor does one without a label; vectors of different
length don't link; repeated rows are vectors of their own and link with each
other; a null ``vec_id`` never names a component that holds an id and is not kept
there (rows without ids that link with nothing else have a null component and are
all kept: nothing tells them apart); an empty table gives an empty table; columns that clash with the added ones are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidgraph.llm.common import quoted, scratch, without
from vidgraph.llm.components import components

THRESHOLD = 0.93
CELL, FAN, SAMPLE, ROUNDS = 512, 256, 8192, 5
CHUNK, BLOCK, BLOCK_BYTES = 4096, 1 << 15, 16 << 20
SCORES = 1 << 22  # products held at once
COPY = 2000  # a copied row (written, shuffled, read) costs about as much as this many products
SHRINK = 0.7  # a cell is split again only below this share of what it was split from
# One level of a row's path: the cell it stands in, its home, the cells it visits (one bit each).
LEVEL = np.dtype([("cell", "<i2"), ("home", "<i2"), ("seen", "u1", 32)])
ADDED = ["n_links", "component_id", "kept"]
_ASSIGNED = "cls bigint, cell int, own boolean, path binary, gid bigint, mult bigint, e {kind}"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows in double precision, scaled to length one (by the largest component
    first: no overflow)."""
    vectors = vectors.astype(np.float64)
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of length one."""
    centres = x[:k].copy()
    for _ in range(rounds):
        near = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return centres


def visits(x: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each row, and which cells it visits (boolean matrix)."""
    s = x @ centres.T
    home = np.argmax(s, axis=1)
    apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * centres @ centres.T))[home]
    near = s[np.arange(len(x)), home][:, None] - s <= math.sqrt(2.0 - 2.0 * threshold) / 2.0 * apart + 1e-9
    near[np.arange(len(x)), home] = False
    return home, near


def _cost(x: np.ndarray, centres: np.ndarray, n: int, block: int, threshold: float) -> float:
    """Products and copies of a class of ``n`` rows in these cells, by its sample."""
    home, near = visits(x, centres, threshold)
    own = np.bincount(home, minlength=len(centres)) * (n / len(x))
    size = own + near.sum(axis=0) * (n / len(x))
    return float((own * (size - own / 2)).sum() + COPY * (size * np.ceil(size / block)).sum())


def _fit(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Centres of one class; none if cells cost more than to compare it whole."""
    rows = rows.sort_values(["h", "gid"])
    x = unit(np.stack(rows["e"].to_numpy()))
    n, block, cls = int(rows["n"].iloc[0]), int(rows["per_block"].iloc[0]), rows["cls"].iloc[0]
    whole = n * n / 2 + COPY * n * math.ceil(n / block)
    best, least = None, whole if rows["level"].iloc[0] else math.inf
    k = 2
    while k <= min(FAN, len(x)):
        centres = kmeans(x, k)
        cost = _cost(x, centres, n, block, threshold)
        if cost < least:
            best, least = centres, cost
        k *= 2
    cells = [] if best is None else list(best)
    return pd.DataFrame({"cls": np.full(len(cells), cls, np.int64), "cell": np.arange(len(cells), dtype=np.int32),
                         "centre": pd.Series(cells, dtype=object)})


def _assign(rows: pd.DataFrame, cells: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Every row in its home cell and in the cells that it visits."""
    if not len(rows):
        return pd.DataFrame({c: [] for c in ("cls", "cell", "own", "path", "gid", "mult", "e")}, dtype=object)
    cells = cells.sort_values("cell")
    x = unit(np.stack(rows["e"].to_numpy()))
    home, near = visits(x, np.stack(cells["centre"].to_numpy()), threshold)
    seen = np.zeros((len(x), 256), np.uint8)
    seen[:, :near.shape[1]] = near
    guest, at = np.nonzero(near)
    row, cell = np.concatenate([np.arange(len(x)), guest]), np.concatenate([home, at])
    level = np.zeros(len(row), LEVEL)
    level["cell"], level["home"], level["seen"] = cell, home[row], np.packbits(seen, axis=1)[row]
    raw, width, old = level.tobytes(), LEVEL.itemsize, rows["path"].to_numpy()
    out = rows[["cls", "gid", "mult", "e"]].iloc[row].reset_index(drop=True)
    return out.assign(cell=cell.astype(np.int32), own=np.arange(len(row)) < len(x),
                      path=[bytes(old[r]) + raw[i * width:(i + 1) * width] for i, r in enumerate(row)])[
        ["cls", "cell", "own", "path", "gid", "mult", "e"]]


class _Meetings:
    """Tells which linked pairs of one cell are counted there.  On each level one
    of the two is at home; a visitor and a resident that visits the visitor's home
    meet in both cells, and the cell with the smaller number counts them."""

    def __init__(self, paths: list[bytes]):
        levels = np.frombuffer(b"".join(paths), LEVEL).reshape(len(paths), -1)
        self.levels = []
        for n in range(levels.shape[1]):
            home, cell = levels["home"][:, n].astype(np.int64), int(levels["cell"][0, n])
            self.levels.append((cell, home, home == cell, np.unpackbits(levels["seen"][:, n], axis=1).astype(bool)))

    def counted(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        keep = np.ones(len(i), bool)
        for cell, home, own, seen in self.levels:
            for a, b in ((i, j), (j, i)):
                keep &= own[a] | own[b]
                keep &= ~(own[a] & ~own[b] & (home[b] < cell) & seen[a, home[b]])
        return keep


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the trees of linked rows; a root is the smallest row of its tree."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def _compare(unit_rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of one unit: blocks ``u1`` and ``u2`` of one cell (or one block)."""
    unit_rows = unit_rows.sort_values("gid")
    x = unit(np.stack(unit_rows["e"].to_numpy()))
    meetings = _Meetings([bytes(p) for p in unit_rows["path"]])
    mult, gid = unit_rows["mult"].to_numpy().astype(np.int64), unit_rows["gid"].to_numpy()
    u1, u2 = int(unit_rows["u1"].iloc[0]), int(unit_rows["u2"].iloc[0])
    block = unit_rows["block"].to_numpy()
    left, right = np.flatnonzero(block == u1), np.flatnonzero(block == u2)
    other = x[right]
    counts, root = np.zeros(len(gid), np.int64), np.arange(len(gid))
    step = max(1, SCORES // max(1, len(right)))
    for start in range(0, len(left), step):
        some = left[start:start + step]
        first = start if u1 == u2 else 0
        i, j = np.nonzero(x[some] @ other[first:].T >= threshold)
        i, j = some[i], right[j + first]
        if u1 == u2:
            i, j = i[i < j], j[i < j]
        keep = meetings.counted(i, j)
        i, j = i[keep], j[keep]
        np.add.at(counts, i, mult[j])
        np.add.at(counts, j, mult[i])
        _join(root, i, j)
    linked = counts > 0
    return pd.DataFrame({"gid": gid[linked], "n": counts[linked], "root": gid[root[linked]]})


def usable(e: Column, label: Column) -> Column:
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & e.isNotNull() & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def _per_block() -> Column:
    return F.least(F.lit(BLOCK), F.greatest(F.lit(256), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("dim")))).cast("int"))


def _cells(rows: DataFrame, centres: DataFrame, kind: str, threshold: float) -> DataFrame:
    """The rows of the split classes in their new cells, each cell a class."""
    of = centres.groupBy("cls").agg(F.count(F.lit(1)).alias("k"))
    split = rows.join(of, "cls")
    chunks = F.ceil(F.col("n") / CHUNK).cast("bigint")
    dealt = split.select("cls", F.pmod(F.xxhash64("gid"), chunks).alias("chunk"), "path", "gid", "mult", "e")
    parents = scratch(split.groupBy("cls", "n", "dim").agg(F.lit(1).alias("one")), "split-classes")
    copies = centres.join(parents.select("cls", F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)).alias("chunk")),
                          "cls")
    placed = dealt.groupBy("cls", "chunk").cogroup(copies.groupBy("cls", "chunk")).applyInPandas(
        lambda a, b: _assign(a, b, threshold), _ASSIGNED.format(kind=kind))
    placed = scratch(placed, "cells")
    sizes = placed.groupBy("cls", "cell").agg(F.sum(F.col("own").cast("bigint")).alias("m"), F.count(F.lit(1)).alias("size"))
    sizes = sizes.where("m > 0 and size > 1").join(parents, "cls").select(
        "cls", "cell", F.monotonically_increasing_id().alias("child"), "dim", F.col("size").alias("n"),
        (F.col("size") - F.col("m")).alias("v"), (F.col("size") <= SHRINK * F.col("n")).alias("open"))
    sizes = scratch(sizes, "cell-sizes")
    return placed.join(sizes, ["cls", "cell"]).select(
        F.col("child").alias("cls"), "dim", "n", "v", "open", "own", "path", "gid", "mult", "e")


def _units(points: DataFrame, kind: str, threshold: float) -> DataFrame:
    """Splits classes into cells, level by level, and deals the rows to pairs of
    blocks (``u1``, ``u2``)."""
    level, todo, done = 0, points, []
    while True:
        big = todo.where(F.col("open") & (F.col("n") > (_per_block() if level else F.lit(CELL))))
        h = F.xxhash64("gid")
        some = F.pmod(h, F.lit(1 << 31)) < F.lit(SAMPLE) / F.col("n") * (1 << 31)
        sample = big.where(some).select("cls", "n", "gid", "e", h.alias("h"), _per_block().alias("per_block"),
                                        F.lit(level).alias("level"))
        centres = scratch(sample.groupBy("cls").applyInPandas(
            lambda rows: _fit(rows, threshold), "cls bigint, cell int, centre array<double>"), "centres")
        if centres.isEmpty():
            done.append(todo.withColumn("level", F.lit(level)))
            break
        done.append(todo.join(centres.select("cls").distinct(), "cls", "left_anti").withColumn("level", F.lit(level)))
        todo = scratch(_cells(todo, centres, kind, threshold), "points")
        level += 1
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    per = _per_block()
    blocks = lambda c: F.ceil(c / per).cast("bigint")
    alone = F.col("n") <= per
    rows = rows.where("n > 1").withColumn("nb", F.when(alone, 1).otherwise(blocks(F.col("n") - F.col("v"))))
    rows = rows.withColumn("nv", F.when(alone, 0).otherwise(blocks(F.col("v"))))
    h = F.xxhash64("gid")
    block = F.when(F.col("own") | (F.col("nv") == 0), F.pmod(h, "nb")).otherwise(F.col("nb") + F.pmod(h, "nv"))
    rows = rows.withColumn("block", block)
    # Block pairs (u1, u2), u1 <= u2 and u1 of residents; blocks of visitors come last.
    to = F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(F.col("block") < F.col("nb"), F.col("nb") + F.col("nv") - 1)
                              .otherwise(F.col("nb") - 1)))
    rows = rows.select("*", to.alias("o"))
    return rows.select("level", "cls", "path", "gid", "mult", "e", "block",
                       F.least("block", "o").alias("u1"), F.greatest("block", "o").alias("u2"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vectors`` (``vec_id, embedding, label``, any further columns) plus
    ``n_links``, ``component_id`` and ``kept`` (the component's representative)."""
    base = without(vectors, *ADDED)
    # Vectors travel as they are; the arithmetic is in double precision.
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    e = F.col("embedding").cast(kind)
    rows = base.select("vec_id", "label", e.alias("e")).where(usable(F.col("e"), F.col("label")))
    groups = rows.groupBy("label", "e").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("mult"))
    groups = scratch(groups.withColumn("gid", F.monotonically_increasing_id()).withColumn("dim", F.size("e")), "vectors")
    classes = groups.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    classes = scratch(classes.select("label", "dim", "n", F.monotonically_increasing_id().alias("cls")), "classes")
    points = groups.join(classes, ["label", "dim"]).select(
        "cls", "dim", "n", F.lit(0).cast("bigint").alias("v"), F.lit(True).alias("open"), F.lit(True).alias("own"),
        F.lit(b"").alias("path"), "gid", "mult", "e")
    units = _units(scratch(points, "points"), kind, threshold)
    found = units.groupBy("level", "cls", "u1", "u2").applyInPandas(
        lambda unit_rows: _compare(unit_rows, threshold), "gid bigint, n bigint, root bigint")
    found = scratch(found, "vector-links")

    roots = components(found.select(F.col("gid").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("gid").agg(F.sum("n").alias("n"))
    known = groups.join(counts, "gid", "left").join(roots.withColumnRenamed("node", "gid"), "gid", "left")
    known = scratch(known.select(
        "label", "e", "low", F.coalesce("root", "gid").alias("root"),
        (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links")), "linked-vectors")
    lows = known.groupBy("root").agg(F.min("low").alias("component_id"))
    known = known.join(lows, "root").select(F.col("label").alias("__label"), F.col("e").alias("__e"),
                                            F.xxhash64("e").alias("__h"), "n_links", "component_id")
    known = scratch(known, "vector-components")
    own = base.withColumn("__own", F.when(usable(e, F.col("label")), e)).withColumn("__key", F.xxhash64("__own"))
    out = own.join(known, (F.col("__key") == F.col("__h")) & (F.col("label") == F.col("__label"))
                   & (F.col("__own") == F.col("__e")), "left")
    single = F.col("n_links").isNull()
    component = F.when(single, F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(*[quoted(c) for c in base.columns], F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
