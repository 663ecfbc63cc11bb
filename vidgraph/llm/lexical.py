"""Ranked lexical search by dual trees: each item's ``k`` best documents.

A document scores, for an item, the sum over the item's terms (repeats included)
of weight x impact, in 64-bit integers (``weights``, ``_impacts``).

1. **Postings**: one scan counts, per document, all its terms and the frequencies
   of those that some item holds; what is kept is a lean table.  Document and term
   counts come from it by partial sums.
2. **Document tree**: postings are range-partitioned and sorted by their rarest
   terms, so that neighbours share terms.  A chunk of a partition (at most
   ``CHUNK_POSTINGS`` postings) is a subtree: chunk, nodes of ``NODE`` documents,
   leaves of ``LEAF``; each node holds the largest weight x impact of every term below it.
3. **Item tree**: similar items form groups of ``GROUP``; a group holds the largest
   count of every term.
4. **Search**: the product of two nodes' maxima bounds every score between them.
   A pair whose bound is below the smallest kth score of the node's items is
   dropped with all under it; what is left is split on both sides, down to single
   items and documents, which are scored exactly.  Equal bounds are followed, as
   ties are decided by ``doc_id``.
5. **Weakest kth scores** start from a first light pass in which every chunk scores,
   for each item group, its most promising leaf; they rise as a task goes on.
   Tasks return only rows that may be among the best, and a window ranks them.

Items are read in blocks of about ``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` item
terms, each a pass over the postings of that block's terms: that is what is
broadcast and what the driver holds, whatever the number of documents and items.

Defined cases: null texts have no terms; such documents and items count for nothing
and are not returned; only scores above 0 are; equal scores rank by ascending
``doc_id``, null last; rows of one ``doc_id`` are documents of their own, rows of one
``item_id`` (null included) items of their own; very long texts are read whole; other
columns are ignored, also those named like an added one; empty tables give no row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidgraph.llm.common import scratch

TOP_K = 10
LEAF, NODE, GROUP = 32, 512, 16
CHUNK_POSTINGS = 1 << 18
BLOCK_ITEMS, BLOCK_TERMS = 4096, 1 << 20
# ASCII letters and digits (A-Z lower-cased) and all bytes of other characters stay; the rest parts terms.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
POSTINGS = "n bigint, terms array<int>, tfs array<bigint>"
WEIGHTED = "t1 int, t2 int, mark bigint, terms array<int>, vals array<bigint>"


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def item_terms(items: DataFrame) -> DataFrame:
    """``no, term, q`` of numbered items."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for no, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = Counter(terms_of(text.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([no] * len(held), pa.int64()), pa.array(list(held), pa.binary()),
                     pa.array(list(held.values()), pa.int64())], names=["no", "term", "q"])

    return items.select("no", F.col("text").cast("binary")).mapInArrow(split, "no bigint, term binary, q bigint")


def _lists(sizes: list[int], values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)), pa.array(values))


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of all documents with a term; only terms of the vocabulary are listed."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(vocabulary)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = known.value
        for batch in batches:
            rows, ns, sizes, terms, tfs = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                words = terms_of(text.as_py())
                if words:
                    held = Counter(words)
                    found = [(ids[t], held[t]) for t in held.keys() & ids.keys()]
                    rows.append(i)
                    ns.append(len(words))
                    sizes.append(len(found))
                    terms += [t for t, _ in found]
                    tfs += [f for _, f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(ns, pa.int64()),
                 _lists(sizes, np.array(terms, np.int32)), _lists(sizes, np.array(tfs, np.int64))],
                names=["doc_id", "n", "terms", "tfs"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(count, f"doc_id {kind}, {POSTINGS}")


def weights(table: DataFrame, n_docs: int) -> dict[int, int]:
    """floor(1000 ln((2N+2)/(2df+1))) by term of the vocabulary that stands in a document."""
    held = table.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ratio = F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)
    return dict(held.select("term", F.floor(1000 * F.log(ratio)).cast("bigint").alias("w")).collect())


def _impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weighted(table: DataFrame, by_term: dict[int, int], n_terms: int, n_docs: int, length: int) -> DataFrame:
    """Postings with weight x impact, sorted by the two rarest terms, equal ones apart by id."""
    spark = table.sparkSession
    w = np.zeros(max(1, n_terms), np.int64)
    w[list(by_term)] = list(by_term.values())
    shared = spark.sparkContext.broadcast(w)
    kind = table.schema["doc_id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, terms, tfs = batch.column(1).to_numpy(), batch.column(2), batch.column(3)
            sizes = np.diff(terms.offsets.to_numpy())
            term, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
            of = np.repeat(np.arange(len(n)), sizes)
            val = shared.value[term] * _impacts(tf, (25 + (75 * n * n_docs) // length)[of])
            order = np.lexsort((term, -shared.value[term], of))
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            t1 = term[order[first]]
            t2 = np.where(sizes > 1, term[order[np.minimum(first + 1, len(order) - 1)]], -1)
            mark = np.add.reduceat(val * (2 * term.astype(np.int64) + 1), first)  # tells unlike documents of one id apart
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(t1, pa.int32()), pa.array(t2, pa.int32()), pa.array(mark, pa.int64()),
                 _lists(sizes, term), _lists(sizes, val)], names=["doc_id", "t1", "t2", "mark", "terms", "vals"])

    out = table.where(F.size("terms") > 0).mapInArrow(weigh, f"doc_id {kind}, {WEIGHTED}")
    out = out.repartitionByRange("t1", "t2", "doc_id", "mark").sortWithinPartitions("t1", "t2", "doc_id")
    return scratch(out.select("doc_id", "terms", "vals"), "lexical-documents")


class ItemTree:
    """Items in groups of similar ones; each group's terms, largest counts and count matrix."""

    def __init__(self, numbers: np.ndarray, item: np.ndarray, term: np.ndarray, q: np.ndarray, w: np.ndarray):
        sketch = np.zeros((len(numbers), 64))  # random signs per term: dot products tell similar items
        signs = np.random.default_rng(1).choice([-1.0, 1.0], (len(w), 64))
        np.add.at(sketch, item, signs[term] * (q * w[term])[:, None])
        left, self.groups, self.w_terms = np.arange(len(numbers)), [], len(w)
        while len(left):
            near = np.argsort(-(sketch[left] @ sketch[left[0]]), kind="stable")
            near = np.concatenate([[0], near[near != 0]])[:GROUP]
            members = left[near]
            left = np.delete(left, near)
            of = np.full(len(numbers), -1)
            of[members] = np.arange(len(members))
            held = of[item] >= 0
            terms, at = np.unique(term[held], return_inverse=True)
            counts = np.zeros((len(terms) + 1, len(members)), np.int64)  # the last row: terms of no member
            counts[at, of[item[held]]] = q[held]
            self.groups.append((members, terms, counts))
        self.numbers = numbers


def _maxima(of: np.ndarray, term: np.ndarray, val: np.ndarray, width: int):
    """Largest value by (node, term): arrays sorted by node."""
    key = of.astype(np.int64) * width + term
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[starts] // width, (key[starts] % width).astype(np.int64), np.maximum.reduceat(val[order], starts)


def _sums(of: np.ndarray, rows: np.ndarray):
    """Sums of ``rows`` by ``of`` (sorted): the distinct values of ``of`` and their sums."""
    starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    return of[starts], np.add.reduceat(rows, starts, axis=0)


def _chunks(batches: Iterator[pa.RecordBatch]):
    """Parts of the batches with at most ``CHUNK_POSTINGS`` postings (one document at least)."""
    for batch in batches:
        ends = np.asarray(batch.column(1).offsets, np.int64) - batch.column(1).offsets[0].as_py()
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + CHUNK_POSTINGS, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            part = batch.slice(start, stop - start)
            sizes = np.diff(ends[start:stop + 1])
            yield (part.column(0), np.repeat(np.arange(stop - start), sizes),
                   part.column(1).flatten().to_numpy(), part.column(2).flatten().to_numpy())
            start = stop


class _Best:
    """The best rows of every item so far and the weakest kth scores."""

    def __init__(self, items: int, k: int, floors: np.ndarray):
        self.k, self.floors, self.rows = k, floors.copy(), [[] for _ in range(items)]

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray, ids: pa.Array):
        good = (scores >= self.floors[item]) & (scores > 0)
        if good.sum() > self.k:
            good &= scores >= np.partition(scores[good], -self.k)[-self.k]
        new = [(-s, i is None, i) for s, i in zip(scores[good].tolist(), ids.take(pa.array(docs[good])).to_pylist())]
        if new:
            held = sorted(self.rows[item] + new, key=lambda r: r[:2] if r[1] else r)[:self.k]
            self.rows[item] = held
            if len(held) == self.k:
                self.floors[item] = max(self.floors[item], -held[-1][0])


def _visit(chunk, tree: ItemTree, best: _Best, promising_only: bool):
    ids, of, term, val = chunk
    width = tree.w_terms
    leaves = _maxima(of // LEAF, term, val, width)
    nodes = _maxima(leaves[0] // (NODE // LEAF), leaves[1], leaves[2], width)
    whole = _maxima(np.zeros_like(nodes[0]), nodes[1], nodes[2], width)
    local = np.full(width, -1)
    for members, terms, counts in tree.groups:
        largest = counts.max(axis=1)
        local[terms] = np.arange(len(terms))

        def bounds(level, among, by=largest):
            """Bounds of the nodes of a level that lie under ``among`` against the group."""
            at = local[level[1]]
            use = (at >= 0) & among
            if not use.any():
                return np.empty(0, np.int64), np.empty((0, *by.shape[1:]), np.int64)
            weight = level[2][use]
            return _sums(level[0][use], (weight[:, None] if by.ndim > 1 else weight) * by[at[use]])

        floor = 1 if promising_only else max(1, best.floors[members].min())
        _, top = bounds(whole, True)
        if len(top) and top[0] >= floor:
            node, bound = bounds(nodes, True)
            kept = node[bound >= floor]
            leaf, bound = bounds(leaves, np.isin(leaves[0] // (NODE // LEAF), kept))
            if promising_only:
                kept = leaf[[bound.argmax()]]
            else:
                kept = leaf[bound >= floor]
                leaf, single = bounds(leaves, np.isin(leaves[0], kept), counts)
                kept = leaf[(single >= np.maximum(1, best.floors[members])).any(axis=1)]
            doc, scores = bounds((of, term, val), np.isin(of // LEAF, kept), counts)
            for j, item in enumerate(members):
                best.add(item, scores[:, j], doc, ids)
        local[terms] = -1


def search_block(docs: DataFrame, tree: ItemTree, k: int) -> DataFrame:
    """``no, doc_id, score``: candidates that hold each item's k best."""
    sc, n = docs.sparkSession.sparkContext, len(tree.numbers)
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = sc.broadcast(tree)

    def run(batches, floors, promising_only):
        best = _Best(n, k, floors)
        for chunk in _chunks(batches):
            _visit(chunk, shared.value, best, promising_only)
        for no, rows in zip(shared.value.numbers.tolist(), best.rows):
            if rows:
                yield no, [r[2] for r in rows], [-r[0] for r in rows]

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for no, _, scores in run(batches, np.zeros(n, np.int64), True):
            yield pa.RecordBatch.from_arrays([pa.array([no] * len(scores), pa.int64()), pa.array(scores, pa.int64())],
                                             names=["no", "score"])

    first = Window.partitionBy("no").orderBy(F.desc("score"))
    found = docs.mapInArrow(seeds, "no bigint, score bigint").withColumn("r", F.row_number().over(first))
    kth = dict(found.where(F.col("r") <= k).groupBy("no").agg(F.min("score"), F.count(F.lit(1)).alias("c"))
               .where(F.col("c") == k).drop("c").collect())  # one row per item of the block
    floors = sc.broadcast(np.array([kth.get(no, 0) for no in tree.numbers.tolist()], np.int64))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        kind = first.schema.field(0).type

        def again():
            yield first
            yield from batches

        for no, held, scores in run(again(), floors.value, False):
            yield pa.RecordBatch.from_arrays([pa.array([no] * len(scores), pa.int64()), pa.array(held, kind),
                                              pa.array(scores, pa.int64())], names=["no", "doc_id", "score"])

    return docs.mapInArrow(search, f"no bigint, doc_id {kind}, score bigint")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP_K) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best ``docs`` (``doc_id, text``)
    for every row of ``items`` (``item_id, text``)."""
    numbered = scratch(items.select("item_id", "text", F.monotonically_increasing_id().alias("no")), "lexical-items")
    pairs = scratch(item_terms(numbered), "lexical-item-terms")
    size = pairs.agg(F.countDistinct("no").alias("items"), F.count(F.lit(1)).alias("pairs")).first()
    blocks = max(1, -(-size["items"] // BLOCK_ITEMS), -(-size["pairs"] // BLOCK_TERMS))
    found = None
    for block in range(blocks):
        rows = pairs.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == block).collect()  # about BLOCK_TERMS rows at most
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
        table = scratch(postings(docs, vocabulary), "lexical-postings")
        counts = table.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
        by_term = weights(table, counts["n"])
        w = np.zeros(max(1, len(vocabulary)), np.int64)
        w[list(by_term)] = list(by_term.values())
        numbers, item = np.unique(np.array([r["no"] for r in rows], np.int64), return_inverse=True)
        tree = ItemTree(numbers, item, np.array([vocabulary[bytes(r["term"])] for r in rows], np.int64),
                        np.array([r["q"] for r in rows], np.int64), w)
        documents = weighted(table, by_term, len(vocabulary), counts["n"], max(1, counts["l"] or 0))
        best = scratch(search_block(documents, tree, k), "lexical-candidates")
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("no", "item_id"), "no").select("item_id", "rank", "doc_id", "score")
