"""Mixing sources to target weights by Poisson replication.

Each source has a target repetition rate ``epochs * total * share / size``; sizes
count a text's code points plus one for its end.  Without given weights a
source's share is proportional to ``size ** alpha``.  A document's number of
copies is the Poisson distribution function of its source's rate, inverted at a
uniform number taken from a hash of seed and ``doc_id``; rates above
``MEAN_LIMIT`` are sums of equal independent parts, so the table of the function
stays short.  Copies are dealt and ordered by a hash: one global shuffle, without
sampling.  Rates depend on one row per source only, so a source that holds a
third of all rows is neither grouped nor moved by its key: the rates are broadcast
up to ``RATES_BYTES``; of more sources, those of over a thousandth of all bytes (fewer
than 1,000) are, and only the others' rows are joined by their key.

Defined cases: null texts count as empty; null sources are a source of their
own; a null ``doc_id`` draws like the text ``null``; repeated rows of one
``doc_id`` draw alike; a source without a weight, or with a null one, gets no copies
and counts in no total; a negative or not finite weight is an error; of several
weights of one source the largest counts; texts are kept whole whatever their length;
columns that clash with the added ones are replaced; an empty table gives an empty
table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidgraph.llm.common import quoted, scratch, without

MEAN_LIMIT = 64
RATES_BYTES = 32 << 20
ADDED = ["copy", "n_copies", "shuffle_key"]


def _digest(*parts) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def _uniform(*parts) -> Column:
    """52 bits of a hash as a number in [0, 1)."""
    return F.conv(F.substring(_digest(*parts), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def _poisson_table(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until it is 1 for every 52-bit number."""
    last = F.ceil(mean + 10 * F.sqrt(mean) + 40).cast("int")
    first = F.exp(-mean)
    start = F.struct(first.alias("term"), F.array(first).alias("cum"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * mean / k
        return F.struct(term.alias("term"), F.concat(acc["cum"], F.array(F.element_at(acc["cum"], -1) + term)).alias("cum"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["cum"])


def source_rates(docs: DataFrame, weights: DataFrame | None = None, alpha: float = 0.5,
                 epochs: float = 1.0) -> DataFrame:
    """``source, size, rate, parts, cdf``: one row per source (null-safe key)."""
    size = F.sum(F.length(F.coalesce("text", F.lit(""))) + 1).cast("bigint")
    sizes = scratch(docs.groupBy(F.col("source").alias("__source")).agg(size.alias("size")), "source-sizes")
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(alpha)))
    else:
        w = weights.groupBy("source").agg(F.max("weight").cast("double").alias("weight"),
                                          F.min("weight").cast("double").alias("least")).where("weight is not null")
        bad = w.where((F.col("least") < 0) | F.isnan("weight") | (F.col("weight") == float("inf")))
        if not bad.isEmpty():
            raise ValueError("weights must be finite and not negative")
        sizes = sizes.join(w.drop("least"), sizes["__source"].eqNullSafe(w["source"])).drop("source")
    total = sizes.agg(F.sum("size").alias("s"), F.sum("weight").cast("double").alias("w")).first()
    if not total["s"] or not total["w"]:
        sizes, total = sizes.where(F.lit(False)), {"s": 1, "w": 1.0}
    rate = F.col("weight").cast("double") / F.lit(total["w"]) * F.lit(float(epochs) * total["s"]) / F.col("size")
    sizes = sizes.withColumn("rate", rate).withColumn("parts", F.ceil(F.col("rate") / MEAN_LIMIT).cast("int"))
    sizes = sizes.where("parts > 0").withColumn("cdf", _poisson_table(F.col("rate") / F.col("parts")))
    return scratch(sizes, "source-rates")


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, alpha: float = 0.5, epochs: float = 1.0,
                seed: int = 42) -> DataFrame:
    """``docs`` (``doc_id, text, source``, any further columns) with each row
    repeated ``n_copies`` times (``copy`` counts from 1; no copies: no row), in
    the global order of ``shuffle_key``."""
    rates = source_rates(docs, weights, alpha, epochs)
    base = without(docs, *ADDED)
    near, far = _split_rates(rates)
    rows = _repeated(base, near, seed)
    if far is not None:
        rows = rows.unionByName(_repeated(base, far, seed))
    rows = rows.select("*", F.explode_outer(F.sequence(F.lit(1).cast("bigint"), "n_copies")).alias("copy"))
    rows = rows.withColumn("shuffle_key", _digest(F.lit(seed), F.lit("order"), F.col("doc_id"), F.col("copy")))
    return rows.repartition("shuffle_key").sortWithinPartitions("shuffle_key", "doc_id", "copy")


def _split_rates(rates: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rates to broadcast, and those of the smaller sources where all are too many."""
    found = rates.agg(F.sum(F.size("cdf") * 8 + F.coalesce(F.octet_length("__source"), F.lit(0)) + 64).alias("bytes"),
                      F.sum("size").alias("size")).first()
    if (found["bytes"] or 0) <= RATES_BYTES:
        return F.broadcast(rates), None
    large = F.col("size") * 1000 > found["size"]
    return F.broadcast(rates.where(large)), rates.where(~large)


def _repeated(base: DataFrame, rates: DataFrame, seed: int) -> DataFrame:
    """Rows of the sources in ``rates`` with ``n_copies`` above 0."""
    rows = base.join(rates, base["source"].eqNullSafe(rates["__source"]))
    draws = F.transform(F.sequence(F.lit(1), rates["parts"]), lambda part: _uniform(F.lit(seed), base["doc_id"], part))
    copies = F.aggregate(draws, F.lit(0), lambda acc, u: acc + F.size(F.filter(rates["cdf"], lambda c: c <= u)))
    columns = [base[f"`{c}`"] if "`" not in c else quoted(c) for c in base.columns]
    return rows.select(*columns, copies.cast("bigint").alias("n_copies")).where("n_copies > 0")
