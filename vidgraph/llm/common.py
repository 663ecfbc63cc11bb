"""Helpers of this package: scratch tables, guarded broadcasts, native word splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidgraph.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Runs of ASCII characters that are no letter and no digit end a word.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder under ``spark.checkpoint.dir`` and read it
    back: cuts the lineage, survives lost executors, and gives the planner the
    real size of the table."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit_bytes: int = 32 << 20) -> DataFrame:
    """Hint a broadcast only when the measured bytes of ``df`` (a scratch table)
    stay below the limit; otherwise Spark picks a shuffle join."""
    width = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind == "string":
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0)) + 24
        elif kind.startswith(("array", "map", "struct")):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0)) + 32
        else:
            width = width + 16
    size = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if size <= limit_bytes else df


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that the operator is about to add (names compare case-insensitively)."""
    low = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in low])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; pure ASCII texts take Spark's fast path."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Lower-cased words of a text (array; null text: null)."""
    return F.array_remove(F.split(lower_ascii(text), NOT_WORD), "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: the optimiser cannot
    copy the expression into the lambdas that use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_hash(text: Column) -> Column:
    """Tells rows of one ``doc_id`` with different texts apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def held_out(doc_id: Column) -> Column:
    """The evaluation fold: crc32 of the id's text modulo 3 is 1 (null id: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
