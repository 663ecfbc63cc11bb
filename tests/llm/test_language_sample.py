"""op6: copies of one text do not use up a language's training sample."""

from pyspark.sql import functions as F

from vidgraph.llm import language
from vidgraph.llm.common import text_hash


def test_copies_do_not_shrink_the_sample(spark):
    docs = spark.range(3000).select((F.col("id") * 3).alias("doc_id"), F.lit("en").alias("lang"),
                                    F.concat(F.lit("text number "), F.col("id")).alias("text"))
    least = docs.where(~language.held_out(F.col("doc_id"))).orderBy(text_hash(F.col("text"))).first()["text"]
    copies = spark.range(400).select((F.col("id") + 100_000).alias("doc_id"), F.lit("en").alias("lang"),
                                     F.lit(least).alias("text"))
    found = [r["text"] for r in language.training_rows(docs.unionByName(copies)).collect()]
    assert least in found and len(found) == len(set(found)) == language.SAMPLE_ROWS
