"""Language identification by compression.

Each language has a zstandard raw-content dictionary: the texts of a bounded
sample of its rows.  A text is normalised (lower case, runs of other characters
than letters become one blank) and compressed with every dictionary, in pieces
short enough that a word's repeats count each time they come; the smallest sum
wins.  The last piece gets a constant tail that compresses well: else the format
would store a short one uncompressed and all sizes would tie.  The score is a
softmax over the saved bits, so a narrow margin gives a score near 1 / languages;
below ``min_score`` the prediction is ``rejected`` (the best guess stays in
``lang_pred``).

Every label is learned.  Of each, ``SAMPLE_ROWS`` distinct texts (all, if fewer) are
picked by a hash of the text: a threshold on the hash, from an estimate of the
label's distinct texts, leaves a few hundred in each task's scan, and the smallest
of those are taken, so no task sees a label's rows.  A text gives bytes spread over
its whole length, shorter ones all they have.  A dictionary has ``DICTIONARY_BYTES``
at most, all together ``MODEL_BYTES`` (with very many labels each gets its share);
it is built in a task, and that is what the driver collects and broadcasts.
Prediction reads every text as a whole.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
rejected; equal sizes go to the language with the smaller name; no labelled row
at all: every text is ``und``; rows with a null ``doc_id`` are not held out, repeated
rows are predicted alike; columns that clash with the added ones are replaced; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vidgraph.llm.common import held_out, text_hash

SAMPLE_ROWS, DICTIONARY_BYTES, MODEL_BYTES = 384, 1 << 18, 1 << 26
PIECE, LEVEL = 512, 5
EXCERPT = 256  # bytes of one of the places that a long training text gives
TAIL = b" " + b"#" * 64
MIN_SCORE = 0.6
UNKNOWN = "und"
_NOT_LETTERS = regex.compile(r"[^\p{L}]+")


def normalise(text: str) -> bytes:
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def training_rows(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``lang, text``: at most ``rows`` distinct texts a language, the smallest
    hashes of those outside the held-out fold."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select("lang", "text", text_hash(F.col("text")).alias("h"))
    # Copies are one text.  Three times the wanted share of the hashes: fewer than wanted is out of the question.
    share = F.lit(3.0 * rows) / F.greatest(F.approx_count_distinct("h", 0.05), F.lit(1))
    share = known.groupBy("lang").agg(F.least(share, F.lit(1.0)).alias("share"))
    below = F.col("h").cast("double") <= F.lit(-(2.0 ** 63)) + F.lit(2.0 ** 64) * F.col("share")
    near = known.join(F.broadcast(share), "lang").where(below)  # one row a label, each of which has its dictionary anyway
    picked = near.select("lang", "h").distinct()  # about 3 * rows a language
    picked = picked.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    picked = picked.where(F.col("n") <= rows).select("lang", "h")
    return near.join(picked, ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"))


def excerpt(raw: bytes, size: int) -> bytes:
    """``size`` bytes of ``raw`` (all, if shorter) from places spread evenly from its start to its end."""
    if len(raw) <= size:
        return raw
    places = max(1, size // EXCERPT)
    width = size // places
    if places == 1:
        start = (len(raw) - width) // 2
        return raw[start:start + width]
    return b"".join(raw[i * (len(raw) - width) // (places - 1):][:width] for i in range(places))


def dictionary(texts: list[bytes], size: int) -> bytes:
    """Content of ``size`` bytes at most: equal shares, what short texts leave goes to longer ones."""
    parts, kept, left = sorted(texts, key=lambda p: (len(p), p)), [], size
    for i, p in enumerate(parts):
        kept.append(excerpt(p, left // (len(parts) - i)))
        left -= len(kept[-1])
    return b" ".join(p for p in kept if p)


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, size: int = DICTIONARY_BYTES, model: int = MODEL_BYTES) -> dict[str, bytes]:
    """Language -> dictionary content; at most ``size`` bytes each and about ``model`` in all."""
    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [excerpt(normalise(t.as_py()), size) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["lang", "raw"])

    sample = training_rows(docs, rows).select("lang", "text").mapInArrow(normal, "lang string, raw binary")
    langs = docs.where(F.col("lang").isNotNull()).select("lang").distinct().count()
    size = max(1, min(size, model // max(1, langs)))

    def build(group: pa.Table) -> pa.Table:  # at most ``rows`` texts of ``size`` bytes
        content = dictionary(group.column("raw").to_pylist(), size)
        return pa.table({"lang": group.column("lang").slice(0, 1), "content": pa.array([content], pa.binary())})

    made = sample.groupBy("lang").applyInArrow(build, "lang string, content binary")
    return {r["lang"]: bytes(r["content"]) for r in made.collect() if r["content"]}


class Classifier:
    """The compressors of all languages."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.compressors = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int] | None:
        """Compressed bytes by language; whole texts, in pieces that know the
        dictionary but not each other.  None: no letter."""
        raw = normalise(text)
        if not raw or not self.langs:
            return None
        pieces = [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]
        pieces[-1] += TAIL
        return [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float]:
        sizes = self.sizes(text) if text else None
        if sizes is None:
            return UNKNOWN, 0.0
        best = min(range(len(sizes)), key=sizes.__getitem__)
        # Half the saved bytes in bits: neighbouring symbols are not independent.
        return self.langs[best], 1.0 / sum(2.0 ** -min(4.0 * (s - sizes[best]), 1000.0) for s in sizes)


def _predict(batches: Iterator[pa.RecordBatch], dictionaries) -> Iterator[pa.RecordBatch]:
    model = Classifier(dictionaries.value)
    for batch in batches:
        found = [model.predict(t.as_py()) for t in batch.column(batch.num_columns - 1)]
        out = pa.StructArray.from_arrays(
            [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
            names=["lang_pred", "score"])
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out.flatten()],
                                         names=[*batch.schema.names[:-1], "lang_pred", "score"])


def identify(docs: DataFrame, model_docs: DataFrame | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` per row of ``docs`` (``doc_id,
    text``); the model is learned from ``model_docs`` (default: ``docs``)."""
    source = docs if model_docs is None else model_docs
    model = docs.sparkSession.sparkContext.broadcast(train(source))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    out = rows.mapInArrow(lambda it: _predict(it, model),
                          f"doc_id {kind}, held_out boolean, lang_pred string, score double")
    return out.withColumn("rejected", F.col("score") < min_score)
