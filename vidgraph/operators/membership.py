"""Membership tests against large stored tables: a bitmap before the exact join.

The keys of the smaller side set three bits each in one 64-bit word, chosen by their
hash; words are combined by ``bit_or`` (a partial aggregate) and broadcast.  A row of
the large side whose bits are not all set is not among the keys and is dropped in
the scan's own stage, before any exchange; the rest (all true members and, at 16 bits
a key, about one other row in a hundred) go on to the exact join.

The bitmap has at most ``MAX_WORDS`` words (32 MB as word and bits); more keys make it
fuller, and above 32 million keys (under 4 bits each) it is left out: results are the
same with and without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MIN_WORDS, MAX_WORDS = 64, 1 << 21


class KeyFilter:
    """Bitmap of the distinct values of ``columns`` in ``keys`` (about ``n_keys`` of
    them); rows with a null in a column are neither keys nor members."""

    def __init__(self, keys: DataFrame, columns: list[str], n_keys: int):
        wanted = 1 << max(0, n_keys * BITS_PER_KEY // 64 - 1).bit_length()
        self.words = min(max(wanted, MIN_WORDS), MAX_WORDS)
        self.useful = n_keys * 4 <= self.words * 64
        word, bits = self._place([F.col(c) for c in columns])
        held = keys.where(self._given(columns)).select(word.alias("_word"), bits.alias("_bits"))
        self.masks = held.groupBy("_word").agg(F.bit_or("_bits").alias("_mask"))

    @staticmethod
    def _given(columns: list[str]) -> Column:
        given = F.lit(True)
        for c in columns:
            given = given & F.col(c).isNotNull()
        return given

    def _place(self, values: list[Column]) -> tuple[Column, Column]:
        h = F.xxhash64(*values)
        bits = F.lit(0).cast("bigint")
        for shift in (40, 46, 52):
            at = F.call_function("shiftrightunsigned", h, F.lit(shift)).bitwiseAND(F.lit(63)).cast("int")
            bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
        return F.pmod(h, F.lit(self.words)), bits

    def maybe(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """The rows whose ``columns`` may be a key (every true member is kept)."""
        if not self.useful:
            return rows.where(self._given(columns))
        word, bits = self._place([F.col(c) for c in columns])
        tested = rows.where(self._given(columns)).withColumn("_at", word).withColumn("_bits", bits)
        # A semi join: Spark would push the exact semi join below an inner one.
        hit = (F.col("_at") == F.col("_word")) & (F.col("_mask").bitwiseAND(F.col("_bits")) == F.col("_bits"))
        found = tested.join(F.broadcast(self.masks), hit, "left_semi")
        return found.select(*[F.col(f"`{c}`") for c in rows.columns])
