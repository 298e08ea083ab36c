"""Which rows of a large table may hold a key, without a shuffle of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a key filter. It has at most so many rows, whatever the number of keys, so it may be sent to
#: every task; with more keys than bits it lets more rows through than needed.
FILTER_WORDS = 1 << 14


def key_filter(keys: DataFrame, key: str, words: int = FILTER_WORDS) -> DataFrame:
    """``_word`` and ``_bits``: a bit set with a bit for the hash of every key."""
    hashed = keys.select(F.xxhash64(F.col(f"`{key}`")).alias("_hash"))
    return hashed.selectExpr(f"pmod(_hash, {words}) AS _word", "shiftleft(1L, cast(shiftrightunsigned(_hash, 40) & 63 AS int)) AS _bit").groupBy(
        "_word"
    ).agg(F.bit_or("_bit").alias("_bits"))


def marked(df: DataFrame, keys: DataFrame, key: str, words: int = FILTER_WORDS, mark: str = "_may") -> DataFrame:
    """The rows with ``mark``: true for all rows that hold one of the keys, false for nearly all others."""
    hashed = df.withColumn("_hash", F.xxhash64(F.col(f"`{key}`"))).withColumn("_word", F.expr(f"pmod(_hash, {words})"))
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(_hash, 40) & 63 AS int))")
    held = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))
    return hashed.join(F.broadcast(key_filter(keys, key, words)), "_word", "left").withColumn(mark, held).drop("_hash", "_word", "_bits")
