"""A bounded screen for keys, made of built-in functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 18            # of 64 bits


def screen(keys: DataFrame, columns: Sequence[str], words: int = WORDS) -> DataFrame:
    """A table of bits of which every key in ``columns`` has set one: ``words``
    rows at most, so it can be broadcast however many keys there are."""
    word, bit = _place(columns, words)
    return (keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word")
            .agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits")))


def _place(columns: Sequence[str], words: int):
    h = F.xxhash64(*columns)
    return F.pmod(h, F.lit(words)), F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")


def marked(df: DataFrame, columns: Sequence[str], bits: DataFrame, out: str, words: int = WORDS) -> DataFrame:
    """``df`` with a column ``out``: false where a row's key is certainly none of
    the screen's, true for every key that is one (and for a few others). Column
    types must be those of the screen's keys."""
    word, bit = _place(columns, words)
    return (df.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bits), "_word", "left")
            .withColumn(out, F.coalesce(F.getbit("_bits", "_bit") == 1, F.lit(False)))
            .drop("_word", "_bit", "_bits"))


def screened(df: DataFrame, columns: Sequence[str], bits: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows of ``df`` that the screen can't rule out."""
    word, bit = _place(columns, words)
    return (df.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bits), "_word")
            .where(F.getbit("_bits", "_bit") == 1).drop("_word", "_bit", "_bits"))
