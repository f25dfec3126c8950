"""A bit table of fixed size over many keys: a native filter that lets all keys of a set through, and few others.

Its size does not depend on the number of keys (128 KB at 2^20 bits); the fuller
it is, the more it lets through, which costs time and never a row. An exact join
always follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stage

BITS = 1 << 20


def passes(keys: DataFrame, *columns: str, bits: int = BITS) -> Column:
    """A condition on another frame with the same ``columns``: its key may be one of ``keys``."""
    bit = F.pmod(F.xxhash64(*columns), F.lit(bits))
    word, place = F.floor(bit / 64).cast("int"), (bit % 64).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    filled = keys.select(word.alias("word"), one.alias("one")).groupBy("word").agg(F.bit_or("one").alias("bits"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"))
    cell = F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    whole = every.join(filled, "word", "left").agg(F.array_sort(F.collect_list(cell)).getField("bits").alias("bits"))
    return F.getbit(F.element_at(stage(whole, "bits").scalar(), word + 1), place) == 1
