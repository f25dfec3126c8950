"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixed corpus, and so a mean repetition
rate: target bytes over present bytes. A row's number of copies is a Poisson
draw with that mean, made by inverting the distribution at a uniform number that
comes from a hash of the seed and the row's id: the same row gets the same
copies in every run. Copies are exploded and dealt out by another hash, so that
the result is shuffled over the whole corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh, stage

#: Hash digits that make a uniform number: 13 hexadecimal digits are 52 bits.
DIGITS = 13
#: How far the distribution is written out, in standard deviations past the mean; the rest has no 2^-52 of mass.
TAIL = 12


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the hash of ``parts``."""
    return hashed(*parts) / F.lit(float(16**DIGITS))


def hashed(*parts: Column) -> Column:
    text = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("long")


def poisson_steps(mean: Column) -> Column:
    """The cumulative Poisson probabilities of 0, 1, 2, ... as an array."""
    last = F.ceil(mean + TAIL * F.sqrt(mean) + 30).cast("int")
    start = F.struct((-mean).alias("log"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("steps"))

    def step(state: Column, k: Column) -> Column:
        log = state["log"] + F.log(mean) - F.log(k.cast("double"))
        total = state["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(state["steps"], F.array(total)).alias("steps"))

    return F.when(mean > 0, F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["steps"])).otherwise(F.array(F.lit(1.0)))


def rates(docs: DataFrame, source_col: str, text_col: str, weights: dict | None, temperature: float, size: float) -> DataFrame:
    """(source, rate, steps): the mean copies of a row per source; one row per source.

    Shares follow ``weights`` (sources that it doesn't name get none), or the
    present bytes to the power ``temperature``. ``size`` is the mixed corpus'
    bytes over the present ones. A source without bytes has rate 0.
    """
    bytes_of = F.sum(F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0))).cast("long")
    present = docs.groupBy(F.col(f"`{source_col}`").alias("source")).agg(bytes_of.alias("bytes"))
    if weights is None:
        weight = F.pow(F.col("bytes").cast("double"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for source, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(value))).otherwise(weight)
    present = stage(present.withColumn("weight", F.when(F.col("bytes") > 0, weight).otherwise(0.0)), "sources")
    total = present.agg(F.sum("bytes").alias("v")).scalar().cast("double")
    weighed = present.agg(F.sum("weight").alias("v")).scalar()
    rate = F.when((F.col("bytes") > 0) & (weighed > 0), F.col("weight") / weighed * total * size / F.col("bytes")).otherwise(0.0)
    rated = present.select("source", rate.alias("rate"))
    return stage(rated.withColumn("steps", poisson_steps(F.col("rate"))), "rates")


def mix(
    docs: DataFrame,
    weights: dict | None = None,
    temperature: float = 0.5,
    size: float = 1.0,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    numbers: bool = False,
) -> DataFrame:
    """The rows of ``docs``, each as often as its source's draw says, in an order shuffled over the whole corpus.

    A null source is a source of its own; null ids share one draw, as do
    repeated rows; rows of sources with rate 0 have no copy. An empty table
    gives an empty result. With ``numbers``, columns ``copy`` (from 1) and
    ``order_key`` follow; they replace columns of that name.
    """
    if numbers:
        docs = docs.drop("copy", "order_key")
    of, steps, copy, key = fresh(docs, "of", "steps", "copy", "key")
    # The staged table has its true size, so Spark broadcasts it only below its own limit.
    table = rates(docs, source_col, text_col, weights, temperature, size).select(F.col("source").alias(of), F.col("steps").alias(steps))
    source, row_id = F.col(f"`{source_col}`"), F.col(f"`{id_col}`")
    joined = docs.join(table, source.eqNullSafe(F.col(of)))
    draw = uniform(F.lit(seed), row_id)
    copies = F.size(F.filter(F.col(steps), lambda c: c <= draw))
    many = joined.withColumn(copy, F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
    many = many.withColumn(key, hashed(F.lit(seed + 1), row_id, F.col(copy))).drop(of, steps)
    mixed = many.repartition(F.col(key)).sortWithinPartitions(key, *(F.col(f"`{c}`") for c in (id_col, copy)))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return mixed.select(*names, F.col(copy).alias("copy"), F.col(key).alias("order_key")) if numbers else mixed.select(*names)
