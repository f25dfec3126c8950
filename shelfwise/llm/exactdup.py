"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical after A-Z are set in lower case; a null
text counts as empty. Rows whose length nobody shares leave first, then rows
whose length and prefix hash nobody shares; only the rest are compared by the
hash of their whole text. Every step is a count per key, combined on the map
side; the shared keys filter the rows in place, and only the last step joins, on
the full hash, where Spark splits a key that holds a large part of the rows. No
group is gathered anywhere.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bits import passes
from shelfwise.llm.common import fresh, keyed, stage

PREFIX = 64


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _keys(text: Column) -> tuple[Column, Column, Column]:
    text = F.coalesce(text, F.lit(""))
    head = F.xxhash64(ascii_lower(F.substring(text, 1, PREFIX)))
    return F.octet_length(text).alias("size"), head.alias("head"), F.sha2(ascii_lower(text).cast("binary"), 256).alias("digest")


def _shared(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)


def _suspects(keys: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` whose length, and then length and prefix hash, other rows may share.

    The shared keys pass through a bit table, so no row moves; what it lets
    through too much, the full hash sorts out.
    """
    lengths = stage(_shared(keys, "size"), "lengths")
    heads = stage(_shared(keys.where(passes(lengths, "size")), "size", "head"), "heads")
    return rows.where(passes(heads, "size", "head"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: str = "shared") -> DataFrame:
    """(id_col, keep_id, group_size, kept, digest) of the rows of ``docs``.

    Of equal texts the row with the largest id stays; null ids count as the
    smallest, and of repeated rows one stays. ``digests="shared"`` reads whole
    texts only where length and prefix are shared, and returns the rows whose
    text occurs more than once; ``"all"`` returns every row and hashes every
    text in the first scan, for callers who want each digest. An empty table
    gives an empty result; other columns are not read.
    """
    size, head, digest = _keys(F.col("text"))
    rows = keyed(docs, id=id_col, text=text_col)
    number = F.monotonically_increasing_id().alias("row")
    if digests == "all":
        base = stage(rows.select("id", number, size, head, digest), "keys")
        full = _suspects(base, base)
    else:
        narrow = stage(rows.select(size, head), "keys")
        full = stage(_suspects(narrow, rows.select("id", "text", size, head)).select("id", number, "size", "head", digest), "full")
    groups = (
        full.groupBy("size", "digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row")).alias("keep"))
        .where("group_size > 1")
    )
    groups = stage(groups, "groups")
    if digests == "all":
        found = base.join(groups, ["size", "digest"], "left")
        alone = F.col("group_size").isNull()
        return found.select(
            F.col("id").alias(id_col),
            F.when(alone, F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (alone | (F.col("row") == F.col("keep.row"))).alias("kept"),
            "digest",
        )
    return full.join(groups, ["size", "digest"]).select(
        F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), F.col("group_size").cast("long"), (F.col("row") == F.col("keep.row")).alias("kept"), "digest"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without those that ``exact_groups`` drops.

    Rows go by id and digest, so only repeated rows (equal id and text) need a
    choice of their own; of those the greatest row stays. Rows whose id no group
    has pass in place; only the others are moved and hashed again.
    """
    gone, digest_of, once = fresh(docs, "gone", "digest", "row")
    groups = stage(exact_groups(docs, id_col, text_col), "groups")
    drop = groups.groupBy(F.col(id_col).alias(gone), F.col("digest").alias(digest_of)).agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    drop = stage(drop.where("n > 1 OR NOT stays"), "drop")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    known = docs.withColumn(gone, F.col(f"`{id_col}`"))
    suspect = passes(drop.select(gone), gone)
    marked = known.where(suspect).drop(gone).withColumn(digest_of, _keys(F.col(f"`{text_col}`"))[2])
    same = marked[id_col].eqNullSafe(drop[gone]) & (marked[digest_of] == drop[digest_of])
    again = marked.join(drop.where("stays"), same, "left_semi").groupBy(F.col(f"`{id_col}`"), digest_of).agg(F.max(F.struct(*columns)).alias(once))
    free, single = known.where(~suspect).select(*columns), marked.join(drop, same, "left_anti").select(*columns)
    return free.unionByName(single).unionByName(again.select(f"{once}.*"))
