"""Table maintenance: upserts, partition replacement, change logs and bounded logs.

Every operator returns the new state as a frame. Write it to a new path or with
``sources.tables.replace_partitions_at``; never over the path being read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions import text
from shelfwise.operators.rows import chunk_window, chunked, dedup, earlier_chunks, running_low


def upsert(
    target: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    keep_if_null: Sequence[str] = (),
    keep: Sequence[str] = (),
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``src`` replace those of ``target`` with the same key or are added.

    ``keep_if_null`` names columns where a null in ``src`` keeps the old value,
    ``keep`` those that an update never touches. Columns missing from ``src`` keep
    their old value. With ``order``, the last of several ``src`` rows of one key
    counts; without it keys in ``src`` must be unique.
    """
    keys = list(keys)
    if order is not None:
        src = dedup(src, keys, order, keep="last")
    rest = [name for name in target.columns if name not in keys]
    given = [name for name in rest if name in src.columns]
    old = target.select(*keys, F.struct(*rest).alias("_old"))
    new = src.select(*keys, F.struct(*given).alias("_new"))
    matched, added = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(name: str):
        if name not in given:
            return F.col(f"_old.{name}")
        fresh = F.col(f"_new.{name}").cast(target.schema[name].dataType)
        if name in keep:
            return F.when(matched, F.col(f"_old.{name}")).otherwise(fresh)
        if name in keep_if_null:
            return F.coalesce(fresh, F.col(f"_old.{name}"))
        return F.when(added, fresh).otherwise(F.col(f"_old.{name}"))

    joined = old.join(new, keys, "full")
    return joined.select(*keys, *[value(name).alias(name) for name in rest]).select(*target.columns)


def replace_partitions(target: DataFrame, src: DataFrame, part_cols: Sequence[str]) -> DataFrame:
    """Drop every ``target`` row whose partition occurs in ``src`` and add all rows of ``src``.

    For tables on disk ``sources.tables.replace_partitions_at`` does the same
    without reading the target at all.
    """
    kept = target.join(affected(src, part_cols), list(part_cols), "left_anti")
    return kept.unionByName(src, allowMissingColumns=True)


def affected(src: DataFrame, part_cols: Sequence[str]) -> DataFrame:
    return src.select(*part_cols).distinct()


def _net(deltas: DataFrame, keys: list[str], quantity: str) -> DataFrame:
    """Sum of the changes per key, added up before the shuffle."""
    found = [name for name in ("product_id", "last_restocked") if name in deltas.columns]
    pick = {"product_id": F.min, "last_restocked": F.max}
    return deltas.groupBy(*keys).agg(
        F.sum(quantity).cast("bigint").alias("_delta"), *[pick[name](name).alias(f"_{name}") for name in found]
    )


def apply_deltas(stock: DataFrame, deltas: DataFrame, keys: Sequence[str] = ("store_id", "sku")) -> DataFrame:
    """Add ``deltas.quantity`` to the stock of each key; unknown keys start from zero.

    ``last_restocked``, where the deltas carry it, becomes the newest date seen.
    """
    keys = list(keys)
    net = _net(deltas, keys, "quantity")
    joined = stock.withColumn("_known", F.lit(True)).join(net, keys, "full")

    def value(name: str):
        if name == "quantity":
            return F.coalesce("quantity", F.lit(0)) + F.coalesce("_delta", F.lit(0))
        if name == "last_restocked" and "_last_restocked" in net.columns:
            return F.coalesce("_last_restocked", "last_restocked")
        if name == "product_id" and "_product_id" in net.columns:
            return F.when(F.col("_known"), F.col("product_id")).otherwise(
                F.col("_product_id").cast(stock.schema["product_id"].dataType)
            )
        return F.col(name)

    return joined.select(*[value(name).alias(name) for name in stock.columns])


def apply_imports(stock: DataFrame, imports: DataFrame) -> DataFrame:
    """Book stock imports: positive quantities are added and the import date becomes the restocking date."""
    valid = imports.where(F.col("quantity_imported") > 0)
    return apply_deltas(
        stock,
        valid.select(
            "store_id",
            "sku",
            "product_id",
            F.col("quantity_imported").alias("quantity"),
            F.col("import_date").alias("last_restocked"),
        ),
    )


def sale_deltas(tx: DataFrame) -> DataFrame:
    """Sales as negative stock changes; lines without a store, a SKU or a positive quantity change nothing."""
    sold = (F.col("quantity") > 0) & F.col("store_id").isNotNull() & (F.coalesce("sku", F.lit("")) != "")
    return tx.where(sold).select("store_id", "sku", "product_id", (-F.col("quantity")).alias("quantity"))


def apply_sales(stock: DataFrame, tx: DataFrame) -> DataFrame:
    """Subtract sales from stock; stock may go below zero, which ``warn`` tells."""
    return apply_deltas(stock, sale_deltas(tx)).withColumn("warn", F.col("quantity") < 0)


def adjust_stock(stock: DataFrame, changes: DataFrame, order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Change stock by ``delta`` per key, never below zero; returns (new stock, changes of unknown keys).

    Changes of one key are applied one after the other in ``order`` and each is
    clamped. A whole run of clamped changes equals one step: the sum of all
    changes, raised by how far the running sum dips below what was there. Both
    come from running sums, so no row-by-row loop is needed.
    """
    keys = ["store_id", "sku"]
    known = changes.join(stock.select(*keys), keys, "left_semi")
    unknown = changes.join(stock.select(*keys), keys, "left_anti")
    if order:
        net = running_low(known, keys, list(order), "delta")
    else:
        net = known.groupBy(*keys).agg(F.sum("delta").alias("total")).withColumn("low", F.least(F.lit(0), "total"))
    total, low = F.coalesce("total", F.lit(0)), F.coalesce("low", F.lit(0))
    lifted = F.greatest(F.lit(0), -(F.col("quantity") + low))
    quantity = F.when(F.col("total").isNull(), F.col("quantity")).otherwise(F.col("quantity") + total + lifted)
    out = stock.join(net, keys, "left").withColumn("quantity", quantity.cast(stock.schema["quantity"].dataType))
    return out.select(*stock.columns), unknown


def set_stock(stock: DataFrame, levels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overwrite quantities of known keys; returns (new stock, levels of unknown keys)."""
    keys = ["store_id", "sku"]
    known = levels.join(stock.select(*keys), keys, "left_semi")
    unknown = levels.join(stock.select(*keys), keys, "left_anti")
    return upsert(stock, known.select(*keys, "quantity"), keys), unknown


def seed_stock(tx: DataFrame, share: float = 0.2, restock_days: int = 7, existing: DataFrame | None = None) -> DataFrame:
    """Opening stock per (store, SKU): a fifth of all units ever sold, restocked a week after the last sale.

    With a non-empty ``existing`` table nothing is seeded. Several products under
    one SKU are one stock row, under the smallest product id.
    """
    sold = tx.where((F.col("quantity") > 0) & F.col("store_id").isNotNull() & F.col("sku").isNotNull())
    if existing is not None:
        sold = sold.where(existing.agg(F.count(F.lit(1)).alias("value")).scalar() == 0)
    return sold.groupBy("store_id", "sku").agg(
        F.min("product_id").alias("product_id"),
        F.greatest(F.lit(0), F.round(F.sum("quantity") * F.lit(share))).cast("bigint").alias("quantity"),
        F.date_add(F.max(F.to_date("transaction_date")), restock_days).alias("last_restocked"),
    )


def init_stock(stock: DataFrame, skus: DataFrame, first: int = 1, last: int = 35) -> DataFrame:
    """Stock plus a zero row for each new SKU in each store of the range; existing rows stay as they are."""
    grid = skus.select("sku").distinct().select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("store_id"), "sku")
    fresh = grid.join(stock.select("store_id", "sku"), ["store_id", "sku"], "left_anti")
    return stock.unionByName(fresh.withColumn("quantity", F.lit(0).cast("bigint")), allowMissingColumns=True)


def drop_product_stock(stock: DataFrame, products: DataFrame) -> DataFrame:
    """Stock without the rows of the given products under any spelling of their SKUs."""
    spellings = F.array_compact(F.array_append(text.sku_spellings(F.col("product_id")), F.nullif("sku", F.lit(""))))
    gone = products.select(F.explode(spellings).alias("sku")).distinct()
    return stock.join(gone, "sku", "left_anti").select(*stock.columns)


def apply_changes(
    base: DataFrame, changes: DataFrame, key: str | Sequence[str], order: str = "seq"
) -> tuple[DataFrame, DataFrame]:
    """Apply a change log to a table in ``order``; returns (new snapshot, rejected changes).

    ``changes`` holds the key, ``op`` (insert, update or delete), a unique position
    ``order`` and any of the table's columns. An insert of an existing key is
    rejected with status 409, an update or delete of a missing key with 404. A
    null field of an update leaves the stored value as it is.

    Whether a key exists before a change depends only on the last insert or
    delete before it, accepted or not: afterwards the key exists or does not. So
    one running value judges every change, and the record itself is an aggregate:
    each field's last given value since the record was last created.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [name for name in base.columns if name not in keys]
    fresh = [name for name in rest if name in changes.columns]
    log = chunked(changes, keys, [order])
    turn = F.when(F.col("op").isin("insert", "delete"), F.col("op"))
    before = chunk_window(keys, [order]).rowsBetween(W.unboundedPreceding, -1)
    ends = (
        log.groupBy(*keys, "_chunk")
        .agg(F.max_by(turn, F.when(turn.isNotNull(), F.col(order))).alias("_turn"))
        .select(*keys, "_chunk", F.last("_turn", ignorenulls=True).over(earlier_chunks(keys)).alias("_carried"))
        .where(F.col("_carried").isNotNull())
    )
    known = base.select(*keys, F.lit("insert").alias("_known"))
    state = F.coalesce("_turn", "_carried", "_known", F.lit("delete"))
    exists = state == "insert"
    judged = (
        log.withColumn("_turn", F.last(turn, ignorenulls=True).over(before))
        .join(ends, [*keys, "_chunk"], "left")
        .join(known, keys, "left")
        .withColumn(
            "status",
            F.when((F.col("op") == "insert") & exists, 409).when((F.col("op") != "insert") & ~exists, 404),
        )
    )
    rejects = judged.where(F.col("status").isNotNull()).select(*keys, "op", order, "status")
    good = judged.where(F.col("status").isNull())

    at, is_turn = F.col(order), turn.isNotNull()
    patch = good.groupBy(*keys).agg(
        F.max(F.when(is_turn, at)).alias("_since"),
        F.max_by("op", F.when(is_turn, at)).alias("_op"),
        *[F.max(F.when(F.col(name).isNotNull(), F.struct(at.alias("at"), F.col(name).alias("value")))).alias(f"_{name}")
          for name in fresh],
    )
    created = F.col("_since").isNotNull()

    def value(name: str):
        if name not in fresh:
            return F.when(~created, F.col(name))
        given = F.col(f"_{name}")
        stored = given["value"].cast(base.schema[name].dataType)
        return F.when(created, F.when(given["at"] >= F.col("_since"), stored)).otherwise(
            F.coalesce(stored, F.col(name))
        )

    snapshot = (
        base.join(patch, keys, "full")
        .where(F.coalesce(F.col("_op") != "delete", F.lit(True)))
        .select(*keys, *[value(name).alias(name) for name in rest])
        .select(*base.columns)
    )
    return snapshot, rejects


def retain_latest(df: DataFrame, n: int = 1000, order: Sequence[str] = ("timestamp", "id")) -> DataFrame:
    """The newest ``n`` rows of a log; each task keeps its own newest ``n`` before they are merged."""
    return df.orderBy(*[F.col(name).desc_nulls_last() for name in order]).limit(n)
