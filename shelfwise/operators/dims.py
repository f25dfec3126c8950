"""Joins of facts with products, stores, employees and stock.

No join here carries a broadcast hint unless the hinted frame is bounded by its
construction: Spark's own size checks (at planning time for files, at run time
through adaptive execution) decide, and the skew-join rule splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import money, text
from shelfwise.operators import clean
from shelfwise.operators.aggregate import ATTRIBUTES, PLACES
from shelfwise.operators.rows import dedup


def join_dims(tx: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Clean transactions with their product and store attributes and the resolved SKU.

    ``products`` and ``stores`` must be unique on their ids (see ``dedup``), or
    sales would be counted several times.
    """
    product = products.select("product_id", "sku_prod", "usd_price", *ATTRIBUTES)
    store = stores.select("store_id", *PLACES, "num_distinct_products", "num_distinct_skus")
    joined = tx.drop("sku").join(product, "product_id", "left").join(store, "store_id", "left")
    joined = clean.resolve_sku(joined)
    joined = clean.fill_text(joined, [*ATTRIBUTES, *PLACES], "Unknown")
    joined = clean.fill_num(joined, ["discount_pct", "usd_price"], 0.0)
    return joined.drop("sku_original", "sku_prod")


def priced_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """What the daily totals need: ``aggregate.combined_lines`` with resolved SKU and dollar price.

    A product with a third of all sales is one row per (store, SKU, day) by now,
    and how the products are joined is left to Spark.
    """
    product = products.select("product_id", "sku_prod", "usd_price", "size", "color")
    return clean.resolve_sku(lines.join(product, "product_id", "left")).select(
        "store_id", "sku", "tx_date", "product_id", "quantity", "usd_price", "shares", "n"
    )


def describe(daily: DataFrame, products: DataFrame | None, stores: DataFrame) -> DataFrame:
    """Attach product and store attributes to daily rows; unknown texts become 'Unknown'.

    Leave out ``products`` when the product attributes are there already. Stores
    come in staged (see ``session.stage``) in large jobs: a store may own a third
    of all rows, and only a table of known size is broadcast instead of shuffled.
    """
    out = daily
    if products is not None:
        out = out.join(products.select("product_id", *ATTRIBUTES), "product_id", "left")
    store = stores.select("store_id", *PLACES, "num_distinct_products", "num_distinct_skus")
    return clean.fill_text(out.join(store, "store_id", "left"), [*ATTRIBUTES, *PLACES], "Unknown")


def sku_catalog(stock: DataFrame, daily: DataFrame, store: int | None = None) -> DataFrame:
    """Stocked SKUs with the attributes of their newest feature row; SKUs without one keep nulls."""
    if store is not None:
        stock = stock.where(F.col("store_id") == store)
        daily = daily.where(F.col("store_id") == store)
    shown = ("category", "sub_category", "color", "size", "color_type", "avg_usd_price")
    newest = (
        daily.groupBy("store_id", "sku")
        .agg(F.max_by(F.struct(*shown), "date").alias("newest"))
        .select("store_id", "sku", "newest.*")
    )
    return stock.select("store_id", "sku", "product_id").join(newest, ["store_id", "sku"], "left")


def named_products(products: DataFrame) -> DataFrame:
    """(product_id, product_name) with one row per id."""
    name = F.coalesce(F.nullif("description_en", F.lit("")), F.nullif("name_en", F.lit("")))
    return products.groupBy(F.col("product_id").try_cast("bigint").alias("product_id")).agg(
        F.min(name).alias("product_name")
    )


def inventory_view(
    inventory: DataFrame, skus: DataFrame, products: DataFrame, low: int = 15, keep_unmatched: bool = False
) -> DataFrame:
    """Stock rows with product name, category and a low-stock flag; placeholder SKUs are left out."""
    how = "left" if keep_unmatched else "inner"
    name = F.coalesce("product_name", text.numbered_label(text.PRODUCT_LABEL, F.col("sku"), ""))
    return (
        inventory.where(~F.lower("sku").contains("string") & (F.col("sku") != ""))
        .join(skus.select("sku", "product_id"), "sku", how)
        .join(products.select("product_id", "product_name", "category"), "product_id", how)
        .select(
            "store_id",
            "sku",
            "stock_quantity",
            name.alias("product_name"),
            F.coalesce("category", F.lit("Clothing")).alias("category"),
            (F.col("stock_quantity") <= low).alias("low_stock"),
        )
    )


def transactions_view(tx: DataFrame, products: DataFrame, employees: DataFrame) -> DataFrame:
    """Transactions with product name, the salesperson's account label and portal defaults."""
    sellers = employees.select(
        F.col("employee_id").cast("string").alias("employee_id"),
        text.salesperson_label(F.col("position"), F.col("store_id")).alias("salesperson"),
    )
    quantity = F.coalesce(F.nullif("quantity", F.lit(0)), F.lit(1))
    price = F.coalesce("unit_price", F.lit(0.0))
    return (
        tx.withColumn("employee_id", F.col("employee_id").cast("string"))
        .join(products.select("product_id", "product_name"), "product_id", "left")
        .join(sellers, "employee_id", "left")
        .select(
            "transaction_id",
            "store_id",
            "customer_id",
            "product_id",
            F.coalesce(
                F.nullif("sku", F.lit("")), F.concat(F.lit("SKU-"), F.col("product_id").cast("string"))
            ).alias("sku"),
            F.coalesce("product_name", text.numbered_label(text.PRODUCT_LABEL, F.col("product_id"))).alias(
                "product_name"
            ),
            F.to_date("transaction_date").alias("date"),
            F.coalesce("salesperson", F.nullif("employee_id", F.lit("")), F.lit("System")).alias("salesperson"),
            text.text_or_default(F.col("payment_method"), "Cash").alias("payment_method"),
            text.text_or_default(F.col("currency"), "USD").alias("currency"),
            price.alias("usd_price"),
            quantity.alias("quantity"),
            money.line_total(F.col("line_total"), F.col("unit_price"), F.col("quantity")).alias("line_total"),
        )
    )


def imports_view(
    imports: DataFrame, stores: DataFrame, products: DataFrame, store: int | None = None, newest: int = 150
) -> DataFrame:
    """The newest imports with store and product names. The top rows are taken first, so the joins are tiny."""
    if store is not None:
        imports = imports.where(F.col("store_id") == store)
    top = (
        imports.orderBy(F.col("import_date").desc_nulls_last(), F.col("import_id").desc())
        .limit(newest)
        .withColumn("product_id", text.sku_product_id(F.col("sku")))
    )
    return (
        top.join(stores.select("store_id", "store_name"), "store_id", "left")
        .join(named_products(products), "product_id", "left")
        .select(
            "import_id",
            "store_id",
            "sku",
            "quantity",
            "import_date",
            text.text_or_default(F.col("supplier"), "N/A").alias("supplier"),
            F.coalesce("store_name", text.numbered_label(text.STORE_LABEL, F.col("store_id"))).alias("store_name"),
            F.coalesce("product_name", text.numbered_label(text.PRODUCT_LABEL, F.col("sku"), "")).alias("product_name"),
        )
    )


def assign_employee(sales: DataFrame, employees: DataFrame) -> DataFrame:
    """The first employee of the sale's store, else the first of all, else '1'. First means smallest id."""
    first = F.min("employee_id").cast("string")
    per_store = employees.groupBy("store_id").agg(first.alias("_own"))
    anyone = employees.agg(first.alias("value")).scalar()
    return sales.join(per_store, "store_id", "left").withColumn(
        "employee_id", F.coalesce("_own", anyone, F.lit("1"))
    ).drop("_own")


def reconcile_stock(remote: DataFrame, local: DataFrame, default_category: str = "Clothing") -> DataFrame:
    """Stock of two sources on (store, SKU): the greater quantity counts."""
    keys = ["store_id", "sku"]
    a = remote.select(*keys, F.coalesce("quantity", F.lit(0)).alias("_a"))
    b = local.select(*keys, F.coalesce("quantity", F.lit(0)).alias("_b"))
    # greatest() skips nulls, so a row of only one side keeps its own quantity.
    quantity = F.greatest("_a", "_b")
    return a.join(b, keys, "full").select(
        *keys, quantity.alias("stock_quantity"), text.sku_category(F.col("sku"), default_category).alias("category")
    )


def append_missing(base: DataFrame, extra: DataFrame, key: list[str]) -> DataFrame:
    """``base`` plus the rows of ``extra`` whose key it lacks; of several such rows with one key, one is added."""
    order = [name for name in extra.columns if name not in key]
    fresh = extra.join(base.select(*key), key, "left_anti")
    return base.unionByName(dedup(fresh, key, order) if order else fresh.distinct(), allowMissingColumns=True)


def product_stock(products: DataFrame, inventory: DataFrame) -> DataFrame:
    """Total stock per product over the stock rows that belong to it.

    A row belongs to a product if its SKU digits are the product id, or the names
    are equal (trimmed, any case), or its SKU starts with the product's SKU
    without trailing dashes. Rows matched by several rules count once, which is
    done by inclusion and exclusion over the seven rule combinations: every
    combination is an equality on its keys, so stock is summed per key first and
    joined once. No pair of product and stock row is ever built, whatever the
    number of equal names.
    """
    def folded(name: str) -> Column:
        return F.when(F.coalesce(F.col(name), F.lit("")) != "", F.trim(F.lower(name)))

    def key(**parts: Column) -> Column:
        """One key per rule combination; null as soon as one of its parts is."""
        return F.concat(F.lit(" ".join(parts)), *[F.concat(F.lit("\u0001"), part) for part in parts.values()])

    start = F.regexp_replace(F.nullif("sku", F.lit("")), "-+$", "")
    # Only lengths that some product SKU has are worth a prefix.
    lengths = products.agg(F.collect_set(F.length(start)).alias("value")).scalar()
    items = (
        inventory.select(
            text.sku_product_id(F.col("sku")).cast("string").alias("id"),
            folded("product_name").alias("name"),
            F.nullif("sku", F.lit("")).alias("sku"),
            F.col("stock_quantity").cast("bigint").alias("quantity"),
        )
        .groupBy("id", "name", "sku")
        .agg(F.sum("quantity").alias("quantity"))
        .withColumn("lengths", F.array_intersect(F.sequence(F.lit(0), F.length("sku")), lengths))
    )
    number, name, sku = F.col("id"), F.col("name"), F.col("sku")
    starts = F.transform("lengths", lambda n: F.substring(sku, F.lit(1), n))
    keys = F.concat(
        F.array(key(id=number), key(name=name), key(id=number, name=name)),
        F.coalesce(
            F.flatten(
                F.transform(
                    starts,
                    lambda start: F.array(
                        key(start=start),
                        key(id=number, start=start),
                        key(name=name, start=start),
                        key(id=number, name=name, start=start),
                    ),
                )
            ),
            F.array().cast("array<string>"),
        ),
    )
    per_key = (
        items.select(F.explode(F.array_compact(keys)).alias("key"), "quantity")
        .groupBy("key")
        .agg(F.sum("quantity").alias("quantity"))
    )

    number, name = F.col("product_id").cast("string"), folded("product_name")
    terms = [
        (key(id=number), 1),
        (key(name=name), 1),
        (key(start=start), 1),
        (key(id=number, name=name), -1),
        (key(id=number, start=start), -1),
        (key(name=name, start=start), -1),
        (key(id=number, name=name, start=start), 1),
    ]
    signed = F.array(*[F.struct(k.alias("key"), F.lit(sign).alias("sign")) for k, sign in terms])
    wanted = products.select("product_id", F.inline(signed))
    return (
        wanted.join(per_key, "key", "left")
        .groupBy("product_id")
        .agg(F.coalesce(F.sum(F.col("sign") * F.col("quantity")), F.lit(0)).alias("stock_quantity"))
    )


def shortage_alerts(forecasts: DataFrame, stock: DataFrame) -> DataFrame:
    """Next week's forecast against stock per (store, SKU), with the missing amount where it exceeds stock.

    Next week is the first week without an actual, or the first week at all when
    every week has one.
    """
    point = F.struct("year", "week")
    open_week = F.when(F.col("actual_quantity").isNull(), point)
    coming = forecasts.groupBy("store_id", "sku").agg(
        F.coalesce(F.min_by("predicted_quantity", open_week), F.min_by("predicted_quantity", point)).alias("forecast")
    )
    on_hand = F.coalesce("quantity", F.lit(0))
    return (
        coming.join(stock.select("store_id", "sku", "quantity"), ["store_id", "sku"], "left")
        .withColumn("quantity", on_hand)
        .where(F.col("forecast") > F.col("quantity"))
        .withColumn("shortage", F.col("forecast") - F.col("quantity"))
    )
