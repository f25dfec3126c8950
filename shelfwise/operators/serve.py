"""Portal queries: listings, lookups, search, pages and row scope."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import text
from shelfwise.operators.rows import ranked
from shelfwise.session import count_of

Order = Sequence[str | Column]


def equals(filters: Mapping[str, Any]) -> Column:
    """All given equalities; a filter whose value is None is left out (0 is a value)."""
    rule = F.lit(True)
    for name, value in filters.items():
        if value is not None:
            rule = rule & (F.col(name) == F.lit(value))
    return rule


def listing(
    df: DataFrame,
    filters: Mapping[str, Any] | None = None,
    order: Order = (),
    limit: int = 100,
    offset: int = 0,
    with_total: bool = False,
    with_page_total: bool = False,
) -> DataFrame:
    """Filtered rows in order, one page of them.

    The first page keeps ``limit`` rows per task. A later page numbers the rows by
    a range-partitioned sort and takes its positions, so no task gathers the rows
    before it. ``with_total`` adds the number of all matching rows, counted by a
    separate aggregate; ``with_page_total`` the number of rows on the page.
    """
    found = df.where(equals(filters or {}))
    if offset and order:
        places = ranked(found, order, "_position")
        inside = (F.col("_position") >= offset) & (F.col("_position") < offset + limit)
        page = places.where(inside).orderBy("_position").drop("_position")
    else:
        page = found.orderBy(*order) if order else found
        page = (page.offset(offset) if offset else page).limit(limit)
    if with_page_total:
        page = page.withColumn("page_total", count_of(page))
    return page.withColumn("total", count_of(found)) if with_total else page


def paginate(df: DataFrame, page: int, size: int, order: Order) -> DataFrame:
    """A numbered page; page numbers outside 1 .. last are moved to the nearest page. Counts the rows first."""
    total = df.count()
    last = max(1, -(-total // size))
    page = min(max(page, 1), last)
    out = listing(df, order=order, limit=size, offset=(page - 1) * size)
    return out.withColumns({"page": F.lit(page), "pages": F.lit(last), "total": F.lit(total).cast("bigint")})


def lookup(df: DataFrame, keys: Mapping[str, Any] | DataFrame) -> DataFrame:
    """Rows of one key given as values, or of many keys given as a frame."""
    if isinstance(keys, DataFrame):
        return df.join(keys.distinct(), keys.columns, "left_semi")
    return df.where(equals(keys))


def search(df: DataFrame, cols: Sequence[str], query: str, literal: bool = True) -> DataFrame:
    """Rows where any column contains the text, in any case. Not ``literal``: % and _ are wildcards."""
    hit = F.lit(False)
    for name in cols:
        value = F.col(name).cast("string")
        found = F.contains(F.lower(value), F.lower(F.lit(query))) if literal else value.ilike(f"%{query}%")
        hit = hit | F.coalesce(found, F.lit(False))
    return df.where(hit)


# The permissions that show every store, and the one that shows the own store.
EVERY_STORE = ("view_all_stores",)
OWN_STORE = "view_own_store"


def scope_rows(
    df: DataFrame, role: str, store_id: int | None, perms: Mapping[str, Sequence[str]], full: Sequence[str] = EVERY_STORE
) -> DataFrame:
    """Rows one user may see: all with one of the permissions ``full``, the own store's with 'view_own_store', else none.

    The store list, for one, is also open to 'manage_users'.
    """
    granted = perms.get(role, ())
    if any(name in granted for name in full):
        return df
    if OWN_STORE in granted and store_id is not None:
        return df.where(F.col("store_id") == store_id)
    return df.where(F.lit(False))


def discounts_for(discounts: DataFrame, store: int) -> DataFrame:
    """Discounts of one store and those valid everywhere."""
    return discounts.where((F.col("store_id") == store) | F.col("store_id").isNull())


def list_discounts(discounts: DataFrame, store: int | None = None) -> DataFrame:
    """Discounts, the one that ends last first."""
    if store is not None:
        discounts = discounts_for(discounts, store)
    dates = [F.col(name) for name in ("end_date", "valid_until", "start_date") if name in discounts.columns]
    return discounts.orderBy(F.coalesce(*dates).desc_nulls_last(), F.col("discount_id"))


def list_transactions(
    tx: DataFrame,
    store_id: int | None = None,
    customer_id: Any = None,
    payment_method: str | None = None,
    from_date: dt.date | str | None = None,
    to_date: dt.date | str | None = None,
    inclusive_day: bool = False,
    limit: int = 100,
    offset: int = 0,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Transactions, newest first, the greater id first on ties; ``ties`` are further columns, where ids repeat.

    ``to_date`` cuts at midnight of that day unless ``inclusive_day`` is set.
    """
    day = F.col("transaction_date")
    found = tx.where(equals({"store_id": store_id, "customer_id": customer_id, "payment_method": payment_method}))
    # Bounds of the column's own type keep the comparison in the scan.
    kind = tx.schema["transaction_date"].dataType
    if from_date is not None:
        found = found.where(day >= F.lit(str(from_date)).cast(kind))
    if to_date is not None:
        end = F.lit(str(to_date)).cast(kind)
        found = found.where(day < end + F.expr("INTERVAL 1 DAY") if inclusive_day else day <= end)
    order = [day.desc_nulls_first(), *(F.col(name).desc() for name in ("transaction_id", *ties))]
    return listing(found, order=order, limit=limit, offset=offset)


def list_features(
    daily: DataFrame,
    store_id: int,
    sku: str | None = None,
    from_date: dt.date | str | None = None,
    to_date: dt.date | str | None = None,
    limit: int = 500,
) -> DataFrame:
    """Feature rows of a store, newest first."""
    found = daily.where(equals({"store_id": store_id, "sku": sku}))
    if from_date is not None:
        found = found.where(F.col("date") >= F.lit(str(from_date)).cast("date"))
    if to_date is not None:
        found = found.where(F.col("date") <= F.lit(str(to_date)).cast("date"))
    return listing(found, order=[F.col("date").desc_nulls_first(), "sku"], limit=limit)


def velocity_chart(daily: DataFrame, store_id: int, sku: str) -> DataFrame:
    return (
        daily.where(equals({"store_id": store_id, "sku": sku}))
        .select("date", "s_sales_velocity", "s2_sales_velocity", "rolling_mean_7d", "lag_1d", "lag_7d")
        .orderBy("date")
    )


def list_audit(log: DataFrame, action: str | None = None) -> DataFrame:
    """Audit entries, newest first, with their class."""
    found = log.where(equals({"action": action}))
    return found.withColumn("action_class", text.action_class(F.col("action"))).orderBy(
        F.col("timestamp").desc_nulls_last(), F.col("id").desc()
    )
