"""Grouped summaries of sales, features, customers, staff, stock and forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import calendar, money, text

ATTRIBUTES = ("size", "color", "color_type", "category", "sub_category")
PLACES = ("country", "city")


def combined_lines(tx: DataFrame) -> DataFrame:
    """Clean transaction lines added up per (store, product, original SKU, day), the one pass over the raw rows.

    All sums are of whole numbers, so the order of adding does not matter, and
    they are made on the map side before anything moves.
    """
    shares = money.whole_units(F.coalesce("discount_pct", F.lit(0.0)), money.SHARE_UNITS)
    return tx.groupBy("store_id", "product_id", "sku_original", "tx_date").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.sum(shares).alias("shares"),
        F.count(F.lit(1)).alias("n"),
    )


def store_variety(tx: DataFrame) -> DataFrame:
    """Distinct products and distinct original SKUs sold per store, from lines or combined lines.

    Spark de-duplicates on (store, value) before it counts per store, so a store
    with a third of all sales sends only its distinct values.
    """
    return tx.groupBy("store_id").agg(
        F.count_distinct("product_id").alias("num_distinct_products"),
        F.count_distinct("sku_original").alias("num_distinct_skus"),
    )


def daily_totals(lines: DataFrame) -> DataFrame:
    """Sales per (store, SKU, day): quantity, mean dollar price, mean discount and the smallest product id.

    ``lines`` come from ``dims.priced_lines``, each standing for ``n`` transaction lines.
    Everything is a sum or a minimum of numbers, so Spark aggregates in hash maps
    before the shuffle and a best-selling SKU arrives as one row per map task.
    """
    cents = money.whole_units(F.coalesce("usd_price", F.lit(0.0)), money.CENTS)
    rows = F.sum("n")
    return (
        lines.groupBy("store_id", "sku", F.col("tx_date").alias("date"))
        .agg(
            F.sum("quantity").cast("double").alias("qty"),
            money.rounded_mean(F.sum(cents * F.col("n")), rows, money.CENTS, 2).alias("avg_usd_price"),
            money.rounded_mean(F.sum("shares"), rows, money.SHARE_UNITS, 4).alias("total_discount_avg"),
            F.min("product_id").alias("product_id"),
        )
        .where(F.col("qty") > 0)
    )


def profile_transactions(tx: DataFrame) -> DataFrame:
    return tx.agg(F.count(F.lit(1)).alias("n_rows"), F.min("tx_date").alias("min_date"), F.max("tx_date").alias("max_date"))


def profile_daily(daily: DataFrame) -> DataFrame:
    """Quantity range and the numbers of days, stores and SKUs.

    Repeated values are dropped on the map side before anything is shuffled.
    """
    return daily.agg(
        F.min("qty").alias("min_qty"),
        F.max("qty").alias("max_qty"),
        F.round(F.avg("qty"), 4).alias("avg_qty"),
        F.count_distinct("date").alias("n_dates"),
        F.count_distinct("store_id").alias("n_stores"),
        F.count_distinct("sku").alias("n_skus"),
    )


def check_sku(df: DataFrame) -> DataFrame:
    """How many rows have a usable SKU, in one pass."""
    blank = text.blank_to_null(F.col("sku")).isNull()
    total, missing = F.count(F.lit(1)), F.count_if(blank)
    return df.agg(
        total.alias("total"),
        (total - missing).alias("ok"),
        missing.alias("null_sku"),
        F.coalesce(F.round(F.try_divide((total - missing) * 100.0, total), 1), F.lit(0.0)).alias("pct_ok"),
    )


def check_features(df: DataFrame, from_date: str = "2023-01-08") -> DataFrame:
    """Key feature levels from a date on, and a flag for each that never leaves zero."""
    levels = df.where(F.col("date") >= F.lit(from_date).cast("date")).agg(
        F.max("lag_1d").alias("max_lag_1d"),
        F.max("lag_7d").alias("max_lag_7d"),
        F.max("rolling_mean_7d").alias("max_rolling_mean_7d"),
        F.max("s_sales_velocity").alias("max_velocity"),
        F.round(F.avg("lag_1d"), 3).alias("avg_lag_1d"),
        F.round(F.avg("rolling_mean_7d"), 3).alias("avg_rolling_mean_7d"),
        F.round(F.avg("s_sales_velocity"), 3).alias("avg_velocity"),
        F.round(F.avg("total_lifespan"), 1).alias("avg_lifespan"),
    )
    watched = {
        "max_lag_1d": "lag_1d",
        "max_lag_7d": "lag_7d",
        "max_rolling_mean_7d": "rolling_mean_7d",
        "max_velocity": "s_sales_velocity",
        "avg_lifespan": "total_lifespan",
    }
    flags = {f"{name}_all_zero": F.col(level) == 0 for level, name in watched.items()}
    levels = levels.withColumns(flags)
    any_zero = F.lit(False)
    for name in flags:
        any_zero = any_zero | F.coalesce(F.col(name), F.lit(False))
    return levels.withColumn("healthy", ~any_zero)


def daily_label(tx: DataFrame) -> DataFrame:
    """Quantity per (store, SKU, day) of raw transactions, returns included; only numeric store ids count."""
    store = F.when(F.col("store_id").cast("string").rlike("^[0-9]+$"), F.col("store_id")).try_cast("int")
    return (
        tx.withColumn("store_id", store)
        .where(F.col("store_id").isNotNull())
        .groupBy("store_id", "sku", F.to_date("transaction_date").alias("date"))
        .agg(F.sum("quantity").alias("daily_quantity"))
    )


def store_summary(daily: DataFrame, store: int | None = None) -> DataFrame:
    """Assortment, date range, price, discount and velocity per (store, country, city)."""
    if store is not None:
        daily = daily.where(F.col("store_id") == store)
    rows = F.count(F.lit(1))
    cents = money.whole_units(F.col("avg_usd_price"), money.CENTS)
    shares = money.whole_units(F.col("total_discount_avg"), money.SHARE_UNITS)
    velocity = money.whole_units(F.col("s_sales_velocity"), 10_000)
    return daily.groupBy("store_id", *PLACES).agg(
        F.count_distinct("sku").alias("total_skus"),
        F.count_distinct("product_id").alias("total_products"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        money.rounded_mean(F.sum(cents), rows, money.CENTS, 2).alias("avg_price"),
        money.rounded_mean(F.sum(shares), rows, money.SHARE_UNITS, 4).alias("avg_discount"),
        money.rounded_mean(F.sum(velocity), F.lit(1), 10_000, 2).alias("total_velocity"),
    )


def gender_distribution(customers: DataFrame) -> DataFrame:
    return customers.groupBy(text.gender_group(F.col("gender")).alias("gender")).agg(F.count(F.lit(1)).alias("n"))


def age_distribution(customers: DataFrame) -> DataFrame:
    age = F.col("age").try_cast("int")
    return customers.groupBy(text.age_band(age).alias("age_band")).agg(F.count(F.lit(1)).alias("n"))


def staff_split(employees: DataFrame, role: str = "position") -> DataFrame:
    managers = F.count_if(text.is_leader(F.col(role)))
    return employees.agg(managers.alias("managers"), (F.count(F.lit(1)) - managers).alias("staff"))


def store_inventory_variety(stores: DataFrame, inventory: DataFrame) -> DataFrame:
    """Stores with their numbers of distinct SKUs and product names in stock, 0 when there is none."""
    variety = inventory.groupBy("store_id").agg(
        F.count_distinct("sku").alias("num_distinct_skus"),
        F.count_distinct(F.nullif("product_name", F.lit(""))).alias("num_distinct_products"),
    )
    return stores.join(variety, "store_id", "left").fillna(0, ["num_distinct_skus", "num_distinct_products"])


def store_centroid(stores: DataFrame) -> DataFrame:
    return stores.agg(
        F.round(F.avg("latitude"), 6).alias("latitude"), F.round(F.avg("longitude"), 6).alias("longitude")
    )


def forecast_vs_actual(forecasts: DataFrame, grain: str = "week") -> DataFrame:
    """Predicted and actual quantity per (store, SKU, period), and what is still to come.

    Actual stays null while no week of the period has one.
    """
    if grain not in ("week", "month"):
        raise ValueError("grain must be 'week' or 'month'")
    period = F.col("week") if grain == "week" else calendar.week_to_month(F.col("week"))
    predicted, actual = F.sum("predicted_quantity"), F.sum("actual_quantity")
    return forecasts.groupBy("store_id", "sku", "year", period.alias(grain)).agg(
        predicted.alias("predicted"),
        actual.alias("actual"),
        F.greatest(F.lit(0), predicted - F.coalesce(actual, F.lit(0))).alias("upcoming"),
    )


def forecast_timeline(forecasts: DataFrame) -> DataFrame:
    """One row per (store, SKU) with its weeks in order; a forecast table has one row per week, so lists stay short."""
    point = F.struct(
        "year",
        "week",
        F.col("predicted_quantity").alias("predicted"),
        F.col("actual_quantity").alias("actual"),
    )
    return forecasts.groupBy("store_id", "sku").agg(
        F.min("product_name").alias("product_name"),
        F.min("category").alias("category"),
        F.sort_array(F.collect_list(point)).alias("timeline"),
    )


def inventory_by_category(inventory: DataFrame) -> DataFrame:
    known = F.when(F.col("category").isin(*text.SHOWN_CATEGORIES), F.col("category")).otherwise("Other")
    return inventory.groupBy(known.alias("category")).agg(F.count(F.lit(1)).alias("n"))


def discount_report(discounts: DataFrame) -> DataFrame:
    """Discounts in percent, with a mark on those above 15."""
    percent = F.round(F.col("discount_pct") * 100, 4)
    return discounts.select(
        "discount_id", "store_id", "description", percent.alias("percent"), (percent > 15).alias("highlight")
    )


def discount_shares(discounts: DataFrame) -> DataFrame:
    """How many discounts each store runs at each percentage."""
    percent = F.round(F.col("discount_pct") * 100, 4)
    return discounts.groupBy("store_id", percent.alias("percent")).agg(F.count(F.lit(1)).alias("n"))


def cart_totals(lines: DataFrame, key: str = "order_id") -> DataFrame:
    """Total per order, summed in whole cents."""
    total = money.line_total(F.lit(None).cast("double"), F.col("price"), F.col("quantity"))
    cents = money.whole_units(total, money.CENTS)
    return lines.groupBy(key).agg((F.sum(cents) / float(money.CENTS)).alias("total"))


def regression_metrics(df: DataFrame, y: str = "qty", yhat: str = "prediction", places: int | None = None) -> DataFrame:
    """RMSE, MAE, R2 and the percentage error with y + 1 as denominator, in one pass."""
    actual, error = F.col(y), F.col(y) - F.col(yhat)
    n = F.count(F.lit(1))
    spread = F.var_pop(actual) * n
    metrics: dict[str, Column] = {
        "n": n,
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "r2": 1 - F.try_divide(F.sum(error * error), spread),
        "mape": F.avg(F.abs(F.try_divide(error, actual + 1))) * 100,
    }
    if places is not None:
        metrics = {k: v if k == "n" else F.round(v, places) for k, v in metrics.items()}
    return df.agg(*[value.alias(name) for name, value in metrics.items()])
