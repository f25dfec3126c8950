"""Time-series features of daily sales per (store, SKU).

A series has one row per selling day, so its length is bounded by the calendar,
whatever the number of transactions behind it: no window partition can grow
with a best-seller. All windows share one partitioning and one sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.calendar import day_number
from shelfwise.schemas import FINAL_DAILY, FINAL_DAILY_EXTRA, require

SERIES = ("store_id", "sku")
LAGS = (1, 7)
MORE_LAGS = (14, 28)
MORE_MEANS = (14, 30)
VELOCITY_WINDOWS = {"s": 30, "s2": 7}


def by_day() -> WindowSpec:
    return W.partitionBy(*SERIES).orderBy(day_number(F.col("date")))


def days_before(days: int) -> WindowSpec:
    """The given number of calendar days before the row's own day."""
    return by_day().rangeBetween(-days, -1)


def _or_zero(col: Column) -> Column:
    return F.coalesce(col.cast("double"), F.lit(0.0))


def lag_columns(offsets: Sequence[int], calendar: bool = False) -> dict[str, Column]:
    """Quantity that many selling rows back, or with ``calendar`` that many days back; 0 where there is none."""
    if calendar:
        return {f"lag_{n}d": _or_zero(F.max("qty").over(by_day().rangeBetween(-n, -n))) for n in offsets}
    return {f"lag_{n}d": _or_zero(F.lag("qty", n, 0.0).over(by_day())) for n in offsets}


def rolling_columns(windows: Sequence[int], std: Sequence[int] = ()) -> dict[str, Column]:
    """Mean and sample deviation of quantity over the days before; 0 where undefined."""
    means = {f"rolling_mean_{n}d": _or_zero(F.round(F.avg("qty").over(days_before(n)), 4)) for n in windows}
    stds = {f"rolling_std_{n}d": _or_zero(F.round(F.stddev_samp("qty").over(days_before(n)), 4)) for n in std}
    return means | stds


def velocity_columns(windows: Mapping[str, int] = VELOCITY_WINDOWS) -> dict[str, Column]:
    """Selling days in the window before, under both of its names, and quantity per such day."""
    out = {}
    for prefix, days in windows.items():
        active = F.count("qty").over(days_before(days)).cast("double")
        sold = F.sum("qty").over(days_before(days))
        out[f"{prefix}_days_active"] = active
        out[f"{prefix}_selling_days_count"] = active
        out[f"{prefix}_sales_velocity"] = _or_zero(F.round(sold / F.greatest(active, F.lit(1.0)), 4))
    return out


def target_column() -> Column:
    """Mean quantity of the series over all earlier rows; the row's own quantity is left out."""
    earlier = by_day().rowsBetween(W.unboundedPreceding, -1)
    return _or_zero(F.round(F.avg("qty").over(earlier), 4))


def lag_features(daily: DataFrame, offsets: Sequence[int] = LAGS, calendar: bool = False) -> DataFrame:
    return daily.withColumns(lag_columns(offsets, calendar))


def rolling_features(daily: DataFrame, windows: Sequence[int] = (7,), std: Sequence[int] = (7,)) -> DataFrame:
    return daily.withColumns(rolling_columns(windows, std))


def velocity_features(daily: DataFrame, windows: Mapping[str, int] = VELOCITY_WINDOWS) -> DataFrame:
    return daily.withColumns(velocity_columns(windows))


def target_encoding(daily: DataFrame) -> DataFrame:
    return daily.withColumn("target_encoding_store_sku", target_column())


def window_features(daily: DataFrame, extended: bool = False) -> DataFrame:
    """All windowed features in one projection: one shuffle and one sort of the daily table."""
    columns = lag_columns(LAGS) | rolling_columns((7,), (7,)) | velocity_columns()
    if extended:
        columns |= lag_columns(MORE_LAGS) | rolling_columns(MORE_MEANS)
        columns["target_encoding_store_sku"] = target_column()
    return daily.withColumns(columns)


def series_table(daily: DataFrame) -> DataFrame:
    """One row per (store, SKU): its first day, the SKU's first day anywhere and the stores that sell it.

    The SKU figures come from this table, not from the daily rows, so a SKU sold
    everywhere weighs one row per store in the shuffle on SKU.
    """
    series = daily.groupBy(*SERIES).agg(F.min("date").alias("first_store_date"))
    per_sku = series.groupBy("sku").agg(
        F.min("first_store_date").alias("first_global_date"),
        F.count(F.lit(1)).cast("double").alias("sku_store_coverage"),
    )
    return series.join(per_sku, "sku")


def product_coverage(daily: DataFrame) -> DataFrame:
    """Stores per product id; de-duplicated on (product, store) before it is counted."""
    pairs = daily.where(F.col("product_id").isNotNull()).select("product_id", "store_id").distinct()
    return pairs.groupBy("product_id").agg(F.count(F.lit(1)).cast("double").alias("product_store_coverage"))


def coverage_lifespan(
    df: DataFrame, daily: DataFrame | None = None, coverage: DataFrame | None = None
) -> DataFrame:
    """Store coverage of SKU and product, and days since the first sale anywhere and in the store.

    ``daily`` is the table the figures are taken from, ``df`` itself by default;
    pass the staged daily table when ``df`` already carries other features.
    ``coverage`` may be a staged ``product_coverage`` with further product columns,
    which are then attached by the same join.
    """
    daily = df if daily is None else daily
    coverage = product_coverage(daily) if coverage is None else coverage
    stores = F.greatest(F.lit(1.0), F.coalesce("product_store_coverage", F.lit(0.0)))
    joined = df.join(series_table(daily), list(SERIES), "left").join(coverage, "product_id", "left")
    return _lifespan_columns(joined).withColumn("product_store_coverage", stores)


def lifespan(df: DataFrame, series: DataFrame) -> DataFrame:
    """Store coverage of the SKU, and days since the first sale anywhere and in the store, from ``series_table``."""
    return _lifespan_columns(df.join(series, list(SERIES), "left"))


def _lifespan_columns(df: DataFrame) -> DataFrame:
    columns = {
        "total_lifespan": _or_zero(F.datediff("date", "first_global_date")),
        "s_total_lifespan": _or_zero(F.datediff("date", "first_store_date")),
        "sku_store_coverage": F.greatest(F.lit(1.0), F.coalesce("sku_store_coverage", F.lit(0.0))),
    }
    return df.withColumns(columns).drop("first_global_date", "first_store_date")


def project_features(df: DataFrame, extended: bool = False) -> DataFrame:
    """The feature table's columns in order; a missing one is an error."""
    fields = [*FINAL_DAILY.fields, *(FINAL_DAILY_EXTRA.fields if extended else [])]
    require(df, [field.name for field in fields])
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in fields])


def lag_sample(daily: DataFrame, store: int = 1, from_date: str = "2023-01-08", rows: int = 3) -> DataFrame:
    """The first rows of a store from a date on, with a mark where the one-row lag is zero."""
    return (
        daily.where((F.col("store_id") == store) & (F.col("date") >= F.lit(from_date).cast("date")))
        .select("date", "sku", "qty", "lag_1d", "lag_7d", (F.col("lag_1d") <= 0).alias("zero_lag"))
        .orderBy("date", "sku")
        .limit(rows)
    )
