"""Forecast jobs: the daily run over all series, and answers to forecast requests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.calendar import week_key
from shelfwise.functions.text import parse_store_id
from shelfwise.operators import clean, lookup, model
from shelfwise.session import stage
from shelfwise.sources.tables import latest_snapshot

# Version labels of the two jobs.
DAILY_VERSION = "lgbm_v1"
REQUEST_VERSION = "lightgbm_v1"


def expand_horizon(df: DataFrame, start: dt.date, days: int = 7) -> DataFrame:
    """Each row once for each of the ``days`` days after ``start``; replaces the ``date`` column."""
    first, last = F.lit(start + dt.timedelta(days=1)), F.lit(start + dt.timedelta(days=days))
    return df.drop("date").withColumn("date", F.explode(F.sequence(first, last)))


def weekly_forecast(df: DataFrame, mode: str = "calendar", places: int | None = None) -> DataFrame:
    """Predictions summed per (store, SKU, product, year, week)."""
    year, week = week_key(F.col("date"), mode)
    total = F.sum("prediction")
    total = total if places is None else F.round(total, places)
    return df.groupBy(
        "store_id", "sku", "product_id", year.alias("forecast_year"), week.alias("forecast_week")
    ).agg(total.alias("predicted_quantity"))


def monthly_forecast(df: DataFrame, places: int | None = 2) -> DataFrame:
    """Predictions summed per (store, SKU, year, month)."""
    total = F.sum("prediction")
    total = total if places is None else F.round(total, places)
    return df.groupBy("store_id", "sku", F.year("date").alias("year"), F.month("date").alias("month")).agg(
        total.alias("predicted_quantity")
    )


def forecast_rows(weekly: DataFrame, version: str) -> DataFrame:
    """Weekly sums in the layout of the forecast table."""
    return weekly.select(
        F.col("store_id").cast("string").alias("store_id"),
        "sku",
        F.col("product_id").cast("string").alias("product_id"),
        "forecast_year",
        "forecast_week",
        "predicted_quantity",
        F.lit(version).alias("model_version"),
    )


def run_forecast(
    daily: DataFrame, fitted: model.DemandModel, start: dt.date, days: int = 7, version: str = DAILY_VERSION
) -> DataFrame:
    """Weekly forecasts of every series on the newest feature date, for the days after ``start``.

    The texts are encoded once per series, before a row is unfolded into its days.
    Write the result with ``replace_partitions_at`` on (forecast_year,
    forecast_week, model_version): whole weeks are replaced even if only some of
    their days were forecast.
    """
    snapshot = model.encode(latest_snapshot(daily), fitted.encoder)
    rows = model.calendar_features(expand_horizon(snapshot, start, days))
    return forecast_rows(weekly_forecast(model.score(fitted, rows, encoded=True)), version)


def prepared_requests(
    requests: DataFrame, daily: DataFrame, products: DataFrame, stores: DataFrame, defaults: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Requests with features, overrides and status; and those whose own fields are invalid.

    ``requests`` holds store_id as text, sku, date as ISO text and optionally
    feature overrides such as total_discount_avg. The narrow requests are checked,
    parsed and staged once, as the keys, the features and the invalid ones are all
    taken from them; the wide rows are not staged, so a caller that needs them
    twice has to keep what it makes of them. With ``defaults`` (a profile of
    ``lookup.PROFILES``) the found features are laid over that profile's values, so
    that every valid request has features.
    """
    if "total_discount_avg" not in requests.columns:
        requests = requests.withColumn("total_discount_avg", F.lit(None).cast("double"))
    parsed = requests.withColumns({"_store": parse_store_id(F.col("store_id")), "_day": clean.request_day()})
    checked = stage(clean.with_reasons(parsed, clean.request_rules(F.col("_day"))), "requests")
    good, bad = clean.by_reasons(checked)
    good = good.withColumnRenamed("store_id", "store_raw").withColumn("date", F.col("_day")).drop("_day")
    good = good.withColumnRenamed("_store", "store_id")
    found = lookup.apply_overrides(lookup.fetch_features(good, daily, products, stores))
    if defaults:
        known = F.when(F.col("source") == "missing", "default").otherwise(F.col("source"))
        found = lookup.default_features(found, defaults).withColumn("source", known)
    return lookup.validate_features(found), bad.drop("_store", "_day")


def scored_requests(checked: DataFrame, fitted: model.DemandModel) -> DataFrame:
    """``checked`` with a ``prediction`` where the status is 'ok', and null elsewhere, in one pass.

    The model reads no gaps, so rows with missing features get defaults on the way.
    """
    scored = model.score(fitted, model.calendar_features(lookup.default_features(checked)))
    return scored.withColumn("prediction", F.when(F.col("status") == "ok", F.col("prediction")))


def score_batch(
    requests: DataFrame,
    daily: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    fitted: model.DemandModel,
    defaults: str | None = None,
) -> DataFrame:
    """One outcome per request: status, predicted quantity (0.0 on errors) and message.

    Requests without features are errors, or with ``defaults="miss"`` scored on the predictor's defaults.
    """
    checked, bad = prepared_requests(requests, daily, products, stores, defaults)
    outcome = ["store_id", "sku", "date", "status", "predicted_quantity", "message"]
    answered = scored_requests(checked, fitted).select(
        F.col("store_raw").alias("store_id"),
        "sku",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.when(F.col("status") == "ok", "success").otherwise(F.col("status")).alias("status"),
        F.coalesce("prediction", F.lit(0.0)).alias("predicted_quantity"),
        "message",
    )
    invalid = bad.select(
        F.col("store_id").cast("string").alias("store_id"),
        "sku",
        "date",
        F.lit("error").alias("status"),
        F.lit(0.0).alias("predicted_quantity"),
        F.concat(F.lit("invalid fields: "), F.array_join("reasons", ", ")).alias("message"),
    )
    return answered.unionByName(invalid).select(*outcome)


def forecast_requests(
    requests: DataFrame, daily: DataFrame, products: DataFrame, stores: DataFrame, fitted: model.DemandModel
) -> dict[str, DataFrame]:
    """Daily, weekly and monthly forecasts of the valid requests, rows for the forecast table, and the rest.

    All are taken from the requests' outcomes, which are staged without the features.
    """
    checked, bad = prepared_requests(requests, daily, products, stores)
    columns = ("store_raw", "sku", "date", "product_id", "status", "message", "prediction")
    outcomes = stage(scored_requests(checked, fitted).select(*columns), "outcomes")
    scored = outcomes.where(F.col("status") == "ok").withColumnRenamed("store_raw", "store_id")
    weekly = weekly_forecast(scored, places=2)
    return {
        "daily": scored.select("store_id", "sku", "date", F.col("prediction").alias("predicted_quantity")),
        "weekly": weekly,
        "monthly": monthly_forecast(scored),
        "rows": forecast_rows(weekly, REQUEST_VERSION),
        "errors": outcomes.where(F.col("status") != "ok").select("store_raw", "sku", "date", "message"),
        "invalid": bad,
    }
