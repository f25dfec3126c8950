"""Window features, lookups and ledgers against plain Python."""

import datetime as dt
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.operators import aggregate, dims, features, lookup, maintain
from shelfwise.schemas import evolve

LIMITED = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
DAY = dt.date(2024, 1, 1)


def series(spark, sold):
    """One series from {day offset: quantity}."""
    data = [(1, "a", DAY + dt.timedelta(days=d), float(q), 7) for d, q in sold.items()]
    return spark.createDataFrame(data, "store_id INT, sku STRING, date DATE, qty DOUBLE, product_id INT")


@LIMITED
@given(st.dictionaries(st.integers(0, 60), st.integers(1, 50), min_size=1, max_size=40))
def test_windows_equal_brute_force(spark, sold):
    got = features.window_features(series(spark, sold), extended=True).orderBy("date").collect()
    days = sorted(sold)
    for i, row in enumerate(got):
        day = days[i]
        week = [sold[d] for d in days if day - 7 <= d < day]
        month = [sold[d] for d in days if day - 30 <= d < day]
        assert row.lag_1d == (sold[days[i - 1]] if i >= 1 else 0)
        assert row.lag_7d == (sold[days[i - 7]] if i >= 7 else 0)
        assert row.rolling_mean_7d == pytest.approx(round(sum(week) / len(week), 4) if week else 0, abs=1e-4)
        assert row.rolling_std_7d == pytest.approx(statistics.stdev(week) if len(week) > 1 else 0, abs=1e-4)
        assert row.s_days_active == row.s_selling_days_count == len(month)
        assert row.s_sales_velocity == pytest.approx(sum(month) / max(1, len(month)), abs=1e-4)
        before = [sold[d] for d in days[:i]]
        assert row.target_encoding_store_sku == pytest.approx(sum(before) / len(before) if before else 0, abs=1e-4)


def test_lags_count_rows_unless_asked_for_days(spark):
    df = series(spark, {0: 5, 3: 6, 4: 7})
    assert [r.lag_1d for r in features.lag_features(df, [1]).orderBy("date").collect()] == [0, 5, 6]
    assert [r.lag_1d for r in features.lag_features(df, [1], calendar=True).orderBy("date").collect()] == [0, 0, 6]


def test_coverage_and_lifespan(spark):
    data = [(1, "a", DAY, 1.0, 7), (2, "a", DAY + dt.timedelta(days=4), 1.0, 8), (2, "a", DAY + dt.timedelta(days=6), 1.0, 8)]
    df = spark.createDataFrame(data, "store_id INT, sku STRING, date DATE, qty DOUBLE, product_id INT")
    got = features.coverage_lifespan(df).orderBy("date").collect()
    assert [(r.total_lifespan, r.s_total_lifespan, r.sku_store_coverage, r.product_store_coverage) for r in got] == [
        (0, 0, 2, 1), (4, 0, 2, 1), (6, 2, 2, 1),
    ]


def test_projection_names_missing_columns(spark):
    with pytest.raises(ValueError, match="lag_1d"):
        features.project_features(spark.createDataFrame([(1,)], "store_id INT"))


@LIMITED
@given(st.sets(st.integers(0, 40), min_size=1, max_size=12), st.sets(st.integers(-5, 45), min_size=1, max_size=12))
def test_nearest_date_equals_minimum(spark, known, wanted):
    daily = series(spark, dict.fromkeys(known, 1))
    asked = spark.createDataFrame([(1, "a", DAY + dt.timedelta(days=d)) for d in wanted], "store_id INT, sku STRING, date DATE")
    got = {(r.date - DAY).days: (r.feature_date - DAY).days for r in lookup.nearest_dates(asked, daily).collect()}
    assert got == {d: min(known, key=lambda k: (abs(k - d), k)) for d in wanted}


def test_unknown_series_fall_back_to_static_features(spark):
    requests = spark.createDataFrame(
        [(1, "NEW-12", DAY), (9, "zzz", DAY), (1, "zzz", DAY)], "store_id INT, sku STRING, date DATE"
    )
    daily = series(spark, {0: 1})
    products = spark.createDataFrame(
        [("12", "P", None, "None", "c", None, 3.5)],
        "product_id STRING, sku STRING, size STRING, color STRING, category STRING, sub_category STRING, cost DOUBLE",
    )
    stores = spark.createDataFrame([(1, "X", None, 2)], "store_id INT, country STRING, city STRING, num_employees INT")
    got = {(r.store_id, r.sku): r for r in lookup.features_for(requests, daily, products, stores).collect()}
    new = got[1, "NEW-12"]
    assert (new.source, new.product_id, new["size"], new.color_type, new.avg_usd_price) == ("static", 12, "M", "Multi Color", 3.5)
    assert (new.city, new.num_distinct_products, new.num_distinct_skus) == ("New York", 3400, 10000)
    assert got[9, "zzz"].source == "missing"
    assert got[1, "zzz"].source == "static" and got[1, "zzz"].product_id is None


def test_overrides_and_validation(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (None, None, "x")], "lag_1d DOUBLE, asked_lag_1d DOUBLE, city STRING")
    got = lookup.validate_features(lookup.apply_overrides(df), ["lag_1d", "city"]).collect()
    assert [(r.lag_1d, r.status, r.message) for r in got] == [
        (2.0, "error", "missing features: city"),
        (None, "error", "missing features: lag_1d"),
    ]


STOCK = "store_id INT, sku STRING, product_id STRING, quantity BIGINT, last_restocked DATE"


def test_stock_ledger(spark, rows):
    stock = spark.createDataFrame([(1, "a", "p", 1, None)], STOCK)
    sales = spark.createDataFrame(
        [(1, "a", "p", 3), (1, "b", "q", 3), (None, "a", "p", 1), (1, "", "p", 1), (1, "a", "p", None), (1, "a", "p", -2)],
        "store_id INT, sku STRING, product_id STRING, quantity INT",
    )
    assert rows(maintain.apply_sales(stock, sales), "sku", "product_id", "quantity", "warn") == [
        ("a", "p", -2, True), ("b", "q", -3, True),
    ]
    imports = spark.createDataFrame(
        [(1, "a", "z", 5, DAY), (1, "a", "z", 10, DAY + dt.timedelta(days=1)), (1, "a", "z", 0, DAY)],
        "store_id INT, sku STRING, product_id STRING, quantity_imported INT, import_date DATE",
    )
    got = maintain.apply_imports(stock, imports).first()
    assert (got.quantity, got.product_id, got.last_restocked) == (16, "p", DAY + dt.timedelta(days=1))


def test_seed_rounds_a_fifth(spark):
    tx = spark.createDataFrame(
        [(1, "a", 2, 7, DAY), (1, "a", 1, 5, DAY), (1, "a", 1, -9, DAY)],
        "store_id INT, sku STRING, product_id INT, quantity INT, transaction_date DATE",
    )
    got = maintain.seed_stock(tx).collect()
    assert [tuple(r) for r in got] == [(1, "a", 1, 2, DAY + dt.timedelta(days=7))]
    assert maintain.seed_stock(tx, existing=spark.range(1)).count() == 0


def test_upsert_is_idempotent_and_keeps_old_values(spark, rows):
    target = spark.createDataFrame([(1, "p", 5), (2, "q", 6)], "k INT, product STRING, n INT")
    src = spark.createDataFrame([(1, None, 7), (3, "r", 8)], "k INT, product STRING, n INT")
    once = maintain.upsert(target, src, ["k"], keep_if_null=["product"])
    assert rows(once) == [(1, "p", 7), (2, "q", 6), (3, "r", 8)]
    assert rows(maintain.upsert(once, src, ["k"], keep_if_null=["product"])) == rows(once)


def test_evolve_leaves_existing_names_alone(spark):
    df = spark.createDataFrame([(1, 2)], "quantity INT, quantity_imported INT")
    assert evolve(df, {"a": "string"}, {"quantity": "quantity_imported"}).columns == ["quantity", "quantity_imported", "a"]


def test_shortages(spark, rows):
    weeks = [("a", 1, 9, 9), ("a", 2, 10, None), ("b", 2, 8, None), ("c", 2, 3, None), ("d", 1, 4, 4), ("d", 2, 9, 9)]
    forecasts = spark.createDataFrame(
        [(1, sku, 2024, w, p, a) for sku, w, p, a in weeks],
        "store_id INT, sku STRING, year INT, week INT, predicted_quantity INT, actual_quantity INT",
    )
    stock = spark.createDataFrame([(1, "a", 8), (1, "b", 8), (1, "d", 1)], "store_id INT, sku STRING, quantity INT")
    assert rows(dims.shortage_alerts(forecasts, stock), "sku", "shortage") == [("a", 2), ("c", 3), ("d", 3)]


def test_product_stock_counts_each_row_once(spark, rows):
    products = spark.createDataFrame(
        [(7, "CH7--", "Shirt"), (8, "---", "Hat"), (9, None, " shirt "), (10, "MA", None)], "product_id INT, sku STRING, product_name STRING"
    )
    inventory = spark.createDataFrame(
        [("CH7--", "shirt", 5), ("CH7-x", None, 2), ("MA10", "SHIRT", 11), (None, "Hat", 1)], "sku STRING, product_name STRING, stock_quantity INT"
    )
    assert rows(dims.product_stock(products, inventory)) == [(10, 11), (7, 18), (8, 19), (9, 16)]


def test_actual_stays_null_without_any(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 2024, 1, 5, None), (1, "a", 2024, 2, 5, 3)],
        "store_id INT, sku STRING, year INT, week INT, predicted_quantity INT, actual_quantity INT",
    )
    assert rows(aggregate.forecast_vs_actual(df, "week"), "week", "actual", "upcoming") == [(1, None, 5), (2, 3, 2)]
    assert rows(aggregate.forecast_vs_actual(df, "month"), "month", "predicted", "actual", "upcoming") == [(1, 10, 3, 7)]
