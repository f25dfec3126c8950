"""Literal cases of the column rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import calendar, money, text
from shelfwise.operators import clean


def values(spark, inputs, kind, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


def test_store_id(spark):
    raw = ["STORE_001", "1", "store_7", "abc", None, "STORE_x"]
    assert values(spark, raw, "STRING", text.parse_store_id) == [1, 1, 7, 1, 1, 1]
    strict = values(spark, raw, "STRING", lambda c: text.parse_store_id(c, strict=True))
    assert strict == [1, 1, 7, 1, 1, None]


def test_week_keys(spark):
    day = [dt.date(2027, 1, 1)]

    def key(mode):
        return values(spark, day, "DATE", lambda c: F.concat_ws("/", *calendar.week_key(c, mode)))[0]

    assert key("calendar") == "2027/53"
    assert key("iso") == "2026/53"
    assert key("sunday") == "2027/1"
    with pytest.raises(ValueError):
        calendar.week_key(F.col("d"), "moon")


def test_sunday_weeks_start_on_sundays(spark):
    days = [dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 12, 31)]
    assert values(spark, days, "DATE", lambda c: calendar.week_key(c, "sunday")[1]) == [1, 2, 53]


def test_week_to_month(spark):
    assert values(spark, [1, 5, 6, 53], "INT", calendar.week_to_month) == [1, 1, 2, 12]


def test_age_bands(spark):
    ages = [17, 18, 25, 26, 56, None]
    assert values(spark, ages, "INT", text.age_band) == ["18-25"] * 3 + ["26-35", "56+", "18-25"]


def test_color_type(spark):
    colors = ["Red/Blue", "FLORAL", "BLACK"]
    assert values(spark, colors, "STRING", text.color_type) == ["Multi Color", "Multi Color", "Cor Unica"]


def test_usd_price(spark):
    df = spark.createDataFrame([(10.0, "EUR"), (10.0, "XXX"), (10.0, None)], "p DOUBLE, c STRING")
    assert [r[0] for r in df.select(money.to_usd(F.col("p"), F.col("c"))).collect()] == [10.8, 10.0, 10.0]


def test_sku_chain(spark):
    df = spark.createDataFrame(
        [
            (" A ", "B", 1, "S", "red"),
            (" ", " B ", 1, "S", "red"),
            (None, None, 1, None, "red"),
            (None, "", None, "S", "red"),
        ],
        "sku_prod STRING, sku_original STRING, product_id INT, size STRING, color STRING",
    )
    assert [r.sku for r in clean.resolve_sku(df).collect()] == ["A", "B", "SKU-1-UNK-red", "SKU-UNKNOWN"]


def test_sku_digits_and_category(spark):
    skus = ["CHAC10010--", "fe-x", "SKU", "MA7-8", "99999999999999999999"]
    assert values(spark, skus, "STRING", text.sku_product_id) == [10010, None, None, 7, None]
    assert values(spark, skus, "STRING", text.sku_category) == [
        "Children", "Feminine", "Clothing", "Masculine", "Clothing",
    ]


def test_salesperson(spark):
    df = spark.createDataFrame(
        [("Store Manager", 3), ("Sales Staff", None), ("IT Admin", 4), ("Area  Lead", 2), (None, 1)], "r STRING, s INT"
    )
    got = [r[0] for r in df.select(text.salesperson_label(F.col("r"), F.col("s"))).collect()]
    assert got == ["manager3", "sales", "admin", "arealead2", "1"]


def test_line_total(spark):
    df = spark.createDataFrame([(5.0, 2.0, 3), (None, 2.0, 3), (0.0, 2.0, None), (None, None, 2)], "t DOUBLE, p DOUBLE, q INT")
    got = [r[0] for r in df.select(money.line_total(F.col("t"), F.col("p"), F.col("q"))).collect()]
    assert got == [5.0, 6.0, 2.0, 0.0]


def test_rounded_mean_does_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.015,)], "v DOUBLE")
    mean = money.rounded_mean(F.sum(money.whole_units(F.col("v"), 1000)), F.count(F.lit(1)), 1000, 2)
    assert df.agg(mean).first()[0] == 0.11


def test_request_rules(spark):
    df = spark.createDataFrame(
        [("2026-06-24", 0.15), ("2026-13-01", None), ("24.06.2026", 1.5), (None, None)], "date STRING, total_discount_avg DOUBLE"
    )
    ok, bad = clean.validate(df, clean.request_rules())
    assert ok.count() == 1
    assert sorted(tuple(r.reasons) for r in bad.collect()) == [("date",), ("date",), ("date", "total_discount_avg")]


def test_median_ignores_nan(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 1.0), ("a", 3.0), ("a", 5.0), ("b", None)], "category STRING, price DOUBLE")
    got = sorted(r.price for r in clean.impute_median(df, "price", "category", 50.0).collect())
    assert got == [1.0, 3.0, 3.0, 5.0, 50.0]


def test_mode_prefers_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("g", c) for c in ("b", "a", "b", "a", None)] + [("h", None)], "k STRING, c STRING")
    got = sorted((r.k, r.c) for r in clean.impute_mode(df, "c", "k", "M").collect())
    assert got == [("g", "a"), ("g", "a"), ("g", "a"), ("g", "b"), ("g", "b"), ("h", "M")]


def test_clean_transactions_drops_fractions_and_null_dates(spark):
    df = spark.createDataFrame(
        [("x", 0.4, 0.1, "2024-01-01"), ("x", 2.7, 1.5, "2024-01-01"), ("x", 3.0, None, None), (" ", 1.0, -0.1, "2024-01-02")],
        "sku STRING, quantity DOUBLE, discount_pct DOUBLE, transaction_date STRING",
    ).withColumn("transaction_date", F.col("transaction_date").cast("timestamp"))
    got = clean.clean_transactions(df).select("sku_original", "quantity", "discount_pct").collect()
    assert [tuple(r) for r in got] == [("x", 2, 0.0), (None, 1, 0.0)]
