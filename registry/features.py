"""The feature job and its steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.cases import case, rounded
from registry.tables import tables
from shelfwise.functions import calendar
from shelfwise.operators import aggregate, clean, dims, features, model, serve
from shelfwise.plans import features as jobs
from shelfwise.session import stage
from shelfwise.sources.tables import active_pairs, latest_snapshot

BASE = ("transactions", "products", "stores")
FEATURE_COLUMNS = """store_id, sku, date, CAST(product_id AS INTEGER) AS product_id, size, color, color_type, category,
    sub_category, country, city, num_distinct_products, num_distinct_skus, avg_usd_price, total_discount_avg,
    total_lifespan, s_total_lifespan, sku_store_coverage, product_store_coverage, s_days_active, s_selling_days_count,
    s_sales_velocity, s2_days_active, s2_selling_days_count, s2_sales_velocity, lag_1d, lag_7d, rolling_mean_7d,
    rolling_std_7d"""
EXTRA_COLUMNS = "lag_14d, lag_28d, rolling_mean_14d, rolling_mean_30d, target_encoding_store_sku"


def daily(spark, sf):
    """Daily sales without attributes."""
    return jobs.daily_sales(tables(spark, sf, *BASE))


def feature_table(spark, sf):
    return jobs.flagship_features(tables(spark, sf, *BASE), extended=True)


@case("flagship_features", ("featured",), f"SELECT {FEATURE_COLUMNS} FROM featured")
def flagship_features(spark, sf):
    return jobs.flagship_features(tables(spark, sf, *BASE))


@case("extended_features", ("featured",), f"SELECT {FEATURE_COLUMNS}, {EXTRA_COLUMNS} FROM featured")
def extended_features(spark, sf):
    return feature_table(spark, sf)


@case("clean_transactions", ("clean_tx",), "SELECT line_id, store_id, sku_original, quantity, discount_pct, tx_date FROM clean_tx")
def clean_transactions(spark, sf):
    out = clean.clean_transactions(tables(spark, sf, "transactions")["transactions"])
    return out.select("line_id", "store_id", "sku_original", "quantity", "discount_pct", "tx_date")


@case(
    "clean_products",
    ("clean_products",),
    "SELECT product_id, sku_prod, category, sub_category, color, size, price, currency, color_type, usd_price FROM clean_products",
)
def clean_products(spark, sf):
    out = clean.clean_products(tables(spark, sf, "products")["products"])
    return out.select(
        "product_id", "sku_prod", "category", "sub_category", "color", "size", "price", "currency", "color_type", "usd_price"
    )


@case(
    "impute_median",
    ("products", "median_price"),
    "SELECT product_id, coalesce(price, med, 50.0) AS price FROM products LEFT JOIN median_price USING (category)",
)
def impute_median(spark, sf):
    products = tables(spark, sf, "products")["products"].select("product_id", "category", "price")
    return clean.impute_median(products, "price", "category", 50.0).select("product_id", "price")


@case(
    "impute_mode",
    ("products", "mode_color", "mode_size"),
    """SELECT product_id, coalesce(color, c.mode, 'UNKNOWN') AS color, coalesce(size, z.mode, 'M') AS size
       FROM products p LEFT JOIN mode_color c ON p.category = c.category
            LEFT JOIN mode_size z ON p.sub_category = z.sub_category""",
)
def impute_mode(spark, sf):
    products = tables(spark, sf, "products")["products"]
    out = clean.impute_mode(clean.impute_mode(products, "color", "category", "UNKNOWN"), "size", "sub_category", "M")
    return out.select("product_id", "color", "size")


@case("color_type", ("clean_products",), "SELECT color_type, count(*) AS n FROM clean_products GROUP BY color_type")
def color_type(spark, sf):
    return clean.clean_products(tables(spark, sf, "products")["products"]).groupBy("color_type").agg(F.count(F.lit(1)).alias("n"))


@case(
    "to_usd",
    ("products",),
    "SELECT product_id, "
    + rounded(
        "price * CASE currency WHEN 'USD' THEN 1.0 WHEN 'EUR' THEN 1.08 WHEN 'GBP' THEN 1.27 WHEN 'CNY' THEN 0.14 "
        "WHEN 'BRL' THEN 0.20 ELSE 1.0 END::DOUBLE",
        2,
    )
    + " AS usd_price FROM products",
)
def to_usd(spark, sf):
    from shelfwise.functions.money import to_usd as rule

    return tables(spark, sf, "products")["products"].select(
        "product_id", rule(F.col("price"), F.col("currency")).alias("usd_price")
    )


@case(
    "fill_text_and_num",
    ("stores",),
    """SELECT store_id, coalesce(nullif(trim(country), ''), 'Unknown') AS country,
              coalesce(nullif(trim(city), ''), 'Unknown') AS city,
              coalesce(num_employees, 0) AS num_employees FROM stores""",
)
def fill_text_and_num(spark, sf):
    stores = tables(spark, sf, "stores")["stores"].select("store_id", "country", "city", "num_employees")
    return clean.fill_num(clean.fill_text(stores, ["country", "city"], "Unknown"), ["num_employees"], 0)


@case(
    "clean_stores",
    ("clean_stores",),
    "SELECT * FROM clean_stores",
)
def clean_stores(spark, sf):
    t = tables(spark, sf, "transactions", "stores")
    out = clean.clean_stores(t["stores"], clean.clean_transactions(t["transactions"]))
    return out.select("store_id", "country", "city", "num_distinct_products", "num_distinct_skus")


JOINED_COLUMNS = (
    "store_id, product_id, tx_date, quantity, discount_pct, sku, usd_price, color, size, color_type, category, "
    "sub_category, country, city, num_distinct_products, num_distinct_skus"
)


@case("join_dims", ("joined",), f"SELECT {JOINED_COLUMNS} FROM joined")
def join_dims(spark, sf):
    t = tables(spark, sf, *BASE)
    tx = clean.clean_transactions(t["transactions"])
    out = dims.join_dims(tx, clean.clean_products(t["products"]), clean.clean_stores(t["stores"], tx))
    return out.select(*JOINED_COLUMNS.split(", "))


@case(
    "resolve_sku",
    ("joined",),
    """SELECT sku, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity FROM joined GROUP BY sku""",
)
def resolve_sku(spark, sf):
    t = tables(spark, sf, "transactions", "products")
    lines = dims.priced_lines(jobs.sold_lines(t), clean.clean_products(t["products"]))
    return lines.groupBy("sku").agg(F.sum("n").alias("n"), F.sum("quantity").alias("quantity"))


DAILY_COLUMNS = """store_id, sku, date, qty, avg_usd_price, total_discount_avg, product_id, color, size, color_type,
    category, sub_category, country, city, num_distinct_products, num_distinct_skus"""


@case("daily_sales", ("daily",), f"SELECT {DAILY_COLUMNS} FROM daily")
def daily_sales(spark, sf):
    t = tables(spark, sf, *BASE)
    lines = jobs.sold_lines(t)
    products = jobs.product_table(t["products"])
    totals = aggregate.daily_totals(dims.priced_lines(lines, products))
    return dims.describe(totals, products, stage(clean.clean_stores(t["stores"], lines), "stores"))


@case("store_variety", ("variety",), "SELECT * FROM variety")
def store_variety(spark, sf):
    return aggregate.store_variety(jobs.sold_lines(tables(spark, sf, "transactions")))


KEYS = "store_id, sku, date, "


@case(
    "coverage_lifespan",
    ("featured",),
    f"SELECT {KEYS} total_lifespan, s_total_lifespan, sku_store_coverage, product_store_coverage FROM featured",
)
def coverage_lifespan(spark, sf):
    out = features.coverage_lifespan(daily(spark, sf))
    return out.select(
        "store_id", "sku", "date", "total_lifespan", "s_total_lifespan", "sku_store_coverage", "product_store_coverage"
    )


@case("lag_features", ("featured",), f"SELECT {KEYS} lag_1d, lag_7d, lag_14d, lag_28d FROM featured")
def lag_features(spark, sf):
    out = features.lag_features(daily(spark, sf), [1, 7, 14, 28])
    return out.select("store_id", "sku", "date", "lag_1d", "lag_7d", "lag_14d", "lag_28d")


@case(
    "rolling_features",
    ("featured",),
    f"SELECT {KEYS} rolling_mean_7d, rolling_mean_14d, rolling_mean_30d, rolling_std_7d FROM featured",
)
def rolling_features(spark, sf):
    out = features.rolling_features(daily(spark, sf), [7, 14, 30], [7])
    return out.select("store_id", "sku", "date", "rolling_mean_7d", "rolling_mean_14d", "rolling_mean_30d", "rolling_std_7d")


VELOCITY = "s_days_active, s_selling_days_count, s_sales_velocity, s2_days_active, s2_selling_days_count, s2_sales_velocity"


@case("velocity_features", ("featured",), f"SELECT {KEYS} {VELOCITY} FROM featured")
def velocity_features(spark, sf):
    return features.velocity_features(daily(spark, sf)).select("store_id", "sku", "date", *VELOCITY.split(", "))


@case("target_encoding", ("featured",), f"SELECT {KEYS} target_encoding_store_sku FROM featured")
def target_encoding(spark, sf):
    return features.target_encoding(daily(spark, sf)).select("store_id", "sku", "date", "target_encoding_store_sku")


EVENT_DAYS = {
    "event_days": """
        SELECT CAST(user_id % 5 AS INTEGER) AS store_id, event_type AS sku, CAST(ts AS DATE) AS date,
               CAST(count(*) AS DOUBLE) AS qty FROM events GROUP BY 1, 2, 3""",
}


def event_days(spark, sf):
    """A dense daily series: events per user group, type and day."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    return events.groupBy(
        (F.col("user_id") % 5).cast("int").alias("store_id"),
        F.col("event_type").alias("sku"),
        F.to_date("ts").alias("date"),
    ).agg(F.count(F.lit(1)).cast("double").alias("qty"))


@case(
    "dense_series_features",
    ("event_days",),
    f"""SELECT store_id, sku, date, qty, lag(qty, 1, 0.0) OVER w AS lag_1d,
               coalesce(max(qty) OVER (PARTITION BY store_id, sku ORDER BY date - DATE '1970-01-01'
                                       RANGE BETWEEN 7 PRECEDING AND 7 PRECEDING), 0.0) AS lag_7d,
               coalesce({rounded("avg(qty) OVER d30", 4)}, 0.0) AS rolling_mean_30d,
               coalesce({rounded("stddev_samp(qty) OVER d7", 4)}, 0.0) AS rolling_std_7d,
               CAST(count(qty) OVER d30 AS DOUBLE) AS s_days_active
        FROM event_days
        WINDOW w AS (PARTITION BY store_id, sku ORDER BY date),
               d7 AS (PARTITION BY store_id, sku ORDER BY date - DATE '1970-01-01' RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING),
               d30 AS (PARTITION BY store_id, sku ORDER BY date - DATE '1970-01-01' RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING)""",
    EVENT_DAYS,
)
def dense_series_features(spark, sf):
    columns = (
        features.lag_columns([1])
        | features.lag_columns([7], calendar=True)
        | features.rolling_columns([30], [7])
        | {"s_days_active": features.velocity_columns({"s": 30})["s_days_active"]}
    )
    return event_days(spark, sf).withColumns(columns)


@case(
    "lag_sample",
    ("featured",),
    """SELECT date, sku, qty, lag_1d, lag_7d, lag_1d <= 0 AS zero_lag FROM featured
       WHERE store_id = 1 AND date >= DATE '1996-01-08' ORDER BY date, sku LIMIT 3""",
)
def lag_sample(spark, sf):
    return features.lag_sample(features.lag_features(daily(spark, sf)), 1, "1996-01-08")


@case(
    "profile_transactions",
    ("clean_tx",),
    "SELECT count(*) AS n_rows, min(tx_date) AS min_date, max(tx_date) AS max_date FROM clean_tx",
)
def profile_transactions(spark, sf):
    return aggregate.profile_transactions(clean.clean_transactions(tables(spark, sf, "transactions")["transactions"]))


@case(
    "profile_daily",
    ("daily",),
    f"""SELECT min(qty) AS min_qty, max(qty) AS max_qty, {rounded("avg(qty)", 4)} AS avg_qty,
               count(DISTINCT date) AS n_dates, count(DISTINCT store_id) AS n_stores, count(DISTINCT sku) AS n_skus
        FROM daily""",
)
def profile_daily(spark, sf):
    return aggregate.profile_daily(daily(spark, sf))


@case(
    "check_sku",
    ("transactions",),
    """SELECT count(*) AS total, count(*) FILTER (WHERE trim(sku) <> '') AS ok,
              count(*) - count(*) FILTER (WHERE trim(sku) <> '') AS null_sku,
              round(count(*) FILTER (WHERE trim(sku) <> '') * 100.0::DOUBLE / count(*), 1) AS pct_ok FROM transactions""",
)
def check_sku(spark, sf):
    return aggregate.check_sku(tables(spark, sf, "transactions")["transactions"])


@case(
    "check_features",
    ("featured",),
    f"""SELECT max(lag_1d) AS max_lag_1d, max(lag_7d) AS max_lag_7d, max(rolling_mean_7d) AS max_rolling_mean_7d,
               max(s_sales_velocity) AS max_velocity, {rounded("avg(lag_1d)", 3)} AS avg_lag_1d,
               {rounded("avg(rolling_mean_7d)", 3)} AS avg_rolling_mean_7d,
               {rounded("avg(s_sales_velocity)", 3)} AS avg_velocity, {rounded("avg(total_lifespan)", 1)} AS avg_lifespan,
               max(lag_1d) = 0 AS lag_1d_all_zero, max(lag_7d) = 0 AS lag_7d_all_zero,
               max(rolling_mean_7d) = 0 AS rolling_mean_7d_all_zero, max(s_sales_velocity) = 0 AS s_sales_velocity_all_zero,
               avg(total_lifespan) = 0 AS total_lifespan_all_zero,
               NOT (max(lag_1d) = 0 OR max(lag_7d) = 0 OR max(rolling_mean_7d) = 0 OR max(s_sales_velocity) = 0
                    OR avg(total_lifespan) = 0) AS healthy
        FROM featured WHERE date >= DATE '1996-01-01'""",
)
def check_features(spark, sf):
    return aggregate.check_features(feature_table(spark, sf), "1996-01-01")


@case("latest_snapshot", ("featured",), f"SELECT {FEATURE_COLUMNS} FROM featured WHERE date = (SELECT max(date) FROM featured)")
def latest(spark, sf):
    return latest_snapshot(flagship_features(spark, sf))


@case("active_pairs", ("daily",), "SELECT DISTINCT store_id, sku FROM daily WHERE date = (SELECT max(date) FROM daily)")
def active(spark, sf):
    return active_pairs(daily(spark, sf))


@case(
    "store_summary",
    ("featured",),
    """SELECT store_id, country, city, count(DISTINCT sku) AS total_skus, count(DISTINCT product_id) AS total_products,
              min(date) AS first_date, max(date) AS last_date,
              round(sum(CAST(round(avg_usd_price * 100) AS BIGINT)) / count(*)) / 100.0::DOUBLE AS avg_price,
              round(sum(CAST(round(total_discount_avg * 10000000) AS BIGINT)) / (count(*) * 1000.0::DOUBLE)) / 10000.0::DOUBLE AS avg_discount,
              round(sum(CAST(round(s_sales_velocity * 10000) AS BIGINT)) / 100.0::DOUBLE) / 100.0::DOUBLE AS total_velocity
       FROM featured GROUP BY store_id, country, city""",
)
def store_summary(spark, sf):
    return aggregate.store_summary(feature_table(spark, sf))


@case(
    "list_features",
    ("featured",),
    f"""SELECT {FEATURE_COLUMNS} FROM featured WHERE store_id = 3 AND date >= DATE '1998-01-01' AND date <= DATE '2000-06-30'
        ORDER BY date DESC, sku LIMIT 500""",
)
def list_features(spark, sf):
    return serve.list_features(flagship_features(spark, sf), 3, None, "1998-01-01", "2000-06-30")


@case(
    "velocity_chart",
    ("featured",),
    """SELECT date, s_sales_velocity, s2_sales_velocity, rolling_mean_7d, lag_1d, lag_7d FROM featured
       WHERE store_id = 2 AND sku = 'Brand#7'""",
)
def velocity_chart(spark, sf):
    return serve.velocity_chart(feature_table(spark, sf), 2, "Brand#7")


@case(
    "sku_catalog",
    ("stock", "featured"),
    """SELECT s.store_id, s.sku, s.product_id, f.category, f.sub_category, f.color, f.size, f.color_type, f.avg_usd_price
       FROM stock s LEFT JOIN featured f ON s.store_id = f.store_id AND s.sku = f.sku
       QUALIFY row_number() OVER (PARTITION BY s.store_id, s.sku ORDER BY f.date DESC) = 1""",
)
def sku_catalog(spark, sf):
    return dims.sku_catalog(tables(spark, sf, "stock")["stock"], feature_table(spark, sf))


@case(
    "daily_label",
    ("transactions",),
    """SELECT store_id, sku, CAST(transaction_date AS DATE) AS date, CAST(sum(quantity) AS BIGINT) AS daily_quantity
       FROM transactions WHERE regexp_matches(CAST(store_id AS VARCHAR), '^[0-9]+$') GROUP BY 1, 2, 3""",
)
def daily_label(spark, sf):
    return aggregate.daily_label(tables(spark, sf, "transactions")["transactions"])


@case(
    "calendar_features",
    ("transactions",),
    """SELECT DISTINCT CAST(transaction_date AS DATE) AS date, CAST(month(transaction_date) AS INTEGER) AS month,
              CAST(isodow(transaction_date) - 1 AS INTEGER) AS day_of_week, CAST(day(transaction_date) AS INTEGER) AS day
       FROM transactions""",
)
def calendar_features(spark, sf):
    days = tables(spark, sf, "transactions")["transactions"].select(F.to_date("transaction_date").alias("date")).distinct()
    return model.calendar_features(days)


@case(
    "week_key",
    ("transactions",),
    """SELECT date, CAST(year(date) AS INTEGER) AS calendar_year, CAST(week(date) AS INTEGER) AS calendar_week,
              CAST(isoyear(date) AS INTEGER) AS iso_year, CAST(week(date) AS INTEGER) AS iso_week,
              CAST(year(date) AS INTEGER) AS sunday_year,
              CAST(ceil((dayofyear(date) + dayofweek(make_date(year(date), 1, 1))) / 7.0) AS INTEGER) AS sunday_week
       FROM (SELECT DISTINCT CAST(transaction_date AS DATE) AS date FROM transactions)""",
)
def week_key(spark, sf):
    days = tables(spark, sf, "transactions")["transactions"].select(F.to_date("transaction_date").alias("date")).distinct()
    keys = []
    for mode in calendar.WEEK_MODES:
        year, week = calendar.week_key(F.col("date"), mode)
        keys += [year.alias(f"{mode}_year"), week.alias(f"{mode}_week")]
    return days.select("date", *keys)


@case(
    "week_to_month",
    ("weekly_sales",),
    """SELECT year, CAST(least(12, greatest(1, floor((week - 1) / 4.34::DOUBLE) + 1)) AS INTEGER) AS month,
              CAST(sum(sold) AS BIGINT) AS sold FROM weekly_sales GROUP BY 1, 2""",
)
def week_to_month(spark, sf):
    sales = tables(spark, sf, "weekly_sales")["weekly_sales"]
    return sales.groupBy("year", calendar.week_to_month(F.col("week")).alias("month")).agg(F.sum("sold").alias("sold"))


