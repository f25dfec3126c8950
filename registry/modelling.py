"""Feature lookup, training steps and forecasts."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from registry.cases import case, rounded
from registry.features import BASE, EXTRA_COLUMNS, FEATURE_COLUMNS, feature_table
from registry.tables import table, tables
from shelfwise.functions.text import parse_store_id
from shelfwise.operators import aggregate, lookup, model
from shelfwise.plans import features as jobs
from shelfwise.plans import forecast, training
from shelfwise.session import scratch_dir, stage
from shelfwise.sources.tables import latest_snapshot

START = dt.date(2026, 12, 28)

STEPS = {
    "asked": """
        SELECT DISTINCT coalesce(TRY_CAST(replace(upper(store_id), 'STORE_', '') AS INTEGER), 1) AS store_id, sku,
               CAST(date AS DATE) AS date
        FROM requests WHERE TRY_CAST(date AS DATE) IS NOT NULL""",
    "nearest": f"""
        SELECT a.store_id, a.sku, a.date, f.date AS feature_date, f.* EXCLUDE (store_id, sku, date)
        FROM asked a JOIN (SELECT {FEATURE_COLUMNS}, {EXTRA_COLUMNS} FROM featured) f ON a.store_id = f.store_id AND a.sku = f.sku
        QUALIFY row_number() OVER (PARTITION BY a.store_id, a.sku, a.date ORDER BY abs(a.date - f.date), f.date) = 1""",
    "static": """
        SELECT a.store_id, a.sku,
               CASE WHEN p IS NOT NULL THEN CAST(p.product_id AS INTEGER) END AS product_id,
               CASE WHEN p IS NOT NULL THEN coalesce(p.size, 'M') END AS size,
               CASE WHEN p IS NOT NULL THEN coalesce(p.color, 'BLACK') END AS color,
               CASE WHEN p IS NOT NULL THEN coalesce(p.category, 'Feminine') END AS category,
               CASE WHEN p IS NOT NULL THEN coalesce(p.sub_category, 'Coats and Blazers') END AS sub_category,
               CASE WHEN p IS NOT NULL THEN 'Cor Unica' END AS color_type,
               CASE WHEN p IS NOT NULL THEN coalesce(p.cost, 50.0) END AS avg_usd_price,
               CASE WHEN s.store_id IS NOT NULL THEN coalesce(s.country, 'United States') END AS country,
               CASE WHEN s.store_id IS NOT NULL THEN coalesce(s.city, 'New York') END AS city,
               CASE WHEN s.store_id IS NOT NULL THEN CAST(coalesce(s.num_employees * 1700, 17000) AS BIGINT) END AS num_distinct_products,
               CASE WHEN s.store_id IS NOT NULL THEN CAST(coalesce(s.num_employees * 5000, 50000) AS BIGINT) END AS num_distinct_skus,
               p IS NOT NULL OR s.store_id IS NOT NULL AS static_found
        FROM (SELECT DISTINCT store_id, sku FROM asked) a
             LEFT JOIN (SELECT sku, arg_min(products, product_id) AS q FROM products WHERE sku IS NOT NULL GROUP BY sku) k ON a.sku = k.sku
             LEFT JOIN products d ON CAST(d.product_id AS VARCHAR) = nullif(regexp_extract(a.sku, '[0-9]+'), '')
             LEFT JOIN stores s ON a.store_id = s.store_id,
             LATERAL (SELECT CASE WHEN k.q IS NOT NULL THEN k.q WHEN d.product_id IS NOT NULL THEN d END AS p)""",
}


def asked(spark, sf):
    """Distinct (store, SKU, date) of the valid requests."""
    requests = table(spark, sf, "requests")
    day = F.try_to_date("date", "yyyy-M-d")
    keys = requests.select(parse_store_id(F.col("store_id")).alias("store_id"), "sku", day.alias("date"))
    return keys.where(F.col("date").isNotNull()).distinct()


@case(
    "nearest_features",
    ("nearest",),
    """SELECT store_id, sku, date, feature_date, product_id, avg_usd_price, lag_1d, rolling_mean_7d, s_sales_velocity,
              target_encoding_store_sku FROM nearest""",
    STEPS,
)
def nearest_features(spark, sf):
    out = lookup.nearest_features(asked(spark, sf), feature_table(spark, sf))
    return out.select(
        "store_id", "sku", "date", "feature_date", "product_id", "avg_usd_price", "lag_1d", "rolling_mean_7d",
        "s_sales_velocity", "target_encoding_store_sku",
    )


@case("static_features", ("static",), "SELECT * FROM static", STEPS)
def static_features(spark, sf):
    t = tables(spark, sf, "products", "stores")
    return lookup.static_features(asked(spark, sf).select("store_id", "sku").distinct(), t["products"], t["stores"])


FOUND = """
    SELECT a.store_id, a.sku, a.date, n.feature_date,
           CASE WHEN n.feature_date IS NOT NULL THEN 'daily' WHEN s.static_found THEN 'static' ELSE 'missing' END AS source,
           coalesce(n.product_id, s.product_id) AS product_id, coalesce(n.size, s.size) AS size,
           coalesce(n.category, s.category) AS category, coalesce(n.avg_usd_price, s.avg_usd_price) AS avg_usd_price,
           coalesce(n.country, s.country) AS country, coalesce(n.num_distinct_skus, s.num_distinct_skus) AS num_distinct_skus,
           n.lag_1d, n.rolling_std_7d, n.total_discount_avg
    FROM asked a LEFT JOIN nearest n USING (store_id, sku, date) LEFT JOIN static s USING (store_id, sku)"""
FOUND_COLUMNS = (
    "store_id, sku, date, feature_date, source, product_id, size, category, avg_usd_price, country, num_distinct_skus, "
    "lag_1d, rolling_std_7d, total_discount_avg"
)


@case("features_for", ("asked", "nearest", "static"), f"SELECT {FOUND_COLUMNS} FROM ({FOUND})", STEPS)
def features_for(spark, sf):
    t = tables(spark, sf, "products", "stores")
    out = lookup.features_for(asked(spark, sf), feature_table(spark, sf), t["products"], t["stores"])
    return out.select(*FOUND_COLUMNS.split(", "))


@case(
    "validate_features",
    ("asked", "nearest", "static"),
    f"""SELECT source, CASE WHEN source = 'daily' THEN 'ok' ELSE 'error' END AS status,
               CASE WHEN source = 'static' THEN 'missing features: ' || CASE WHEN product_id IS NULL THEN 'product_id, size, color, ' ELSE '' END
                 || 'total_lifespan, s_total_lifespan, sku_store_coverage, product_store_coverage, s_days_active, '
                 || 's_selling_days_count, s_sales_velocity, s2_days_active, s2_selling_days_count, s2_sales_velocity, '
                 || CASE WHEN product_id IS NULL THEN 'avg_usd_price, ' ELSE '' END
                 || 'total_discount_avg, lag_1d, lag_7d, rolling_mean_7d, rolling_std_7d, '
                 || CASE WHEN product_id IS NULL THEN 'category, sub_category, color_type, ' ELSE '' END
                 || 'lag_14d, lag_28d, rolling_mean_14d, rolling_mean_30d, target_encoding_store_sku' END AS message,
               count(*) AS n
        FROM ({FOUND}) GROUP BY 1, 2, 3""",
    STEPS,
)
def validate_features(spark, sf):
    t = tables(spark, sf, "products", "stores")
    found = lookup.features_for(asked(spark, sf), feature_table(spark, sf), t["products"], t["stores"])
    return lookup.validate_features(found).groupBy("source", "status", "message").agg(F.count(F.lit(1)).alias("n"))


@case(
    "apply_overrides",
    ("requests", "asked", "nearest", "static"),
    f"""SELECT store_id, sku, date, total_discount_avg, count(*) AS n FROM (
          SELECT f.store_id, f.sku, f.date, coalesce(r.total_discount_avg, f.total_discount_avg) AS total_discount_avg
          FROM (SELECT *, coalesce(TRY_CAST(replace(upper(store_id), 'STORE_', '') AS INTEGER), 1) AS store,
                       TRY_CAST(date AS DATE) AS day FROM requests) r
               JOIN ({FOUND}) f ON r.store = f.store_id AND r.sku = f.sku AND r.day = f.date
          WHERE r.total_discount_avg IS NULL OR r.total_discount_avg BETWEEN 0 AND 1) GROUP BY 1, 2, 3, 4""",
    STEPS,
)
def apply_overrides(spark, sf):
    t = tables(spark, sf, "requests", "products", "stores")
    checked, _ = forecast.prepared_requests(t["requests"], feature_table(spark, sf), t["products"], t["stores"])
    return checked.groupBy("store_id", "sku", "date", "total_discount_avg").agg(F.count(F.lit(1)).alias("n"))


DEFAULT_ROWS = "SELECT product_id, size, color, price AS avg_usd_price FROM products"


def _filled(profile):
    """The defaults of a profile in SQL, laid under the columns that the rows have."""
    given = ("product_id", "size", "color", "avg_usd_price")
    text = {name: f"'{value}'" if isinstance(value, str) else f"{value}::{'DOUBLE' if isinstance(value, float) else 'BIGINT'}" for name, value in lookup.PROFILES[profile].items()}
    values = [f"coalesce({name}, {text[name]}) AS {name}" if name in given else f"{text[name]} AS {name}" for name in text]
    return f"SELECT {', '.join(values)}, '{profile}' AS profile FROM ({DEFAULT_ROWS})"


@case("default_features", ("products",), f"{_filled('null')} UNION ALL {_filled('miss')}")
def default_features(spark, sf):
    rows = table(spark, sf, "products").select("product_id", "size", "color", F.col("price").alias("avg_usd_price"))
    kinds = {str: "string", float: "double", int: "bigint"}
    absent = {name: F.lit(None).cast(kinds[type(value)]) for name, value in lookup.NULL_DEFAULTS.items() if name not in rows.columns}
    rows = rows.withColumns(absent)
    parts = [lookup.default_features(rows, profile).withColumn("profile", F.lit(profile)) for profile in lookup.PROFILES]
    return parts[0].unionByName(parts[1])


# --- training steps ---

TRIMMED = "SELECT * REPLACE (trim(sku) AS sku) FROM transactions"
TRAINING = {
    "label": """
        SELECT store_id, trim(sku) AS sku, CAST(transaction_date AS DATE) AS date, CAST(sum(quantity) AS DOUBLE) AS sold
        FROM transactions GROUP BY 1, 2, 3""",
    "training": f"""
        SELECT f.*, coalesce(l.sold, 0.0) AS y FROM (SELECT {FEATURE_COLUMNS}, {EXTRA_COLUMNS} FROM featured) f
        LEFT JOIN label l ON f.store_id = l.store_id AND f.sku = l.sku AND f.date = l.date""",
}


USED = ("store_id", "product_id", "sku", "quantity", "discount_pct", "transaction_date")


def sources(spark, sf):
    """(features, transactions): the transactions are derived from the test tables once, for the features and the label."""
    base = tables(spark, sf, *BASE)
    base["transactions"] = stage(base["transactions"].select(*USED), "transactions")
    return jobs.flagship_features(base, extended=True), base["transactions"]


def kept_sources(spark, sf):
    """``sources`` with the feature table staged, for queries that train on it and look features up in it."""
    daily, tx = sources(spark, sf)
    return stage(daily, "features"), tx


def training_rows(spark, sf, given=None):
    daily, tx = given or sources(spark, sf)
    return training.training_set(daily, tx.withColumn("sku", F.trim("sku")))


@case("training_set", ("training",), "SELECT store_id, sku, date, lag_1d, rolling_mean_30d, y AS qty FROM training", TRAINING)
def training_set(spark, sf):
    return training_rows(spark, sf).select("store_id", "sku", "date", "lag_1d", "rolling_mean_30d", "qty")


@case(
    "time_split",
    ("training",),
    """SELECT part, count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM (
         SELECT date, CASE WHEN max(rn) OVER (PARTITION BY date) <= CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'train' ELSE 'valid' END AS part
         FROM (SELECT date, row_number() OVER (ORDER BY date) AS rn, count(*) OVER () AS n FROM training)) GROUP BY part""",
    TRAINING,
)
def time_split(spark, sf):
    return _split_summary(*model.time_split(stage(training_rows(spark, sf).select("store_id", "sku", "date"), "split"), 0.8))


@case(
    "time_split_exact",
    ("training",),
    """SELECT CASE WHEN rn <= CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'train' ELSE 'valid' END AS part, count(*) AS n,
              min(date) AS first_date, max(date) AS last_date
       FROM (SELECT date, row_number() OVER (ORDER BY date, store_id, sku) AS rn, count(*) OVER () AS n FROM training) GROUP BY part""",
    TRAINING,
)
def time_split_exact(spark, sf):
    rows = stage(training_rows(spark, sf).select("store_id", "sku", "date"), "split")
    return _split_summary(*model.time_split(rows, 0.8, exact=True))


def _split_summary(train, valid):
    both = train.withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("valid")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


DICTIONARY = {
    "dictionary": "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 AS BIGINT) AS code "
        f"FROM (SELECT DISTINCT {c} FROM featured)"
        for c in model.TEXT_COLUMNS
    )
}


@case("fit_encoder", ("dictionary",), 'SELECT "column", value, code FROM dictionary', DICTIONARY)
def fit_encoder(spark, sf):
    return model.fit_encoder(feature_table(spark, sf))


@case(
    "encode",
    ("featured",),
    """SELECT store_id, sku, date, dense_rank() OVER (ORDER BY sku) - 1 AS sku_code, dense_rank() OVER (ORDER BY city) - 1 AS city_code,
              dense_rank() OVER (ORDER BY color) - 1 AS color_code FROM featured""",
)
def encode(spark, sf):
    rows = feature_table(spark, sf).select("store_id", "sku", "date", "city", "color")
    rows = stage(rows, "rows")
    cols = ["sku", "city", "color"]
    out = model.encode(rows, model.fit_encoder(rows, cols), cols)
    return out.select("store_id", "sku", "date", "sku_code", "city_code", "color_code")


@case(
    "encode_unseen",
    ("featured", "products"),
    """SELECT p.product_id, p.sub_category, coalesce(d.code, 0) AS sub_category_code FROM products p LEFT JOIN (
         SELECT sub_category, row_number() OVER (ORDER BY sub_category) - 1 AS code
         FROM (SELECT DISTINCT CASE WHEN category = 'PROMO' AND color = 'red' THEN sub_category ELSE '?' || sub_category END AS sub_category
               FROM products)) d USING (sub_category)""",
)
def encode_unseen(spark, sf):
    products = table(spark, sf, "products").select("product_id", "sub_category", "category", "color")
    # Most values reach the dictionary under another name, so products meet values it lacks.
    seen = F.coalesce((F.col("category") == "PROMO") & (F.col("color") == "red"), F.lit(False))
    known = products.withColumn("sub_category", F.when(seen, F.col("sub_category")).otherwise(F.concat(F.lit("?"), "sub_category")))
    out = model.encode(products, model.fit_encoder(known, ["sub_category"]), ["sub_category"])
    return out.select("product_id", "sub_category", "sub_category_code")


SCALED = ("store_id", "avg_usd_price", "lag_1d", "rolling_mean_7d", "s_sales_velocity", "total_lifespan")


@case(
    "fit_scaler",
    ("featured",),
    "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS scale FROM featured"
        for i, c in enumerate(SCALED)
    ),
)
def fit_scaler(spark, sf):
    out = model.fit_scaler(feature_table(spark, sf), SCALED)
    return out.withColumns({"mean": F.round("mean", 6), "scale": F.round("scale", 6)})


@case(
    "scale",
    ("featured",),
    "SELECT store_id, sku, date, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 4) AS {c}_z" for c in SCALED[1:])
    + " FROM featured",
)
def scale(spark, sf):
    rows = stage(feature_table(spark, sf).select("store_id", "sku", "date", *SCALED[1:]), "rows")
    out = model.scale(rows, model.fit_scaler(rows, SCALED[1:]), "_z")
    return out.select("store_id", "sku", "date", *[F.round(f"{c}_z", 4).alias(f"{c}_z") for c in SCALED[1:]])


@case(
    "regression_metrics",
    ("featured",),
    """SELECT count(*) AS n, round(sqrt(avg((qty - p) * (qty - p))), 6) AS rmse, round(avg(abs(qty - p)), 6) AS mae,
              round(1 - sum((qty - p) * (qty - p)) / (var_pop(qty) * count(*)), 6) AS r2,
              round(avg(abs((qty - p) / (qty + 1))) * 100, 6) AS mape
       FROM (SELECT qty, rolling_mean_30d AS p FROM featured)""",
)
def regression_metrics(spark, sf):
    from registry.features import daily
    from shelfwise.operators.features import rolling_features

    rows = rolling_features(daily(spark, sf), [30], [])
    return aggregate.regression_metrics(rows, "qty", "rolling_mean_30d", places=6)


# --- forecasts with a plain formula in place of the model ---

HORIZON = {
    "horizon": f"""
        SELECT s.*, CAST(d AS DATE) AS day, CAST(round((s.s_sales_velocity + s.lag_1d / 8.0 + day(d)) * 100) AS BIGINT) AS cents
        FROM (SELECT {FEATURE_COLUMNS} FROM featured WHERE date = (SELECT max(date) FROM featured)) s,
             (SELECT unnest(generate_series(DATE '2026-12-29', DATE '2027-01-04', INTERVAL 1 DAY)) AS d)"""
}


def horizon(spark, sf):
    rows = forecast.expand_horizon(latest_snapshot(feature_table(spark, sf)), START, 7)
    value = F.round((F.col("s_sales_velocity") + F.col("lag_1d") / 8 + F.dayofmonth("date")) * 100) / 100
    return rows.withColumn("prediction", value)


@case("expand_horizon", ("horizon",), "SELECT store_id, sku, day AS date, cents / 100.0::DOUBLE AS prediction FROM horizon", HORIZON)
def expand_horizon(spark, sf):
    return horizon(spark, sf).select("store_id", "sku", "date", "prediction")


@case(
    "weekly_forecast",
    ("horizon",),
    """SELECT store_id, sku, product_id, CAST(year(day) AS INTEGER) AS forecast_year, CAST(week(day) AS INTEGER) AS forecast_week,
              round(sum(cents) / 100.0::DOUBLE, 2) AS predicted_quantity FROM horizon GROUP BY 1, 2, 3, 4, 5""",
    HORIZON,
)
def weekly_forecast(spark, sf):
    return forecast.weekly_forecast(horizon(spark, sf), places=2)


@case(
    "monthly_forecast",
    ("horizon",),
    """SELECT store_id, sku, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
              round(sum(cents) / 100.0::DOUBLE, 2) AS predicted_quantity FROM horizon GROUP BY 1, 2, 3, 4""",
    HORIZON,
)
def monthly_forecast(spark, sf):
    return forecast.monthly_forecast(horizon(spark, sf))


# --- with fitted models: keys, outcomes and the formula of a prediction are checked, not its value ---

SAVED: dict[tuple[str, str, str], str] = {}


def fitted(spark, sf, kind="tweedie", given=None):
    """The model over a folder's whole tables, trained once per session, saved and loaded again."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in SAVED:
        trained, _ = training.train_demand(training_rows(spark, sf, given), kind)
        path = f"{scratch_dir(spark)}/model-{uuid.uuid4().hex}"
        model.save_model(trained, path)
        SAVED[key] = path
    return model.load_model(spark, SAVED[key])


@case("train_demand")
def train_demand(spark, sf):
    return training.train_demand(training_rows(spark, sf))[1]


@case("train_demand_trees")
def train_demand_trees(spark, sf):
    """Fewer and larger steps than the library's default, as a round is some ten jobs whatever the size of the table."""
    return training.train_demand(training_rows(spark, sf), "gbt", trees=80, rate=0.3)[1]


@case("score", ("training",), "SELECT store_id, sku, date, y AS qty, TRUE AS follows_formula FROM training", TRAINING)
def score(spark, sf):
    """Every prediction is the exponential of the sum of the model's scaled and weighted inputs."""
    given = kept_sources(spark, sf)
    demand = fitted(spark, sf, given=given)
    rows = model.calendar_features(training_rows(spark, sf, given))
    scored = model.score(demand, model.encode(rows, demand.encoder).drop("prediction"), encoded=True)
    scaling = {r["feature"]: (r["mean"], r["scale"]) for r in demand.scaler.collect()}
    total = F.lit(float(demand.regression.intercept))
    for name, weight in zip(demand.inputs, demand.regression.coefficients.toArray().tolist()):
        mean, spread = scaling[name]
        total = total + F.lit(weight) * (F.col(name).cast("double") - F.lit(mean)) / F.lit(spread)
    codes = model.encode(scored, demand.encoder)
    close = F.abs(F.col("prediction") - F.exp(total)) <= 1e-6 * F.exp(total)
    return codes.select("store_id", "sku", "date", "qty", close.alias("follows_formula"))


@case(
    "run_forecast",
    ("horizon",),
    """SELECT DISTINCT CAST(store_id AS VARCHAR) AS store_id, sku, CAST(product_id AS VARCHAR) AS product_id,
              CAST(year(day) AS INTEGER) AS forecast_year, CAST(week(day) AS INTEGER) AS forecast_week,
              'lgbm_v1' AS model_version, TRUE AS valid FROM horizon""",
    HORIZON,
)
def run_forecast(spark, sf):
    given = kept_sources(spark, sf)
    rows = forecast.run_forecast(given[0], fitted(spark, sf, given=given), START)
    return rows.withColumn("valid", F.col("predicted_quantity") >= 0).drop("predicted_quantity")


REQUESTED = """(SELECT *, coalesce(TRY_CAST(replace(upper(store_id), 'STORE_', '') AS INTEGER), 1) AS store, TRY_CAST(date AS DATE) AS day,
                       TRY_CAST(date AS DATE) IS NULL AS bad_date, coalesce(total_discount_avg < 0 OR total_discount_avg > 1, FALSE) AS bad_discount
                FROM requests)"""
OUTCOMES = f"""
    SELECT r.store_id, r.sku, strftime(r.day, '%Y-%m-%d') AS date, source, f.product_id, r.day,
           CASE source WHEN 'missing' THEN 'features not found' WHEN 'static' THEN 'missing features: '
                || CASE WHEN f.product_id IS NULL THEN 'product_id, size, color, ' ELSE '' END
                || 'total_lifespan, s_total_lifespan, sku_store_coverage, product_store_coverage, s_days_active, '
                || 's_selling_days_count, s_sales_velocity, s2_days_active, s2_selling_days_count, s2_sales_velocity, '
                || CASE WHEN f.product_id IS NULL THEN 'avg_usd_price, ' ELSE '' END
                || CASE WHEN r.total_discount_avg IS NULL THEN 'total_discount_avg, ' ELSE '' END
                || 'lag_1d, lag_7d, rolling_mean_7d, rolling_std_7d, '
                || CASE WHEN f.product_id IS NULL THEN 'category, sub_category, color_type, ' ELSE '' END
                || 'lag_14d, lag_28d, rolling_mean_14d, rolling_mean_30d, target_encoding_store_sku' END AS message
    FROM {REQUESTED} r JOIN ({FOUND}) f ON r.store = f.store_id AND r.sku = f.sku AND r.day = f.date
    WHERE NOT bad_date AND NOT bad_discount"""
INVALID = f"""
    SELECT store_id, sku, date, 'invalid fields: ' || CASE WHEN bad_date AND bad_discount THEN 'date, total_discount_avg'
                                                           WHEN bad_date THEN 'date' ELSE 'total_discount_avg' END AS message
    FROM {REQUESTED} WHERE bad_date OR bad_discount"""


def outcomes(spark, sf, defaults=None):
    t = tables(spark, sf, "requests", "products", "stores")
    given = kept_sources(spark, sf)
    rows = forecast.score_batch(
        t["requests"], given[0], t["products"], t["stores"], fitted(spark, sf, given=given), defaults
    )
    sound = F.when(F.col("status") == "success", F.col("predicted_quantity") >= 0).otherwise(F.col("predicted_quantity") == 0)
    return rows.groupBy("store_id", "sku", "date", "status", "message").agg(F.count(F.lit(1)).alias("n"), F.every(sound).alias("sound"))


@case(
    "score_batch",
    ("requests", "asked", "nearest", "static"),
    f"""SELECT store_id, sku, date, status, message, count(*) AS n, TRUE AS sound FROM (
          SELECT store_id, sku, date, CASE WHEN message IS NULL THEN 'success' ELSE 'error' END AS status, message FROM ({OUTCOMES})
          UNION ALL SELECT store_id, sku, date, 'error', message FROM ({INVALID})) GROUP BY 1, 2, 3, 4, 5""",
    STEPS,
)
def score_batch(spark, sf):
    return outcomes(spark, sf)


@case(
    "score_batch_defaults",
    ("requests", "asked", "nearest", "static"),
    f"""SELECT store_id, sku, date, status, message, count(*) AS n, TRUE AS sound FROM (
          SELECT store_id, sku, date, 'success' AS status, NULL AS message FROM ({OUTCOMES})
          UNION ALL SELECT store_id, sku, date, 'error', message FROM ({INVALID})) GROUP BY 1, 2, 3, 4, 5""",
    STEPS,
)
def score_batch_defaults(spark, sf):
    return outcomes(spark, sf, "miss")


@case(
    "forecast_requests",
    ("requests", "asked", "nearest", "static"),
    f"""SELECT DISTINCT store_id, sku, product_id, CAST(year(day) AS INTEGER) AS forecast_year,
              CAST(week(day) AS INTEGER) AS forecast_week, TRUE AS valid FROM ({OUTCOMES}) WHERE message IS NULL""",
    STEPS,
)
def forecast_requests(spark, sf):
    t = tables(spark, sf, "requests", "products", "stores")
    given = kept_sources(spark, sf)
    out = forecast.forecast_requests(
        t["requests"], given[0], t["products"], t["stores"], fitted(spark, sf, given=given)
    )
    return out["weekly"].withColumn("valid", F.col("predicted_quantity") >= 0).drop("predicted_quantity")
