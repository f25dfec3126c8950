"""Sources, sinks and streams, written to and read back from the scratch folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from registry.cases import case, rounded
from registry.features import EVENT_DAYS, FEATURE_COLUMNS, event_days, feature_table
from registry.tables import raw_table, table, tables
from shelfwise import schemas
from shelfwise.operators import features
from shelfwise.session import scratch_dir
from shelfwise.sources import feed as feeds
from shelfwise.sources import tables as io
from shelfwise.streaming import audit, sales, stock


def new_folder(spark, label):
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


@case(
    "snapshot_tables",
    ("stores", "products", "transactions"),
    """SELECT 'stores' AS name, count(*) AS n FROM stores UNION ALL SELECT 'products', count(*) FROM products
       UNION ALL SELECT 'transactions', count(*) FROM transactions""",
)
def snapshot_tables(spark, sf):
    base = new_folder(spark, "landing")
    paths = io.snapshot_tables(tables(spark, sf, "stores", "products", "transactions"), base, dt.date(2026, 6, 24))
    out = None
    for name in paths:
        one = io.read_table(spark, f"{base}/2026-06-24", name).agg(F.count(F.lit(1)).alias("n"))
        one = one.select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@case("write_features", ("featured",), f"SELECT {FEATURE_COLUMNS} FROM featured")
def write_features(spark, sf):
    """Written twice to the first of two folders: the second run replaces the dates of the first."""
    folders = [new_folder(spark, "final_daily"), new_folder(spark, "final_daily")]
    rows = features.project_features(feature_table(spark, sf))
    io.write_features(rows, [{"path": p} for p in folders])
    io.write_features(spark.read.parquet(folders[0]), [{"path": folders[1]}])
    return features.project_features(spark.read.parquet(folders[1]))


@case("conform", ("products",), """SELECT CAST(product_id AS VARCHAR) AS product_id, sku, category, price, CAST(NULL AS INTEGER) AS stock FROM products""")
def conform(spark, sf):
    raw = table(spark, sf, "products")
    raw = raw.toDF(*[name.upper() for name in raw.columns])
    return schemas.conform(raw, schemas.PRODUCTS).select("product_id", "sku", "category", "price", "stock")


@case(
    "read_json_table",
    ("imports",),
    "SELECT import_id, store_id, sku, quantity_imported, CAST(import_date AS VARCHAR) AS import_date, supplier FROM imports",
)
def read_json_table(spark, sf):
    base = new_folder(spark, "json")
    table(spark, sf, "imports").write.json(f"{base}/imports")
    kinds = "import_id BIGINT, store_id INT, sku STRING, quantity_imported INT, import_date STRING, supplier STRING"
    return io.read_table(spark, base, "imports", "json", schema=schemas.flat_schema(kinds))


@case("read_or_empty", (), "SELECT 1::BIGINT AS id, 'none' AS name WHERE FALSE UNION ALL SELECT count(*), 'customer' FROM customer")
def read_or_empty(spark, sf):
    raw_table(spark, sf, "customer").createOrReplaceTempView("known_customers")
    absent = io.read_or_empty(spark, "no_such_table", schemas.CUSTOMERS).select(
        F.lit(0).cast("bigint").alias("id"), F.lit("none").alias("name")
    )
    known = io.read_or_empty(spark, "known_customers", schemas.CUSTOMERS).agg(F.count(F.lit(1)).alias("id"))
    return absent.unionByName(known.withColumn("name", F.lit("customer")))


@case(
    "event_props",
    (),
    "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1",
)
def event_props(spark, sf):
    events = raw_table(spark, sf, "events")
    return events.groupBy(F.from_json("props", "k BIGINT")["k"].alias("k")).agg(F.count(F.lit(1)).alias("n"))


# --- nested feed ---

FEED = {
    "feed_items": """
        SELECT s_nationkey AS store_id, CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS STRING) AS date,
               CAST(l_partkey AS STRING) AS id, sum(l_quantity) * CAST(1.125 AS DOUBLE) AS weekly_forecast,
               CASE WHEN max(l_linenumber) = 7 THEN NULL ELSE sum(l_quantity) END AS weekly_sale
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3"""
}


def flat(spark, sf):
    """The feed's five tables, after a round through JSON files."""
    for name in ("lineitem", "supplier"):
        raw_table(spark, sf, name).createOrReplaceTempView(name)
    items = spark.sql(FEED["feed_items"])
    nested = items.groupBy("store_id", "date").agg(F.collect_list(F.struct("id", "weekly_forecast", "weekly_sale")).alias("products"))
    nested = nested.withColumns(
        {
            "store_name": F.when(F.col("store_id") > 3, F.concat(F.lit("Shop "), "store_id")),
            "lat": F.col("store_id") * 1.5,
            "lon": F.lit(None).cast("double"),
            "country": F.when(F.col("store_id") != 9, "Land"),
        }
    )
    path = new_folder(spark, "feed")
    nested.write.json(path)
    return feeds.flatten_feed(feeds.read_feed(spark, path, multi_line=False))


@case(
    "flatten_feed_stores",
    ("feed_items",),
    """SELECT store_id, CASE WHEN store_id > 3 THEN 'Shop ' || store_id ELSE 'Store #' || store_id END AS store_name,
              store_id * 1.5::DOUBLE AS latitude, 0.0::DOUBLE AS longitude, CASE WHEN store_id = 9 THEN 'Global' ELSE 'Land' END AS country,
              count(DISTINCT id) AS num_distinct_skus, count(DISTINCT id) AS num_distinct_products FROM feed_items GROUP BY store_id""",
    FEED,
)
def flatten_feed_stores(spark, sf):
    return flat(spark, sf)["stores"]


@case(
    "flatten_feed_products",
    ("feed_items",),
    "SELECT DISTINCT CAST(id AS BIGINT) AS product_id, 'Sản phẩm SKU-' || id AS product_name FROM feed_items",
    FEED,
)
def flatten_feed_products(spark, sf):
    return flat(spark, sf)["products"]


@case(
    "flatten_feed_skus",
    ("feed_items",),
    "SELECT DISTINCT 'SKU-' || id AS sku, CAST(id AS BIGINT) AS product_id FROM feed_items",
    FEED,
)
def flatten_feed_skus(spark, sf):
    return flat(spark, sf)["skus"]


@case(
    "flatten_feed_forecasts",
    ("feed_items",),
    """SELECT store_id, 'SKU-' || id AS sku, 'Sản phẩm SKU-' || id AS product_name,
              CAST(isoyear(CAST(date AS DATE)) AS INTEGER) AS year, CAST(week(CAST(date AS DATE)) AS INTEGER) AS week,
              CAST(round(weekly_forecast) AS INTEGER) AS predicted_quantity, CAST(round(weekly_sale) AS INTEGER) AS actual_quantity
       FROM feed_items""",
    FEED,
)
def flatten_feed_forecasts(spark, sf):
    return flat(spark, sf)["forecasts"]


@case(
    "flatten_feed_transactions",
    ("feed_items",),
    """SELECT store_id, CAST(id AS BIGINT) AS product_id, 'SKU-' || id AS sku, CAST(date AS DATE) AS date,
              CAST(greatest(1, round(weekly_sale)) AS INTEGER) AS quantity FROM feed_items WHERE weekly_sale > 0""",
    FEED,
)
def flatten_feed_transactions(spark, sf):
    return flat(spark, sf)["transactions"]


# --- streams, replayed in three triggers; every file holds rows of all dates, so most rows come late ---

TRIGGERS = 3
#: Rows of an arriving file. A larger table has more files a trigger, not larger ones, so no task reads a third of it.
FILE_ROWS = 1_000_000


def stream(spark, sf, name, key):
    """A test table as a stream of files that are not in the order of time."""
    path = new_folder(spark, "arriving")
    rows = raw_table(spark, sf, name)
    at_once = max(1, -(-rows.count() // (TRIGGERS * FILE_ROWS)))
    rows.repartition(TRIGGERS * at_once, F.col(key)).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", at_once).parquet(path)


def sales_and_imports(events):
    """Purchases and errors as sales, signups as imports of five pieces."""
    kind = F.col("event_type")
    rows = events.select(
        (F.col("user_id") % 5).cast("int").alias("store_id"),
        F.concat(F.lit("SKU "), kind).alias("sku"),
        F.lit(None).cast("bigint").alias("product_id"),
        F.when(kind == "purchase", 1).when(kind == "error", 3).otherwise(0).alias("quantity"),
        F.when(kind == "signup", 5).otherwise(0).alias("quantity_imported"),
    )
    return rows.drop("quantity_imported"), rows.drop("quantity", "product_id")


@case(
    "stock_stream",
    ("moves",),
    """SELECT store_id, sku, quantity, quantity < 0 AS warn FROM (
         SELECT store_id, sku, CAST(sum(delta) + 40 AS BIGINT) AS quantity FROM moves GROUP BY 1, 2)""",
)
def stock_stream(spark, sf):
    path = new_folder(spark, "stock")
    sold, _ = sales_and_imports(stream(spark, sf, "events", "event_id"))
    _, came = sales_and_imports(stream(spark, sf, "events", "event_id"))
    changes = stock.movements(sold, came)
    stock.stock_stream(changes, f"{path}/batches", f"{path}/checkpoint", fold_every=2).awaitTermination()
    opening = sales_and_imports(raw_table(spark, sf, "events"))[1].select("store_id", "sku").distinct()
    return stock.on_hand(spark, f"{path}/batches", opening.withColumn("quantity", F.lit(40).cast("bigint")))


@case(
    "dedup_stream",
    (),
    "SELECT DISTINCT l_orderkey * 10 + l_linenumber AS transaction_id FROM lineitem",
)
def dedup_stream(spark, sf):
    lines = stream(spark, sf, "lineitem", "l_partkey").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_shipdate").alias("transaction_date"),
    )
    path = new_folder(spark, "dedup")
    sales.dedup_stream(lines, f"{path}/rows", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("transaction_id")


def event_sales(spark, sf):
    return stream(spark, sf, "events", "event_id").select(
        (F.col("user_id") % 5).cast("int").alias("store_id"),
        F.col("event_type").alias("sku"),
        (1 + F.col("event_id") % 3).alias("quantity"),
        F.col("ts").alias("transaction_date"),
    )


ARRIVED = {
    "arrived": """SELECT CAST(user_id % 5 AS INTEGER) AS store_id, event_type AS sku, CAST(ts AS DATE) AS date,
                         CAST(sum(1 + event_id % 3) AS DOUBLE) AS qty FROM events GROUP BY 1, 2, 3"""
}


@case("daily_stream", ("arrived",), "SELECT * FROM arrived", ARRIVED)
def daily_stream(spark, sf):
    path = new_folder(spark, "days")
    sales.daily_stream(event_sales(spark, sf), f"{path}/batches", f"{path}/checkpoint", fold_every=2).awaitTermination()
    return sales.days(spark, f"{path}/batches")


@case(
    "refresh_stream",
    ("arrived",),
    f"""SELECT d.store_id, d.sku, d.date, d.qty, lag(qty, 1, 0.0) OVER w AS lag_1d,
               coalesce({rounded("avg(qty) OVER d14", 4)}, 0.0) AS rolling_mean_14d,
               coalesce({rounded("avg(qty) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)", 4)}, 0.0) AS target_encoding_store_sku,
               CAST(c.stores AS DOUBLE) AS sku_store_coverage,
               CAST(d.date - c.first_date AS DOUBLE) AS total_lifespan,
               CAST(d.date - min(d.date) OVER (PARTITION BY d.store_id, d.sku) AS DOUBLE) AS s_total_lifespan
        FROM arrived d JOIN (SELECT sku, count(DISTINCT store_id) AS stores, min(date) AS first_date FROM arrived GROUP BY sku) c USING (sku)
        WINDOW w AS (PARTITION BY d.store_id, d.sku ORDER BY d.date),
               d14 AS (PARTITION BY d.store_id, d.sku ORDER BY d.date - DATE '1970-01-01' RANGE BETWEEN 14 PRECEDING AND 1 PRECEDING)""",
    ARRIVED,
)
def refresh_stream(spark, sf):
    path = new_folder(spark, "refreshed")
    query = sales.daily_stream(event_sales(spark, sf), f"{path}/batches", f"{path}/checkpoint", refreshed=f"{path}/features")
    query.awaitTermination()
    rows = sales.newest_features(spark, f"{path}/features")
    columns = ("lag_1d", "rolling_mean_14d", "target_encoding_store_sku", "sku_store_coverage", "total_lifespan", "s_total_lifespan")
    return rows.select("store_id", "sku", "date", "qty", *columns)


@case(
    "refresh_features",
    ("event_days",),
    f"""SELECT * FROM (
          SELECT store_id, sku, date, qty, lag(qty, 1, 0.0) OVER w AS lag_1d, lag(qty, 28, 0.0) OVER w AS lag_28d,
                 coalesce({rounded("avg(qty) OVER d14", 4)}, 0.0) AS rolling_mean_14d,
                 coalesce({rounded("avg(qty) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)", 4)}, 0.0) AS target_encoding_store_sku
          FROM event_days
          WINDOW w AS (PARTITION BY store_id, sku ORDER BY date),
                 d14 AS (PARTITION BY store_id, sku ORDER BY date - DATE '1970-01-01' RANGE BETWEEN 14 PRECEDING AND 1 PRECEDING))
        WHERE sku = 'purchase' AND date >= DATE '2024-01-12'""",
    EVENT_DAYS,
)
def refresh_features(spark, sf):
    days = event_days(spark, sf)
    late = days.where((F.col("sku") == "purchase") & (F.col("date") >= "2024-01-12"))
    out = sales.refresh_features(late, days)
    return out.select("store_id", "sku", "date", "qty", "lag_1d", "lag_28d", "rolling_mean_14d", "target_encoding_store_sku")


@case(
    "audit_stream",
    ("audit_logs",),
    """SELECT CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS start,
              CASE WHEN action LIKE 'LOGIN%' THEN 'login' WHEN action LIKE '%CREATE' THEN 'create' WHEN action LIKE '%UPDATE' THEN 'update'
                   WHEN action LIKE '%DELETE' THEN 'delete' ELSE 'default' END AS action_class, count(*) AS n
       FROM audit_logs GROUP BY 1, 2""",
)
def audit_stream(spark, sf):
    kind = F.col("event_type")
    action = (
        F.when(kind == "click", "LOGIN_SUCCESS").when(kind == "purchase", "TRANSACTION_CREATE")
        .when(kind == "view", "STOCK_UPDATE").when(kind == "error", "MFA_DELETE").otherwise("EXPORT")
    )
    log = stream(spark, sf, "events", "event_id").select(F.col("ts").alias("timestamp"), action.alias("action"))
    path = new_folder(spark, "audit")
    audit.audit_stream(log, f"{path}/batches", f"{path}/checkpoint", fold_every=2).awaitTermination()
    return audit.counts(spark, f"{path}/batches").withColumn("start", F.col("start").cast("timestamp_ntz"))
