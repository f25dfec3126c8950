"""Stock ledgers, table maintenance, forecasts against stock."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.cases import SKU_DIGITS, case, sku_category
from registry.tables import raw_table, table, tables
from shelfwise import schemas
from shelfwise.operators import aggregate, dims, maintain
from shelfwise.operators import stock as allocation

# --- ledgers ---


@case(
    "seed_stock",
    ("transactions",),
    """SELECT store_id, sku, min(product_id) AS product_id,
              CAST(greatest(0, round(sum(quantity) * 0.2::DOUBLE)) AS BIGINT) AS quantity,
              CAST(CAST(max(transaction_date) AS DATE) + INTERVAL 7 DAY AS DATE) AS last_restocked
       FROM transactions WHERE quantity > 0 AND sku IS NOT NULL GROUP BY store_id, sku""",
)
def seed_stock(spark, sf):
    return maintain.seed_stock(table(spark, sf, "transactions"))


@case(
    "apply_deltas",
    ("stock", "imports"),
    """SELECT store_id, coalesce(s.sku, d.sku) AS sku, product_id, coalesce(s.quantity, 0) + coalesce(d.quantity, 0) AS quantity,
              coalesce(d.day, s.last_restocked) AS last_restocked
       FROM stock s FULL JOIN (SELECT store_id, CASE WHEN import_id % 2 = 0 THEN 'Brand#' || import_id % 40 ELSE sku END AS sku,
                                      CAST(sum(quantity_imported) AS BIGINT) AS quantity, max(import_date) AS day
                               FROM imports WHERE quantity_imported > 0 GROUP BY 1, 2) d USING (store_id, sku)""",
)
def apply_deltas(spark, sf):
    t = tables(spark, sf, "stock", "imports")
    brand = F.concat(F.lit("Brand#"), (F.col("import_id") % 40).cast("string"))
    imports = t["imports"].withColumns(
        {"sku": F.when(F.col("import_id") % 2 == 0, brand).otherwise(F.col("sku")), "product_id": F.lit(None).cast("bigint")}
    )
    return maintain.apply_imports(t["stock"], imports)


@case(
    "apply_sales",
    ("stock", "transactions"),
    """SELECT store_id, sku, coalesce(s.product_id, d.product_id) AS product_id, s.last_restocked,
              coalesce(s.quantity, 0) + coalesce(d.quantity, 0) AS quantity,
              coalesce(s.quantity, 0) + coalesce(d.quantity, 0) < 0 AS warn
       FROM stock s FULL JOIN (SELECT store_id, sku, CAST(-sum(quantity) AS BIGINT) AS quantity, min(product_id) AS product_id
                               FROM (SELECT store_id, quantity, product_id,
                                            CASE WHEN line_id % 3 = 0 THEN trim(sku) ELSE sku END AS sku FROM transactions)
                               WHERE quantity > 0 AND sku <> '' GROUP BY 1, 2) d USING (store_id, sku)""",
)
def apply_sales(spark, sf):
    t = tables(spark, sf, "stock", "transactions")
    sku = F.when(F.col("line_id") % 3 == 0, F.trim("sku")).otherwise(F.col("sku"))
    return maintain.apply_sales(t["stock"], t["transactions"].withColumn("sku", sku))


def _walk(lines: str, keys: str, order: str) -> dict[str, str]:
    """Serve ``lines`` (keys, order, asked, available) one by one."""
    join = " AND ".join(f"n.{k} IS NOT DISTINCT FROM w.{k}" for k in keys.split(", "))
    cols = ", ".join(f"n.{k}" for k in keys.split(", "))
    return {
        "numbered": f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM ({lines})",
        "walk": f"""
            SELECT {keys}, rn, line_id, asked, asked <= available AND asked > 0 AS accepted,
                   CASE WHEN asked <= available AND asked > 0 THEN available - asked ELSE available END AS remaining
            FROM numbered WHERE rn = 1
            UNION ALL
            SELECT {cols}, n.rn, n.line_id, n.asked, n.asked <= w.remaining AND n.asked > 0,
                   CASE WHEN n.asked <= w.remaining AND n.asked > 0 THEN w.remaining - n.asked ELSE w.remaining END
            FROM walk w JOIN numbered n ON {join} AND n.rn = w.rn + 1""",
    }


ORDERS = "store_id, trim(sku) AS sku, line_id, quantity, CAST(transaction_date AS DATE) AS day"


@case(
    "allocate_stock",
    ("transactions", "stock"),
    "SELECT store_id, sku, line_id, accepted, CASE WHEN accepted THEN CAST(remaining AS BIGINT) END AS \"left\" FROM walk",
    _walk(
        f"""SELECT o.*, o.quantity AS asked, CASE WHEN sku IS NULL THEN 0 ELSE coalesce(s.quantity, 100) END AS available
            FROM (SELECT {ORDERS} FROM transactions) o
                 LEFT JOIN stock s USING (store_id, sku)""",
        "store_id, sku",
        "day, line_id, asked",
    ),
)
def allocate_stock(spark, sf):
    t = tables(spark, sf, "transactions", "stock")
    orders = t["transactions"].select(
        "store_id", F.trim("sku").alias("sku"), "line_id", "quantity", F.to_date("transaction_date").alias("day")
    )
    out = allocation.allocate_stock(t["stock"], orders, ["day", "line_id", "quantity"])
    return out.select("store_id", "sku", "line_id", "accepted", "left")


CART = """SELECT customer_id AS order_id, trim(sku) AS sku, line_id, quantity, quantity AS asked, unit_price AS price
          FROM transactions"""


@case(
    "merge_order_lines",
    ("transactions", "stock"),
    f"""SELECT w.order_id, w.sku, CAST(sum(c.asked) AS BIGINT) AS quantity, arg_max(c.price, [c.line_id, c.asked]) AS price, count(*) AS n_lines
        FROM walk w JOIN ({CART}) c USING (line_id, asked) WHERE w.accepted GROUP BY 1, 2""",
    _walk(
        f"""SELECT c.*, coalesce(s.available, 0) AS available
            FROM ({CART}) c LEFT JOIN (SELECT sku, CAST(sum(quantity) // 900 AS BIGINT) AS available FROM stock GROUP BY sku) s
            USING (sku)""",
        "order_id, sku",
        "line_id, asked",
    ),
)
def merge_order_lines(spark, sf):
    t = tables(spark, sf, "transactions", "stock")
    lines = t["transactions"].select(
        F.col("customer_id").alias("order_id"),
        F.trim("sku").alias("sku"),
        "line_id",
        "quantity",
        F.col("unit_price").alias("price"),
    )
    limits = t["stock"].groupBy("sku").agg(F.floor(F.sum("quantity") / 900).alias("quantity"))
    return allocation.merge_order_lines(lines, limits, ["line_id", "quantity"])[0]


MOVED = "SELECT store_id, 'Brand#' || event_id % 30 AS sku, event_id, delta FROM moves"


@case(
    "adjust_stock",
    ("stock", "moves"),
    f"""SELECT s.store_id, s.sku, s.product_id, s.last_restocked,
               CASE WHEN d.deltas IS NULL THEN s.quantity
                    ELSE list_reduce(list_prepend(s.quantity, d.deltas), lambda a, b: greatest(0, a + b)) END AS quantity
        FROM stock s LEFT JOIN (SELECT store_id, sku, list(CAST(delta * 40 AS BIGINT) ORDER BY event_id) AS deltas
                                FROM ({MOVED}) GROUP BY 1, 2) d USING (store_id, sku)""",
)
def adjust_stock(spark, sf):
    t = tables(spark, sf, "stock", "moves")
    sku = F.concat(F.lit("Brand#"), (F.col("event_id") % 30).cast("string"))
    changes = t["moves"].select("store_id", sku.alias("sku"), "event_id", (F.col("delta") * 40).alias("delta"))
    return maintain.adjust_stock(t["stock"], changes, ["event_id"])[0]


@case(
    "adjust_stock_unknown",
    ("stock", "moves"),
    f"SELECT * FROM ({MOVED}) WHERE (store_id, sku) NOT IN (SELECT (store_id, sku) FROM stock)",
)
def adjust_stock_unknown(spark, sf):
    t = tables(spark, sf, "stock", "moves")
    sku = F.concat(F.lit("Brand#"), (F.col("event_id") % 30).cast("string"))
    changes = t["moves"].select("store_id", sku.alias("sku"), "event_id", "delta")
    return maintain.adjust_stock(t["stock"], changes)[1]


@case(
    "set_stock",
    ("stock", "imports"),
    """SELECT store_id, sku, product_id, last_restocked, coalesce(n.quantity, s.quantity) AS quantity
       FROM stock s LEFT JOIN (SELECT store_id, 'Brand#' || import_id % 30 AS sku, max(quantity_imported) AS quantity
                               FROM imports GROUP BY 1, 2) n USING (store_id, sku)""",
)
def set_stock(spark, sf):
    t = tables(spark, sf, "stock", "imports")
    sku = F.concat(F.lit("Brand#"), (F.col("import_id") % 30).cast("string"))
    levels = t["imports"].groupBy("store_id", sku.alias("sku")).agg(F.max("quantity_imported").alias("quantity"))
    return maintain.set_stock(t["stock"], levels)[0]


@case(
    "init_stock",
    ("stock", "inventory"),
    """SELECT store_id, sku, quantity, product_id, last_restocked FROM stock
       UNION ALL
       SELECT g.store_id, g.sku, 0, NULL, NULL FROM
         (SELECT CAST(s.store_id AS INTEGER) AS store_id, k.sku
          FROM (SELECT DISTINCT sku FROM inventory UNION SELECT DISTINCT sku FROM stock) k, (SELECT unnest(range(1, 36)) AS store_id) s) g
       WHERE NOT EXISTS (SELECT 1 FROM stock t WHERE t.store_id = g.store_id AND t.sku = g.sku)""",
)
def init_stock(spark, sf):
    t = tables(spark, sf, "stock", "inventory")
    return maintain.init_stock(t["stock"], t["inventory"].select("sku").unionByName(t["stock"].select("sku")))


@case(
    "drop_product_stock",
    ("inventory", "shop_products"),
    """SELECT * FROM inventory WHERE sku NOT IN (
         SELECT unnest(['SKU-' || product_id, 'CHAC' || product_id || '--', 'FEAC' || product_id || '--',
                        'MAAC' || product_id || '--', coalesce(sku, 'SKU-' || product_id)])
         FROM shop_products WHERE category = 'Feminine')""",
)
def drop_product_stock(spark, sf):
    t = tables(spark, sf, "inventory", "shop_products")
    return maintain.drop_product_stock(t["inventory"], t["shop_products"].where(F.col("category") == "Feminine"))


@case(
    "reconcile_stock",
    ("stock", "imports"),
    f"""SELECT store_id, sku, greatest(a.quantity, b.quantity) AS stock_quantity, {sku_category('Clothing')} AS category
        FROM stock a FULL JOIN (SELECT store_id, CASE WHEN import_id % 2 = 0 THEN 'Brand#' || import_id % 30 ELSE sku END AS sku,
                                       CAST(max(quantity_imported) * 5 AS BIGINT) AS quantity FROM imports GROUP BY 1, 2) b
             USING (store_id, sku)""",
)
def reconcile_stock(spark, sf):
    t = tables(spark, sf, "stock", "imports")
    brand = F.concat(F.lit("Brand#"), (F.col("import_id") % 30).cast("string"))
    sku = F.when(F.col("import_id") % 2 == 0, brand).otherwise(F.col("sku"))
    local = t["imports"].groupBy("store_id", sku.alias("sku")).agg(
        (F.max("quantity_imported") * 5).cast("bigint").alias("quantity")
    )
    return dims.reconcile_stock(t["stock"], local)


@case(
    "append_missing",
    ("customers",),
    """SELECT CASE WHEN segment = 'BUILDING' THEN -customer_id ELSE customer_id END AS customer_id, name, segment FROM customers
       UNION ALL
       SELECT customer_id, min(name || '!'), min(segment) FROM (
         SELECT customer_id, coalesce(name, '?') AS name, segment FROM customers WHERE segment = 'BUILDING'
         UNION ALL SELECT customer_id, 'zz', 'zz' FROM customers WHERE segment = 'BUILDING') GROUP BY customer_id""",
)
def append_missing(spark, sf):
    customers = table(spark, sf, "customers").select("customer_id", "name", "segment")
    local = customers.withColumn("name", F.concat(F.coalesce("name", F.lit("?")), F.lit("!")))
    copies = customers.select("customer_id", F.lit("zz!").alias("name"), F.lit("zz").alias("segment"))
    # One segment has other ids in the base table, so that its local rows are missing there.
    other = F.when(F.col("segment") == "BUILDING", -F.col("customer_id")).otherwise(F.col("customer_id"))
    base = customers.withColumn("customer_id", other)
    return dims.append_missing(base, local.unionByName(copies), ["customer_id"])


@case(
    "product_stock",
    ("shop_products", "named_stock"),
    f"""SELECT p.product_id, CAST(coalesce(sum(i.stock_quantity), 0) AS BIGINT) AS stock_quantity
        FROM shop_products p LEFT JOIN (SELECT *, {SKU_DIGITS} AS digits FROM named_stock) i
          ON i.digits = p.product_id OR lower(trim(i.product_name)) = lower(trim(p.product_name))
             OR starts_with(i.sku, rtrim(p.sku, '-'))
        GROUP BY p.product_id""",
    {
        "named_stock": """
            SELECT i.store_id, i.sku, i.stock_quantity, ' ' || upper(p.product_name) AS product_name
            FROM inventory i LEFT JOIN skus s ON i.sku = s.sku LEFT JOIN shop_products p ON s.product_id = p.product_id"""
    },
)
def product_stock(spark, sf):
    t = tables(spark, sf, "inventory", "skus", "shop_products")
    named = (
        t["inventory"]
        .join(t["skus"], "sku", "left")
        .join(t["shop_products"].select("product_id", "product_name"), "product_id", "left")
        .withColumn("product_name", F.concat(F.lit(" "), F.upper("product_name")))
    )
    return dims.product_stock(t["shop_products"], named)


# --- forecast tables ---

# Old and new rows meet only in part: the years of the others lie apart.
NEW_WEEKS = """SELECT CAST(store_id AS VARCHAR) AS store_id, sku, '7' AS product_id,
                      CAST(CASE WHEN week BETWEEN 10 AND 25 THEN year ELSE year + 200 END AS INTEGER) AS forecast_year, week AS forecast_week,
                      CAST(sold AS DOUBLE) AS predicted_quantity, 'b' AS model_version FROM weekly_sales"""
OLD_WEEKS = """SELECT CAST(store_id AS VARCHAR) AS store_id, sku, '3' AS product_id,
                      CAST(CASE WHEN sold < 60 THEN year ELSE year + 100 END AS INTEGER) AS forecast_year, week AS forecast_week,
                      CAST(sold + 1 AS DOUBLE) AS predicted_quantity, CASE WHEN week % 3 = 0 THEN 'a' ELSE 'b' END AS model_version
               FROM weekly_sales"""


def _forecasts(spark, sf):
    sales = table(spark, sf, "weekly_sales")

    def rows(apart, years, product, quantity, version):
        return sales.select(
            F.col("store_id").cast("string").alias("store_id"),
            "sku",
            F.lit(product).alias("product_id"),
            F.when(apart, F.col("year") + years).otherwise(F.col("year")).cast("int").alias("forecast_year"),
            F.col("week").alias("forecast_week"),
            quantity.cast("double").alias("predicted_quantity"),
            version.alias("model_version"),
        )

    old_version = F.when(F.col("week") % 3 == 0, "a").otherwise("b")
    old = rows(F.col("sold") >= 60, 100, "3", F.col("sold") + 1, old_version)
    new = rows(~F.col("week").between(10, 25), 200, "7", F.col("sold"), F.lit("b"))
    return old, new


@case(
    "upsert_forecasts",
    ("weekly_sales",),
    f"""SELECT store_id, sku, coalesce(o.product_id, n.product_id) AS product_id, forecast_year, forecast_week,
               coalesce(n.predicted_quantity, o.predicted_quantity) AS predicted_quantity,
               coalesce(n.model_version, o.model_version) AS model_version
        FROM ({OLD_WEEKS}) o FULL JOIN ({NEW_WEEKS}) n USING (store_id, sku, forecast_year, forecast_week)""",
)
def upsert_forecasts(spark, sf):
    old, new = _forecasts(spark, sf)
    return maintain.upsert(old, new, ["store_id", "sku", "forecast_year", "forecast_week"], keep=["product_id"])


@case(
    "replace_partitions",
    ("weekly_sales",),
    f"""SELECT * FROM ({OLD_WEEKS}) o WHERE (forecast_year, forecast_week, model_version) NOT IN (
          SELECT (forecast_year, forecast_week, model_version) FROM ({NEW_WEEKS}))
        UNION ALL SELECT * FROM ({NEW_WEEKS})""",
)
def replace_partitions(spark, sf):
    old, new = _forecasts(spark, sf)
    return maintain.replace_partitions(old, new, ["forecast_year", "forecast_week", "model_version"])


@case(
    "affected_weeks",
    ("weekly_sales",),
    f"SELECT DISTINCT forecast_year, forecast_week FROM ({NEW_WEEKS})",
)
def affected_weeks(spark, sf):
    return maintain.affected(_forecasts(spark, sf)[1], ["forecast_year", "forecast_week"])


@case(
    "upsert_stock",
    ("stock", "imports"),
    """SELECT store_id, sku, coalesce(n.quantity, s.quantity) AS quantity, coalesce(n.product_id, s.product_id) AS product_id,
              s.last_restocked
       FROM stock s FULL JOIN (SELECT store_id, 'Brand#' || import_id % 40 AS sku,
                                      arg_max(CAST(quantity_imported AS BIGINT), import_id) AS quantity,
                                      CAST(arg_max(CASE WHEN import_id % 2 = 0 THEN import_id ELSE -1 END, import_id) AS BIGINT) AS raw_id,
                                      nullif(raw_id, -1) AS product_id
                               FROM imports GROUP BY 1, 2) n USING (store_id, sku)""",
)
def upsert_stock(spark, sf):
    t = tables(spark, sf, "stock", "imports")
    levels = t["imports"].select(
        "store_id",
        F.concat(F.lit("Brand#"), (F.col("import_id") % 40).cast("string")).alias("sku"),
        F.col("quantity_imported").alias("quantity"),
        F.when(F.col("import_id") % 2 == 0, F.col("import_id")).alias("product_id"),
        "import_id",
    )
    return maintain.upsert(t["stock"], levels, ["store_id", "sku"], keep_if_null=["product_id"], order=["import_id"])


for _grain in ("week", "month"):
    _period = "week" if _grain == "week" else "CAST(least(12, greatest(1, floor((week - 1) / 4.34::DOUBLE) + 1)) AS INTEGER)"

    @case(
        f"forecast_vs_actual_{_grain}",
        ("forecasts",),
        f"""SELECT store_id, sku, year, {_period} AS {_grain}, CAST(sum(predicted_quantity) AS BIGINT) AS predicted,
                   CAST(sum(actual_quantity) AS BIGINT) AS actual,
                   CAST(greatest(0, sum(predicted_quantity) - coalesce(sum(actual_quantity), 0)) AS BIGINT) AS upcoming
            FROM forecasts GROUP BY 1, 2, 3, 4""",
    )
    def forecast_vs_actual(spark, sf, grain=_grain):
        return aggregate.forecast_vs_actual(table(spark, sf, "forecasts"), grain)


@case(
    "forecast_timeline",
    ("forecasts",),
    """SELECT store_id, sku, min(product_name) AS product_name, min(category) AS category,
              string_agg(year || '/' || week || ':' || predicted_quantity || ':' || coalesce(CAST(actual_quantity AS VARCHAR), '-'), ' '
                         ORDER BY year, week) AS timeline
       FROM forecasts GROUP BY 1, 2""",
)
def forecast_timeline(spark, sf):
    def point(p):
        actual = F.coalesce(p["actual"].cast("string"), F.lit("-"))
        return F.concat(p["year"], F.lit("/"), p["week"], F.lit(":"), p["predicted"], F.lit(":"), actual)

    out = aggregate.forecast_timeline(table(spark, sf, "forecasts"))
    return out.withColumn("timeline", F.array_join(F.transform("timeline", point), " "))


@case(
    "shortage_alerts",
    ("forecasts", "stock"),
    """SELECT *, forecast - quantity AS shortage FROM (
         SELECT f.store_id, f.sku, coalesce(arg_min(predicted_quantity, year * 100 + week) FILTER (WHERE actual_quantity IS NULL),
                                            arg_min(predicted_quantity, year * 100 + week)) AS forecast,
                coalesce(min(s.quantity), 0) AS quantity
         FROM forecasts f LEFT JOIN (SELECT store_id, CASE WHEN product_id % 5 = 0 THEN sku || '?' ELSE sku END AS sku,
                                            quantity // 20 AS quantity FROM stock) s
              ON f.store_id = s.store_id AND f.sku = s.sku GROUP BY 1, 2) WHERE forecast > quantity""",
)
def shortage_alerts(spark, sf):
    t = tables(spark, sf, "forecasts", "stock")
    # A fifth of the stock has other SKUs, so that their series have none.
    other = F.when(F.col("product_id") % 5 == 0, F.concat("sku", F.lit("?"))).otherwise(F.col("sku"))
    stock = t["stock"].withColumns({"sku": other, "quantity": F.floor(F.col("quantity") / 20)})
    return dims.shortage_alerts(t["forecasts"], stock)


# --- change logs ---

RETAIL_CHANGES = {
    "customers": ("customer_id", "user_id * 7 + event_id % 3 * 1000", "name", "'n' || event_id", "age", "CAST(event_id % 90 AS INT)"),
    "employees": ("employee_id", "user_id % 130", "position", "'p' || event_id", "salary", "value"),
    "stores": ("store_id", "CAST(user_id % 30 AS INT)", "country", "'c' || event_id", "latitude", "value"),
    "products": ("product_id", "user_id * 17", "category", "'k' || event_id", "price", "value"),
    "discounts": ("discount_id", "user_id", "description", "'d' || event_id", "discount_pct", "value / 1000"),
}


def _changes(name):
    key, key_sql, text, text_sql, number, number_sql = RETAIL_CHANGES[name]
    log = f"""
        SELECT event_id AS seq, {key_sql} AS {key},
               CASE event_type WHEN 'click' THEN 'insert' WHEN 'purchase' THEN 'delete' ELSE 'update' END AS op,
               CASE WHEN event_id % 3 = 0 THEN NULL ELSE {text_sql} END AS {text},
               CASE WHEN event_id % 4 = 0 THEN NULL ELSE {number_sql} END AS {number}
        FROM events"""
    return key, text, number, log


def _judged(base: str, keys: str, log: str) -> str:
    """Every change with its status, told by the last insert or delete before it."""
    join = " AND ".join(f"c.{k} = b.{k}" for k in keys.split(", "))
    part = ", ".join(f"c.{k}" for k in keys.split(", "))
    first = keys.split(", ")[0]
    return f"""
        SELECT *, CASE WHEN op = 'insert' AND present THEN 409 WHEN op <> 'insert' AND NOT present THEN 404 END AS status FROM (
          SELECT c.*, coalesce(last_value(CASE WHEN c.op IN ('insert', 'delete') THEN c.op END IGNORE NULLS) OVER (
                     PARTITION BY {part} ORDER BY c.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   CASE WHEN b.{first} IS NOT NULL THEN 'insert' ELSE 'delete' END) = 'insert' AS present
          FROM ({log}) c LEFT JOIN {base} b ON {join})"""


def _register_changes(name):
    key, text, number, log = _changes(name)
    judged = _judged(name, key, log)

    @case(
        f"apply_changes_{name}",
        (name,),
        f"""SELECT coalesce(b.{key}, p.{key}) AS {key},
                   CASE WHEN p.since IS NULL THEN coalesce(p.last_text, b.{text}) WHEN p.text_at >= p.since THEN p.last_text END AS {text},
                   CASE WHEN p.since IS NULL THEN coalesce(p.last_number, b.{number}) WHEN p.number_at >= p.since THEN p.last_number END AS {number}
            FROM {name} b FULL JOIN (
              SELECT {key}, max(seq) FILTER (WHERE op IN ('insert', 'delete')) AS since,
                     arg_max(op, seq) FILTER (WHERE op IN ('insert', 'delete')) AS turn,
                     arg_max({text}, seq) FILTER (WHERE {text} IS NOT NULL) AS last_text,
                     max(seq) FILTER (WHERE {text} IS NOT NULL) AS text_at,
                     arg_max({number}, seq) FILTER (WHERE {number} IS NOT NULL) AS last_number,
                     max(seq) FILTER (WHERE {number} IS NOT NULL) AS number_at
              FROM ({judged}) WHERE status IS NULL GROUP BY {key}) p ON b.{key} = p.{key}
            WHERE coalesce(p.turn, '') <> 'delete'""",
    )
    def snapshot(spark, sf):
        return run(spark, sf)[0].select(key, text, number)

    @case(f"rejected_changes_{name}", (name,), f"SELECT {key}, op, seq, status FROM ({judged}) WHERE status IS NOT NULL")
    def rejected(spark, sf):
        return run(spark, sf)[1]

    def run(spark, sf):
        raw_table(spark, sf, "events").createOrReplaceTempView("events")
        return maintain.apply_changes(table(spark, sf, name), spark.sql(log), key)


for _name in RETAIL_CHANGES:
    _register_changes(_name)


SALE_CHANGES = """
    SELECT line_id AS seq, transaction_id + CASE WHEN line_id % 5 = 0 THEN 3 ELSE 0 END AS transaction_id,
           CASE line_id % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS op,
           CASE WHEN line_id % 2 = 0 THEN NULL ELSE quantity + 1 END AS quantity, payment_method
    FROM transactions"""
SALES = "SELECT transaction_id, min(quantity) AS quantity, min(payment_method) AS payment_method FROM transactions GROUP BY 1"


def _apply_sale_changes(spark, sf):
    tx = table(spark, sf, "transactions")
    base = tx.groupBy("transaction_id").agg(F.min("quantity").alias("quantity"), F.min("payment_method").alias("payment_method"))
    shift = F.when(F.col("line_id") % 5 == 0, 3).otherwise(0)
    op = F.when(F.col("line_id") % 3 == 0, "insert").when(F.col("line_id") % 3 == 1, "update").otherwise("delete")
    log = tx.select(
        F.col("line_id").alias("seq"),
        (F.col("transaction_id") + shift).alias("transaction_id"),
        op.alias("op"),
        F.when(F.col("line_id") % 2 != 0, F.col("quantity") + 1).alias("quantity"),
        "payment_method",
    )
    return maintain.apply_changes(base, log, "transaction_id")


@case(
    "apply_changes_transactions",
    ("sales", "transactions"),
    f"""SELECT coalesce(b.transaction_id, p.transaction_id) AS transaction_id,
               CASE WHEN p.since IS NULL THEN coalesce(p.q, b.quantity) WHEN p.q_at >= p.since THEN p.q END AS quantity,
               CASE WHEN p.since IS NULL THEN coalesce(p.m, b.payment_method) ELSE p.m END AS payment_method
        FROM sales b FULL JOIN (
          SELECT transaction_id, max(seq) FILTER (WHERE op <> 'update') AS since,
                 arg_max(op, seq) FILTER (WHERE op <> 'update') AS turn,
                 arg_max(quantity, seq) FILTER (WHERE quantity IS NOT NULL) AS q,
                 max(seq) FILTER (WHERE quantity IS NOT NULL) AS q_at, arg_max(payment_method, seq) AS m
          FROM ({_judged("sales", "transaction_id", SALE_CHANGES)}) WHERE status IS NULL GROUP BY 1) p
          ON b.transaction_id = p.transaction_id
        WHERE coalesce(p.turn, '') <> 'delete'""",
    {"sales": SALES},
)
def apply_changes_transactions(spark, sf):
    return _apply_sale_changes(spark, sf)[0]


@case(
    "rejected_changes_transactions",
    ("sales", "transactions"),
    f"SELECT transaction_id, op, seq, status FROM ({_judged('sales', 'transaction_id', SALE_CHANGES)}) WHERE status IS NOT NULL",
    {"sales": SALES},
)
def rejected_changes_transactions(spark, sf):
    return _apply_sale_changes(spark, sf)[1]


# --- schema evolution and bounded log ---


@case(
    "evolve",
    ("imports",),
    "SELECT import_id, store_id, sku, quantity_imported, import_date, supplier, CAST(NULL AS VARCHAR) AS product_id FROM imports",
)
def evolve(spark, sf):
    old = table(spark, sf, "imports").withColumnRenamed("quantity_imported", "quantity")
    return schemas.evolve(old, {"product_id": "string", "sku": "string"}, {"quantity": "quantity_imported"})


@case("retain_latest", ("audit_logs",), "SELECT * FROM audit_logs ORDER BY timestamp DESC, id DESC LIMIT 1000")
def retain_latest(spark, sf):
    return maintain.retain_latest(table(spark, sf, "audit_logs"))


