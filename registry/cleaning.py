"""Column rules, listings and portal views."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.cases import SKU_DIGITS, case, sku_category
from registry.tables import raw_table, table, tables
from shelfwise.functions import text
from shelfwise.operators import aggregate, clean, dims, rows, serve


@case(
    "scan_transactions",
    ("transactions",),
    """SELECT transaction_id, store_id, customer_id, product_id, sku, quantity, transaction_date FROM transactions""",
)
def scan_transactions(spark, sf):
    return table(spark, sf, "transactions").select(
        "transaction_id", "store_id", "customer_id", "product_id", "sku", "quantity", "transaction_date"
    )


@case(
    "parse_store_id",
    ("requests",),
    """SELECT store_id, coalesce(TRY_CAST(replace(upper(store_id), 'STORE_', '') AS INTEGER), 1) AS parsed,
              CASE WHEN upper(store_id) LIKE '%STORE\\_%' ESCAPE '\\'
                   THEN TRY_CAST(replace(upper(store_id), 'STORE_', '') AS INTEGER)
                   ELSE coalesce(TRY_CAST(store_id AS INTEGER), 1) END AS strictly, count(*) AS n
       FROM requests GROUP BY ALL""",
)
def parse_store_id(spark, sf):
    raw = F.col("store_id")
    return table(spark, sf, "requests").groupBy(
        "store_id", text.parse_store_id(raw).alias("parsed"), text.parse_store_id(raw, strict=True).alias("strictly")
    ).agg(F.count(F.lit(1)).alias("n"))


@case(
    "sku_category",
    ("inventory",),
    f"SELECT store_id, sku, {sku_category('Clothing')} AS category, {sku_category('Other')} AS category_or_other FROM inventory",
)
def sku_category_query(spark, sf):
    return table(spark, sf, "inventory").select(
        "store_id",
        "sku",
        text.sku_category(F.col("sku")).alias("category"),
        text.sku_category(F.col("sku"), "Other").alias("category_or_other"),
    )


@case("sku_product_id", ("inventory",), f"SELECT DISTINCT sku, {SKU_DIGITS} AS product_id FROM inventory")
def sku_product_id(spark, sf):
    return table(spark, sf, "inventory").select("sku", text.sku_product_id(F.col("sku")).alias("product_id")).distinct()


@case(
    "build_sku",
    ("shop_products",),
    """SELECT product_id, CASE lower(category) WHEN 'children' THEN 'CHAC' WHEN 'feminine' THEN 'FEAC'
              WHEN 'masculine' THEN 'MAAC' ELSE 'SKU' END || product_id || '--' AS sku FROM shop_products""",
)
def build_sku(spark, sf):
    return table(spark, sf, "shop_products").select(
        "product_id", text.build_sku(F.col("category"), F.col("product_id")).alias("sku")
    )


@case(
    "drop_junk_skus",
    ("inventory",),
    f"""SELECT * FROM (SELECT store_id, sku, stock_quantity, {sku_category('Clothing')} AS category FROM inventory)
        WHERE sku <> '' AND lower(sku) NOT LIKE '%string%' AND sku NOT LIKE 'SKU-%' AND sku <> 'undefined'
          AND category IN ('Children', 'Masculine', 'Feminine')""",
)
def drop_junk_skus(spark, sf):
    stock = table(spark, sf, "inventory").withColumn("category", text.sku_category(F.col("sku")))
    return clean.drop_junk_skus(stock)


@case(
    "drop_junk_products",
    ("products",),
    """SELECT product_id, sku, description_en, category FROM products
       WHERE lower(coalesce(nullif(description_en, ''), name_en, '')) <> 'string'
         AND lower(coalesce(description_en, name_en, '')) NOT LIKE '%sports velvet sports%'
         AND lower(coalesce(sub_category, '')) <> 'string' AND lower(coalesce(sku, '')) <> 'string'
         AND category IN ('LARGE', 'SMALL', 'PROMO')""",
)
def drop_junk_products(spark, sf):
    out = clean.drop_junk_products(table(spark, sf, "products"), ("LARGE", "SMALL", "PROMO"))
    return out.select("product_id", "sku", "description_en", "category")


@case(
    "conform_customers",
    ("customers",),
    """SELECT customer_id, coalesce(nullif(name, ''), 'Khách hàng #' || customer_id) AS customer_name,
              coalesce(nullif(age, 0), 30) AS age,
              CASE gender WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE coalesce(nullif(gender, ''), 'Unknown') END AS gender,
              coalesce(nullif(country, ''), 'United States') AS country,
              CAST(customer_id % 35 + 1 AS INTEGER) AS store_id FROM customers""",
)
def conform_customers(spark, sf):
    return clean.conform_customers(table(spark, sf, "customers"))


@case("assign_store", ("customers",), "SELECT CAST(customer_id % 35 + 1 AS INTEGER) AS store_id, count(*) AS n FROM customers GROUP BY 1")
def assign_store(spark, sf):
    return (
        table(spark, sf, "customers")
        .groupBy(clean.assigned_store(F.col("customer_id")).alias("store_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@case(
    "clean_output",
    ("events",),
    """SELECT event_id, CASE WHEN event_id % 10 IN (3, 4) THEN NULL ELSE value END AS value,
              strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts FROM events""",
)
def clean_output(spark, sf):
    events = raw_table(spark, sf, "events").select("event_id", "value", "ts")
    number = (
        F.when(F.col("event_id") % 10 == 3, float("nan")).when(F.col("event_id") % 10 == 4, float("-inf")).otherwise(F.col("value"))
    )
    return clean.clean_output(events.withColumn("value", number))


LINE_TOTAL = "coalesce(nullif(line_total, 0), coalesce(unit_price, 0) * coalesce(nullif(quantity, 0), 1))"


@case("line_totals", ("transactions",), f"SELECT line_id, {LINE_TOTAL} AS line_total FROM transactions")
def line_totals(spark, sf):
    return clean.line_totals(table(spark, sf, "transactions")).select("line_id", "line_total")


@case(
    "cart_totals",
    ("transactions",),
    """SELECT transaction_id, sum(CAST(round(unit_price * quantity * 100) AS BIGINT)) / 100.0::DOUBLE AS total
       FROM transactions GROUP BY 1""",
)
def cart_totals(spark, sf):
    lines = table(spark, sf, "transactions").withColumnRenamed("unit_price", "price")
    return aggregate.cart_totals(lines, "transaction_id")


@case(
    "validate_requests",
    ("requests",),
    """SELECT *, CASE WHEN bad_date AND bad_discount THEN 'date,total_discount_avg' WHEN bad_date THEN 'date'
                      WHEN bad_discount THEN 'total_discount_avg' ELSE '' END AS reasons FROM (
         SELECT store_id, sku, date, total_discount_avg,
                TRY_CAST(date AS DATE) IS NULL AS bad_date,
                coalesce(total_discount_avg < 0 OR total_discount_avg > 1, FALSE) AS bad_discount FROM requests)""",
)
def validate_requests(spark, sf):
    ok, bad = clean.validate(table(spark, sf, "requests"), clean.request_rules())
    both = ok.withColumn("reasons", F.lit("")).unionByName(bad.withColumn("reasons", F.array_join("reasons", ",")))
    flags = {
        "bad_date": F.contains("reasons", F.lit("date")),
        "bad_discount": F.contains("reasons", F.lit("total_discount_avg")),
    }
    return both.withColumns(flags)


@case(
    "validate_sales",
    ("transactions",),
    """SELECT count(*) FILTER (WHERE ok) AS passed, count(*) FILTER (WHERE NOT ok) AS rejected FROM (
         SELECT store_id <> 0 AND customer_id <> 0 AND coalesce(sku, '') <> '' AND quantity <> 0
                AND payment_method <> '' AND unit_price <> 0 AND regexp_matches(coalesce(sku, ''), '[0-9]') AS ok
         FROM transactions)""",
)
def validate_sales(spark, sf):
    lines = table(spark, sf, "transactions").withColumnRenamed("unit_price", "price")
    ok, bad = clean.validate(lines, clean.sale_rules())
    both = ok.select(F.lit(True).alias("ok")).unionByName(bad.select(F.lit(False).alias("ok")))
    return both.agg(F.count_if("ok").alias("passed"), F.count_if(~F.col("ok")).alias("rejected"))


@case(
    "validate_imports",
    ("imports",),
    "SELECT import_id, quantity_imported, quantity_imported > 0 AS ok FROM imports",
)
def validate_imports(spark, sf):
    ok, bad = clean.validate(table(spark, sf, "imports"), clean.import_rules())
    out = ok.withColumn("ok", F.lit(True)).unionByName(bad.drop("reasons").withColumn("ok", F.lit(False)))
    return out.select("import_id", "quantity_imported", "ok")


@case(
    "validate_discounts",
    ("discounts",),
    "SELECT discount_id, discount_pct * 3 AS discount_pct, discount_pct * 3 BETWEEN 0 AND 1 AS ok FROM discounts",
)
def validate_discounts(spark, sf):
    tripled = table(spark, sf, "discounts").select("discount_id", (F.col("discount_pct") * 3).alias("discount_pct"))
    ok, bad = clean.validate(tripled, clean.discount_rules())
    return ok.withColumn("ok", F.lit(True)).unionByName(bad.drop("reasons").withColumn("ok", F.lit(False)))


@case(
    "validate_stock",
    ("stock",),
    "SELECT store_id, sku, quantity - 100 AS quantity, quantity >= 100 AS ok FROM stock",
)
def validate_stock(spark, sf):
    lowered = table(spark, sf, "stock").select("store_id", "sku", (F.col("quantity") - 100).alias("quantity"))
    ok, bad = clean.validate(lowered, clean.stock_rules())
    return ok.withColumn("ok", F.lit(True)).unionByName(bad.drop("reasons").withColumn("ok", F.lit(False)))


@case(
    "discount_report",
    ("discounts",),
    """SELECT discount_id, store_id, description, round(discount_pct * 100, 4) AS percent,
              round(discount_pct * 100, 4) > 15 AS highlight FROM discounts""",
)
def discount_report(spark, sf):
    return aggregate.discount_report(table(spark, sf, "discounts"))


@case(
    "discount_shares",
    ("discounts",),
    "SELECT store_id, round(discount_pct * 100, 4) AS percent, count(*) AS n FROM discounts GROUP BY 1, 2",
)
def discount_shares(spark, sf):
    return aggregate.discount_shares(table(spark, sf, "discounts"))


SALESPERSON = """CASE position WHEN 'IT Admin' THEN 'admin' WHEN 'Director' THEN 'director'
    WHEN 'Store Manager' THEN 'manager' || store_id WHEN 'Sales Staff' THEN 'sales' || store_id
    ELSE regexp_replace(lower(coalesce(position, '')), '\\s+', '', 'g') || store_id END"""


@case("salesperson_label", ("employees",), f"SELECT employee_id, {SALESPERSON} AS label FROM employees")
def salesperson_label(spark, sf):
    return table(spark, sf, "employees").select(
        "employee_id", text.salesperson_label(F.col("position"), F.col("store_id")).alias("label")
    )


ACTION_CLASS = """CASE WHEN lower(action) LIKE '%login%' THEN 'login' WHEN lower(action) LIKE '%create%' THEN 'create'
    WHEN lower(action) LIKE '%update%' THEN 'update' WHEN lower(action) LIKE '%delete%' THEN 'delete'
    WHEN lower(action) LIKE '%mfa%' THEN 'mfa' ELSE 'default' END"""


@case("action_class", ("audit_logs",), f"SELECT action, {ACTION_CLASS} AS action_class, count(*) AS n FROM audit_logs GROUP BY 1, 2")
def action_class(spark, sf):
    return (
        table(spark, sf, "audit_logs")
        .groupBy("action", text.action_class(F.col("action")).alias("action_class"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@case(
    "list_audit",
    ("audit_logs",),
    f"SELECT *, {ACTION_CLASS} AS action_class FROM audit_logs WHERE action = 'MFA_DELETE'",
)
def list_audit(spark, sf):
    return serve.list_audit(table(spark, sf, "audit_logs"), "MFA_DELETE")


# --- listings ---

LISTINGS = {
    "list_customers": ("customers", {"country": "NATION_3", "segment": "BUILDING", "gender": None}, ["customer_id"], 100, 0),
    "list_employees": ("employees", {"store_id": 0, "department": None}, ["employee_id"], 100, 0),
    "list_stores": ("stores", {"country": None}, ["store_id"], 10, 5),
    "list_products": ("products", {"category": "PROMO", "sub_category": None, "color": "red"}, ["product_id"], 100, 2),
    "list_discounts_by_product": ("discounts", {"store_id": None, "product_id": 3}, ["discount_id"], 100, 0),
    "list_stock": ("stock", {"store_id": 4, "sku": None}, ["store_id", "sku"], 20, 3),
}


def _listing(name, source, filters, order, limit, offset):
    rules = [f"{col} = '{v}'" if isinstance(v, str) else f"{col} = {v}" for col, v in filters.items() if v is not None]
    where = f"WHERE {' AND '.join(rules)}" if rules else ""
    sql = f"""SELECT *, (SELECT count(*) FROM {source} {where}) AS total FROM {source} {where}
              ORDER BY {', '.join(order)} LIMIT {limit} OFFSET {offset}"""

    @case(name, (source,), sql)
    def query(spark, sf):
        return serve.listing(table(spark, sf, source), filters, order, limit, offset, with_total=True)


for _name, _args in LISTINGS.items():
    _listing(_name, *_args)


@case(
    "list_imports",
    ("imports",),
    """SELECT * FROM imports WHERE store_id = 7 ORDER BY import_date DESC, import_id LIMIT 100 OFFSET 10""",
)
def list_imports(spark, sf):
    order = [F.col("import_date").desc_nulls_first(), "import_id"]
    return serve.listing(table(spark, sf, "imports"), {"store_id": 7}, order, 100, 10)


TX_COLUMNS = "transaction_id, line_id, store_id, customer_id, payment_method, quantity, transaction_date"


@case(
    "list_transactions",
    ("transactions",),
    f"""SELECT {TX_COLUMNS} FROM transactions
        WHERE store_id = 0 AND payment_method = '2-HIGH' AND transaction_date >= TIMESTAMP '1996-01-01'
          AND transaction_date <= TIMESTAMP '1999-12-31'
        ORDER BY transaction_date DESC, transaction_id DESC, line_id DESC LIMIT 1000""",
)
def list_transactions(spark, sf):
    out = serve.list_transactions(
        table(spark, sf, "transactions"),
        store_id=0,
        payment_method="2-HIGH",
        from_date="1996-01-01",
        to_date="1999-12-31",
        limit=1000,
        ties=["line_id"],
    )
    return out.select(*TX_COLUMNS.split(", "))


@case("lookup", ("customers",), "SELECT * FROM customers WHERE customer_id = 17")
def lookup(spark, sf):
    return serve.lookup(table(spark, sf, "customers"), {"customer_id": 17})


@case(
    "lookup_many",
    ("stock", "employees"),
    "SELECT * FROM stock WHERE store_id IN (SELECT store_id FROM employees WHERE position = 'Store Manager')",
)
def lookup_many(spark, sf):
    managed = table(spark, sf, "employees").where(F.col("position") == "Store Manager").select("store_id")
    return serve.lookup(table(spark, sf, "stock"), managed)


@case(
    "search_customers",
    ("customers",),
    "SELECT * FROM customers WHERE contains(lower(name), '00012') OR contains(CAST(customer_id AS VARCHAR), '00012') OR contains(lower(country), '00012')",
)
def search_customers(spark, sf):
    return serve.search(table(spark, sf, "customers"), ["name", "customer_id", "country"], "00012")


@case(
    "search_products",
    ("products",),
    "SELECT product_id, name_en, description_en FROM products WHERE name_en ILIKE '%bl_e%' OR description_en ILIKE '%bl_e%'",
)
def search_products(spark, sf):
    products = table(spark, sf, "products").select("product_id", "name_en", "description_en")
    return serve.search(products, ["name_en", "description_en"], "bl_e", literal=False)


@case(
    "search_inventory",
    ("inventory", "skus", "shop_products"),
    """SELECT i.store_id, i.sku, p.product_name FROM inventory i JOIN skus s ON i.sku = s.sku
       JOIN shop_products p ON s.product_id = p.product_id
       WHERE lower(i.sku) NOT LIKE '%string%' AND (contains(lower(i.sku), 'red') OR contains(lower(p.product_name), 'red')
             OR contains(lower(p.category), 'red'))""",
)
def search_inventory(spark, sf):
    found = serve.search(inventory_view(spark, sf), ["sku", "product_name", "category"], "RED")
    return found.select("store_id", "sku", "product_name")


@case(
    "paginate",
    ("inventory",),
    """SELECT *, 3 AS page, CAST(greatest(1, ceil((SELECT count(*) FROM inventory) / 25.0)) AS INTEGER) AS pages,
              (SELECT count(*) FROM inventory) AS total
       FROM inventory ORDER BY store_id, sku LIMIT 25 OFFSET 50""",
)
def paginate(spark, sf):
    return serve.paginate(table(spark, sf, "inventory"), 3, 25, ["store_id", "sku"])


@case(
    "paginate_past_end",
    ("inventory",),
    """SELECT *, CAST((SELECT ceil(count(*) / 25.0) FROM inventory) AS INTEGER) AS page,
              CAST((SELECT ceil(count(*) / 25.0) FROM inventory) AS INTEGER) AS pages,
              (SELECT count(*) FROM inventory) AS total
       FROM inventory ORDER BY store_id, sku OFFSET (SELECT CAST((ceil(count(*) / 25.0) - 1) * 25 AS BIGINT) FROM inventory)""",
)
def paginate_past_end(spark, sf):
    return serve.paginate(table(spark, sf, "inventory"), 10**9, 25, ["store_id", "sku"])


PERMS = {"Director": ["view_all_stores"], "Store Manager": ["view_own_store"]}


@case("scope_rows", ("stock",), "SELECT * FROM stock WHERE store_id = 6")
def scope_rows(spark, sf):
    return serve.scope_rows(table(spark, sf, "stock"), "Store Manager", 6, PERMS)


@case("scope_rows_store_list", ("stores",), "SELECT * FROM stores")
def scope_rows_store_list(spark, sf):
    perms = {"IT Admin": ["manage_users"]}
    return serve.scope_rows(table(spark, sf, "stores"), "IT Admin", None, perms, (*serve.EVERY_STORE, "manage_users"))


@case(
    "list_page_total",
    ("imports",),
    """SELECT *, count(*) OVER () AS page_total FROM (SELECT * FROM imports WHERE store_id = 7 ORDER BY import_id LIMIT 100 OFFSET 10)""",
)
def list_page_total(spark, sf):
    return serve.listing(table(spark, sf, "imports"), {"store_id": 7}, ["import_id"], 100, 10, with_page_total=True)


@case("discounts_for", ("discounts",), "SELECT * FROM discounts WHERE store_id = 3 OR store_id IS NULL")
def discounts_for(spark, sf):
    return serve.discounts_for(table(spark, sf, "discounts"), 3)


@case("list_discounts", ("discounts",), "SELECT * FROM discounts ORDER BY coalesce(end_date, start_date) DESC, discount_id")
def list_discounts(spark, sf):
    return serve.list_discounts(table(spark, sf, "discounts"))


# --- views ---


@case(
    "inventory_view",
    ("inventory", "skus", "shop_products"),
    """SELECT i.store_id, i.sku, i.stock_quantity, p.product_name, p.category, i.stock_quantity <= 15 AS low_stock
       FROM inventory i JOIN skus s ON i.sku = s.sku JOIN shop_products p ON s.product_id = p.product_id
       WHERE lower(i.sku) NOT LIKE '%string%' AND i.sku <> ''""",
)
def inventory_view(spark, sf):
    t = tables(spark, sf, "inventory", "skus", "shop_products")
    return dims.inventory_view(t["inventory"], t["skus"], t["shop_products"])


@case(
    "transactions_view",
    ("transactions", "shop_products", "employees"),
    f"""SELECT t.transaction_id, t.store_id, t.customer_id, t.product_id,
               coalesce(nullif(t.sku, ''), 'SKU-' || t.product_id) AS sku,
               coalesce(p.product_name, 'Sản phẩm #' || t.product_id) AS product_name,
               CAST(t.transaction_date AS DATE) AS date, coalesce(e.label, CAST(t.employee_id AS VARCHAR)) AS salesperson,
               t.payment_method, coalesce(t.currency, 'USD') AS currency, coalesce(t.unit_price, 0) AS usd_price,
               coalesce(nullif(t.quantity, 0), 1) AS quantity, {LINE_TOTAL} AS line_total
        FROM transactions t LEFT JOIN shop_products p ON t.product_id = p.product_id
             LEFT JOIN (SELECT employee_id, {SALESPERSON} AS label FROM employees) e ON t.employee_id = e.employee_id""",
)
def transactions_view(spark, sf):
    t = tables(spark, sf, "transactions", "shop_products", "employees")
    return dims.transactions_view(t["transactions"], t["shop_products"], t["employees"])


@case(
    "imports_view",
    ("imports", "stores", "products"),
    f"""SELECT i.import_id, i.store_id, i.sku, i.quantity_imported AS quantity, i.import_date,
               coalesce(nullif(i.supplier, ''), 'N/A') AS supplier, coalesce(s.store_name, 'Store #' || i.store_id) AS store_name,
               coalesce(nullif(p.description_en, ''), nullif(p.name_en, ''), 'Sản phẩm ' || i.sku) AS product_name
        FROM (SELECT *, {SKU_DIGITS} AS digits FROM imports ORDER BY import_date DESC, import_id DESC LIMIT 150) i
             LEFT JOIN stores s ON i.store_id = s.store_id LEFT JOIN products p ON i.digits = p.product_id""",
)
def imports_view(spark, sf):
    t = tables(spark, sf, "imports", "stores", "products")
    return dims.imports_view(t["imports"].withColumnRenamed("quantity_imported", "quantity"), t["stores"], t["products"])


@case(
    "assign_employee",
    ("stores", "employees"),
    """SELECT s.store_id, coalesce((SELECT CAST(min(employee_id) AS VARCHAR) FROM employees e
                                    WHERE e.store_id = s.store_id AND e.department = 'Floor'),
                                   (SELECT CAST(min(employee_id) AS VARCHAR) FROM employees),
                                   '1') AS employee_id FROM stores s""",
)
def assign_employee(spark, sf):
    t = tables(spark, sf, "stores", "employees")
    # Office staff belong to no store, so some stores have nobody of their own.
    own = F.when(F.col("department") == "Floor", F.col("store_id")).otherwise(-1)
    return dims.assign_employee(t["stores"].select("store_id"), t["employees"].withColumn("store_id", own))


@case(
    "gender_distribution",
    ("customers",),
    """SELECT CASE WHEN gender IN ('M', 'Male') THEN 'Male' WHEN gender IN ('F', 'Female') THEN 'Female' ELSE 'Other' END AS gender,
              count(*) AS n FROM customers GROUP BY 1""",
)
def gender_distribution(spark, sf):
    return aggregate.gender_distribution(table(spark, sf, "customers"))


@case(
    "age_distribution",
    ("customers",),
    """SELECT CASE WHEN age BETWEEN 26 AND 35 THEN '26-35' WHEN age BETWEEN 36 AND 45 THEN '36-45'
                   WHEN age BETWEEN 46 AND 55 THEN '46-55' WHEN age > 55 THEN '56+' ELSE '18-25' END AS age_band,
              count(*) AS n FROM customers GROUP BY 1""",
)
def age_distribution(spark, sf):
    return aggregate.age_distribution(table(spark, sf, "customers"))


@case(
    "staff_split",
    ("employees",),
    """SELECT count(*) FILTER (WHERE upper(position) LIKE '%MANAGER%' OR upper(position) LIKE '%DIRECTOR%') AS managers,
              count(*) - count(*) FILTER (WHERE upper(position) LIKE '%MANAGER%' OR upper(position) LIKE '%DIRECTOR%') AS staff
       FROM employees""",
)
def staff_split(spark, sf):
    return aggregate.staff_split(table(spark, sf, "employees"))


INVENTORY_VIEW = {
    "stocked": """
        SELECT i.store_id, i.sku, p.product_name, p.category FROM inventory i JOIN skus s ON i.sku = s.sku
        JOIN shop_products p ON s.product_id = p.product_id WHERE lower(i.sku) NOT LIKE '%string%'""",
}


@case(
    "store_inventory_variety",
    ("stores", "stocked"),
    """SELECT s.store_id, s.store_name, count(DISTINCT k.sku) AS num_distinct_skus,
              count(DISTINCT k.product_name) AS num_distinct_products
       FROM stores s LEFT JOIN stocked k ON s.store_id = k.store_id GROUP BY 1, 2""",
    INVENTORY_VIEW,
)
def store_inventory_variety(spark, sf):
    stores = table(spark, sf, "stores").select("store_id", "store_name")
    return aggregate.store_inventory_variety(stores, inventory_view(spark, sf))


@case(
    "inventory_by_category",
    ("stocked",),
    """SELECT CASE WHEN category IN ('Children', 'Masculine', 'Feminine') THEN category ELSE 'Other' END AS category,
              count(*) AS n FROM stocked GROUP BY 1""",
    INVENTORY_VIEW,
)
def inventory_by_category(spark, sf):
    return aggregate.inventory_by_category(inventory_view(spark, sf))


@case(
    "store_centroid",
    ("stores",),
    "SELECT round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude FROM stores",
)
def store_centroid(spark, sf):
    return aggregate.store_centroid(table(spark, sf, "stores"))


for _keep in ("first", "last"):

    @case(
        f"dedup_{_keep}",
        ("transactions",),
        f"""SELECT transaction_id, line_id, quantity, payment_method FROM transactions
            QUALIFY row_number() OVER (PARTITION BY transaction_id
                                       ORDER BY line_id {"DESC" if _keep == "last" else ""},
                                                quantity {"DESC" if _keep == "last" else ""}) = 1""",
    )
    def dedup(spark, sf, keep=_keep):
        tx = table(spark, sf, "transactions").select("transaction_id", "line_id", "quantity", "payment_method")
        return rows.dedup(tx, ["transaction_id"], ["line_id", "quantity"], keep)


@case(
    "rank_lines",
    ("transactions",),
    """SELECT line_id, row_number() OVER (PARTITION BY payment_method ORDER BY line_id) - 1 AS position FROM transactions""",
)
def rank_lines(spark, sf):
    lines = table(spark, sf, "transactions").select("payment_method", "line_id")
    return rows.ranked(lines, ["line_id"], "position", within=["payment_method"]).select("line_id", "position")
