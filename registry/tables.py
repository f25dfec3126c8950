"""Retail tables derived from the star-schema test tables.

The texts use only SQL that Spark and DuckDB both understand, so the queries and
their SQL counterparts start from the same rows. The test tables are clean;
missing and wrong values are put in by arithmetic on keys.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

RETAIL = {
    "transactions": """
        SELECT l.l_orderkey * 10 + l.l_linenumber AS transaction_id,
               ((l.l_orderkey * 10 + l.l_linenumber) * 1000000 + l.l_partkey) * 10000 + l.l_suppkey AS line_id,
               s.s_nationkey AS store_id, o.o_custkey AS customer_id, l.l_suppkey AS employee_id,
               l.l_partkey AS product_id,
               CASE WHEN l.l_partkey % 11 = 0 THEN NULL WHEN l.l_partkey % 13 = 0 THEN '  '
                    ELSE ' ' || p.p_brand END AS sku,
               CAST(CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber % 4 = 1 THEN -l.l_quantity
                         ELSE l.l_quantity END AS INT) AS quantity,
               l.l_extendedprice / l.l_quantity AS unit_price,
               CASE WHEN l.l_partkey % 10 = 3 THEN NULL ELSE 'USD' END AS currency,
               CASE WHEN l.l_orderkey % 50 = 0 THEN l.l_discount + CAST(1.5 AS DOUBLE)
                    WHEN l.l_orderkey % 50 = 1 THEN CAST(-0.1 AS DOUBLE)
                    WHEN l.l_orderkey % 50 = 2 THEN NULL ELSE l.l_discount END AS discount_pct,
               CASE WHEN l.l_linenumber = 5 THEN NULL ELSE l.l_extendedprice END AS line_total,
               o.o_orderpriority AS payment_method, l.l_shipdate AS transaction_date
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
             JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS sku,
               p_name AS name_en,
               CASE WHEN p_partkey % 17 = 0 THEN 'string' WHEN p_partkey % 19 = 0 THEN NULL
                    ELSE p_name || ' ' || p_type END AS description_en,
               p_type AS category, p_brand AS sub_category,
               CASE WHEN p_partkey % 9 = 0 THEN NULL
                    WHEN p_partkey % 9 = 1 THEN split_part(p_name, ' ', 1) || '/multi'
                    ELSE split_part(p_name, ' ', 1) END AS color,
               CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE CAST(p_size AS STRING) END AS size,
               CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_retailprice END AS price,
               CASE WHEN p_partkey % 12 = 0 THEN NULL ELSE p_retailprice * 0.5 END AS cost,
               CASE p_partkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CNY'
                    WHEN 4 THEN 'BRL' ELSE 'XXX' END AS currency
        FROM part""",
    "stores": """
        SELECT n.n_nationkey AS store_id,
               CASE WHEN n.n_nationkey % 5 = 0 THEN NULL ELSE 'Shop ' || n.n_name END AS store_name,
               CASE WHEN n.n_nationkey % 6 = 0 THEN ' ' ELSE n.n_name END AS country,
               CASE WHEN n.n_nationkey % 6 = 1 THEN NULL ELSE r.r_name END AS city,
               CASE WHEN n.n_nationkey % 7 = 0 THEN NULL ELSE n.n_nationkey + 5 END AS num_employees,
               n.n_nationkey * CAST(1.25 AS DOUBLE) AS latitude, n.n_regionkey * CAST(-3.5 AS DOUBLE) AS longitude
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "customers": """
        SELECT c.c_custkey AS customer_id,
               CASE WHEN c.c_custkey % 21 = 0 THEN NULL ELSE c.c_name END AS name,
               CASE c.c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'Other' ELSE NULL END AS gender,
               CASE WHEN c.c_custkey % 23 = 0 THEN NULL ELSE CAST(15 + c.c_custkey % 60 AS INT) END AS age,
               CASE WHEN c.c_custkey % 31 = 0 THEN '' ELSE n.n_name END AS country,
               c.c_mktsegment AS segment
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "employees": """
        SELECT s_suppkey AS employee_id, s_nationkey AS store_id, s_name AS name,
               CASE s_suppkey % 10 WHEN 0 THEN 'Store Manager' WHEN 1 THEN 'Director' WHEN 2 THEN 'IT Admin'
                    WHEN 3 THEN 'Area  Manager' WHEN 4 THEN NULL ELSE 'Sales Staff' END AS position,
               CASE WHEN s_suppkey % 3 = 0 THEN 'Floor' ELSE 'Office' END AS department, s_acctbal AS salary
        FROM supplier""",
    "discounts": """
        SELECT s_suppkey AS discount_id,
               CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE s_nationkey END AS store_id,
               s_suppkey * 3 AS product_id,
               s_suppkey * 7 % 40 / CAST(100 AS DOUBLE) AS discount_pct,
               CAST('2024-01-01' AS DATE) AS start_date,
               CASE s_suppkey % 5 WHEN 0 THEN CAST('2024-03-31' AS DATE) WHEN 1 THEN CAST('2024-06-30' AS DATE)
                    WHEN 2 THEN CAST('2024-09-30' AS DATE) WHEN 3 THEN CAST('2024-12-31' AS DATE)
                    ELSE NULL END AS end_date,
               'Season ' || CAST(s_suppkey % 5 AS STRING) AS description
        FROM supplier""",
    "stock": """
        SELECT store_id, trim(sku) AS sku, min(product_id) AS product_id,
               CAST(greatest(0, round(sum(quantity) * CAST(0.2 AS DOUBLE))) AS BIGINT) AS quantity,
               CAST(max(transaction_date) AS DATE) AS last_restocked
        FROM transactions WHERE quantity > 0 AND trim(sku) <> ''
        GROUP BY store_id, trim(sku)""",
    "inventory": """
        SELECT s.s_nationkey AS store_id,
               CASE l.l_partkey % 8 WHEN 0 THEN 'CHAC' || CAST(l.l_partkey AS STRING) || '--'
                    WHEN 1 THEN 'feac' || CAST(l.l_partkey AS STRING) || '--'
                    WHEN 2 THEN 'MAAC' || CAST(l.l_partkey AS STRING) || '--'
                    WHEN 3 THEN 'MA' || CAST(l.l_partkey AS STRING) || '-M-RED'
                    WHEN 4 THEN 'SKU-' || CAST(l.l_partkey AS STRING)
                    WHEN 5 THEN 'Testing string' WHEN 6 THEN 'undefined'
                    ELSE 'ZZ' || CAST(l.l_partkey AS STRING) END AS sku,
               CAST(sum(l.l_quantity) AS BIGINT) % 40 AS stock_quantity
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
        GROUP BY 1, 2""",
    "skus": """
        SELECT p_partkey AS product_id,
               CASE p_partkey % 8 WHEN 0 THEN 'CHAC' || CAST(p_partkey AS STRING) || '--'
                    WHEN 1 THEN 'feac' || CAST(p_partkey AS STRING) || '--'
                    WHEN 2 THEN 'MAAC' || CAST(p_partkey AS STRING) || '--'
                    WHEN 3 THEN 'MA' || CAST(p_partkey AS STRING) || '-M-RED'
                    WHEN 4 THEN 'SKU-' || CAST(p_partkey AS STRING) ELSE 'ZZ' || CAST(p_partkey AS STRING) END AS sku
        FROM part""",
    "shop_products": """
        SELECT p_partkey AS product_id,
               CASE p_partkey % 8 WHEN 0 THEN 'CHAC' || CAST(p_partkey AS STRING) || '--'
                    WHEN 2 THEN 'MAAC' || CAST(p_partkey AS STRING) || '--'
                    WHEN 3 THEN 'MA' || CAST(p_partkey % 100 AS STRING) || '-' WHEN 4 THEN NULL
                    WHEN 5 THEN '--' ELSE 'ZZ' || CAST(p_partkey AS STRING) END AS sku,
               p_name || ' ' || p_type AS product_name,
               CASE p_partkey % 4 WHEN 0 THEN 'Children' WHEN 1 THEN 'Feminine' WHEN 2 THEN 'Masculine'
                    ELSE 'Home' END AS category
        FROM part""",
    "imports": """
        SELECT event_id AS import_id, CAST(user_id % 25 AS INT) AS store_id,
               'CHAC' || CAST(user_id % 90 AS STRING) || '--' AS sku,
               CAST(floor(value) AS INT) % 50 AS quantity_imported, CAST(ts AS DATE) AS import_date,
               CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'Supplier ' || event_type END AS supplier
        FROM events""",
    "moves": """
        SELECT event_id, CAST(user_id % 5 AS INT) AS store_id, 'SKU ' || event_type AS sku, ts,
               CAST(CASE event_type WHEN 'purchase' THEN -1 WHEN 'signup' THEN 5 WHEN 'error' THEN -3
                    ELSE 0 END AS INT) AS delta
        FROM events""",
    "audit_logs": """
        SELECT event_id AS id, ts AS timestamp, 'user' || CAST(user_id AS STRING) AS username,
               CASE event_type WHEN 'click' THEN 'LOGIN_SUCCESS' WHEN 'purchase' THEN 'TRANSACTION_CREATE'
                    WHEN 'view' THEN 'STOCK_UPDATE' WHEN 'error' THEN 'MFA_DELETE' ELSE 'EXPORT' END AS action
        FROM events""",
    "weekly_sales": """
        SELECT store_id, trim(sku) AS sku, CAST(year(transaction_date) AS INT) AS year,
               CAST(weekofyear(transaction_date) AS INT) AS week, CAST(sum(quantity) AS BIGINT) AS sold
        FROM transactions WHERE quantity > 0 AND trim(sku) <> ''
        GROUP BY 1, 2, 3, 4""",
    "forecasts": """
        SELECT store_id, sku, 'Product ' || sku AS product_name, 'Clothing' AS category, year, week,
               sold + (week % 5) - 2 AS predicted_quantity,
               CASE WHEN year = 2001 AND (week > 30 OR week % 7 = 3) THEN NULL ELSE sold END AS actual_quantity
        FROM weekly_sales""",
    "requests": """
        SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'STORE_' || lpad(CAST(s_nationkey AS STRING), 3, '0')
                    WHEN l_orderkey % 101 = 1 THEN 'nowhere' ELSE CAST(s_nationkey AS STRING) END AS store_id,
               CASE WHEN l_orderkey % 97 = 5 THEN 'Brand#x' WHEN l_orderkey % 89 = 5 THEN 'NEW-' || CAST(l_partkey AS STRING)
                    ELSE p_brand END AS sku,
               CASE WHEN l_orderkey % 53 = 7 THEN 'soon'
                    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS date,
               CASE WHEN l_orderkey % 41 = 3 THEN CAST(1.7 AS DOUBLE) WHEN l_orderkey % 4 = 1 THEN l_tax
                    ELSE NULL END AS total_discount_avg
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
             JOIN part ON l_partkey = p_partkey""",
    "users": """
        SELECT 'user' || CAST(s_suppkey AS STRING) AS username,
               CASE s_suppkey % 10 WHEN 0 THEN 'Store Manager' WHEN 1 THEN 'Director' WHEN 2 THEN 'IT Admin'
                    ELSE 'Sales Staff' END AS role, s_nationkey AS store_id
        FROM supplier""",
    "perms": """
        SELECT CASE r_regionkey WHEN 0 THEN 'Director' WHEN 1 THEN 'Store Manager' WHEN 2 THEN 'Sales Staff'
                    ELSE 'IT Admin' END AS role,
               CASE r_regionkey WHEN 0 THEN 'view_all_stores' WHEN 1 THEN 'view_own_store'
                    WHEN 2 THEN 'view_own_store' ELSE 'manage_users' END AS permission
        FROM region""",
}

def with_clause(names: tuple[str, ...] | list[str], extra: dict[str, str] | None = None) -> str:
    """The WITH clause that defines the named tables and everything they mention."""
    texts = RETAIL | (extra or {})
    wanted: set[str] = set()
    queue = [name for name in names if name in texts]
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue += [other for other in texts if other != name and re.search(rf"\b{other}\b", texts[name])]
    parts = [f"{name} AS ({texts[name]})" for name in texts if name in wanted]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One retail table as a frame over the test files."""
    text = f"{with_clause([name])} SELECT * FROM {name}"
    for raw in RAW:
        if re.search(rf"\b{raw}\b", text):
            raw_table(spark, sf_dir, raw).createOrReplaceTempView(raw)
    return spark.sql(text)


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in names}
