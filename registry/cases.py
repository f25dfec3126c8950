"""The list of named queries and the helpers their SQL counterparts share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from registry.tables import RETAIL, with_clause

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Case:
    name: str
    query: Query
    sql: str | None


CASES: dict[str, Case] = {}


def rounded(expr: str, places: int) -> str:
    """Half-up rounding of a double by its decimal digits, as Spark rounds."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30, 13)), {places}) AS DOUBLE)"


def rounded_mean(units: str, per_unit: int, places: int, count: str = "count(*)") -> str:
    """Mean of whole units, rounded half up."""
    scale = 10**places
    return f"round(sum({units}) / ({count} * {per_unit / scale})) / {float(scale)}"


def units(expr: str, per_unit: int) -> str:
    return f"CAST(round(({expr}) * {per_unit}) AS BIGINT)"


RATE = (
    "CASE currency WHEN 'USD' THEN 1.0 WHEN 'EUR' THEN 1.08 WHEN 'GBP' THEN 1.27 "
    "WHEN 'CNY' THEN 0.14 WHEN 'BRL' THEN 0.20 ELSE 1.0 END::DOUBLE"
)
SKU_DIGITS = "TRY_CAST(nullif(regexp_extract(sku, '[0-9]+'), '') AS BIGINT)"


def sku_category(default: str, sku: str = "sku") -> str:
    return (
        f"CASE WHEN upper({sku}) LIKE 'CH%' THEN 'Children' WHEN upper({sku}) LIKE 'FE%' THEN 'Feminine' "
        f"WHEN upper({sku}) LIKE 'MA%' THEN 'Masculine' ELSE '{default}' END"
    )


def _mode(col: str, by: str) -> str:
    return f"""
        SELECT {by}, {col} AS mode FROM (
            SELECT {by}, {col}, row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, {col}) AS rn
            FROM products WHERE {col} IS NOT NULL GROUP BY {by}, {col}) WHERE rn = 1"""


# Steps of the feature job in SQL, for the oracles only.
STEPS = {
    "clean_tx": """
        SELECT transaction_id, line_id, store_id, product_id, nullif(trim(sku), '') AS sku_original, quantity,
               CASE WHEN discount_pct > 1 OR discount_pct < 0 THEN 0.0 ELSE discount_pct END AS discount_pct,
               CAST(transaction_date AS DATE) AS tx_date, unit_price
        FROM transactions WHERE quantity > 0 AND transaction_date IS NOT NULL""",
    "median_price": "SELECT category, quantile_disc(price, 0.5) AS med FROM products GROUP BY category",
    "mode_color": _mode("color", "category"),
    "mode_size": _mode("size", "sub_category"),
    "clean_products": f"""
        SELECT p.product_id, p.sku AS sku_prod, p.category, p.sub_category,
               coalesce(p.color, c.mode, 'UNKNOWN') AS color, coalesce(p.size, z.mode, 'M') AS size,
               coalesce(p.price, m.med, 50.0) AS price, p.currency,
               CASE WHEN regexp_matches(lower(coalesce(p.color, c.mode, 'UNKNOWN')),
                                        'multi|/|estampado|listrado|xadrez|floral|print')
                    THEN 'Multi Color' ELSE 'Cor Unica' END AS color_type,
               {rounded(f"coalesce(p.price, m.med, 50.0) * {RATE}", 2)} AS usd_price
        FROM products p LEFT JOIN median_price m ON p.category = m.category
             LEFT JOIN mode_color c ON p.category = c.category
             LEFT JOIN mode_size z ON p.sub_category = z.sub_category""",
    "variety": """
        SELECT store_id, count(DISTINCT product_id) AS num_distinct_products,
               count(DISTINCT sku_original) AS num_distinct_skus
        FROM clean_tx GROUP BY store_id""",
    "clean_stores": """
        SELECT s.store_id, coalesce(nullif(trim(s.country), ''), 'Unknown') AS country,
               coalesce(nullif(trim(s.city), ''), 'Unknown') AS city,
               coalesce(v.num_distinct_products, 0) AS num_distinct_products,
               coalesce(v.num_distinct_skus, 0) AS num_distinct_skus
        FROM stores s LEFT JOIN variety v ON s.store_id = v.store_id""",
    "joined": """
        SELECT t.store_id, t.product_id, t.tx_date, t.quantity, coalesce(t.discount_pct, 0.0) AS discount_pct,
               CASE WHEN trim(p.sku_prod) <> '' THEN trim(p.sku_prod)
                    WHEN t.sku_original IS NOT NULL THEN t.sku_original
                    WHEN t.product_id IS NOT NULL THEN concat('SKU-', t.product_id, '-', coalesce(trim(p.size), 'UNK'),
                                                              '-', coalesce(trim(p.color), 'UNK'))
                    ELSE 'SKU-UNKNOWN' END AS sku,
               coalesce(p.usd_price, 0.0) AS usd_price,
               coalesce(p.color, 'Unknown') AS color, coalesce(p.size, 'Unknown') AS size,
               coalesce(p.color_type, 'Unknown') AS color_type, coalesce(p.category, 'Unknown') AS category,
               coalesce(p.sub_category, 'Unknown') AS sub_category, coalesce(s.country, 'Unknown') AS country,
               coalesce(s.city, 'Unknown') AS city, s.num_distinct_products, s.num_distinct_skus
        FROM clean_tx t LEFT JOIN clean_products p ON t.product_id = p.product_id
             LEFT JOIN clean_stores s ON t.store_id = s.store_id""",
    "daily": f"""
        SELECT store_id, sku, tx_date AS date, CAST(sum(quantity) AS DOUBLE) AS qty,
               {rounded_mean(units("usd_price", 100), 100, 2)} AS avg_usd_price,
               {rounded_mean(units("discount_pct", 10_000_000), 10_000_000, 4)} AS total_discount_avg,
               min(product_id) AS product_id,
               arg_min(color, product_id) AS color, arg_min(size, product_id) AS size,
               arg_min(color_type, product_id) AS color_type, arg_min(category, product_id) AS category,
               arg_min(sub_category, product_id) AS sub_category, min(country) AS country, min(city) AS city,
               min(num_distinct_products) AS num_distinct_products, min(num_distinct_skus) AS num_distinct_skus
        FROM joined GROUP BY store_id, sku, tx_date HAVING sum(quantity) > 0""",
    "sku_cov": """
        SELECT sku, count(DISTINCT store_id) AS stores, min(date) AS first_date FROM daily GROUP BY sku""",
    "product_cov": "SELECT product_id, count(DISTINCT store_id) AS stores FROM daily GROUP BY product_id",
    "store_first": "SELECT store_id, sku, min(date) AS first_date FROM daily GROUP BY store_id, sku",
    "featured": f"""
        SELECT d.*,
               CAST(greatest(1, coalesce(c.stores, 0)) AS DOUBLE) AS sku_store_coverage,
               CAST(greatest(1, coalesce(p.stores, 0)) AS DOUBLE) AS product_store_coverage,
               CAST(d.date - c.first_date AS DOUBLE) AS total_lifespan,
               CAST(d.date - f.first_date AS DOUBLE) AS s_total_lifespan,
               lag(qty, 1, 0.0) OVER days AS lag_1d, lag(qty, 7, 0.0) OVER days AS lag_7d,
               lag(qty, 14, 0.0) OVER days AS lag_14d, lag(qty, 28, 0.0) OVER days AS lag_28d,
               coalesce({rounded("avg(qty) OVER d7", 4)}, 0.0) AS rolling_mean_7d,
               coalesce({rounded("avg(qty) OVER d14", 4)}, 0.0) AS rolling_mean_14d,
               coalesce({rounded("avg(qty) OVER d30", 4)}, 0.0) AS rolling_mean_30d,
               coalesce({rounded("stddev_samp(qty) OVER d7", 4)}, 0.0) AS rolling_std_7d,
               CAST(count(qty) OVER d30 AS DOUBLE) AS s_days_active,
               CAST(count(qty) OVER d30 AS DOUBLE) AS s_selling_days_count,
               coalesce({rounded("sum(qty) OVER d30 / greatest(count(qty) OVER d30, 1)", 4)}, 0.0) AS s_sales_velocity,
               CAST(count(qty) OVER d7 AS DOUBLE) AS s2_days_active,
               CAST(count(qty) OVER d7 AS DOUBLE) AS s2_selling_days_count,
               coalesce({rounded("sum(qty) OVER d7 / greatest(count(qty) OVER d7, 1)", 4)}, 0.0) AS s2_sales_velocity,
               coalesce({rounded("avg(qty) OVER earlier", 4)}, 0.0) AS target_encoding_store_sku
        FROM daily d LEFT JOIN sku_cov c ON d.sku = c.sku LEFT JOIN product_cov p ON d.product_id = p.product_id
             LEFT JOIN store_first f ON d.store_id = f.store_id AND d.sku = f.sku
        WINDOW days AS (PARTITION BY d.store_id, d.sku ORDER BY d.date),
               earlier AS (PARTITION BY d.store_id, d.sku ORDER BY d.date
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               d7 AS (PARTITION BY d.store_id, d.sku ORDER BY d.date - DATE '1970-01-01'
                      RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING),
               d14 AS (PARTITION BY d.store_id, d.sku ORDER BY d.date - DATE '1970-01-01'
                       RANGE BETWEEN 14 PRECEDING AND 1 PRECEDING),
               d30 AS (PARTITION BY d.store_id, d.sku ORDER BY d.date - DATE '1970-01-01'
                       RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING)""",
}


def case(name: str, needs: tuple[str, ...] = (), sql: str | None = None, ctes: dict[str, str] | None = None):
    """Register a query; its SQL may use the retail tables and feature steps named in ``needs`` or ``ctes``."""

    def add(query: Query) -> Query:
        if name in CASES:
            raise ValueError(f"{name} is registered twice")
        text = None
        if sql is not None:
            extra = STEPS | (ctes or {})
            text = with_clause([*needs, *(ctes or {})], extra) + sql
            if any("UNION ALL" in cte for cte in (ctes or {}).values()):
                text = text.replace("WITH ", "WITH RECURSIVE ", 1)
        CASES[name] = Case(name, query, text)
        return query

    return add


assert not set(STEPS) & set(RETAIL)
