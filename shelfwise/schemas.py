"""Column contracts of the retail tables, and the steps that bring a frame into that shape."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


KINDS = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def flat_schema(columns: str) -> T.StructType:
    """A schema from 'name TYPE, name TYPE'; unlike Spark's parser it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in pairs])


# Table layouts.
TRANSACTIONS = flat_schema(
    "transaction_id STRING, store_id INT, customer_id STRING, employee_id STRING, product_id STRING, sku STRING, "
    "quantity INT, unit_price DOUBLE, currency STRING, discount_pct DOUBLE, line_total DOUBLE, "
    "payment_method STRING, transaction_date TIMESTAMP"
)
PRODUCTS = flat_schema(
    "product_id STRING, sku STRING, name_en STRING, name_pt STRING, description_en STRING, description_pt STRING, "
    "category STRING, sub_category STRING, color STRING, size STRING, price DOUBLE, cost DOUBLE, currency STRING, "
    "stock INT, image_url STRING"
)
STORES = flat_schema(
    "store_id INT, name STRING, address STRING, city STRING, state STRING, country STRING, zip_code STRING, "
    "phone STRING, email STRING, latitude DOUBLE, longitude DOUBLE, store_area DOUBLE, num_employees INT, "
    "opening_date DATE"
)
CUSTOMERS = flat_schema(
    "customer_id STRING, name STRING, email STRING, phone STRING, gender STRING, age INT, age_group STRING, "
    "birthday STRING, address STRING, city STRING, state STRING, country STRING, zip_code STRING, segment STRING"
)
EMPLOYEES = flat_schema(
    "employee_id STRING, store_id INT, name STRING, email STRING, phone STRING, gender STRING, age INT, "
    "position STRING, department STRING, salary DOUBLE, hire_date DATE"
)
DISCOUNTS = flat_schema(
    "discount_id STRING, product_id STRING, store_id INT, discount_pct DOUBLE, start_date DATE, end_date DATE, "
    "description STRING"
)
STOCK = flat_schema(
    "store_id INT, sku STRING, product_id STRING, quantity BIGINT, min_quantity INT, max_quantity INT, "
    "last_restocked DATE, updated_at TIMESTAMP"
)
STOCK_IMPORTS = flat_schema(
    "store_id INT, sku STRING, product_id STRING, quantity_imported INT, import_date DATE, supplier STRING, "
    "notes STRING, created_at TIMESTAMP"
)
DEMAND_FORECASTS = flat_schema(
    "store_id STRING, sku STRING, product_id STRING, forecast_year INT, forecast_week INT, "
    "predicted_quantity DOUBLE, model_version STRING, created_at TIMESTAMP"
)
AUDIT_LOGS = flat_schema(
    "id BIGINT, timestamp TIMESTAMP, username STRING, role STRING, action STRING, details STRING, ip STRING"
)
FEED = flat_schema("store_id INT, store_name STRING, lat DOUBLE, lon DOUBLE, country STRING, date STRING").add(
    "products", T.ArrayType(flat_schema("id STRING, weekly_forecast DOUBLE, weekly_sale DOUBLE"))
)
FINAL_DAILY = flat_schema(
    "store_id INT, sku STRING, date DATE, product_id INT, size STRING, color STRING, color_type STRING, "
    "category STRING, sub_category STRING, country STRING, city STRING, num_distinct_products BIGINT, "
    "num_distinct_skus BIGINT, avg_usd_price DOUBLE, total_discount_avg DOUBLE, total_lifespan DOUBLE, "
    "s_total_lifespan DOUBLE, sku_store_coverage DOUBLE, product_store_coverage DOUBLE, s_days_active DOUBLE, "
    "s_selling_days_count DOUBLE, s_sales_velocity DOUBLE, s2_days_active DOUBLE, s2_selling_days_count DOUBLE, "
    "s2_sales_velocity DOUBLE, lag_1d DOUBLE, lag_7d DOUBLE, rolling_mean_7d DOUBLE, rolling_std_7d DOUBLE"
)
FINAL_DAILY_EXTRA = flat_schema(
    "lag_14d DOUBLE, lag_28d DOUBLE, rolling_mean_14d DOUBLE, rolling_mean_30d DOUBLE, "
    "target_encoding_store_sku DOUBLE"
)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Lower-case names, add missing columns as null, cast leniently, and order as in ``schema``."""
    df = lower_names(df)
    present = set(df.columns)

    def column(field: T.StructField):
        if field.name not in present:
            return F.lit(None).cast(field.dataType)
        if isinstance(field.dataType, T.AtomicType):
            return F.col(field.name).try_cast(field.dataType)
        return F.col(field.name).cast(field.dataType)

    return df.select(*[column(field).alias(field.name) for field in schema.fields])


def evolve(df: DataFrame, adds: Mapping[str, str] = {}, renames: Mapping[str, str] = {}) -> DataFrame:
    """Rename columns whose new name is still free, then add the missing ones as typed nulls."""
    renames = {old: new for old, new in renames.items() if old in df.columns and new not in df.columns}
    df = df.withColumnsRenamed(renames)
    missing = {name: F.lit(None).cast(kind) for name, kind in adds.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
