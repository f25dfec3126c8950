"""Feature lookup for forecast requests: nearest date, static fallback, overrides and validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions import text
from shelfwise.operators.rows import dedup
from shelfwise.session import stage

# The features a model row needs, and what stands in for a missing one.
REQUIRED_FEATURES = (
    "product_id",
    "size",
    "color",
    "total_lifespan",
    "s_total_lifespan",
    "sku_store_coverage",
    "product_store_coverage",
    "s_days_active",
    "s_selling_days_count",
    "s_sales_velocity",
    "s2_days_active",
    "s2_selling_days_count",
    "s2_sales_velocity",
    "avg_usd_price",
    "total_discount_avg",
    "lag_1d",
    "lag_7d",
    "rolling_mean_7d",
    "rolling_std_7d",
    "category",
    "sub_category",
    "color_type",
    "country",
    "city",
    "num_distinct_products",
    "num_distinct_skus",
    "lag_14d",
    "lag_28d",
    "rolling_mean_14d",
    "rolling_mean_30d",
    "target_encoding_store_sku",
)
NULL_DEFAULTS = {
    "product_id": 0,
    "size": "M",
    "color": "BLACK",
    "total_lifespan": 120.0,
    "s_total_lifespan": 180.0,
    "sku_store_coverage": 30.0,
    "product_store_coverage": 30.0,
    "s_days_active": 90.0,
    "s_selling_days_count": 40.0,
    "s_sales_velocity": 0.4,
    "s2_days_active": 60.0,
    "s2_selling_days_count": 5.0,
    "s2_sales_velocity": 0.05,
    "avg_usd_price": 50.0,
    "total_discount_avg": 0.0,
    "lag_1d": 0.0,
    "lag_7d": 0.0,
    "rolling_mean_7d": 0.0,
    "rolling_std_7d": 0.0,
    "category": "Feminine",
    "sub_category": "Dresses and Jumpsuits",
    "color_type": "Cor Unica",
    "country": "United States",
    "city": "New York",
    "num_distinct_products": 17000,
    "num_distinct_skus": 50000,
    "lag_14d": 1.0,
    "lag_28d": 1.0,
    "rolling_mean_14d": 1.15,
    "rolling_mean_30d": 1.15,
    "target_encoding_store_sku": 1.15,
}
MISS_DEFAULTS = {
    "product_id": 8090,
    "size": "40",
    "color": "BLACK",
    "total_lifespan": 120.0,
    "s_total_lifespan": 180.0,
    "sku_store_coverage": 31.0,
    "product_store_coverage": 34.0,
    "s_days_active": 86.0,
    "s_selling_days_count": 42.0,
    "s_sales_velocity": 0.45,
    "s2_days_active": 67.0,
    "s2_selling_days_count": 4.0,
    "s2_sales_velocity": 0.06,
    "avg_usd_price": 51.3,
    "total_discount_avg": 0.10,
    "lag_1d": 1.0,
    "lag_7d": 0.0,
    "rolling_mean_7d": 0.8,
    "rolling_std_7d": 0.15,
    "category": "Feminine",
    "sub_category": "Dresses and Jumpsuits",
    "color_type": "Cor Unica",
    "country": "France",
    "city": "Paris",
    "num_distinct_products": 16500,
    "num_distinct_skus": 44000,
    "lag_14d": 1.0,
    "lag_28d": 1.0,
    "rolling_mean_14d": 1.15,
    "rolling_mean_30d": 1.15,
    "target_encoding_store_sku": 1.15,
}
PROFILES: dict[str, Mapping[str, object]] = {"null": NULL_DEFAULTS, "miss": MISS_DEFAULTS}
STATIC_SUB_CATEGORY = "Coats and Blazers"
PRODUCTS_PER_EMPLOYEE = 1700
SKUS_PER_EMPLOYEE = 5000


def default_features(df: DataFrame, profile: str = "null") -> DataFrame:
    """Fill missing features: profile ``null`` for gaps in a found row, ``miss`` for a row that was not found."""
    present = {name: value for name, value in PROFILES[profile].items() if name in df.columns}
    return df.fillna(present)


def nearest_dates(requests: DataFrame, daily: DataFrame) -> DataFrame:
    """For each requested (store, SKU, date) the feature date closest to it, the earlier one on ties.

    Requests are reduced to distinct dates first, and feature rows are one per
    day, so a window partition holds at most twice the days of the calendar even
    if most requests are for one SKU. The dates of both sides are merged into one
    ordered sequence: the neighbours on either side are the last feature date
    seen going forwards and going backwards, each a running value.
    """
    keys = ["store_id", "sku"]
    wanted = requests.select(*keys, F.col("date").alias("_day")).where(F.col("_day").isNotNull()).distinct()
    known = daily.select(*keys, F.col("date").alias("_day"), F.col("date").alias("_known"))
    known = known.join(requests.select(*keys).distinct(), keys, "left_semi")
    merged = wanted.withColumn("_known", F.lit(None).cast("date")).unionByName(known)
    day = F.unix_date("_day")
    running = (W.unboundedPreceding, W.currentRow)
    # Ranges, not rows: a feature row of the requested day itself counts on both sides.
    forwards = W.partitionBy(*keys).orderBy(day.asc()).rangeBetween(*running)
    backwards = W.partitionBy(*keys).orderBy(day.desc()).rangeBetween(*running)
    before, after = F.col("_before"), F.col("_after")
    closer_after = F.datediff(after, "_day") < F.datediff("_day", before)
    return (
        merged.select(
            *keys,
            "_day",
            "_known",
            F.max("_known").over(forwards).alias("_before"),
            F.min("_known").over(backwards).alias("_after"),
        )
        .where(F.col("_known").isNull())
        .select(
            *keys,
            F.col("_day").alias("date"),
            F.when(before.isNull() | closer_after, after).otherwise(before).alias("feature_date"),
        )
        .where(F.col("feature_date").isNotNull())
    )


def nearest_features(requests: DataFrame, daily: DataFrame) -> DataFrame:
    """Requests with the feature row of the nearest date; requests for unknown series are left out.

    Requests are computed once and staged. They learn their feature date from
    narrow rows; the wide feature rows are fetched last, by key, and shuffled once.
    """
    return fetch_nearest(stage(requests, "requests"), daily)


def fetch_nearest(requests: DataFrame, daily: DataFrame) -> DataFrame:
    """``nearest_features`` of requests that are staged already."""
    dated = requests.join(nearest_dates(requests, daily), ["store_id", "sku", "date"])
    rows = daily.withColumnRenamed("date", "feature_date")
    wide = [name for name in rows.columns if name not in ("store_id", "sku", "feature_date")]
    order = ["store_id", "sku", "date", *(c for c in requests.columns if c not in ("store_id", "sku", "date")), "feature_date", *wide]
    return dated.join(rows, ["store_id", "sku", "feature_date"]).select(*order)


def static_features(requests: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Product attributes by SKU, else by the SKU's digits, and store attributes, for requests without features.

    ``static_found`` tells whether anything was found. The cost stands in for the
    price, and the number of employees for the size of the assortment.
    """
    info = F.struct("product_id", "size", "color", "category", "sub_category", "cost")
    by_sku = dedup(products.where(F.col("sku").isNotNull()).select("sku", info.alias("_by_sku")), ["sku"], ["_by_sku"])
    by_id = products.select(F.col("product_id").cast("string").alias("_digits"), info.alias("_by_id"))
    by_id = dedup(by_id.where(F.col("_digits").isNotNull()), ["_digits"], ["_by_id"])
    place = stores.select("store_id", F.struct("country", "city", "num_employees").alias("_store"))

    digits = F.nullif(F.regexp_extract("sku", r"\d+", 0), F.lit(""))
    df = (
        requests.withColumn("_digits", digits)
        .join(by_sku, "sku", "left")
        .join(by_id, "_digits", "left")
        .join(dedup(place, ["store_id"], ["_store"]), "store_id", "left")
    )
    product = F.coalesce("_by_sku", "_by_id")
    df = df.withColumn("_product", product)
    product_found, store_found = F.col("_product").isNotNull(), F.col("_store").isNotNull()

    def part(source: str, field: str, default: object):
        return F.when(F.col(source).isNotNull(), F.coalesce(F.col(f"{source}.{field}"), F.lit(default)))

    employees = F.col("_store.num_employees")
    color = part("_product", "color", NULL_DEFAULTS["color"])
    columns = {
        "product_id": F.when(product_found, F.coalesce(F.col("_product.product_id").try_cast("int"), F.lit(0))),
        "size": part("_product", "size", NULL_DEFAULTS["size"]),
        "color": color,
        "category": part("_product", "category", NULL_DEFAULTS["category"]),
        "sub_category": part("_product", "sub_category", STATIC_SUB_CATEGORY),
        "color_type": F.when(color == "None", text.MULTI_COLOR).when(product_found, text.SINGLE_COLOR),
        "avg_usd_price": part("_product", "cost", NULL_DEFAULTS["avg_usd_price"]),
        "country": part("_store", "country", NULL_DEFAULTS["country"]),
        "city": part("_store", "city", NULL_DEFAULTS["city"]),
        "num_distinct_products": F.when(
            store_found, F.coalesce(employees * PRODUCTS_PER_EMPLOYEE, F.lit(NULL_DEFAULTS["num_distinct_products"]))
        ).cast("bigint"),
        "num_distinct_skus": F.when(
            store_found, F.coalesce(employees * SKUS_PER_EMPLOYEE, F.lit(NULL_DEFAULTS["num_distinct_skus"]))
        ).cast("bigint"),
        "static_found": product_found | store_found,
    }
    return df.select(*requests.columns, *[col.alias(name) for name, col in columns.items()])


def features_for(requests: DataFrame, daily: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Each request with its features: nearest date, else static, else none.

    ``source`` says which: 'daily', 'static' or 'missing'. Request columns that
    are named like features are kept aside as ``asked_<name>``.

    Features are put together per distinct (store, SKU, date); the requests join
    them once, by all three, so wide rows are never shuffled by store and SKU, of
    which a few may have most of the requests. ``requests`` are computed once and
    staged, as the keys and the last join both read them.
    """
    return fetch_features(stage(requests, "requests"), daily, products, stores)


def fetch_features(requests: DataFrame, daily: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """``features_for`` of requests that are staged already."""
    own = ["store_id", "sku", "date"]
    asked = {name: f"asked_{name}" for name in requests.columns if name in REQUIRED_FEATURES}
    requests = requests.withColumnsRenamed(asked)
    features = [name for name in REQUIRED_FEATURES if name in daily.columns]
    types = {field.name: field.dataType for field in daily.schema.fields}

    keys = stage(requests.select(*own).distinct(), "keys")
    dated = stage(keys.join(nearest_dates(keys, daily), own, "left"), "dated")
    near = default_features(daily.select("store_id", "sku", F.col("date").alias("feature_date"), *features))
    near = near.withColumnsRenamed({name: f"_near_{name}" for name in features})

    needy = dated.where(F.col("feature_date").isNull()).select("store_id", "sku").distinct()
    static = static_features(needy, products, stores).where("static_found").drop("static_found")
    static_names = [name for name in static.columns if name not in ("store_id", "sku")]
    static = static.select("store_id", "sku", *[F.col(name).alias(f"_static_{name}") for name in static_names], F.lit(True).alias("_static"))
    found = dated.join(near, ["store_id", "sku", "feature_date"], "left").join(static, ["store_id", "sku"], "left")
    missed = F.col("feature_date").isNull()

    def pick(name: str):
        choices = []
        if name in features:
            choices.append(F.col(f"_near_{name}"))
        if name in static_names:
            kind = types.get(name, static.schema[f"_static_{name}"].dataType)
            choices.append(F.when(missed, F.col(f"_static_{name}").cast(kind)))
        return F.coalesce(*choices) if choices else F.lit(None).cast("double")

    source = F.when(~missed, "daily").when(F.col("_static"), "static").otherwise("missing")
    picked = found.select(
        *[F.col(name).alias(f"_{name}") for name in own],
        "feature_date",
        source.alias("_source"),
        *[pick(name).alias(name) for name in REQUIRED_FEATURES],
    )
    # A request without a date still finds what is known of its product and store.
    same = (requests["store_id"] == F.col("_store_id")) & (requests["sku"] == F.col("_sku")) & requests["date"].eqNullSafe(F.col("_date"))
    return requests.join(picked, same, "left").select(
        *[requests[name] for name in requests.columns],
        "feature_date",
        F.coalesce("_source", F.lit("missing")).alias("source"),
        *REQUIRED_FEATURES,
    )


def apply_overrides(df: DataFrame, names: Sequence[str] | None = None, prefix: str = "asked_") -> DataFrame:
    """A feature value given with the request (``asked_<name>``) wins over the looked-up one."""
    if names is None:
        names = [name.removeprefix(prefix) for name in df.columns if name.startswith(prefix)]
    given = {name: F.coalesce(F.col(prefix + name).cast(df.schema[name].dataType), F.col(name)) for name in names}
    return df.withColumns(given).drop(*[prefix + name for name in names]) if given else df


def missing_features(names: Sequence[str] = REQUIRED_FEATURES):
    """Array with the names of all features that are null in a row."""
    return F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in names]))


def validate_features(df: DataFrame, names: Sequence[str] = REQUIRED_FEATURES) -> DataFrame:
    """Add ``status`` ('ok' or 'error') and ``message`` listing what is missing."""
    df = df.withColumn("_missing", missing_features(names))
    not_found = F.col("source") == "missing" if "source" in df.columns else F.lit(False)
    message = F.when(not_found, "features not found").when(
        F.size("_missing") > 0, F.concat(F.lit("missing features: "), F.array_join("_missing", ", "))
    )
    return df.withColumn("message", message).withColumn(
        "status", F.when(F.col("message").isNull(), "ok").otherwise("error")
    ).drop("_missing")
