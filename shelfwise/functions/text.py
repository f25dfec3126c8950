"""Text rules: blanks, SKUs, colours, stores, people and audit labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, labels and prefixes.
MULTI_COLOR_PATTERN = "(?i)multi|/|estampado|listrado|xadrez|floral|print"
MULTI_COLOR = "Multi Color"
SINGLE_COLOR = "Cor Unica"
CATEGORY_BY_SKU_PREFIX = {"CH": "Children", "FE": "Feminine", "MA": "Masculine"}
SKU_PREFIX_BY_CATEGORY = {"children": "CHAC", "feminine": "FEAC", "masculine": "MAAC"}
SHOWN_CATEGORIES = ("Children", "Masculine", "Feminine")
AUDIT_CLASSES = ("login", "create", "update", "delete", "mfa")
UNKNOWN_SKU = "SKU-UNKNOWN"
PRODUCT_LABEL = "Sản phẩm"
CUSTOMER_LABEL = "Khách hàng"
STORE_LABEL = "Store"


def blank_to_null(col: Column) -> Column:
    """Trimmed text; blank counts as missing."""
    return F.nullif(F.trim(col.cast("string")), F.lit(""))


def text_or(col: Column, default: str) -> Column:
    return F.coalesce(blank_to_null(col), F.lit(default))


def color_type(color: Column) -> Column:
    return F.when(color.rlike(MULTI_COLOR_PATTERN), MULTI_COLOR).otherwise(SINGLE_COLOR)


def sku_chain(product_sku: Column, own_sku: Column, product_id: Column, size: Column, color: Column) -> Column:
    """The first usable SKU: product's, transaction's, one built from the product, or the unknown marker."""
    built = F.concat_ws(
        "-",
        F.lit("SKU"),
        product_id.cast("string"),
        F.coalesce(F.trim(size), F.lit("UNK")),
        F.coalesce(F.trim(color), F.lit("UNK")),
    )
    return F.coalesce(
        blank_to_null(product_sku),
        blank_to_null(own_sku),
        F.when(product_id.isNotNull(), built),
        F.lit(UNKNOWN_SKU),
    )


def parse_store_id(raw: Column, strict: bool = False) -> Column:
    """'STORE_001' or '1' to 1. Text that is no number becomes 1.

    ``strict`` follows the prediction endpoint, where a malformed STORE_ code is
    an error: such a row gets null, so that the caller can reject it.
    """
    text = F.upper(raw.cast("string"))
    parsed = F.trim(F.replace(text, F.lit("STORE_"))).try_cast("int")
    if strict:
        return F.when(text.contains("STORE_"), parsed).otherwise(F.coalesce(parsed, F.lit(1)))
    return F.coalesce(parsed, F.lit(1))


def sku_category(sku: Column, default: str = "Clothing") -> Column:
    upper = F.upper(sku)
    rule = F
    for prefix, category in CATEGORY_BY_SKU_PREFIX.items():
        rule = rule.when(upper.startswith(prefix), category)
    return rule.otherwise(default)


def sku_product_id(sku: Column) -> Column:
    """The first run of digits in a SKU as a product id, null when there is none."""
    return F.regexp_extract(sku, r"\d+", 0).try_cast("bigint")


def build_sku(category: Column, product_id: Column) -> Column:
    lower = F.lower(category)
    prefix = F
    for name, code in SKU_PREFIX_BY_CATEGORY.items():
        prefix = prefix.when(lower == name, code)
    return F.concat(prefix.otherwise("SKU"), product_id.cast("string"), F.lit("--"))


def sku_spellings(product_id: Column) -> Column:
    """Every SKU under which a product's stock may have been booked."""
    number = product_id.cast("string")
    return F.array(
        F.concat(F.lit("SKU-"), number),
        *[F.concat(F.lit(code), number, F.lit("--")) for code in SKU_PREFIX_BY_CATEGORY.values()],
    )


def gender_label(code: Column, default: str = "Unknown") -> Column:
    return F.when(code == "M", "Male").when(code == "F", "Female").otherwise(text_or_default(code, default))


def text_or_default(col: Column, default: str) -> Column:
    """Null or empty text becomes the default; other text is kept untouched."""
    return F.coalesce(F.nullif(col.cast("string"), F.lit("")), F.lit(default))


def numbered_label(label: str, number: Column, mark: str = "#") -> Column:
    """A stand-in name such as 'Store #7'."""
    return F.concat(F.lit(f"{label} {mark}"), number.cast("string"))


def salesperson_label(role: Column, store_id: Column) -> Column:
    """Account label of an employee from the role and the store."""
    suffix = F.coalesce(store_id.cast("string"), F.lit(""))
    plain = F.regexp_replace(F.lower(F.coalesce(role, F.lit(""))), r"\s+", "")
    return (
        F.when(role == "IT Admin", "admin")
        .when(role == "Director", "director")
        .when(role == "Store Manager", F.concat(F.lit("manager"), suffix))
        .when(role == "Sales Staff", F.concat(F.lit("sales"), suffix))
        .otherwise(F.concat(plain, suffix))
    )


def is_leader(role: Column) -> Column:
    upper = F.upper(F.coalesce(role, F.lit("")))
    return upper.contains("MANAGER") | upper.contains("DIRECTOR")


def action_class(action: Column, classes: Sequence[str] = AUDIT_CLASSES) -> Column:
    lower = F.lower(action)
    rule = F
    for name in classes:
        rule = rule.when(lower.contains(name), name)
    return rule.otherwise("default")


def age_band(age: Column) -> Column:
    """Five age bands; under 18 and unknown ages are counted with the youngest band."""
    years = F.coalesce(age, F.lit(0))
    return (
        F.when(years.between(26, 35), "26-35")
        .when(years.between(36, 45), "36-45")
        .when(years.between(46, 55), "46-55")
        .when(years > 55, "56+")
        .otherwise("18-25")
    )


def gender_group(gender: Column) -> Column:
    return F.when(gender.isin("Male", "M"), "Male").when(gender.isin("Female", "F"), "Female").otherwise("Other")
