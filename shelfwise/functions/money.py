"""Prices, discounts and totals.

Averages of money are taken over whole units (cents, and ten-millionths for
discount shares): whole numbers add up to the same sum in any order, so a
retried task or another partitioning cannot change a rounded average.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# US dollars per unit of currency, and the price used when nothing else is known.
USD_RATES = {"USD": 1.00, "EUR": 1.08, "GBP": 1.27, "CNY": 0.14, "BRL": 0.20}
DEFAULT_PRICE = 50.0
CENTS = 100
SHARE_UNITS = 10_000_000


def to_usd(price: Column, currency: Column, rates: Mapping[str, float] = USD_RATES) -> Column:
    """Price in US dollars with two decimals; an unknown currency counts as dollars."""
    table = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    return F.round(price * F.coalesce(table[currency], F.lit(1.0)), 2)


def whole_units(amount: Column, per_unit: int) -> Column:
    return F.round(amount * per_unit).cast("bigint")


def rounded_mean(total_units: Column, count: Column, per_unit: int, places: int) -> Column:
    """Mean of whole units, rounded half up to ``places`` decimals of the original amount."""
    scale = 10**places
    return F.round(total_units / (count * F.lit(per_unit / scale))) / F.lit(float(scale))


def valid_share(discount: Column) -> Column:
    """A discount share outside 0..1 counts as no discount; a missing one stays missing."""
    return F.when((discount > 1.0) | (discount < 0.0), 0.0).otherwise(discount.cast("double"))


def line_total(given: Column, price: Column, quantity: Column) -> Column:
    """The booked total, or price times quantity where none (or zero) was booked."""
    return F.coalesce(
        F.nullif(given, F.lit(0.0)),
        F.coalesce(price, F.lit(0.0)) * F.coalesce(F.nullif(quantity, F.lit(0)), F.lit(1)),
    )


def finite_or_null(number: Column) -> Column:
    return F.when(F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)
