"""Money expressions. Sums stay in DECIMAL; reports turn them into DOUBLE last."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pegged rate of the reporting currency.
USD_TO_AED = Decimal("3.6725")


def to_aed(amount: Column, currency: Column) -> Column:
    """Amount in AED, two decimals; any currency but USD is taken as AED already."""
    amount = amount.cast("decimal(18,2)")
    converted = F.round(amount * F.lit(USD_TO_AED), 2)
    return F.when(currency == "USD", converted).otherwise(amount).cast("decimal(18,2)")


def money_total(amount: Column) -> Column:
    """Exact sum, shown as DOUBLE."""
    return F.sum(amount).cast("double")


def money_mean(amount: Column, digits: int | None = None) -> Column:
    """Mean of an exact sum: unrounded DOUBLE, or rounded in DECIMAL first."""
    if digits is None:
        return F.sum(amount).cast("double") / F.count(amount)
    return F.round(F.sum(amount) / F.count(amount), digits).cast("double")


def money_text(value: Column) -> Column:
    """``1.23M AED``, ``4.5K AED`` or whole ``AED``."""
    value = value.cast("double")

    def digits(scaled: Column, places: int) -> Column:
        return F.replace(F.format_number(scaled, places), F.lit(","), F.lit(""))

    return (
        F.when(value >= 1_000_000, F.concat(digits(value / 1_000_000, 2), F.lit("M AED")))
        .when(value >= 1_000, F.concat(digits(value / 1_000, 1), F.lit("K AED")))
        .otherwise(F.concat(F.format_number(value, 0), F.lit(" AED")))
    )
