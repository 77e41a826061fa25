"""Numeric column functions: exact rounding, safe ratios, text coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"


def py_round(x: Column, digits: int) -> Column:
    """Round a double correctly on its exact binary value.

    Spark's ``round``/``bround`` work on the shortest decimal text and differ
    on near-ties; formatting the double does not.  NaN and infinities pass.
    """
    text = F.replace(F.format_number(x, digits), F.lit(","), F.lit(""))
    special = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(special, x).otherwise(text.try_cast("double"))


def safe_divide(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Rounded quotient; 0.0 for a null or zero denominator."""
    divisor = F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.when(divisor.isNull(), F.lit(0.0)).otherwise(
        py_round(numerator.cast("double") / divisor, digits)
    )


def discount_pct(original: Column, current: Column) -> Column:
    """Discount in percent; 0.0 without an original price above the current one."""
    base = F.nullif(original, F.lit(0.0))
    return F.when(base.isNull() | (base <= current), F.lit(0.0)).otherwise(
        py_round((base - current) / base * 100, 2)
    )


def to_double(text: Column) -> Column:
    """Number in a text, null if it is none.

    The cast alone would also take Java's type suffixes, as in ``1.5d``.
    """
    suffixed = text.rlike(r"[0-9.][dDfF]\s*$")
    return F.when(~suffixed, text.try_cast("double"))


def not_a_number(text: Column) -> Column:
    """True for a non-empty text that ``to_double`` cannot read."""
    return text.isNotNull() & (text != "") & to_double(text).isNull()


def or_zero(x: Column) -> Column:
    """Null becomes zero."""
    return F.coalesce(x, F.lit(0))


def to_money(text: Column) -> Column:
    """Exact decimal of a text; null if absent, not numeric or out of range."""
    return text.try_cast(MONEY)


def not_money(text: Column) -> Column:
    """True for a present text that is no amount of money."""
    return text.isNotNull() & to_money(text).isNull()
