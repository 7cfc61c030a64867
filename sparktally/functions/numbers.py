"""Tolerant casts, truncation and exact amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def number_or_null(value: Column | str, kind: str = "double") -> Column:
    """The number, or NULL where the text is not one (for rules that reject the row)."""
    return as_column(value).try_cast(kind)


def number_or_zero(value: Column | str, kind: str = "double") -> Column:
    """The number, or 0 where the text is missing or not a number."""
    return F.coalesce(number_or_null(value, kind), F.lit(0).cast(kind))


def exact_amount(value: Column | str, precision: int = 12, scale: int = 2) -> Column:
    """An amount as a decimal, so that sums do not depend on the order of addition."""
    return as_column(value).cast(f"decimal({precision},{scale})")


def scaled(value: Column | str, digits: int = 2) -> Column:
    """A floating-point amount as a whole number of its smallest unit, such as cents.

    Whole numbers add up exactly in any order, at a fraction of the cost of decimals. An amount
    with more decimals is not rounded but rejected, as is one that is no number: it is NULL.
    """
    units = as_column(value) * float(10**digits)
    # What binary fractions leave of whole units is far below one in 10^9 of the amount.
    off = F.abs(units - F.rint(units)) <= F.greatest(F.abs(units), F.lit(1.0)) * 1e-9
    return F.when(off, F.rint(units).try_cast("bigint"))


def unscaled(value: Column | str, digits: int = 2) -> Column:
    """Whole units as a floating-point amount again."""
    return as_column(value).cast("double") / float(10**digits)


# A plain sum of large amounts overflows a bigint at some 10^10 rows per group. Upper and
# lower bits are added up apart, each far from the limit, and put together at the end.
LOW_BITS = 20


def bit_parts(value: Column | str) -> dict[str, Column]:
    """A bigint as two parts, ``high`` and ``low``, whose sums cannot overflow."""
    number = as_column(value)
    low = number.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint"))
    return {"high": F.shiftright(number, LOW_BITS), "low": low}


def from_bit_parts(high: Column | str = "high", low: Column | str = "low") -> Column:
    """The exact number that the sums of both parts stand for, as a decimal(38,0)."""
    wide = as_column(high).cast("decimal(28,0)") * F.lit(1 << LOW_BITS) + as_column(low)
    return wide.cast("decimal(38,0)")


def truncated(value: Column | str) -> Column:
    """The whole part as a bigint, rounded toward zero; NULL for NaN, infinity and what exceeds it."""
    return as_column(value).try_cast("bigint")


def whole_percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, truncated; NULL if ``whole`` is 0.

    The sums are widened first: a hundred times a sum of many rows can exceed a bigint.
    """
    wide = "decimal(30,0)"
    return F.call_function(
        "div", part.cast(wide) * F.lit(100), F.nullif(whole.cast(wide), F.lit(0).cast(wide))
    )
