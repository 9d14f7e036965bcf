"""Scalar column builders. All are built-in expressions (codegen, no UDF)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from martflow.contracts import EXTRA_SEPARATOR, MONEY


def month_key(date_col: str | Column) -> Column:
    """``yyyy-MM`` of a date: the first seven characters of its ISO text.

    Same as ``substring(date, 1, 7)`` with the implicit date-to-string cast.
    """
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.substring(c.cast("string"), 1, 7)


def full_name(first: str | Column, last: str | Column) -> Column:
    """``first || ' ' || last``; NULL when either part is NULL (concat, not concat_ws)."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def money(c: str | Column) -> Column:
    """Exact two-place money (decimal(18,2))."""
    return _c(c).cast(MONEY)


def fold_columns(names: list[str]) -> Column:
    """Fold columns into one string: names sorted, NULLs skipped (concat_ws).

    No extras gives NULL; extras that are all NULL give ''.
    """
    return fold_values([F.col(f"`{n}`") for n in sorted(names)])


def fold_values(values: list[Column]) -> Column:
    """The same for columns in the given order."""
    if not values:
        return F.lit(None).cast("string")
    return F.concat_ws(EXTRA_SEPARATOR, *[v.cast("string") for v in values])


def rate_of(amount: str | Column, rate: str, places: int = 2) -> Column:
    """``round(amount * rate, places)`` in decimal, half-up."""
    return F.round(_c(amount) * F.lit(Decimal(rate)), places)


def split_part(c: str | Column, sep: str, index: int) -> Column:
    """1-based ``split_part`` on a literal separator: '' when the piece is absent."""
    return F.split_part(_c(c), F.lit(sep), F.lit(index))


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
