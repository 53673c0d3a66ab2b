"""Scalar column functions (SCL-1..14).

All are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from decimal import Decimal, InvalidOperation

import time

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.schemas import MONEY_SQL


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_key(date_col: str | Column) -> Column:
    """SCL-1: ``yyyy-MM`` text of a date (first 7 chars of its ISO text)."""
    return F.substring(_c(date_col).cast("string"), 1, 7)


# SCL-2: the same month key in SQL-expression form.
MONTH_KEY_EXPR = "substring(CAST(sales_date AS STRING), 1, 7)"


def full_name(first: str | Column, last: str | Column) -> Column:
    """SCL-3: ``first || ' ' || last``; NULL when either part is NULL."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def fold_extras(extra_cols: list[str]) -> Column:
    """SCL-4: extra columns folded into one string, in header order.

    ``concat_ws`` skips NULLs; no extras at all gives a typed NULL.
    """
    if not extra_cols:
        return F.lit(None).cast("string")
    return F.concat_ws(", ", *[F.col(f"`{c}`").cast("string") for c in extra_cols])


def money(c: str | Column) -> Column:
    return _c(c).cast(MONEY_SQL)


def incentive(rank_one: Column, total: str | Column, rate: str = "0.01") -> Column:
    """SCL-7/8 + WIN-4: ``rate`` of the total for the top seller, else 0.

    Decimal arithmetic, rounded half-up to cents.  A NULL total at rank 1
    keeps a NULL incentive.
    """
    return F.when(rank_one, (_c(total) * F.lit(rate).cast(_rate_type(rate))).cast(MONEY_SQL)) \
        .otherwise(F.lit(0).cast(MONEY_SQL))


def _rate_type(rate: str) -> str:
    """The decimal type that holds ``rate`` exactly (checked once, here)."""
    try:
        value = Decimal(rate)
    except InvalidOperation as e:
        raise ValueError(f"rate {rate!r} is not a number") from e
    if not value.is_finite() or value < 0:
        raise ValueError(f"rate {rate!r} is not a finite, non-negative number")
    _, digits, exponent = value.as_tuple()
    scale = max(0, -exponent)
    precision = max(len(digits) + max(0, exponent), scale, 1)
    if precision > 10:
        raise ValueError(f"rate {rate!r} has more than ten digits")
    return f"decimal({precision},{scale})"


def basename(path: str | Column) -> Column:
    """SCL-9: last path segment."""
    return F.element_at(F.split(_c(path), "/"), -1)


def rewrite_prefix(path: str | Column, source_prefix: str, dest_prefix: str) -> Column:
    """SCL-10: replace a leading key prefix (literal, not a pattern)."""
    p = _c(path)
    n = len(source_prefix)
    return F.when(p.startswith(source_prefix),
                  F.concat(F.lit(dest_prefix), F.substring(p, n + 1, 1 << 30))).otherwise(p)


def run_clock() -> tuple[int, int]:
    """SCL-11/12: one run timestamp, captured once on the driver.

    Returns (epoch milliseconds truncated to whole seconds, epoch seconds).
    Used as literals so every task of a run sees the same instant, whatever
    the session time zone.
    """
    secs = int(time.time())
    return secs * 1000, secs


def run_clock_text(secs: int) -> str:
    """``%Y-%m-%d %H:%M:%S`` (UTC) text of a run instant."""
    return time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(secs))
