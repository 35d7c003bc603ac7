"""Scalar column functions.

All are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pay-period multipliers that turn an amount into a yearly
# figure (year x1, hour x2000, week x50, day x260, month x12); a piece rate
# has no yearly equivalent. Any other or missing period keeps the raw amount.
PAY_PERIOD_MULTIPLIERS = {"year": 1, "hour": 2000, "week": 50, "day": 260, "month": 12}
PIECE_PERIOD = "piece"

# Salary buckets are 10,000 wide; everything above 200,000 is
# reported as one 210,000 bucket.
SALARY_BUCKET_WIDTH = 10000
SALARY_BUCKET_CAP = 200000
SALARY_BUCKET_TOP = 210000

NULL_LABEL = "<NULL>"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: str | Column) -> Column:
    """``UPPER(TRIM(x))`` (trims spaces only)."""
    return F.upper(F.trim(col(c)))


def lower_trim(c: str | Column) -> Column:
    """X2."""
    return F.lower(F.trim(col(c)))


def null_if_any(c: str | Column, sentinels: list[str]) -> Column:
    """Nested ``NULLIF`` over a list of sentinel values."""
    out = col(c)
    for s in sentinels:
        out = F.nullif(out, F.lit(s))
    return out


def recode(c: str | Column, mapping: Mapping[str, str], key: Column | None = None,
           default: Column | None = None) -> Column:
    """Searched ``CASE`` recode; ``key`` is the expression tested
    (defaults to the column), ``default`` what unmatched values become
    (defaults to the column itself; pass ``F.lit(None)`` for NULL)."""
    base = col(c)
    test = base if key is None else key
    out = None
    for k, v in mapping.items():
        out = (F.when(test == F.lit(k), F.lit(v)) if out is None
               else out.when(test == F.lit(k), F.lit(v)))
    fallback = base if default is None else default
    return fallback if out is None else out.otherwise(fallback)


def map_lookup(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Dictionary lookup through a literal map; unmatched -> NULL."""
    if not mapping:
        return F.lit(None).cast("string")
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.try_element_at(m, col(c))


def annual_salary(amount: str | Column, period: str | Column, piece_is_null: bool = True) -> Column:
    """Amount per pay period -> yearly amount.

    The period is lower-cased but not trimmed. ``piece`` gives NULL unless
    ``piece_is_null=False`` (the outlier variant), in which case it falls
    through to the raw amount like any unknown period.
    """
    a, p = col(amount), F.lower(col(period))
    out = None
    for name, mult in PAY_PERIOD_MULTIPLIERS.items():
        val = a if mult == 1 else a * F.lit(mult)
        out = F.when(p == name, val) if out is None else out.when(p == name, val)
    if piece_is_null:
        out = out.when(p == PIECE_PERIOD, F.lit(None).cast("double"))
    return out.otherwise(a)


def salary_bucket(yearly: str | Column) -> Column:
    """X11: > 200000 -> 210000, else floor to the 10000 below (bigint)."""
    y = col(yearly)
    return (F.when(y > SALARY_BUCKET_CAP, F.lit(SALARY_BUCKET_TOP).cast("bigint"))
            .otherwise(F.floor(y / SALARY_BUCKET_WIDTH) * SALARY_BUCKET_WIDTH))


def drop_suffix(c: str | Column, n: int = 4) -> Column:
    """Drop the trailing ``n`` characters (", ST"); '' when shorter."""
    x = col(c)
    return x.substr(F.lit(1), F.length(x) - F.lit(n))


def left(c: str | Column, n: int) -> Column:
    """``LEFT(code, n)``."""
    return F.substring(col(c), 1, n)


def split_list(c: str | Column, sep: str = ", ") -> Column:
    """Split a list encoded as text and trim each element ('' kept)."""
    # A one-argument lambda: ``transform`` passes the element index as a
    # second argument to functions that accept two (``F.trim`` does: the
    # characters to trim).
    return F.transform(F.split(col(c), re.escape(sep)), lambda x: F.trim(x))


def month_start(c: str | Column) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(col(c), "MM")


def date_lit(d: str | _dt.date) -> Column:
    """A DATE literal."""
    return F.to_date(F.lit(str(d)))


def ts_lit(d: str | _dt.date) -> Column:
    """A TIMESTAMP_NTZ literal for comparing timestamp columns, folded to a
    constant so the comparison reaches the parquet scan."""
    return F.to_timestamp_ntz(F.lit(str(d)))


def safe_div(n: str | Column, d: str | Column) -> Column:
    """NULL when the divisor is 0 or NULL (``n / NULLIF(d, 0)``)."""
    return F.try_divide(col(n).cast("double"), F.nullif(col(d), F.lit(0)))


def frac_or_zero(n: str | Column, d: str | Column) -> Column:
    """``CASE WHEN d > 0 THEN COALESCE(n, 0) / d ELSE 0 END``."""
    num = F.coalesce(col(n), F.lit(0)).cast("double")
    return F.when(col(d) > 0, num / col(d)).otherwise(F.lit(0.0))


def half_up(c: str | Column, scale: int) -> Column:
    """SQL ``ROUND`` (half away from zero)."""
    return F.round(col(c), scale)


def pct_round(n: str | Column, d: str | Column, scale: int = 0) -> Column:
    """``ROUND(n / d * 100, scale)`` computed as a rounding of the scaled
    ratio ``n * 100 * 10^scale / d`` to an integer, so exact decimal ties
    (x.5) are rounded away from zero however the ratio is stored; equals the
    exact decimal result of the warehouse. NULL when ``d`` is 0."""
    f = 100 * 10 ** scale
    return F.round(F.try_divide(col(n).cast("double") * f, col(d)), 0) / (10 ** scale)


def pct_round_even(n: str | Column, d: str | Column, scale: int = 0) -> Column:
    """``round(n / d * 100, scale)`` as pandas does it (half to even),
    computed on the scaled ratio like ``pct_round``; NULL when ``d`` is 0."""
    f = 100 * 10 ** scale
    return F.bround(F.try_divide(col(n).cast("double") * f, col(d)), 0) / (10 ** scale)


def half_even(c: str | Column, scale: int = 0) -> Column:
    """Python / pandas rounding (half to even)."""
    return F.bround(col(c), scale)


def to_number(c: str | Column, type_: str = "double") -> Column:
    """Text -> number, unparsable -> NULL."""
    return col(c).try_cast(type_)


def null_label(c: str | Column, label: str = NULL_LABEL) -> Column:
    """NULL -> a visible label."""
    return F.coalesce(col(c).cast("string"), F.lit(label))


def title_case(c: str | Column) -> Column:
    """``initcap`` (capitalises after whitespace only)."""
    return F.initcap(col(c))


def not_like_any(value: Column, patterns: list[str], fold: str = "upper") -> Column:
    """Value matches none of the ``LIKE`` patterns. With
    ``fold='upper'`` both sides are upper-cased (the patterns as written);
    NULL values yield NULL, i.e. the row is dropped by a filter."""
    out = F.lit(True)
    for p in patterns:
        pat = p.upper() if fold == "upper" else p
        out = out & ~value.like(pat)
    return out


def not_ilike_any(value: Column, patterns: list[str]) -> Column:
    """C4: case-insensitive ``NOT ILIKE`` over a list of patterns."""
    out = F.lit(True)
    for p in patterns:
        out = out & ~value.ilike(p)
    return out
