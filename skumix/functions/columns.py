"""Scalar column functions: C3-C8 and small helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def concentration_ratio(volume, customers, decimals: int = 2) -> Column:
    """round(volume / unique customers, 2).

    Zero customers (every customer id null) gives null instead of the
    ANSI divide-by-zero error; such products are dropped before the
    feature vector is assembled."""
    return F.round(F.try_divide(_c(volume).cast("double"), _c(customers).cast("double")), decimals)


def smoothed_concentration(volume, customers) -> Column:
    """C4: volume / (customers + 1), unrounded (never divides by zero)."""
    return _c(volume).cast("double") / (_c(customers).cast("double") + F.lit(1.0))


def week_key(date) -> Column:
    """ISO year * 100 + ISO week, e.g. 199901.  Uses the ISO week-year so
    the last days of December can belong to week 1 of the next year."""
    d = _c(date)
    return (F.extract(F.lit("YEAROFWEEK"), d) * 100 + F.weekofyear(d)).cast("int")


def truncate_name(name, length: int = 50) -> Column:
    """First ``length`` characters."""
    return F.substring(_c(name), 1, length)


def attribute_label(key) -> Column:
    """Attribute key for display: '_' -> ' ', upper case."""
    return F.upper(F.regexp_replace(_c(key), "_", " "))


def with_default(value, default: str) -> Column:
    """Missing value -> fixed default."""
    return F.coalesce(_c(value), F.lit(default))


def nonneg_round(x, decimals: int = 6) -> Column:
    """Round and fold -0.0 into 0.0 so equal values compare equal."""
    return F.round(_c(x), decimals) + F.lit(0.0)


def half_up_mean(total, count, decimals: int) -> Column:
    """The exact mean total/count rounded half-up to ``decimals``.

    ``total`` must be an exact integer sum (scaled by 10**decimals for
    fixed-point inputs); integer arithmetic avoids double rounding of a
    float mean near a tie."""
    scale = 10 ** decimals
    t = _c(total).cast("long")
    n = _c(count).cast("long")
    num = t * (2 * scale) + n
    den = n * 2
    # exact integer quotient (inputs are non-negative), then scale down
    return ((num - num % den) / den).cast("double") / F.lit(float(scale))
