"""Null-safe column expressions shared by every operator.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ts(c) -> Column:
    """Any timestamp/date/string column as TIMESTAMP (session zone, UTC)."""
    return col_(c).cast("timestamp")


def floor_days(end, start) -> Column:
    """Whole days elapsed from ``start`` to ``end``, floored.

    22 hours before the start gives -1 and two hours across midnight give 0,
    unlike ``datediff`` which counts calendar boundaries.
    """
    diff = F.unix_micros(to_ts(end)) - F.unix_micros(to_ts(start))
    return F.floor(diff / F.lit(MICROS_PER_DAY)).cast("bigint")


def safe_div(num, den) -> Column:
    """x / 0 and NULL operands give NULL (never inf, NaN or an ANSI error)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def clip(c, lo=None, hi=None) -> Column:
    """Clamp into [lo, hi]; NULL stays NULL (greatest/least skip NULLs)."""
    out = col_(c)
    res = out
    if lo is not None:
        res = F.greatest(res, F.lit(lo) if not isinstance(lo, Column) else lo)
    if hi is not None:
        res = F.least(res, F.lit(hi) if not isinstance(hi, Column) else hi)
    return F.when(out.isNull(), F.lit(None).cast("double")).otherwise(res.cast("double"))


def safe_corr(x, y) -> Column:
    """Pearson correlation over pairwise-complete rows; NULL for a constant side.

    ``corr`` raises DIVIDE_BY_ZERO in ANSI mode on a constant column; the
    regression moments give the same value and NULL instead.
    """
    xs, ys = col_(x).cast("double"), col_(y).cast("double")
    sxy = F.regr_sxy(ys, xs)
    den = F.sqrt(F.regr_sxx(ys, xs) * F.regr_syy(ys, xs))
    return F.try_divide(sxy, F.nullif(den, F.lit(0.0)))


def total(c) -> Column:
    """Sum as DOUBLE; small and large values keep their share, NaN and infinities show."""
    return F.sum(col_(c).cast("double"))


def season(month) -> Column:
    """Wet season ``Hujan`` for months 10-3, dry ``Kemarau`` otherwise.

    A NULL month compares false on both tests and lands in ``Kemarau``.
    """
    m = col_(month)
    return F.when((m >= 10) | (m <= 3), F.lit(WET_SEASON)).otherwise(F.lit(DRY_SEASON))


# Fixed values that must equal the reference's output labels.
WET_SEASON = "Hujan"
DRY_SEASON = "Kemarau"


def ts_literal(value) -> Column:
    """A fixed point in time (the ``as_of`` clock) as a TIMESTAMP literal."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp(F.lit(str(value)))


def ts_text(c) -> Column:
    """Timestamp rendered as ``yyyy-MM-dd HH:mm:ss`` text (engine-neutral output)."""
    return F.date_format(to_ts(c), "yyyy-MM-dd HH:mm:ss")


#: Added before flooring to six decimals: a plain half, and a half with a margin.
HALF, HALF_WITH_MARGIN = 0.5, 0.50000377


def r6(c, half: float = HALF) -> Column:
    """Round half up to 6 decimals with plain IEEE double ops.

    ``floor(x * 1e6 + 0.5) / 1e6`` gives bit-identical results in any engine
    for the same input double (``round`` differs between engines: decimal
    string vs binary product). Doubles too large to have such decimals stay
    as they are. The last bits of a sum depend on the order of its rows; with
    ``HALF_WITH_MARGIN`` a ratio of sums that lies on a half to within such
    bits is rounded up for any order.
    """
    x = col_(c).cast("double")
    return F.when(F.abs(x) < F.lit(9e12), F.floor(x * F.lit(1e6) + F.lit(half)) / F.lit(1e6)).otherwise(x) + F.lit(0.0)
