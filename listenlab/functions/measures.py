"""Measure builders shared by every mart and report.

Two semantic rules live here:

* Division never raises and never turns decimal: ``ratio`` casts the
  numerator to double and uses ``try_divide`` (NULL when the denominator is
  0 or NULL). A decimal literal such as ``* 1.0`` would make Spark compute
  in DECIMAL(38, x); ANSI mode would raise on ``x / 0``.
* Conditional counts keep SQL's three-valued logic: a NULL predicate is not
  counted (``count_if``), and a conditional sum over no rows is NULL.
* Display rounding works on the binary value like the original engines:
  ``sql_round`` is round-half-away of ``x * 10^d`` (SQL ``round``),
  ``frame_round`` is round-half-even of ``x * 10^d`` (a data frame's
  ``round``). Spark's own ``round`` rounds the shortest decimal string and
  differs from both on exact ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cnt() -> Column:
    """``count(*)``."""
    return F.count(F.lit(1))


def count_if(pred) -> Column:
    """``count(*) FILTER (WHERE pred)``: 0 on no match, NULL counts as false."""
    return F.count(F.when(_c(pred), F.lit(1)))


def sum_if(pred, value) -> Column:
    """``sum(value) FILTER (WHERE pred)``."""
    return F.sum(F.when(_c(pred), _c(value)))


def sql_round(value, digits: int) -> Column:
    """SQL ``round(x, d)``: half away from zero on ``x * 10^d``."""
    m = float(10 ** digits)
    return F.round(_c(value) * F.lit(m), 0) / F.lit(m)


def frame_round(value, digits: int) -> Column:
    """A data frame's ``round(d)``: half to even on ``x * 10^d``."""
    m = float(10 ** digits)
    return F.rint(_c(value) * F.lit(m)) / F.lit(m)


def distinct_count(df, column: str) -> Column:
    """``count(DISTINCT column)`` of ``df`` as a scalar subquery: a one-column
    scan, deduplicated map-side, instead of an ``Expand`` of every row when
    several distinct counts share one aggregate."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().agg(cnt()).scalar()


def ratio(num, den, scale: float = 1.0) -> Column:
    """``num * scale / nullif(den, 0)`` as DOUBLE; NULL on a zero denominator."""
    numerator = _c(num).cast("double")
    if scale != 1.0:
        numerator = numerator * F.lit(float(scale))
    return F.try_divide(numerator, _c(den).cast("double"))


def pct(num, den) -> Column:
    """Percentage ``num * 100 / den``."""
    return ratio(num, den, 100.0)
