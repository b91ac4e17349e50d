"""Rounded ratios with exact integer arithmetic.

``round(a / b * mult, digits)`` with half away from zero, computed on
integers so that every engine gives the same value: the quotient is formed
as ``sign(n) * ((|n| * 2 + b) div (2 * b))`` with ``n = a * mult * 10^digits``
and only the final scaling to a double divides by a power of ten.
Null when ``b`` is null or zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rounded_ratio(a, b, mult: int = 1, digits: int = 2) -> Column:
    a, b = _c(a).cast("bigint"), _c(b).cast("bigint")
    scale = 10 ** digits
    n = a * (mult * scale)
    b2 = F.when(b != 0, b)
    m = F.abs(n) * 2 + b2
    d = b2 * 2
    q = F.signum(n).cast("bigint") * ((m - m % d) / d).cast("bigint")   # exact integer division
    return (q / F.lit(float(scale))).cast("double")


def pct(a, b) -> Column:
    return rounded_ratio(a, b, 100, 2)


def avg2(a, b) -> Column:
    return rounded_ratio(a, b, 1, 2)
