"""Exact money arithmetic.

Money is carried as integer cents (``bigint``) from the first step and only
turned into ``decimal(p,2)`` in the last projection.  Rounding of averages
and ratios is done on integers (half away from zero), so the result does not
depend on an engine's decimal scale rules or on binary floating point.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cents(x: Column | str) -> Column:
    """Double or decimal amount -> bigint cents, rounded half away from zero."""
    return F.round(_c(x) * 100).cast("bigint")


def cents_to_decimal(c: Column | str, precision: int = 18) -> Column:
    return (_c(c).cast("decimal(38,0)") / F.lit(100)).cast(f"decimal({precision},2)")


def money(x: Column | str, precision: int = 18) -> Column:
    """Amount rounded to cents as ``decimal(precision,2)``."""
    return cents_to_decimal(cents(x), precision)


def int_div(a: Column | str, b: Column | str, guarded: bool = True) -> Column:
    """Integral division (SQL ``div``), exact.  When ``b`` is 0: null if
    ``guarded`` (the reference's CASE guard), else an error."""
    n, d = _c(a).cast("bigint"), _c(b).cast("bigint")
    return F.call_function("div", n, F.nullif(d, F.lit(0)) if guarded else d)


def div_round(num: Column | str, den: Column | str, guarded: bool = True) -> Column:
    """``round(num / den)`` on integers, half away from zero, for ``den > 0``;
    null when ``den`` is null, and when it is 0 as in ``int_div``."""
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    mag = int_div(F.abs(n) * 2 + d, d * 2, guarded)
    return F.when(n < 0, -mag).otherwise(mag)


def typed(x: Column | str, type_: str, lenient: bool = False) -> Column:
    """A text as a number: a text that is none is an error, or null if
    ``lenient``."""
    return _c(x).try_cast(type_) if lenient else _c(x).cast(type_)


def avg_cents(sum_cents: Column | str, n: Column | str) -> Column:
    """Average of cents rounded to whole cents."""
    return div_round(sum_cents, n)
