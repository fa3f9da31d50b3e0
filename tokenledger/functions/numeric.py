"""Money, ratio and NULL-aware numeric helpers (all JVM-side expressions).

Conventions (kept identical in the DuckDB oracle texts):

* money is ``DECIMAL(28,9)``; every money operation re-rounds to 9 decimals,
  the way a fixed-scale NUMERIC warehouse type behaves;
* rates are ``DECIMAL(10,6)``, discounts ``DECIMAL(5,4)``, token counts BIGINT;
* ratios are DOUBLE quotients of the operands converted to DOUBLE; a zero
  or NULL denominator gives NULL (SAFE_DIVIDE semantics; plain ``/`` raises
  under ANSI mode);
* ``strict_greatest`` is NULL when any argument is NULL (Spark's
  ``greatest`` skips NULLs).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(28, 9)
RATE = DecimalType(10, 6)
DISCOUNT = DecimalType(5, 4)
PCT = DecimalType(5, 4)
_SUM6 = DecimalType(28, 6)
_OUT6 = DecimalType(38, 6)  # wide enough for any sum of tokens or money


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(expr) -> Column:
    """Round an exact decimal expression to the money type."""
    return F.round(col_(expr), 9).cast(MONEY)


def per_million(expr) -> Column:
    """``expr / 1e6`` on an exact token x rate sum, rounded to money."""
    return money(col_(expr).cast(_SUM6) * F.lit("0.000001").cast(DecimalType(7, 6)))


def discounted(amount, discount) -> Column:
    """``amount * (1 - discount)`` rounded to money."""
    return money(col_(amount).cast(MONEY) * (F.lit(1) - col_(discount)).cast(DISCOUNT))


def as_double(expr) -> Column:
    """Decimal -> DOUBLE through a 6-decimal exact value (same bits in every engine)."""
    return F.round(col_(expr), 6).cast(_OUT6).cast("double")


def ratio(num, den, num_is_money: bool = False, den_is_money: bool = False) -> Column:
    """SAFE_DIVIDE as DOUBLE; NULL on a zero or NULL denominator.

    Operands are converted straight to DOUBLE (correctly rounded), so shares
    used as multipliers keep full precision and sum to 1 within 1e-15."""
    n = col_(num).cast("double")
    d = col_(den).cast("double")
    return F.when(d != 0, n / d)


def strict_greatest(*cols) -> Column:
    """GREATEST that is NULL if any argument is NULL."""
    cs = [col_(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.greatest(*cs))


def money_times_ratio(amount, share) -> Column:
    """Money x DOUBLE share, re-rounded to money (the share is a ratio)."""
    return F.round(col_(amount).cast("double") * col_(share), 9).cast(MONEY)
