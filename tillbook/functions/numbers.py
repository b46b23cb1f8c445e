"""Number helpers with the rounding rules of the reported figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillbook.operators.core import col


def rnd(c, digits: int = 0) -> Column:
    """Half-even rounding of the 8-digit decimal value (binary noise decides no tie)."""
    return F.bround(col(c).cast("decimal(30,8)"), digits).cast("double")


def rnd_int(c) -> Column:
    """Half-even to a whole number, null as 0."""
    return F.coalesce(F.rint(col(c).cast("double")).cast("bigint"), F.lit(0).cast("bigint"))


def trunc_int(c) -> Column:
    """Towards zero, null as 0."""
    return F.coalesce(col(c).cast("bigint"), F.lit(0).cast("bigint"))


def ratio(num, den) -> Column:
    """num / den as double, null when the denominator is 0."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def pct(now, base, digits: int = 2) -> Column:
    """Change of ``now`` against ``base`` in percent."""
    return rnd(ratio(col(now) - col(base), base) * 100, digits)
