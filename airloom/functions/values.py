"""Value rules: sentinels, floor, averages and rounded percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airloom.options import QualityRules


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_sentinel(c: str | Column, rules: QualityRules) -> Column:
    """True when the value equals a sentinel (numeric equality); null stays null."""
    return _col(c).isin(*[float(v) for v in rules.sentinels])


def is_below_floor(c: str | Column, rules: QualityRules) -> Column:
    """True when the value fails the floor: below it, null or NaN.

    Spark orders NaN above every number, so ``NaN >= 0`` is true; NaN is
    therefore tested explicitly.
    """
    v = _col(c)
    return F.coalesce(~((v >= F.lit(float(rules.min_valid))) & ~F.isnan(v)), F.lit(True))


def is_valid_value(c: str | Column, rules: QualityRules) -> Column:
    """Neither a sentinel nor below the floor (null and NaN are invalid)."""
    return ~is_below_floor(c, rules) & ~F.coalesce(is_sentinel(c, rules), F.lit(False))


def exact_avg(c: str | Column) -> Column:
    """Average whose value does not depend on summation order.

    Every group is summed as DECIMAL(38,8) and divided once as DOUBLE:
    exact for values of up to eight decimals. A value or sum beyond 30
    digits before the point fails the job.
    """
    v = _col(c)
    dec = v.try_cast("decimal(38,8)")
    total = F.try_sum(dec)
    unfit = (F.count_if(v.isNotNull() & dec.isNull()) > 0) | (total.isNull() & (F.count(v) > 0))
    return F.when(
        unfit, F.raise_error(F.lit("a value or sum does not fit DECIMAL(38,8)")).cast("double")
    ).otherwise(total.cast("double") / F.nullif(F.count(v), F.lit(0)))


def rounded_pct(numerator: Column, denominator: Column, digits: int = 1) -> Column:
    """``ROUND(100.0 * num / NULLIF(den, 0), digits)`` as DOUBLE."""
    return F.round(F.lit(100.0) * numerator / F.nullif(denominator, F.lit(0)), digits)
