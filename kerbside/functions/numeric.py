"""Order-independent sums.

A double ``sum`` depends on the order rows meet, so two runs of the same job
(or two engines) can differ in the last bits.  Summing through a decimal with
nine places is exact for every reading given to a billionth, hence identical
however Spark splits and merges partials.  Groups that hold a NaN, an infinite
or a huge value (1e15 and beyond) fall back to the plain double sum, so such values
show in the result.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.functions.temporal import _col

DEFAULT_SCALE = 9
_EXACT_BELOW = 1e15


def exact_sum(c: Column | str, scale: int = DEFAULT_SCALE) -> Column:
    """Sum of the non-NULL values as double; NULL when there are none."""
    value = _col(c).cast("double")
    plain = ~F.isnan(value) & (F.abs(value) < _EXACT_BELOW)
    odd = F.count_if(value.isNotNull() & ~plain)
    exact = F.sum(F.when(plain, value).cast(f"decimal(28,{scale})")).cast("double")
    return F.when(odd > 0, F.sum(value)).otherwise(exact)


def exact_avg(c: Column | str, scale: int = DEFAULT_SCALE) -> Column:
    """Average of non-NULL values = exact sum / count; NULL when none."""
    return F.try_divide(exact_sum(c, scale), F.count(_col(c)))
