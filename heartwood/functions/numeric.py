"""Rounding, clipping and counting expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clip_score(value: Column) -> Column:
    """Limit to 0..100. A missing value becomes 100, as ``least`` skips NULL."""
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), value))


def np_round(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rule numpy and pandas use."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def py_round(value: Column, digits: int) -> Column:
    """Round the exact binary value half to even: the rule of a plain Python float.

    It differs from :func:`np_round` only where the scaled product lands on a half
    that the exact product misses; the product's rounding error (Dekker) tells on
    which side it was.
    """
    scale = float(10**digits)
    scaled = value * scale
    split = value * 134217729.0
    high = split - (split - value)
    error = (high * scale - scaled) + (value - high) * scale
    on_half = scaled - F.floor(scaled) == 0.5
    return (
        F.when(on_half & (error > 0), F.ceil(scaled).cast("double"))
        .when(on_half & (error < 0), F.floor(scaled).cast("double"))
        .otherwise(F.rint(scaled))
        / scale
    )


def sql_average(total: Column, rows: Column, digits: int) -> Column:
    """``ROUND(AVG(x), digits)`` over decimals: exact, halves away from zero.

    ``total`` is a decimal sum of at most two fraction digits, ``rows`` the number
    of non-NULL values in it; no rows give NULL.
    """
    quotient = F.try_divide(total.cast("decimal(20,2)"), rows.cast("decimal(18,0)"))
    return F.round(quotient, digits).cast("double")


def whole_number_text(value: Column) -> Column:
    """The text of a score without fraction digits, halves to even."""
    return F.rint(value).cast("bigint").cast("string")


def count_where(predicate: Column) -> Column:
    """Rows where the predicate holds; NULL does not count. BIGINT, 0 if none."""
    return F.count(F.when(predicate, F.lit(1)))


def view_rows(view: DataFrame) -> Column:
    """How many rows of a view each of its rows stands for: 1 unless it says so."""
    return F.col("view_rows") if "view_rows" in view.columns else F.lit(1).cast("bigint")


def weighted_count(weight: Column, predicate: Column | None = None) -> Column:
    """Sum of the weights where the predicate holds. BIGINT, 0 if there are none."""
    counted = weight if predicate is None else F.when(predicate, weight)
    return F.coalesce(F.sum(counted), F.lit(0))
