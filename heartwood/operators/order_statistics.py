"""Exact quantiles of a column through a histogram of its distinct values.

The histogram has a row per distinct value, with how many rows have it and how many a smaller one.
Ranks are read off it, so rows are counted once, before anything is moved, and neither sorted nor
gathered; only distinct values are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, column: str) -> DataFrame:
    """Rows (value, rows, below, total): every distinct value that is not NULL, its rows, the rows
    with a smaller value and all rows."""
    counted = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    smaller = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumns(
        {
            "below": F.coalesce(F.sum("rows").over(smaller), F.lit(0)),
            "total": F.sum("rows").over(Window.partitionBy()),
        }
    )


def quantiles(ranked: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """One row: an array of the quantiles of a :func:`histogram`, NULLs if it is empty.

    A quantile between two ranks is interpolated between their values.
    """
    values, picked = {}, []
    for k, p in enumerate(probabilities):
        place = F.col("total").cast("double") * p - p
        for end, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            # the value that covers a rank is the largest with no more rows below it
            values[f"{end}{k}"] = F.max(F.when(F.col("below") <= rank, F.col("value")))
        values[f"place{k}"] = F.max(place)
        low, high, at = F.col(f"low{k}"), F.col(f"high{k}"), F.col(f"place{k}")
        between = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
        picked.append(F.when(low == high, low.cast("double")).otherwise(between))
    row = ranked.agg(*[value.alias(name) for name, value in values.items()])
    return row.select(F.array(*picked).alias("quantiles"))
