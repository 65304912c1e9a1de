"""Per-key building blocks that stay even when one key owns much of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def newest_per_key(df: DataFrame, key: str, *newest_first: Column) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps at most one row per key and task before the shuffle (window group
    limit), so a key with very many rows reaches the final task already reduced.
    """
    order = W.partitionBy(key).orderBy(*newest_first)
    ranked = df.withColumn("_position", F.row_number().over(order))
    return ranked.filter(F.col("_position") == 1).drop("_position")


def left_join_many(
    left: DataFrame, right: DataFrame, key: str, left_keys: DataFrame
) -> DataFrame:
    """``left`` ⟕ ``right`` where one key may own much of ``right``.

    In an outer join Spark can split a hot key on the preserved side only. So keys
    without a partner get an all-NULL one, found from the key columns alone, and the
    join becomes an inner one whose large side can be split.

    ``left_keys`` holds the key values of ``left``; NULL keys are kept, as they would be.
    """
    partnered = right.filter(F.col(key).isNotNull())
    lonely = left_keys.select(key).distinct().join(
        partnered.select(key).distinct(), key, "left_anti"
    )
    complete = partnered.unionByName(lonely, allowMissingColumns=True)
    complete = complete.withColumnRenamed(key, "_right_key")
    matched = left.join(complete, left[key].eqNullSafe(complete["_right_key"]))
    return matched.drop("_right_key")
