"""Latest row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], newest: list[str | Column]) -> DataFrame:
    """One row for each key, the greatest by `newest`, nulls last. The planner cuts every task's rows to the first of each
    key before the shuffle, so many versions of one key cost one row a task."""
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in newest]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
