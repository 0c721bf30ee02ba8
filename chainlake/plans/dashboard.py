"""What a dashboard shows of Gold, as pandas frames; the tables are bounded by their limits or their grain's reading window."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.plans.pipeline import Lake
from chainlake.sources.files import table

if TYPE_CHECKING:
    import pandas as pd

KPIS = ["total_swaps", "unique_transactions", "unique_pools", "latest_block_number"]


def read(spark: SparkSession, path: str) -> DataFrame:
    """A Gold table; what a panel shows of it is bounded by the panel."""
    found = table(spark, path)
    if found is None:
        raise FileNotFoundError(f"no Gold at {path}; run the Gold job first")
    return found


def kpis(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """The summary's figures over all protocols and chains' first row."""
    row = read(spark, lake.gold("pipeline_summary")).orderBy("protocol", "chain").select(*KPIS).first()
    return row.asDict() if row else {}


def swaps_over_time(spark: SparkSession, lake: Lake, minutes: int = 1440) -> pd.DataFrame:
    """Swaps by minute, the last `minutes` of them."""
    found = read(spark, lake.gold("swaps_per_minute")).groupBy("minute_ts").agg(F.sum("swap_count").alias("swap_count"))
    return found.orderBy(F.desc("minute_ts")).limit(minutes).orderBy("minute_ts").toPandas()


def top_pools(spark: SparkSession, lake: Lake, rows: int = 10) -> pd.DataFrame:
    """The first rows of the ranking."""
    return read(spark, lake.gold("top_pools")).orderBy(F.desc("swap_count"), "protocol", "chain", "pool_address").limit(rows).toPandas()


def recent_swaps(spark: SparkSession, lake: Lake, rows: int = 100) -> pd.DataFrame:
    """The latest swaps, latest first."""
    return read(spark, lake.gold("recent_swaps")).orderBy(F.desc_nulls_last("kafka_timestamp"), F.desc_nulls_last("block_number"), "event_id").limit(rows).toPandas()
