"""Gold: the eight aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.functions.wideint import wide_sum
from chainlake.operators.dedup import latest
from chainlake.schema import AGGREGATION_VERSION

TOP_POOLS, RECENT = 50, 100
VARIABLE, STABLE = 2, 1
_PROVENANCE = ["producer_version", "schema_version", "bronze_processed_at", "bronze_file", "silver_processed_at", "silver_job_version"]


def _last(names: list[str]) -> list[Column]:
    return [F.max(n).alias(n) for n in names]


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumns({"gold_processed_at": F.current_timestamp(), "aggregation_version": F.lit(AGGREGATION_VERSION)})


def _sorted(df: DataFrame, *by: str) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in by])


def swaps_per_minute(silver: DataFrame) -> DataFrame:
    keys = [F.date_trunc("minute", "kafka_timestamp").alias("minute_ts"), "protocol", "chain"]
    metrics = [F.count("*").alias("swap_count"), F.count_distinct("pool_address").alias("unique_pools"), F.min("block_number").alias("min_block_number"), F.max("block_number").alias("max_block_number")]
    return _sorted(_stamped(silver.groupBy(*keys).agg(*metrics, *_last(_PROVENANCE))), "minute_ts", "protocol", "chain")


def top_pools(silver: DataFrame, limit: int = TOP_POOLS) -> DataFrame:
    """The pools with most swaps; ties by name."""
    metrics = [
        F.count("*").alias("swap_count"), F.min("block_number").alias("first_block_seen"), F.max("block_number").alias("latest_block_seen"),
        F.min("kafka_timestamp").alias("first_seen_at"), F.max("kafka_timestamp").alias("latest_seen_at"),
    ]
    found = silver.groupBy("protocol", "chain", "pool_address").agg(*metrics, *_last(_PROVENANCE))
    return _stamped(found).orderBy(F.desc("swap_count"), "protocol", "chain", "pool_address").limit(limit)


def pipeline_summary(silver: DataFrame) -> DataFrame:
    metrics = [
        F.count("*").alias("total_swaps"), F.count_distinct("transaction_hash").alias("unique_transactions"), F.count_distinct("pool_address").alias("unique_pools"),
        F.min("block_number").alias("min_block_number"), F.max("block_number").alias("latest_block_number"),
        F.min("kafka_timestamp").alias("first_event_time"), F.max("kafka_timestamp").alias("latest_event_time"),
        F.min("ingested_at").alias("first_ingested_at"), F.max("ingested_at").alias("latest_ingested_at"),
    ]
    return _sorted(_stamped(silver.groupBy("protocol", "chain").agg(*metrics, *_last(_PROVENANCE))), "protocol", "chain")


def recent_swaps(silver: DataFrame, limit: int = RECENT) -> DataFrame:
    """The latest swaps; ties by event."""
    columns = [
        "event_id", "protocol", "chain", "event_type", "block_number", "transaction_hash", "pool_address", "log_index", "kafka_timestamp",
        "producer_version", "schema_version", "ingested_at", "bronze_processed_at", "bronze_file", "silver_processed_at", "silver_job_version",
    ]
    return _stamped(silver.select(*columns)).orderBy(F.desc_nulls_last("kafka_timestamp"), F.desc_nulls_last("block_number"), "event_id").limit(limit)


def lending_events(silver: DataFrame) -> DataFrame:
    """Lending events, the latest version of each, with event_date the UTC day of the block."""
    rows = latest(silver.where("protocol = 'aave_v3'"), ["protocol", "chain", "transaction_hash", "log_index"], ["kafka_timestamp", "ingested_at", "silver_processed_at", "bronze_file"])
    return rows.withColumn("event_date", F.to_date("block_timestamp"))


_DAY = ["event_date", "protocol", "chain"]
_M7 = [c for c in _PROVENANCE if c != "bronze_file"]


def _daily(events: DataFrame, grain: list[str], metrics: list[Column], names: list[Column | str] | None = None) -> DataFrame:
    found = events.groupBy(*_DAY, *(names or grain)).agg(*metrics, *_last(_M7))
    return _sorted(_stamped(found), *_DAY, *grain)


def daily_borrow_activity(borrows: DataFrame) -> DataFrame:
    metrics = [
        F.count("*").alias("borrow_event_count"), F.count_distinct("user").alias("unique_borrowers"), wide_sum("amount_raw").alias("total_borrow_amount_raw"),
        F.count_if(F.col("interest_rate_mode") == VARIABLE).alias("variable_rate_borrow_count"), F.count_if(F.col("interest_rate_mode") == STABLE).alias("stable_rate_borrow_count"),
    ]
    return _daily(borrows, ["reserve_address"], metrics, [F.col("reserve").alias("reserve_address")])


def daily_repayment_activity(repayments: DataFrame) -> DataFrame:
    metrics = [
        F.count("*").alias("repay_event_count"), F.count_distinct("user").alias("unique_borrowers_repaid"), F.count_distinct("repayer").alias("unique_repayers"),
        wide_sum("amount_raw").alias("total_repaid_amount_raw"), F.count_if("use_atokens").alias("atoken_repay_count"),
    ]
    return _daily(repayments, ["reserve_address"], metrics, [F.col("reserve").alias("reserve_address")])


def daily_liquidation_activity(liquidations: DataFrame) -> DataFrame:
    metrics = [
        F.count("*").alias("liquidation_count"), F.count_distinct("user").alias("unique_liquidated_users"), F.count_distinct("liquidator").alias("unique_liquidators"),
        wide_sum("debt_to_cover_raw").alias("total_debt_covered_raw"), wide_sum("liquidated_collateral_amount_raw").alias("total_collateral_liquidated_raw"),
        F.count_if("receive_atoken").alias("receive_atoken_count"),
    ]
    return _daily(liquidations, ["collateral_asset", "debt_asset"], metrics)


SUMMARY = ["borrow_event_count", "repay_event_count", "liquidation_count", "unique_borrowers", "unique_repayers", "unique_liquidated_users", "unique_liquidators"]


def daily_lending_summary(borrows: DataFrame, repayments: DataFrame, liquidations: DataFrame) -> DataFrame:
    """Counts of the three event types by day. Each is aggregated to its days first, so the union and its sum are small; distinct users are
    those of the day, not sums over reserves."""
    parts = [
        borrows.groupBy(*_DAY).agg(F.count("*").alias("borrow_event_count"), F.count_distinct("user").alias("unique_borrowers"), *_last(_M7)),
        repayments.groupBy(*_DAY).agg(F.count("*").alias("repay_event_count"), F.count_distinct("repayer").alias("unique_repayers"), *_last(_M7)),
        liquidations.groupBy(*_DAY).agg(F.count("*").alias("liquidation_count"), F.count_distinct("user").alias("unique_liquidated_users"), F.count_distinct("liquidator").alias("unique_liquidators"), *_last(_M7)),
    ]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).na.fill(0, SUMMARY)
    return _sorted(_stamped(both.groupBy(*_DAY).agg(*[F.sum(c).alias(c) for c in SUMMARY], *_last(_M7))), *_DAY)
