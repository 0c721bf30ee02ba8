"""Data-quality checks over Silver and Gold tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.sources.files import table

log = logging.getLogger(__name__)

_DAY = ["event_date", "protocol", "chain"]
_COUNTS = ["borrow_event_count", "repay_event_count", "liquidation_count"]
SILVER_REQUIRED = [
    "event_id", "protocol", "chain", "event_date", "transaction_hash", "pool_address", "block_number", "log_index",
    "producer_version", "schema_version", "ingested_at", "bronze_processed_at", "bronze_file", "silver_processed_at", "silver_job_version",
]
GOLD_REQUIRED = ["producer_version", "schema_version", "bronze_processed_at", "silver_processed_at", "silver_job_version", "gold_processed_at", "aggregation_version"]
#: Grain of each lending dataset beyond the day, and its counts.
GRAINS = {
    "daily_borrow_activity": (["reserve_address"], ["borrow_event_count"]),
    "daily_repayment_activity": (["reserve_address"], ["repay_event_count"]),
    "daily_liquidation_activity": (["collateral_asset", "debt_asset"], ["liquidation_count"]),
    "daily_lending_summary": ([], _COUNTS),
}


class DataQualityError(RuntimeError):
    """An invariant does not hold."""


def run_check(name: str, value: int | None, expected: int | None = None) -> None:
    """Raise unless value is the expected one, or positive if none is expected."""
    if value != expected if expected is not None else not value or value <= 0:
        raise DataQualityError(f"{name}: got {value}, expected {expected if expected is not None else 'more than 0'}")
    log.info("passed: %s", name)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> Column:
    """Aggregate: rows less distinct keys. Keys with nulls count as one, as a struct does."""
    return F.count("*") - F.count_distinct(F.struct(*keys) if len(keys) > 1 else F.col(keys[0]))


def nulls(columns: Sequence[str]) -> Column:
    """Aggregate: rows with a null in one of the columns."""
    return F.count_if(any_of([F.col(c).isNull() for c in columns]))


def grain_violations(df: DataFrame, grain: Sequence[str], counts: Sequence[str], protocol: str = "aave_v3") -> int:
    """Rows that repeat the grain or whose fields are missing or out of their domain."""
    bad = [F.col(c).isNull() for c in (*_DAY, *grain, "gold_processed_at", "aggregation_version")] + [F.col("protocol") != protocol] + [F.col(c) < 0 for c in counts]
    return df.agg((repeated_keys(df, [*_DAY, *grain]) + F.count_if(any_of(bad))).alias("n")).first().n


def unreconciled(activities: Sequence[DataFrame], summary: DataFrame) -> DataFrame:
    """Days on which the activities' totals and the summary differ, in either direction."""
    parts = [a.groupBy(*_DAY).agg(F.sum(c).alias(c)) for a, c in zip(activities, _COUNTS, strict=True)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).na.fill(0, _COUNTS)
    totals = both.groupBy(*_DAY).agg(*[F.sum(c).alias(c) for c in _COUNTS]).alias("t")
    joined = totals.join(summary.select(*_DAY, *_COUNTS).alias("s"), _DAY, "full_outer")
    return joined.where(any_of([~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in _COUNTS])).select(*_DAY, *[F.col(f"t.{c}").alias(f"total_{c}") for c in _COUNTS], *[F.col(f"s.{c}").alias(c) for c in _COUNTS])


def check_swaps(silver: DataFrame, summary: DataFrame) -> None:
    found = silver.agg(repeated_keys(silver, ["event_id"]).alias("repeated"), nulls(SILVER_REQUIRED).alias("nulls")).first()
    run_check("event ids of swap Silver are unique", found.repeated, 0)
    run_check("swap Silver has its required fields", found.nulls, 0)
    gold = summary.agg(nulls(GOLD_REQUIRED).alias("nulls"), F.min("total_swaps").alias("least")).first()
    run_check("Gold has its provenance", gold.nulls, 0)
    run_check("the summary has swaps", gold.least)


def check_lending(spark: SparkSession, gold_root: str) -> bool:
    """All checks of the four lending datasets; False if none is there, an error if only some are."""
    tables = {name: table(spark, f"{gold_root}/{name}") for name in GRAINS}
    missing = [name for name, t in tables.items() if t is None]
    if len(missing) == len(GRAINS):
        log.info("no lending Gold; its checks are skipped")
        return False
    if missing:
        raise DataQualityError(f"lending Gold is not complete: {', '.join(missing)}")
    for name, (grain, counts) in GRAINS.items():
        run_check(f"grain and fields of {name}", grain_violations(tables[name], grain, counts), 0)
    run_check("activities and summary agree", unreconciled([tables[n] for n in list(GRAINS)[:3]], tables["daily_lending_summary"]).count(), 0)
    return True
