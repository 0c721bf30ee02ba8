"""Silver: normalised events, one row for each, the latest version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake.functions.columns import compatible, event_id, payload_field
from chainlake.operators.dedup import latest
from chainlake.schema import EVENT_KEY, LENDING_COMMON, PAYLOAD, SILVER_JOB_VERSION, SWAP_SILVER

_RUN = ["silver_processed_at", "silver_job_version"]
_NEWEST = ["kafka_timestamp", "ingested_at"]
_REQUIRED = ["protocol", "chain", "event_date", "transaction_hash", "pool_address", "block_number", "log_index"]


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumns({"silver_processed_at": F.current_timestamp(), "silver_job_version": F.lit(SILVER_JOB_VERSION)})


def swaps(bronze: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Swaps of Bronze files with all required fields, merged into the existing table. Ties of time go to the row that is there, then by file."""
    new = compatible(bronze, SWAP_SILVER).where("event_type = 'swap'").dropna(subset=_REQUIRED)
    new = _stamped(new).withColumn("__old", F.lit(0))
    if existing is not None:
        new = compatible(existing, [*SWAP_SILVER, *_RUN]).withColumn("__old", F.lit(1)).unionByName(new)
    return latest(new, EVENT_KEY, [*_NEWEST, "__old", "bronze_file"]).select(event_id().alias("event_id"), *SWAP_SILVER, *_RUN)


@dataclass(frozen=True)
class LendingModel:
    """A dataset of one event type: its payload fields, with types from the payload's schema."""

    event_type: str
    fields: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{self.event_type}_events"


MODELS = (
    LendingModel("borrow", ("reserve", "user", "on_behalf_of", "amount_raw", "interest_rate_mode", "borrow_rate_raw", "referral_code")),
    LendingModel("repay", ("reserve", "user", "repayer", "amount_raw", "use_atokens")),
    LendingModel("liquidation", ("collateral_asset", "debt_asset", "user", "debt_to_cover_raw", "liquidated_collateral_amount_raw", "liquidator", "receive_atoken")),
)
_RAW = ("contract_address", "raw_data", "raw_topics")


def lending(bronze: DataFrame, model: LendingModel) -> DataFrame:
    """One lending dataset. The filters reach the partition columns, and only the payload fields in use are read."""
    rows = bronze.where((F.col("protocol") == "aave_v3") & (F.col("event_type") == model.event_type))
    types: dict[str, T.DataType] = {f.name: f.dataType for f in PAYLOAD.fields}
    flat = rows.select(*LENDING_COMMON, *[payload_field(bronze, f, types[f]) for f in (*_RAW, *model.fields)])
    out = latest(flat, EVENT_KEY, [*_NEWEST, "bronze_file"])
    return _stamped(out.select(event_id().alias("event_id"), *flat.columns)).sortWithinPartitions("block_number", "log_index")
