"""The data model: schemas, column contracts and versions. Fixed values of the model are stated plainly."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "binary": T.BinaryType(), "array<string>": T.ArrayType(T.StringType())}


def struct(text: str) -> T.StructType:
    """A flat schema from "name type, ..."; needs no session, as importing this module must not."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (f.split() for f in text.split(", "))])


PRODUCER_VERSION = SCHEMA_VERSION = SILVER_JOB_VERSION = AGGREGATION_VERSION = "1.0.0"

#: A raw EVM log as JSON-RPC gives it.
RAW_LOG = struct("address string, topics array<string>, data string, blockNumber string, transactionHash string, transactionIndex string, blockHash string, logIndex string, removed boolean")

#: A block's time, for enrichment.
BLOCKS = struct("block_number int, block_timestamp timestamp")

#: All payload fields of all event types; an event fills its own.
PAYLOAD = struct(
    "pool_address string, sender string, recipient string, owner string, tick_lower int, tick_upper int, amount string, amount0 string, "
    "amount1 string, sqrt_price_x96 string, liquidity string, tick int, raw_data string, raw_topics array<string>, contract_address string, "
    "reserve string, user string, on_behalf_of string, amount_raw string, interest_rate_mode int, borrow_rate_raw string, referral_code int, "
    "repayer string, use_atokens boolean, collateral_asset string, debt_asset string, debt_to_cover_raw string, "
    "liquidated_collateral_amount_raw string, liquidator string, receive_atoken boolean"
)

ENVELOPE = T.StructType(
    [
        *struct(
            "protocol string, chain string, event_type string, block_number int, transaction_hash string, log_index int, block_timestamp timestamp, "
            "producer_version string, schema_version string, ingested_at timestamp"
        ).fields,
        T.StructField("payload", PAYLOAD),
    ]
)

#: A record as the Kafka source gives it.
KAFKA = struct("key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int")

BRONZE_PARTITIONS = ["protocol", "chain", "event_type", "event_date"]

SWAP_SILVER = [
    "protocol", "chain", "event_date", "event_type", "block_number", "transaction_hash", "pool_address", "log_index", "raw_data", "raw_topics",
    "kafka_timestamp", "producer_version", "schema_version", "ingested_at", "bronze_processed_at", "bronze_file",
]

LENDING_COMMON = [
    "protocol", "chain", "event_date", "event_type", "block_timestamp", "transaction_hash", "block_number", "log_index", "kafka_timestamp",
    "ingested_at", "producer_version", "schema_version", "bronze_processed_at", "bronze_file",
]

#: What older files lack, and what stands for it: a literal, or another column.
LEGACY = {
    "producer_version": ("literal", "legacy"),
    "schema_version": ("literal", "legacy"),
    "bronze_file": ("literal", "legacy"),
    "silver_job_version": ("literal", "legacy"),
    "bronze_processed_at": ("column", "ingested_at"),
    "silver_processed_at": ("column", "ingested_at"),
}

EVENT_KEY = ["chain", "transaction_hash", "log_index"]
