"""Raw logs to event envelopes: block times joined, fields decoded, and every log sent one of three ways."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainlake.functions import abi
from chainlake.operators.plugins import Event, Field, ProtocolPlugin
from chainlake.schema import ENVELOPE, PAYLOAD, PRODUCER_VERSION, SCHEMA_VERSION

DECODED, UNSUPPORTED, MALFORMED = "decoded", "unsupported", "malformed"


def subscribed(logs: DataFrame, plugins: Sequence[ProtocolPlugin]) -> DataFrame:
    """The logs that some plugin subscribes to."""
    wanted = [s.predicate() for p in plugins for s in p.subscriptions()]
    return logs.where(reduce(Column.__or__, wanted, F.lit(False)))


def with_block_time(logs: DataFrame, blocks: DataFrame) -> DataFrame:
    """logs with block_timestamp by a left join on the block's number; blocks hold each number once. The planner broadcasts them only if
    they are small, and shuffles both sides by number otherwise."""
    times = blocks.select(F.col("block_number").cast("long").alias("__block"), F.col("block_timestamp"))
    return logs.withColumn("__block", abi.hex_long(F.col("blockNumber"))).join(times, "__block", "left").drop("__block")


def _valid(event: Event) -> Column:
    """Whether topics and data have the event's form: counts, and each word its type's."""
    shape = (F.size("topics") == event.topics) & F.col("data").rlike("^0[xX][0-9a-fA-F]*$") & (F.length("data") >= 2 + abi.WORD * event.words)
    return F.coalesce(reduce(Column.__and__, [shape, *[abi.valid(f.word(), f.kind) for f in event.fields]]), F.lit(False))


def _by_event(choices: Sequence[tuple[Event, Column]]) -> Column:
    """The choice of each log's event type; null for others."""
    out = F.lit(None)
    for event, choice in choices:
        out = F.when(abi.topic(0) == event.topic0, choice).otherwise(out)
    return out


def decode(logs: DataFrame, plugins: Sequence[ProtocolPlugin], chain: str) -> DataFrame:
    """logs with status and the envelope's columns, which are null unless the log decodes. All wide words go through Python in one Arrow
    batch, a column for each payload field, whatever the event type; everything else is JVM expressions."""
    owners = [(p, e) for p in plugins for e in p.events]
    events = [e for _, e in owners]
    numbers = abi.hex_long(F.col("blockNumber")).isNotNull() & abi.hex_long(F.col("logIndex")).isNotNull() & F.col("transactionHash").isNotNull() & F.col("address").isNotNull()
    d = logs.withColumns(
        {
            "protocol": _by_event([(e, F.lit(p.protocol)) for p, e in owners]).cast("string"),
            "event_type": _by_event([(e, F.lit(e.name)) for e in events]).cast("string"),
            "__valid": F.coalesce(_by_event([(e, _valid(e)) for e in events]).cast("boolean") & numbers, F.lit(False)),
        }
    )
    sources: dict[str, list[tuple[Event, Field]]] = {}
    for e in events:
        for f in e.fields:
            sources.setdefault(f.name, []).append((e, f))
    ok = lambda c: F.when(F.col("__valid"), c)
    values: dict[str, Column] = {"raw_data": F.col("data"), "raw_topics": F.col("topics")}
    for name in {e.address_field for e in events}:
        values[name] = _by_event([(e, F.lower("address")) for e in events if e.address_field == name])
    for name, found in sources.items():
        if found[0][1].kind in abi.WIDE:
            word, sign = _by_event([(e, f.word()) for e, f in found]), _by_event([(e, F.lit(abi.WIDE[f.kind])) for e, f in found])
            values[name] = abi.wide_int(ok(word).cast("string"), F.coalesce(sign.cast("boolean"), F.lit(False)))
        else:
            values[name] = _by_event([(e, abi.value(f.word(), f.kind)) for e, f in found])
    payload = F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PAYLOAD.fields])
    time = F.col("block_timestamp") if "block_timestamp" in logs.columns else F.lit(None).cast("timestamp")
    return d.select(
        *[F.col(c) for c in logs.columns if c not in ENVELOPE.fieldNames()],
        F.when(F.col("event_type").isNull(), UNSUPPORTED).when(F.col("__valid"), DECODED).otherwise(MALFORMED).alias("status"),
        "protocol",
        F.lit(chain).alias("chain"),
        "event_type",
        ok(abi.hex_long(F.col("blockNumber")).try_cast("int")).alias("block_number"),
        ok(F.lower("transactionHash")).alias("transaction_hash"),
        ok(abi.hex_long(F.col("logIndex")).try_cast("int")).alias("log_index"),
        time.alias("block_timestamp"),
        F.lit(PRODUCER_VERSION).alias("producer_version"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.current_timestamp().alias("ingested_at"),
        ok(payload).alias("payload"),
    )


def routes(decoded: DataFrame) -> dict[str, DataFrame]:
    """The decoded, unsupported and malformed logs."""
    return {s: decoded.where(F.col("status") == s) for s in (DECODED, UNSUPPORTED, MALFORMED)}


def envelopes(decoded: DataFrame) -> DataFrame:
    """The decoded logs' envelopes alone."""
    return decoded.where(F.col("status") == DECODED).select(*ENVELOPE.fieldNames())


def progress(decoded: DataFrame) -> DataFrame:
    """Counts by event type and route."""
    return decoded.groupBy("event_type", "status").count()


def parse_swap_log(log: dict, chain: str, protocol: str = "uniswap_v3", block_timestamp: str | None = None, ingested_at: str | None = None, spark=None) -> dict:
    """One log as an envelope, for callers that have a single one. ValueError if it does not decode."""
    from pyspark.sql import SparkSession

    from chainlake.operators.plugins import default_registry
    from chainlake.schema import RAW_LOG

    spark = spark or SparkSession.getActiveSession()
    rows = decode(spark.createDataFrame([{k: log.get(k) for k in RAW_LOG.fieldNames()}], RAW_LOG), [default_registry().get(protocol)], chain).collect()
    if rows[0].status != DECODED:
        raise ValueError(f"the log is {rows[0].status}")
    out = {k: v for k, v in rows[0].asDict(recursive=True).items() if k in ENVELOPE.fieldNames()}
    out["payload"] = {k: v for k, v in out["payload"].items() if v is not None}
    return out | {"block_timestamp": block_timestamp} | ({"ingested_at": ingested_at} if ingested_at else {})
