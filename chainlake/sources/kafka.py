"""Kafka and its stand-in on files: the same columns, so that jobs do not know which one they read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.schema import ENVELOPE, KAFKA, RAW_LOG

TOPIC = "blockchain-events"


def read_stream(spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "latest") -> DataFrame:
    """A topic as a stream; needs the connector (session.create_session(kafka=True))."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting).load()


def read_stream_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Parquet files with a topic's columns as a stream, for replays and tests."""
    reader = spark.readStream.schema(KAFKA)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def read_log_files(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Raw logs as JSON lines."""
    return (spark.readStream if streaming else spark.read).schema(RAW_LOG).json(path)


def messages(envelopes: DataFrame) -> DataFrame:
    """Key and value of each envelope: transaction hash ("" if there is none) and JSON."""
    value = F.to_json(F.struct(*ENVELOPE.fieldNames()), {"ignoreNullFields": "true", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return envelopes.select(F.coalesce("transaction_hash", F.lit("")).cast("binary").alias("key"), value.cast("binary").alias("value"))


def write(envelopes: DataFrame, servers: str, topic: str = TOPIC) -> None:
    messages(envelopes).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_stream(envelopes: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC):
    return messages(envelopes).writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("checkpointLocation", checkpoint).start()


def as_records(found: DataFrame, topic: str = TOPIC) -> DataFrame:
    """messages() with a topic's other columns, for the file stand-in. The record's time is `timestamp` if there is one, else now."""
    time = F.col("timestamp") if "timestamp" in found.columns else F.current_timestamp().alias("timestamp")
    return found.select("key", "value", F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), time, F.lit(0).alias("timestampType"))


def console(stream: DataFrame):
    return stream.writeStream.outputMode("append").format("console").option("truncate", "false").start()
