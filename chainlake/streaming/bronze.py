"""Bronze: Kafka records to partitioned Parquet, by Structured Streaming. Stateless, append only; late and repeated events are settled in Silver."""

from __future__ import annotations

import logging
import signal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from chainlake.schema import BRONZE_PARTITIONS, ENVELOPE

log = logging.getLogger(__name__)


def build(records: DataFrame, path: str = "data/bronze") -> DataFrame:
    """22 columns of each record. Text that is no envelope gives nulls and stays in json_value."""
    e = F.col("event")
    parsed = records.select(
        F.col("timestamp").alias("kafka_timestamp"), F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
        F.col("key").cast("string").alias("kafka_key"), F.col("value").cast("string").alias("json_value"),
    ).withColumn("event", F.from_json("json_value", ENVELOPE))
    day = F.to_date(F.coalesce(e["block_timestamp"], F.col("kafka_timestamp")))
    folder = F.concat(F.lit(f"{path.rstrip('/')}/protocol="), e["protocol"], F.lit("/chain="), e["chain"], F.lit("/event_type="), e["event_type"], F.lit("/event_date="), day.cast("string"))
    plain = ["protocol", "chain", "event_type", "block_number", "transaction_hash", "log_index", "block_timestamp", "producer_version", "schema_version", "payload"]
    return parsed.select(
        "kafka_timestamp", day.alias("event_date"), "kafka_partition", "kafka_offset", "kafka_key", "json_value",
        *[e[c].alias(c) for c in plain],
        *[e["payload"][c].alias(c) for c in ("pool_address", "raw_data", "raw_topics")],
        F.coalesce(e["ingested_at"], F.current_timestamp()).alias("ingested_at"),
        F.current_timestamp().alias("bronze_processed_at"),
        folder.alias("bronze_file"),
    )


def bad_records(bronze: DataFrame) -> DataFrame:
    """Counts of records that lost something on the way: no envelope, or a block number beyond 32 bits."""
    no_envelope = F.col("protocol").isNull() & F.col("transaction_hash").isNull()
    return bronze.agg(F.count("*").alias("records"), F.count_if(no_envelope).alias("unreadable"), F.count_if(~no_envelope & F.col("block_number").isNull()).alias("without_block"))


def start(bronze: DataFrame, path: str, checkpoint: str, once: bool = False, seconds: int = 10) -> StreamingQuery:
    """Append to path until stopped, or with `once` until all that is there now is written. The file sink's log makes it exactly once."""
    trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
    return bronze.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*BRONZE_PARTITIONS).trigger(**trigger).start()


def until_stopped(query: StreamingQuery) -> None:
    """Wait for the query; SIGTERM and an interrupt stop it after its batch."""

    def stop(*_) -> None:
        raise KeyboardInterrupt

    before = signal.signal(signal.SIGTERM, stop)
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        log.info("stopping")
        query.stop()
    finally:
        signal.signal(signal.SIGTERM, before)


def observed(decoded: DataFrame) -> DataFrame:
    """decoded with the counts of its routes as metrics of each batch."""
    of = lambda s: F.count_if(F.col("status") == s).alias(s)
    return decoded.observe("routes", of("decoded"), of("unsupported"), of("malformed"))


class ProgressLog(StreamingQueryListener):
    """Logs the routes' totals after the first event, and whenever another `every` were decoded."""

    def __init__(self, every: int = 100):
        self.every, self.totals, self.logged = every, {"decoded": 0, "unsupported": 0, "malformed": 0}, 0

    def add(self, counts: dict[str, int]) -> bool:
        for k in self.totals:
            self.totals[k] += counts.get(k, 0)
        due = self.totals["decoded"] > 0 and (self.logged == 0 or self.totals["decoded"] // self.every > self.logged // self.every)
        if due:
            self.logged = self.totals["decoded"]
            log.info("events so far: %s", self.totals)
        for k in ("unsupported", "malformed"):
            if counts.get(k):
                log.warning("%d logs are %s", counts[k], k)
        return due

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if row := event.progress.observedMetrics.get("routes"):
            self.add(row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
