"""python -m chainlake JOB: producer, bronze, silver, gold, quality, or all (silver, gold, quality), configured by the environment."""

from __future__ import annotations

import json
import logging
import sys

from chainlake.operators import ingest
from chainlake.operators.plugins import default_registry
from chainlake.plans import pipeline
from chainlake.session import create_session, ship
from chainlake.settings import Settings
from chainlake.sources import kafka, logs
from chainlake.streaming import bronze


def producer(settings: Settings) -> None:
    """Logs of a node, with their blocks' times, to Kafka. Protocols and their subscriptions are checked before anything is opened."""
    pool = settings.required("AAVE_V3_POOL_ADDRESS") if "aave_v3" in settings.protocols else None
    plugins = default_registry(pool).enabled(settings.protocols)
    wanted = json.dumps([{"topics": s.topics, "addresses": s.addresses} for p in plugins for s in p.subscriptions()])
    url = settings.required("NODE_WEBSOCKET_URL")
    spark = create_session("chainlake-producer", kafka=True)
    ship(spark)
    spark.dataSource.register(logs.NodeLogs)
    spark.streams.addListener(bronze.ProgressLog())
    raw = spark.readStream.format("node_logs").option("url", url).option("subscriptions", wanted).load()
    decoded = bronze.observed(ingest.decode(ingest.subscribed(raw, plugins), plugins, settings.chain))
    bronze.until_stopped(kafka.write_stream(ingest.envelopes(decoded), settings.kafka_servers, f"{settings.checkpoint}-producer", settings.kafka_topic))


def land(settings: Settings) -> None:
    spark = create_session("chainlake-bronze", kafka=True)
    path = pipeline.Lake(settings.lake_root).bronze
    records = kafka.read_stream(spark, settings.kafka_servers, settings.kafka_topic)
    bronze.until_stopped(bronze.start(bronze.build(records, path), path, settings.checkpoint))


def batch(settings: Settings, *steps) -> None:
    spark, lake = create_session("chainlake"), pipeline.Lake(settings.lake_root)
    for step in steps:
        logging.info("%s: %s", step.__name__, step(spark, lake))


JOBS = {
    "producer": producer,
    "bronze": land,
    "silver": lambda s: batch(s, pipeline.run_silver),
    "gold": lambda s: batch(s, pipeline.run_gold),
    "quality": lambda s: batch(s, pipeline.run_checks),
    "all": lambda s: batch(s, pipeline.run_silver, pipeline.run_gold, pipeline.run_checks),
}


def main(args: list[str]) -> int:
    if len(args) != 1 or args[0] not in JOBS:
        print(__doc__, file=sys.stderr)
        return 2
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    JOBS[args[0]](Settings.from_env())
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
