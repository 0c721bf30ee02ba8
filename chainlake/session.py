"""Sessions, and getting this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: What every job relies on: UTC days, run-time re-planning, timestamps that other readers of Parquet understand.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}
#: Rows and bytes of the batches that Python workers get: texts are long, and a worker and its executor hold several batches at once.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608b")}
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"

_shipped: set[str] = set()


def create_session(app_name: str = "chainlake", kafka: bool = False, **conf: str) -> SparkSession:
    """A session with CONF; kafka adds the connector, which needs network access or a local jar."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in (CONF | conf | ({"spark.jars.packages": KAFKA_PACKAGE} if kafka else {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once an application, so that they can import it; and make batches for Python small, where the
    session has Spark's defaults."""
    for key, (default, own) in BATCHES.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, own)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).parent
    path = os.path.join(tempfile.mkdtemp(), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
