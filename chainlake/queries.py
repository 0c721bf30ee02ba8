"""The catalogue of queries over the test tables, and the SQL that DuckDB must answer alike.

`events` stands for decoded events: event_type for type, user_id for user or pool, the number in props for the reserve, ts for the record's time.
Money is summed in whole cents, as sums of doubles depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.functions.abi import hex_long
from chainlake.functions.columns import compatible, event_id
from chainlake.functions.wideint import wide_sum
from chainlake.operators.dedup import latest
from chainlake.operators.ingest import decode, with_block_time
from chainlake.operators.plugins import default_registry
from chainlake.plans.quality import any_of, repeated_keys
from chainlake.schema import RAW_LOG
from chainlake.session import ship
from chainlake.sources.kafka import as_records
from chainlake.streaming import bronze

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its oracle if SQL can express it."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _reserve() -> Column:
    return F.get_json_object("props", "$.k").cast("int").alias("reserve")


def _cents(c: str) -> Column:
    return F.sum(F.round(F.col(c) * 100).cast("long"))


@query("""
SELECT date_trunc('minute', ts) AS minute_ts, event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
       min(event_id) AS min_event_id, max(event_id) AS max_event_id
FROM events GROUP BY 1, 2""")
def events_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "events")
        .groupBy(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute_ts"), "event_type")
        .agg(F.count("*").alias("event_count"), F.count_distinct("user_id").alias("unique_users"), F.min("event_id").alias("min_event_id"), F.max("event_id").alias("max_event_id"))
    )


@query("""
SELECT user_id, count(*) AS event_count, min(event_id) AS first_event, max(event_id) AS latest_event, min(ts) AS first_seen_at, max(ts) AS latest_seen_at
FROM events GROUP BY user_id ORDER BY event_count DESC, user_id LIMIT 50""")
def top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = [F.count("*").alias("event_count"), F.min("event_id").alias("first_event"), F.max("event_id").alias("latest_event"), F.min("ts").alias("first_seen_at"), F.max("ts").alias("latest_seen_at")]
    return _table(spark, sf_dir, "events").groupBy("user_id").agg(*metrics).orderBy(F.desc("event_count"), "user_id").limit(50)


@query("""
SELECT event_type, count(*) AS total_events, count(DISTINCT user_id) AS unique_users, count(DISTINCT props) AS unique_props, min(event_id) AS min_event_id,
       max(event_id) AS latest_event_id, min(ts) AS first_event_time, max(ts) AS latest_event_time
FROM events GROUP BY event_type""")
def pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(
            F.count("*").alias("total_events"), F.count_distinct("user_id").alias("unique_users"), F.count_distinct("props").alias("unique_props"),
            F.min("event_id").alias("min_event_id"), F.max("event_id").alias("latest_event_id"), F.min("ts").alias("first_event_time"), F.max("ts").alias("latest_event_time"),
        )
    )


@query("SELECT event_id, ts, user_id, event_type, props FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props").orderBy(F.desc("ts"), F.desc("event_id")).limit(100)


@query("""
SELECT event_id, ts, user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_user_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"), ["user_id", "event_type"], ["ts", "event_id"])


@query("""
SELECT CAST(ts AS DATE) AS event_date, CAST(json_extract_string(props, '$.k') AS INT) AS reserve, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases, count(*) FILTER (WHERE event_type = 'view') AS views
FROM events GROUP BY 1, 2""")
def daily_activity_by_reserve(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda t: F.count_if(F.col("event_type") == t)
    return (
        _table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("event_date"), _reserve())
        .agg(F.count("*").alias("event_count"), F.count_distinct("user_id").alias("unique_users"), of("purchase").alias("purchases"), of("view").alias("views"))
    )


@query("""
SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users, count(DISTINCT props) AS unique_props
FROM events GROUP BY 1, 2""")
def daily_multi_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = [F.count("*").alias("event_count"), F.count_distinct("user_id").alias("unique_users"), F.count_distinct("props").alias("unique_props")]
    return _table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(*metrics)


@query("""
SELECT CAST(l_shipdate AS DATE) AS event_date, l_returnflag, l_linestatus, count(*) AS line_count, count(DISTINCT l_partkey) AS unique_parts,
       count(DISTINCT l_suppkey) AS unique_suppliers, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price_cents,
       CAST(sum(CAST(round(l_quantity * 100) AS BIGINT)) AS BIGINT) AS quantity_cents, count(*) FILTER (WHERE l_discount > 0.05) AS discounted
FROM lineitem GROUP BY 1, 2, 3""")
def asset_pair_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("event_date"), "l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("line_count"), F.count_distinct("l_partkey").alias("unique_parts"), F.count_distinct("l_suppkey").alias("unique_suppliers"),
            _cents("l_extendedprice").alias("price_cents"), _cents("l_quantity").alias("quantity_cents"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
        )
    )


_SUMMARY = ("purchase", "view", "click")


@query("""
SELECT event_date, CAST(sum(purchase_count) AS BIGINT) AS purchase_count, CAST(sum(purchase_users) AS BIGINT) AS purchase_users,
       CAST(sum(view_count) AS BIGINT) AS view_count, CAST(sum(view_users) AS BIGINT) AS view_users,
       CAST(sum(click_count) AS BIGINT) AS click_count, CAST(sum(click_users) AS BIGINT) AS click_users
FROM (SELECT CAST(ts AS DATE) AS event_date, count(*) AS purchase_count, count(DISTINCT user_id) AS purchase_users, 0 AS view_count, 0 AS view_users, 0 AS click_count, 0 AS click_users
      FROM events WHERE event_type = 'purchase' GROUP BY 1
      UNION ALL SELECT CAST(ts AS DATE), 0, 0, count(*), count(DISTINCT user_id), 0, 0 FROM events WHERE event_type = 'view' GROUP BY 1
      UNION ALL SELECT CAST(ts AS DATE), 0, 0, 0, 0, count(*), count(DISTINCT user_id) FROM events WHERE event_type = 'click' GROUP BY 1)
GROUP BY 1""")
def daily_summary_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select(F.to_date("ts").alias("event_date"), "event_type", "user_id")
    out = None
    for kind in _SUMMARY:
        part = events.where(F.col("event_type") == kind).groupBy("event_date").agg(F.count("*").alias(f"{kind}_count"), F.count_distinct("user_id").alias(f"{kind}_users"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    names = [f"{k}_{m}" for k in _SUMMARY for m in ("count", "users")]
    return out.na.fill(0, names).groupBy("event_date").agg(*[F.sum(n).alias(n) for n in names])


@query("""
SELECT CAST(ts AS DATE) AS event_date, event_type,
       CAST(sum(CAST(CASE WHEN event_id % 7 = 1 THEN '999999999999999999' WHEN event_id % 7 = 2 THEN '999999999999999999999999999999999999999999999999999999' WHEN event_id % 7 <> 0 THEN CAST(event_id + 1 AS VARCHAR) || '00000000000000000000000000000000000000000000000000000000' || lpad(CAST(user_id AS VARCHAR), 12, '0') END AS BIGNUM)) AS VARCHAR) AS total_amount_raw
FROM events GROUP BY 1, 2""")
def wide_amount_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.when(F.col("event_id") % 7 == 1, F.lit("9" * 18)).when(F.col("event_id") % 7 == 2, F.lit("9" * 54)).when(F.col("event_id") % 7 != 0, F.concat((F.col("event_id") + 1).cast("string"), F.lit("0" * 56), F.lpad(F.col("user_id").cast("string"), 12, "0")))
    return _table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(wide_sum(amount).alias("total_amount_raw"))


@query("""
SELECT event_type || '-' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) AS event_key, ts FROM events""")
def event_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "events").select(F.col("event_type").alias("chain"), F.col("user_id").cast("string").alias("transaction_hash"), F.col("event_id").alias("log_index"), "ts")
    return parts.select(event_id().alias("event_key"), "ts")


@query("""
SELECT event_id, event_type, ts AS ingested_at, 'legacy' AS producer_version, 'legacy' AS schema_version, ts AS bronze_processed_at, 'legacy' AS bronze_file FROM events""")
def compat_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").alias("ingested_at"), "props")
    return compatible(old, ["event_id", "event_type", "ingested_at", "producer_version", "schema_version", "bronze_processed_at", "bronze_file"])


@query("""
SELECT user_id, event_type, event_id, ts FROM (
  SELECT user_id, event_type, event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-20'
  UNION ALL SELECT user_id, event_type, event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND event_type IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    both = events.where(F.col("ts") < at("2024-01-20")).unionByName(events.where((F.col("ts") >= at("2024-01-15")) & F.col("event_type").isNotNull()))
    return latest(both, ["user_id", "event_type"], ["ts", "event_id"])


@query("""
SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN user_id END AS pool, event_type FROM events
WHERE event_type = 'click' AND event_id IS NOT NULL AND ts IS NOT NULL AND (CASE WHEN event_id % 11 <> 0 THEN user_id END) IS NOT NULL""")
def required_field_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").withColumn("pool", F.when(F.col("event_id") % 11 != 0, F.col("user_id")))
    return rows.where("event_type = 'click'").dropna(subset=["event_id", "ts", "pool"]).select("event_id", "pool", "event_type")


@query("""
SELECT count(*) - count(DISTINCT (CAST(ts AS DATE), event_type, user_id)) + count(*) FILTER (WHERE event_type IS NULL OR user_id < 0 OR event_type <> 'click' AND event_id < 10) AS violations,
       count(*) - count(DISTINCT event_id) AS repeated_ids
FROM events""")
def grain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    bad = any_of([F.col("event_type").isNull(), F.col("user_id") < 0, (F.col("event_type") != "click") & (F.col("event_id") < 10)])
    return rows.agg((repeated_keys(rows, ["day", "event_type", "user_id"]) + F.count_if(bad)).alias("violations"), repeated_keys(rows, ["event_id"]).alias("repeated_ids"))


@query("""
SELECT event_date, event_type, t.n AS total, s.n AS summary FROM
  (SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS n FROM events GROUP BY 1, 2) t
FULL OUTER JOIN (SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS n FROM events WHERE event_id % 97 <> 0 GROUP BY 1, 2) s USING (event_date, event_type)
WHERE t.n IS DISTINCT FROM s.n""")
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda d: d.groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(F.count("*").alias("n"))
    events = _table(spark, sf_dir, "events")
    joined = count(events).alias("t").join(count(events.where(F.col("event_id") % 97 != 0)).alias("s"), ["event_date", "event_type"], "full_outer")
    return joined.where(~F.col("t.n").eqNullSafe(F.col("s.n"))).select("event_date", "event_type", F.col("t.n").alias("total"), F.col("s.n").alias("summary"))


@query("SELECT event_type, count(*) AS event_count FROM events GROUP BY 1")
def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("event_count"))


@query("""
SELECT e.event_id, e.ts, o.first_order FROM events e LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1) o ON e.user_id = o.o_custkey""")
def block_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block times by number: customers stand for blocks, their first orders for the times."""
    times = _table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("block_number")).agg(F.min("o_orderdate").alias("block_timestamp"))
    events = _table(spark, sf_dir, "events").select("event_id", "ts", F.col("user_id").cast("string").alias("blockNumber"))
    return with_block_time(events, times).select("event_id", "ts", F.col("block_timestamp").alias("first_order"))


@query("SELECT DISTINCT props AS file FROM events WHERE props NOT IN (SELECT props FROM events WHERE event_id < 50)")
def unprocessed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _table(spark, sf_dir, "events").select("event_id", F.col("props").alias("file"))
    return files.select("file").distinct().join(files.where("event_id < 50"), "file", "left_anti")


@query("""
SELECT CAST(event_id AS INT) AS block, CASE event_id % 4 WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE 'uniswap_v3' END AS protocol,
       CASE event_id % 4 WHEN 0 THEN 'decoded' WHEN 3 THEN 'malformed' ELSE 'unsupported' END AS status
FROM events WHERE user_id IS NOT NULL""")
def signature_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routes of logs by topic where one protocol is enabled."""
    ship(spark)
    found = decode(_logs(spark, sf_dir), default_registry().enabled(["uniswap_v3"]), "arbitrum")
    return found.select(hex_long(F.col("blockNumber")).cast("int").alias("block"), "protocol", "status")


@query("SELECT event_id, user_id, event_type, props FROM events")
def json_envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "event_id long, user_id long, event_type string, payload struct<props: string>"
    text = F.to_json(F.struct("event_id", "user_id", "event_type", F.struct("props").alias("payload")))
    return _table(spark, sf_dir, "events").select(F.from_json(text, schema).alias("event")).select("event.event_id", "event.user_id", "event.event_type", F.col("event.payload.props").alias("props"))


def _hex(c: Column, digits: int = 64) -> Column:
    return F.lpad(F.lower(F.hex(c)), digits, "0")


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw logs made of events: swaps of every fourth, borrows of the next, an unknown topic, and a swap without its last word."""
    topics = {e.name: e.topic0 for name in ("uniswap_v3", "aave_v3") for e in default_registry().get(name).events}
    e, kind = _table(spark, sf_dir, "events").where("user_id IS NOT NULL"), F.col("event_id") % 4
    address = lambda c: F.concat(F.lit("0x"), _hex(c))
    user, number = address(F.col("user_id")), F.col("event_id") + 1
    negative = F.concat(F.lit("f" * 48), F.lower(F.hex(-number)))
    swap = F.concat(negative, _hex(number), F.lit("0" * 39 + "1" + "0" * 24), _hex(number), F.lit("f" * 56), F.substring(F.lower(F.hex(-(F.col("event_id") % 1000) - 1)), 9, 8))
    borrow = F.concat(_hex(F.col("user_id")), F.lit("8" + "0" * 47), F.lpad(F.lower(F.hex(number)), 16, "0"), _hex(F.lit(2)), _hex(number))
    return e.select(
        F.concat(F.lit("0xABCDEF"), _hex(F.col("user_id"), 34)).alias("address"),
        F.when(kind == 1, F.array(F.lit(topics["borrow"]), user, user, address(F.col("event_id") % 100))).when(kind == 2, F.array(F.lit("0x" + "f" * 64))).otherwise(F.array(F.lit(topics["swap"]), user, user)).alias("topics"),
        F.concat(F.lit("0x"), F.when(kind == 1, borrow).when(kind == 3, F.substring(swap, 1, 256)).otherwise(swap)).alias("data"),
        F.concat(F.lit("0x"), F.lower(F.hex("event_id"))).alias("blockNumber"),
        F.concat(F.lit("0x"), _hex(F.col("event_id"))).alias("transactionHash"),
        F.lit("0x0").alias("transactionIndex"), F.lit("0x0").alias("blockHash"), F.lit("0x2").alias("logIndex"), F.lit(False).alias("removed"),
    ).to(RAW_LOG)


@query("""
SELECT CAST(event_id AS INT) AS block, CASE event_id % 4 WHEN 0 THEN 'decoded' WHEN 1 THEN 'decoded' WHEN 2 THEN 'unsupported' ELSE 'malformed' END AS status,
       CASE WHEN event_id % 4 IN (0, 3) THEN 'swap' WHEN event_id % 4 = 1 THEN 'borrow' END AS event_type,
       CASE event_id % 4 WHEN 0 THEN CAST(-(event_id + 1) AS VARCHAR) END AS amount0,
       CASE event_id % 4 WHEN 0 THEN '79228162514264337593543950336' END AS sqrt_price_x96,
       CASE event_id % 4 WHEN 0 THEN CAST(-(event_id % 1000) - 1 AS INT) END AS tick,
       CASE event_id % 4 WHEN 1 THEN CAST(CAST('57896044618658097711785492504343953926634992332820282019728792003956564819968' AS BIGNUM) + CAST(event_id + 1 AS BIGNUM) AS VARCHAR) END AS amount_raw,
       CASE event_id % 4 WHEN 1 THEN 2 END AS interest_rate_mode,
       CASE event_id % 4 WHEN 1 THEN CAST(event_id % 100 AS INT) END AS referral_code,
       CASE WHEN event_id % 4 IN (0, 1) THEN '0xabcdef' || lpad(lower(to_hex(user_id)), 34, '0') END AS contract,
       CASE WHEN event_id % 4 IN (0, 1) THEN '0x' || lpad(lower(to_hex(user_id)), 40, '0') END AS account
FROM events WHERE user_id IS NOT NULL""")
def abi_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    registry = default_registry()
    p = F.col("payload")
    return decode(_logs(spark, sf_dir), registry.enabled(["uniswap_v3", "aave_v3"]), "arbitrum").select(
        F.conv(F.substring("blockNumber", 3, 16), 16, 10).cast("int").alias("block"), "status", "event_type",
        *[p[c].alias(c) for c in ("amount0", "sqrt_price_x96", "tick", "amount_raw", "interest_rate_mode", "referral_code")],
        F.coalesce(p["pool_address"], p["contract_address"]).alias("contract"), F.coalesce(p["sender"], p["user"]).alias("account"),
    )


@query("""
SELECT event_type, CAST(ts AS DATE) AS event_date, count(*) AS records, min(event_id) AS first_block, max(event_id) AS last_block
FROM events GROUP BY 1, 2""")
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records of a file topic, streamed to partitioned Bronze, read back."""
    import tempfile
    import uuid

    from chainlake.sources.kafka import read_stream_files

    base = spark.conf.get("spark.checkpoint.dir", None) or (f"file://{tempfile.mkdtemp()}" if spark.sparkContext.master.startswith("local[") else None)
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    root = f"{base.rstrip('/')}/bronze-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    time = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    value = F.to_json(F.struct(F.lit("uniswap_v3").alias("protocol"), F.lit("arbitrum").alias("chain"), "event_type", F.col("event_id").alias("block_number"), F.lit("0xabc").alias("transaction_hash"), F.lit(1).alias("log_index"), time.alias("block_timestamp")))
    records = as_records(_table(spark, sf_dir, "events").select(F.col("user_id").cast("string").cast("binary").alias("key"), value.cast("binary").alias("value")))
    records.write.parquet(f"{root}/topic")
    bronze.start(bronze.build(read_stream_files(spark, f"{root}/topic"), f"{root}/bronze"), f"{root}/bronze", f"{root}/checkpoint", once=True).awaitTermination()
    found = spark.read.parquet(f"{root}/bronze")
    return found.groupBy("event_type", "event_date").agg(F.count("*").alias("records"), F.min("block_number").cast("long").alias("first_block"), F.max("block_number").cast("long").alias("last_block"))


@query("""
SELECT CAST(event_id AS INT) AS block, CASE WHEN event_id < 500 THEN ts END AS block_time FROM events WHERE user_id IS NOT NULL""")
def log_block_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs with their blocks' times; blocks that are not known stay null."""
    blocks = _table(spark, sf_dir, "events").where("event_id < 500").select(F.col("event_id").cast("int").alias("block_number"), F.col("ts").cast("timestamp").alias("block_timestamp"))
    logs = with_block_time(_logs(spark, sf_dir), blocks)
    return logs.select(F.conv(F.substring("blockNumber", 3, 16), 16, 10).cast("int").alias("block"), F.col("block_timestamp").cast("timestamp_ntz").alias("block_time"))
