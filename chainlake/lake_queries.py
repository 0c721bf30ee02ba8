"""The catalogue's queries over the layers themselves: the library's Bronze, Silver, Gold, quality checks, producer steps and publishing, on logs and
records made of `events`, each with the SQL that DuckDB must answer alike.

Kinds by event_id % 7: 0 and 1 swaps, 2 mints, 3 burns, 4 borrows, 5 repayments, 6 liquidations. Every tenth event is delivered twice, an hour later
and with another owner, so that the latest version counts. Columns that hold the time of the run are left out.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.functions import abi
from chainlake.functions.columns import compatible, event_id
from chainlake.operators import ingest
from chainlake.operators.plugins import AaveV3, UniswapV3, default_registry
from chainlake.plans import gold, pipeline, quality, silver
from chainlake.queries import _hex, _logs, _table, query
from chainlake.schema import ENVELOPE, RAW_LOG
from chainlake.session import ship
from chainlake.sources import files, kafka, logs
from chainlake.streaming import bronze

KINDS = ("swap", "swap", "mint", "burn", "borrow", "repay", "liquidation")

#: The records as SQL has them: one row a delivery.
_RECORDS = """
d AS (SELECT event_id AS e, ts, ts AS kafka, user_id AS owner, 0 AS again FROM events
      UNION ALL SELECT event_id, ts, ts + INTERVAL 1 HOUR, user_id + 1, 1 FROM events WHERE event_id % 10 = 0),
r AS (SELECT *, CASE e % 7 WHEN 0 THEN 'swap' WHEN 1 THEN 'swap' WHEN 2 THEN 'mint' WHEN 3 THEN 'burn' WHEN 4 THEN 'borrow' WHEN 5 THEN 'repay' ELSE 'liquidation' END AS kind,
        CASE WHEN e % 7 < 4 THEN 'uniswap_v3' ELSE 'aave_v3' END AS protocol, '0x' || lower(to_hex(e // 21)) AS tx, CAST(e % 21 AS INT) AS log_index,
        CASE WHEN e % 7 < 4 AND e % 50 <> 0 THEN '0xpool' || CAST(owner % 20 AS VARCHAR) END AS pool,
        '0xr' || CAST(owner % 5 AS VARCHAR) AS reserve, '0xu' || CAST(owner AS VARCHAR) AS usr, '0xp' || CAST(owner % 3 AS VARCHAR) AS payer,
        CASE e % 3 WHEN 0 THEN '999999999999999999' WHEN 1 THEN '999999999999999999999999999999999999' ELSE CAST(e AS VARCHAR) || '000000000000000000000000000000000000000000000000000000000000' END AS amount,
        CAST(e % 2 + 1 AS INT) AS mode, e % 4 = 0 AS flag FROM d),
b AS (SELECT *, 'data/bronze/protocol=' || protocol || '/chain=arbitrum/event_type=' || kind || '/event_date=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS bronze_file FROM r),
s AS (SELECT * FROM b WHERE kind = 'swap' AND pool IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tx, log_index ORDER BY kafka DESC) = 1),
l AS (SELECT * FROM b WHERE protocol = 'aave_v3' QUALIFY row_number() OVER (PARTITION BY tx, log_index ORDER BY kafka DESC) = 1)
"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of the events as Kafka records."""
    e = _table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    twice = e.where("event_id % 10 = 0").select("event_id", "ts", (F.col("user_id") + 1).alias("owner"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("timestamp"))
    d = e.select("event_id", "ts", F.col("user_id").alias("owner"), F.col("ts").alias("timestamp")).unionByName(twice)
    i, owner = F.col("event_id"), F.col("owner")
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (i % 7 + 1).cast("int"))
    name = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    amount = F.when(i % 3 == 0, F.lit("9" * 18)).when(i % 3 == 1, F.lit("9" * 36)).otherwise(F.concat(i.cast("string"), F.lit("0" * 60)))
    fields = {
        "swap": {"pool_address": F.when(i % 50 != 0, name("0xpool", owner % 20)), "sender": name("0xu", owner)},
        "borrow": {"reserve": name("0xr", owner % 5), "user": name("0xu", owner), "amount_raw": amount, "interest_rate_mode": (i % 2 + 1).cast("int"), "borrow_rate_raw": amount},
        "repay": {"reserve": name("0xr", owner % 5), "user": name("0xu", owner), "repayer": name("0xp", owner % 3), "amount_raw": amount, "use_atokens": i % 4 == 0},
        "liquidation": {"collateral_asset": name("0xr", owner % 5), "debt_asset": name("0xp", owner % 3), "user": name("0xu", owner), "debt_to_cover_raw": amount,
                        "liquidated_collateral_amount_raw": amount, "liquidator": name("0xp", owner % 3), "receive_atoken": i % 4 == 0},
    }
    fields["mint"] = fields["burn"] = fields["swap"]
    payload = F.coalesce(*[F.when(F.col("kind") == k, F.to_json(F.struct(*[c.alias(n) for n, c in fs.items()]))) for k, fs in fields.items()])
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    head = F.to_json(
        F.struct(
            F.when(i % 7 < 4, "uniswap_v3").otherwise("aave_v3").alias("protocol"), F.lit("arbitrum").alias("chain"), F.col("kind").alias("event_type"), i.alias("block_number"),
            F.concat(F.lit("0x"), F.lower(F.hex((i / 21).cast("long")))).alias("transaction_hash"), (i % 21).cast("int").alias("log_index"), time.alias("block_timestamp"),
            F.lit("1.0.0").alias("producer_version"), F.lit("1.0.0").alias("schema_version"), time.alias("ingested_at"),
        )
    )
    value = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"payload":'), payload, F.lit("}"))
    return kafka.as_records(d.withColumn("kind", kind).select(owner.cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"), "timestamp"))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.build(_records(spark, sf_dir))


def _swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.swaps(_bronze(spark, sf_dir))


def _lending(spark: SparkSession, sf_dir: str, model: int) -> DataFrame:
    return gold.lending_events(silver.lending(_bronze(spark, sf_dir), silver.MODELS[model]))


def _plain(df: DataFrame, *names: str) -> DataFrame:
    """The columns by name, instants as plain timestamps."""
    kinds = dict(df.dtypes)
    return df.select(*[F.col(n).cast("timestamp_ntz").alias(n) if kinds[n] == "timestamp" else F.col(n) for n in names])


@query(f"""
WITH {_RECORDS} SELECT e AS block_number, kind AS event_type, protocol, 'arbitrum' AS chain, CAST(ts AS DATE) AS event_date, kafka AS kafka_timestamp, ts AS block_timestamp, tx AS transaction_hash,
  log_index, pool AS pool_address, CAST(owner AS VARCHAR) AS kafka_key, CASE WHEN kind IN ('borrow', 'repay') THEN amount END AS amount_raw, bronze_file FROM b""")
def bronze_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _bronze(spark, sf_dir).withColumns({"amount_raw": F.col("payload.amount_raw"), "block_number": F.col("block_number").cast("long")})
    return _plain(found, "block_number", "event_type", "protocol", "chain", "event_date", "kafka_timestamp", "block_timestamp", "transaction_hash", "log_index", "pool_address", "kafka_key", "amount_raw", "bronze_file")


@query("""
SELECT event_id AS e, event_id % 5 <> 0 AS has_time, CASE WHEN event_id % 5 <> 0 THEN CAST(ts AS DATE) ELSE CAST(ts + INTERVAL 2 DAY AS DATE) END AS event_date, event_id % 3 = 0 AS defaulted,
  CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS unreadable, CASE WHEN event_id % 11 <> 0 AND event_id % 13 = 0 THEN 1 ELSE 0 END AS without_block
FROM events WHERE event_id % 11 <> 0
UNION ALL SELECT event_id, NULL, CAST(ts + INTERVAL 2 DAY AS DATE), true, 1, 0 FROM events WHERE event_id % 11 = 0""")
def bronze_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without a block's time, without an ingestion time, with a number beyond 32 bits, and text that is no envelope."""
    e, i = _table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), F.col("event_id")
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    text = F.to_json(F.struct(F.lit("p").alias("protocol"), F.lit("c").alias("chain"), F.lit("k").alias("event_type"), F.lit("0x1").alias("transaction_hash"), F.when(i % 13 == 0, F.lit(2**31)).otherwise(i).alias("block_number"),
                              F.when(i % 5 != 0, time).alias("block_timestamp"), F.when(i % 3 != 0, time).alias("ingested_at")))
    records = e.select(i.cast("string").cast("binary").alias("key"), F.when(i % 11 == 0, "no envelope").otherwise(text).cast("binary").alias("value"), F.lit(0).alias("partition"), i.alias("offset"), (F.col("ts") + F.expr("INTERVAL 2 DAY")).alias("timestamp"))
    rows = bronze.build(records)
    readable = F.col("protocol").isNotNull()
    return rows.select(
        F.col("kafka_offset").alias("e"), F.when(readable, F.col("block_timestamp").isNotNull()).alias("has_time"), "event_date", (F.col("ingested_at") == F.col("bronze_processed_at")).alias("defaulted"),
        F.when(readable, 0).otherwise(1).alias("unreadable"), F.when(readable & F.col("block_number").isNull(), 1).otherwise(0).alias("without_block"),
    )


@query("""
SELECT count(*) AS records, count(*) FILTER (WHERE event_id % 11 = 0) AS unreadable, count(*) FILTER (WHERE event_id % 11 <> 0 AND event_id % 13 = 0) AS without_block FROM events""")
def bronze_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    text = F.when(i % 11 == 0, "{").otherwise(F.to_json(F.struct(F.lit("p").alias("protocol"), F.when(i % 13 == 0, F.lit(2**31)).otherwise(i).alias("block_number"))))
    records = _table(spark, sf_dir, "events").select(F.lit(b"k").alias("key"), text.cast("binary").alias("value"), F.lit(0).alias("partition"), i.alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
    return bronze.bad_records(bronze.build(records))


_SWAP_COLUMNS = "'arbitrum-' || tx || '-' || CAST(log_index AS VARCHAR) AS event_id, protocol, 'arbitrum' AS chain, CAST(ts AS DATE) AS event_date, CAST(e AS INT) AS block_number, tx AS transaction_hash, pool AS pool_address, log_index, kafka AS kafka_timestamp, ts AS ingested_at, '1.0.0' AS producer_version, bronze_file, '1.0.0' AS silver_job_version"
_SWAP_NAMES = ("event_id", "protocol", "chain", "event_date", "block_number", "transaction_hash", "pool_address", "log_index", "kafka_timestamp", "ingested_at", "producer_version", "bronze_file", "silver_job_version")


@query(f"WITH {_RECORDS} SELECT {_SWAP_COLUMNS} FROM s")
def swap_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_swaps(spark, sf_dir), *_SWAP_NAMES)


@query(f"WITH {_RECORDS} SELECT {_SWAP_COLUMNS} FROM s")
def swap_silver_in_two_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of Bronze merged one after the other give what one batch gives."""
    rows = _bronze(spark, sf_dir)
    first = rows.where("kafka_timestamp < '2024-01-10 00:00:00'")
    return _plain(silver.swaps(rows.where("kafka_timestamp >= '2024-01-09 12:00:00'"), silver.swaps(first)), *_SWAP_NAMES)


def _lending_sql(kind: str, columns: str) -> str:
    return f"WITH {_RECORDS} SELECT 'arbitrum-' || tx || '-' || CAST(log_index AS VARCHAR) AS event_id, CAST(ts AS DATE) AS event_date, ts AS block_timestamp, CAST(e AS INT) AS block_number, kafka AS kafka_timestamp, bronze_file, {columns} FROM l WHERE kind = '{kind}'"


_LENDING = ("event_id", "event_date", "block_timestamp", "block_number", "kafka_timestamp", "bronze_file")


@query(_lending_sql("borrow", 'reserve, usr AS "user", CAST(NULL AS VARCHAR) AS on_behalf_of, amount AS amount_raw, mode AS interest_rate_mode, amount AS borrow_rate_raw, CAST(NULL AS INT) AS referral_code'))
def borrow_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(silver.lending(_bronze(spark, sf_dir), silver.MODELS[0]), *_LENDING, *silver.MODELS[0].fields)


@query(_lending_sql("repay", 'reserve, usr AS "user", payer AS repayer, amount AS amount_raw, flag AS use_atokens'))
def repay_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(silver.lending(_bronze(spark, sf_dir), silver.MODELS[1]), *_LENDING, *silver.MODELS[1].fields)


@query(_lending_sql("liquidation", 'reserve AS collateral_asset, payer AS debt_asset, usr AS "user", amount AS debt_to_cover_raw, amount AS liquidated_collateral_amount_raw, payer AS liquidator, flag AS receive_atoken'))
def liquidation_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(silver.lending(_bronze(spark, sf_dir), silver.MODELS[2]), *_LENDING, *silver.MODELS[2].fields)


_PROVENANCE = "max('1.0.0') AS producer_version, max('1.0.0') AS schema_version, max(bronze_file) AS bronze_file, max('1.0.0') AS silver_job_version, max('1.0.0') AS aggregation_version"
_FROM = ("producer_version", "schema_version", "bronze_file", "silver_job_version", "aggregation_version")


@query(f"""
WITH {_RECORDS} SELECT date_trunc('minute', kafka) AS minute_ts, protocol, 'arbitrum' AS chain, count(*) AS swap_count, count(DISTINCT pool) AS unique_pools, CAST(min(e) AS INT) AS min_block_number,
  CAST(max(e) AS INT) AS max_block_number, {_PROVENANCE} FROM s GROUP BY 1, 2""")
def gold_swaps_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(gold.swaps_per_minute(_swaps(spark, sf_dir)), "minute_ts", "protocol", "chain", "swap_count", "unique_pools", "min_block_number", "max_block_number", *_FROM)


@query(f"""
WITH {_RECORDS} SELECT protocol, 'arbitrum' AS chain, pool AS pool_address, count(*) AS swap_count, CAST(min(e) AS INT) AS first_block_seen, CAST(max(e) AS INT) AS latest_block_seen,
  min(kafka) AS first_seen_at, max(kafka) AS latest_seen_at, {_PROVENANCE} FROM s GROUP BY 1, 3 ORDER BY swap_count DESC, protocol, chain, pool_address LIMIT 50""")
def gold_top_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(gold.top_pools(_swaps(spark, sf_dir)), "protocol", "chain", "pool_address", "swap_count", "first_block_seen", "latest_block_seen", "first_seen_at", "latest_seen_at", *_FROM)


@query(f"""
WITH {_RECORDS} SELECT protocol, 'arbitrum' AS chain, count(*) AS total_swaps, count(DISTINCT tx) AS unique_transactions, count(DISTINCT pool) AS unique_pools, CAST(min(e) AS INT) AS min_block_number,
  CAST(max(e) AS INT) AS latest_block_number, min(kafka) AS first_event_time, max(kafka) AS latest_event_time, min(ts) AS first_ingested_at, max(ts) AS latest_ingested_at, {_PROVENANCE} FROM s GROUP BY 1""")
def gold_pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("total_swaps", "unique_transactions", "unique_pools", "min_block_number", "latest_block_number", "first_event_time", "latest_event_time", "first_ingested_at", "latest_ingested_at")
    return _plain(gold.pipeline_summary(_swaps(spark, sf_dir)), "protocol", "chain", *names, *_FROM)


@query(f"""
WITH {_RECORDS}, x AS (SELECT {_SWAP_COLUMNS} FROM s) SELECT event_id, block_number, pool_address, kafka_timestamp FROM x ORDER BY kafka_timestamp DESC, block_number DESC, event_id LIMIT 100""")
def gold_recent_swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(gold.recent_swaps(_swaps(spark, sf_dir)), "event_id", "block_number", "pool_address", "kafka_timestamp")


_DAY_SQL = "CAST(ts AS DATE) AS event_date, protocol, 'arbitrum' AS chain"
_BIG = "CAST(sum(CAST(amount AS BIGNUM)) AS VARCHAR)"
_M7 = "max('1.0.0') AS producer_version, max('1.0.0') AS aggregation_version"


@query(f"""
WITH {_RECORDS} SELECT {_DAY_SQL}, reserve AS reserve_address, count(*) AS borrow_event_count, count(DISTINCT usr) AS unique_borrowers, {_BIG} AS total_borrow_amount_raw,
  count(*) FILTER (WHERE mode = 2) AS variable_rate_borrow_count, count(*) FILTER (WHERE mode = 1) AS stable_rate_borrow_count, {_M7} FROM l WHERE kind = 'borrow' GROUP BY 1, 2, reserve""")
def gold_daily_borrow_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_borrow_activity(_lending(spark, sf_dir, 0)).drop("gold_processed_at", "schema_version", "bronze_processed_at", "silver_processed_at", "silver_job_version")


@query(f"""
WITH {_RECORDS} SELECT {_DAY_SQL}, reserve AS reserve_address, count(*) AS repay_event_count, count(DISTINCT usr) AS unique_borrowers_repaid, count(DISTINCT payer) AS unique_repayers,
  {_BIG} AS total_repaid_amount_raw, count(*) FILTER (WHERE flag) AS atoken_repay_count, {_M7} FROM l WHERE kind = 'repay' GROUP BY 1, 2, reserve""")
def gold_daily_repayment_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_repayment_activity(_lending(spark, sf_dir, 1)).drop("gold_processed_at", "schema_version", "bronze_processed_at", "silver_processed_at", "silver_job_version")


@query(f"""
WITH {_RECORDS} SELECT {_DAY_SQL}, reserve AS collateral_asset, payer AS debt_asset, count(*) AS liquidation_count, count(DISTINCT usr) AS unique_liquidated_users, count(DISTINCT payer) AS unique_liquidators,
  {_BIG} AS total_debt_covered_raw, {_BIG} AS total_collateral_liquidated_raw, count(*) FILTER (WHERE flag) AS receive_atoken_count, {_M7} FROM l WHERE kind = 'liquidation' GROUP BY 1, 2, reserve, payer""")
def gold_daily_liquidation_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_liquidation_activity(_lending(spark, sf_dir, 2)).drop("gold_processed_at", "schema_version", "bronze_processed_at", "silver_processed_at", "silver_job_version")


_SUMMARY_SQL = """count(*) FILTER (WHERE kind = 'borrow') AS borrow_event_count, count(*) FILTER (WHERE kind = 'repay') AS repay_event_count, count(*) FILTER (WHERE kind = 'liquidation') AS liquidation_count,
  count(DISTINCT usr) FILTER (WHERE kind = 'borrow') AS unique_borrowers, count(DISTINCT payer) FILTER (WHERE kind = 'repay') AS unique_repayers,
  count(DISTINCT usr) FILTER (WHERE kind = 'liquidation') AS unique_liquidated_users, count(DISTINCT payer) FILTER (WHERE kind = 'liquidation') AS unique_liquidators"""


@query(f"WITH {_RECORDS} SELECT {_DAY_SQL}, {_SUMMARY_SQL}, {_M7} FROM l GROUP BY 1, 2")
def gold_daily_lending_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = gold.daily_lending_summary(*[_lending(spark, sf_dir, k) for k in range(3)])
    return summary.drop("gold_processed_at", "schema_version", "bronze_processed_at", "silver_processed_at", "silver_job_version")


@query(f"""
WITH {_RECORDS} SELECT 'borrow' AS dataset, count(*) AS rows_n, count(DISTINCT (tx, log_index)) AS keys_n, CAST(sum(CASE WHEN again = 1 THEN 1 ELSE 0 END) AS BIGINT) AS later_versions FROM l WHERE kind = 'borrow'""")
def lending_events_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver that holds events twice, as after a partial rebuild: Gold counts each once, in its latest version."""
    table = silver.lending(_bronze(spark, sf_dir), silver.MODELS[0])
    older = table.withColumns({"kafka_timestamp": F.col("kafka_timestamp") - F.expr("INTERVAL 1 DAY"), "user": F.lit("0xold")})
    events = gold.lending_events(older.unionByName(table))
    again = F.col("kafka_timestamp") > F.col("block_timestamp")
    return events.agg(F.lit("borrow").alias("dataset"), F.count("*").alias("rows_n"), F.count_distinct("event_id").alias("keys_n"), F.count_if(again).alias("later_versions"))


@query(f"""
WITH {_RECORDS}, f AS (SELECT *, e % 9 = 0 AS twice, e % 8 = 0 AS faulty FROM s)
SELECT (SELECT count(*) FROM f WHERE twice) AS repeated_ids, (SELECT CAST(sum(CASE WHEN twice THEN 2 ELSE 1 END) AS BIGINT) FROM f WHERE faulty) AS rows_with_nulls,
  (SELECT count(DISTINCT (reserve, CAST(ts AS DATE))) FROM l WHERE kind = 'borrow') AS borrow_grain_violations,
  (SELECT count(DISTINCT CAST(ts AS DATE)) FROM l WHERE day(ts) % 3 = 0) AS unreconciled_days""")
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks on layers with planted faults: repeated events, missing pools, repeated grains, and a summary that counts too much on some days."""
    swaps = _swaps(spark, sf_dir)
    bad = swaps.withColumn("pool_address", F.when(F.col("block_number") % 8 != 0, F.col("pool_address")))
    bad = bad.unionByName(bad.where("block_number % 9 = 0"))
    events = [_lending(spark, sf_dir, k) for k in range(3)]
    parts = [gold.daily_borrow_activity(events[0]), gold.daily_repayment_activity(events[1]), gold.daily_liquidation_activity(events[2])]
    summary = gold.daily_lending_summary(*events).withColumn("repay_event_count", F.when(F.dayofmonth("event_date") % 3 == 0, F.col("repay_event_count") + 1).otherwise(F.col("repay_event_count")))
    found = bad.agg(quality.repeated_keys(bad, ["event_id"]).alias("repeated_ids"), quality.nulls(quality.SILVER_REQUIRED).alias("rows_with_nulls"))
    grain, counts = quality.GRAINS["daily_borrow_activity"]
    violations = quality.grain_violations(parts[0].unionByName(parts[0]), grain, counts)
    return found.withColumns({"borrow_grain_violations": F.lit(violations).cast("long"), "unreconciled_days": F.lit(quality.unreconciled(parts, summary).count()).cast("long")})


def _scratch(spark: SparkSession, tag: str) -> str:
    """A new folder in the shared folder, or on a local master where none is set in a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or (f"file://{tempfile.mkdtemp()}" if spark.sparkContext.master.startswith("local[") else None)
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


@query(f"""
WITH {_RECORDS}, n AS (SELECT 'swaps' AS dataset, count(*) AS rows_n FROM s UNION ALL SELECT kind || '_events', count(*) FROM l GROUP BY 1
  UNION ALL SELECT 'swaps_per_minute', count(DISTINCT date_trunc('minute', kafka)) FROM s UNION ALL SELECT 'top_pools', count(DISTINCT pool) FROM s UNION ALL SELECT 'pipeline_summary', 1 UNION ALL SELECT 'recent_swaps', 100
  UNION ALL SELECT 'daily_borrow_activity', count(DISTINCT (CAST(ts AS DATE), reserve)) FROM l WHERE kind = 'borrow' UNION ALL SELECT 'daily_repayment_activity', count(DISTINCT (CAST(ts AS DATE), reserve)) FROM l WHERE kind = 'repay'
  UNION ALL SELECT 'daily_liquidation_activity', count(DISTINCT (CAST(ts AS DATE), reserve, payer)) FROM l WHERE kind = 'liquidation' UNION ALL SELECT 'daily_lending_summary', count(DISTINCT CAST(ts AS DATE)) FROM l
  UNION ALL SELECT 'swaps before the second batch', count(*) FROM (SELECT 1 FROM b WHERE again = 0 AND kind = 'swap' AND pool IS NOT NULL))
SELECT dataset, CAST(rows_n AS BIGINT) AS rows_n FROM n""")
def lake_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake from streamed Bronze in two batches to checked Gold: discovery, manifest, incremental merge, atomic publishing, input guards; rows of each dataset."""
    lake = pipeline.Lake(_scratch(spark, "lake"))
    records, rows = _records(spark, sf_dir), {}
    first = F.col("timestamp") == F.to_timestamp(F.get_json_object(F.col("value").cast("string"), "$.block_timestamp"))
    for k, batch in enumerate((records.where(first), records.where(~first))):
        batch.write.mode("append").parquet(f"{lake.root}/topic")
        stream = bronze.build(kafka.read_stream_files(spark, f"{lake.root}/topic"), lake.bronze)
        bronze.start(stream, lake.bronze, f"{lake.root}/checkpoint", once=True).awaitTermination()
        before, after = pipeline.run_swap_silver(spark, lake)
        rows |= {"swaps before the second batch": before} if k else {}
    if pipeline.run_swap_silver(spark, lake) is not None:
        raise AssertionError("files of the manifest were merged again")
    rows |= {"swaps": after, **pipeline.run_lending_silver(spark, lake), **pipeline.run_gold(spark, lake)}
    pipeline.run_checks(spark, lake)
    if {n: files.table(spark, lake.gold(n)).count() for n in pipeline.SWAP_GOLD} != {n: rows[n] for n in pipeline.SWAP_GOLD}:
        raise AssertionError("published rows are not the counted ones")
    return spark.createDataFrame(list(rows.items()), "dataset string, rows_n long")


def _other_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw logs of mints, burns, repayments and liquidations, by event_id % 4."""
    topics = {e.name: e.topic0 for name in ("uniswap_v3", "aave_v3") for e in default_registry().get(name).events}
    e, kind, i = _table(spark, sf_dir, "events").where("user_id IS NOT NULL"), F.col("event_id") % 4, F.col("event_id")
    topic = lambda word: F.concat(F.lit("0x"), word)
    user, number, below = _hex(F.col("user_id")), _hex(i + 1), F.concat(F.lit("f" * 56), F.substring(F.lower(F.hex(-(i % 1000) - 1)), 9, 8))
    wide, flag = F.concat(F.lit("8" + "0" * 47), F.lpad(F.lower(F.hex(i)), 16, "0")), _hex((i % 8 >= 4).cast("long"))
    first = F.element_at(F.array(*[F.lit(topics[n]) for n in ("mint", "burn", "repay", "liquidation")]), (kind + 1).cast("int"))
    others = F.when(kind < 2, F.array(topic(user), topic(below), topic(_hex(i % 1000)))).otherwise(F.array(topic(_hex(i % 7)), topic(_hex(i % 5)), topic(user)))
    data = F.when(kind == 0, F.concat(user, number, wide, number)).when(kind == 1, F.concat(number, wide, number)).when(kind == 2, F.concat(wide, flag)).otherwise(F.concat(wide, number, user, flag))
    return e.select(
        F.concat(F.lit("0xABCDEF"), _hex(F.col("user_id"), 34)).alias("address"), F.concat(F.array(first), others).alias("topics"), F.concat(F.lit("0x"), data).alias("data"),
        F.concat(F.lit("0x"), F.lower(F.hex(i))).alias("blockNumber"), F.concat(F.lit("0x"), _hex(i)).alias("transactionHash"), F.lit("0x0").alias("transactionIndex"), F.lit("0x0").alias("blockHash"),
        F.lit("0x2").alias("logIndex"), F.lit(False).alias("removed"),
    ).to(RAW_LOG)


_WIDE_SQL = "CAST(CAST('57896044618658097711785492504343953926634992332820282019728792003956564819968' AS BIGNUM) + CAST(event_id AS BIGNUM) AS VARCHAR)"


@query(f"""
WITH x AS (SELECT *, event_id % 4 AS k, '0x' || lpad(lower(to_hex(user_id)), 40, '0') AS account, '0x' || lpad(CAST(event_id % 7 AS VARCHAR), 40, '0') AS seven, '0x' || lpad(CAST(event_id % 5 AS VARCHAR), 40, '0') AS five,
  CAST(event_id + 1 AS VARCHAR) AS number, {_WIDE_SQL} AS wide FROM events WHERE user_id IS NOT NULL)
SELECT CAST(event_id AS INT) AS block, CASE k WHEN 0 THEN 'mint' WHEN 1 THEN 'burn' WHEN 2 THEN 'repay' ELSE 'liquidation' END AS event_type, 'decoded' AS status,
  CASE WHEN k < 2 THEN 'uniswap_v3' ELSE 'aave_v3' END AS protocol, CASE WHEN k < 2 THEN account END AS owner, CASE WHEN k < 2 THEN CAST(-(event_id % 1000) - 1 AS INT) END AS tick_lower,
  CASE WHEN k < 2 THEN CAST(event_id % 1000 AS INT) END AS tick_upper, CASE k WHEN 0 THEN account END AS sender, CASE WHEN k < 2 THEN number END AS amount, CASE WHEN k < 2 THEN wide END AS amount0,
  CASE WHEN k < 2 THEN number END AS amount1, CASE k WHEN 2 THEN seven END AS reserve, CASE k WHEN 2 THEN five WHEN 3 THEN account END AS "user", CASE k WHEN 2 THEN account END AS repayer,
  CASE k WHEN 2 THEN wide END AS amount_raw, CASE k WHEN 2 THEN event_id % 8 >= 4 END AS use_atokens, CASE k WHEN 3 THEN seven END AS collateral_asset, CASE k WHEN 3 THEN five END AS debt_asset,
  CASE k WHEN 3 THEN wide END AS debt_to_cover_raw, CASE k WHEN 3 THEN number END AS liquidated_collateral_amount_raw, CASE k WHEN 3 THEN account END AS liquidator, CASE k WHEN 3 THEN event_id % 8 >= 4 END AS receive_atoken
FROM x""")
def abi_decode_other_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mints, burns, repayments and liquidations."""
    ship(spark)
    names = "owner tick_lower tick_upper sender amount amount0 amount1 reserve user repayer amount_raw use_atokens collateral_asset debt_asset debt_to_cover_raw liquidated_collateral_amount_raw liquidator receive_atoken".split()
    found = ingest.decode(_other_logs(spark, sf_dir), default_registry().enabled(["uniswap_v3", "aave_v3"]), "arbitrum")
    return found.select(abi.hex_long(F.col("blockNumber")).cast("int").alias("block"), "event_type", "status", "protocol", *[F.col("payload")[n].alias(n) for n in names])


@query("""
SELECT CASE event_id % 4 WHEN 0 THEN 'mint' WHEN 1 THEN 'burn' ELSE NULL END AS event_type, CASE WHEN event_id % 4 < 2 THEN 'decoded' ELSE 'unsupported' END AS status, count(*) AS events
FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2""")
def plugin_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With one protocol enabled, the other one's logs are unsupported; counts by event type and route."""
    ship(spark)
    return ingest.progress(ingest.decode(_other_logs(spark, sf_dir), default_registry().enabled(["uniswap_v3"]), "arbitrum")).withColumnRenamed("count", "events")


@query("""
SELECT CAST(event_id AS INT) AS block, 'uniswap_v3' AS protocol FROM events WHERE event_id % 4 < 2 AND user_id IS NOT NULL
UNION ALL SELECT CAST(event_id AS INT), 'aave_v3' FROM events WHERE event_id % 4 >= 2 AND user_id = 7""")
def plugin_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the plugins subscribe to: one protocol by its topics alone, the other one at a single contract."""
    plugins = [UniswapV3(), AaveV3("0xABCDEF" + "7".rjust(34, "0"))]
    found = ingest.subscribed(_other_logs(spark, sf_dir), plugins)
    return found.select(abi.hex_long(F.col("blockNumber")).cast("int").alias("block"), F.when(plugins[0].can_handle(), "uniswap_v3").otherwise("aave_v3").alias("protocol"))


@query("SELECT CAST(event_id AS INT) AS block_number, date_trunc('second', ts) AS block_timestamp FROM events")
def block_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers with hex numbers, each seen twice, as the blocks dimension."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    headers = _table(spark, sf_dir, "events").select(F.concat(F.lit("0x"), F.lower(F.hex("event_id"))).alias("number"), F.concat(F.lit("0x"), F.lower(F.hex(seconds))).alias("timestamp"))
    return _plain(logs.blocks_from_headers(headers.unionByName(headers)), "block_number", "block_timestamp")


@query("SELECT CAST(event_id AS INT) AS block FROM events WHERE event_id % 4 IN (0, 3) AND user_id = 3")
def single_pool_swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = next(e.topic0 for e in UniswapV3.events if e.name == "swap")
    found = logs.pool_swaps(_logs(spark, sf_dir), "0xABCDEF" + "3".rjust(34, "0"), topic)
    return found.select(abi.hex_long(F.col("blockNumber")).cast("int").alias("block"))


@query("""
SELECT '0x' || lpad(lower(to_hex(event_id)), 64, '0') AS message_key, 'mint' AS event_type, CAST(event_id AS INT) AS block_number, '0x' || lpad(lower(to_hex(user_id)), 40, '0') AS owner,
  false AS has_reserve, CAST(event_id % 1000 AS INT) AS tick_upper FROM events WHERE event_id % 4 = 0 AND user_id IS NOT NULL""")
def kafka_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded logs as a topic's keys and values, read back: fields that an event lacks are left out."""
    ship(spark)
    decoded = ingest.decode(_other_logs(spark, sf_dir), default_registry().enabled(["uniswap_v3", "aave_v3"]), "arbitrum")
    found = kafka.messages(ingest.envelopes(decoded).where("event_type = 'mint'"))
    text = F.col("value").cast("string")
    event = F.from_json(text, ENVELOPE)
    return found.select(F.col("key").cast("string").alias("message_key"), event["event_type"].alias("event_type"), event["block_number"].alias("block_number"), event["payload"]["owner"].alias("owner"),
                        F.contains(text, F.lit("reserve")).alias("has_reserve"), event["payload"]["tick_upper"].alias("tick_upper"))


@query("""
SELECT CASE WHEN event_id % 3 <> 0 THEN 'arbitrum-0x' || lower(to_hex(event_id)) || '-' || CAST(event_id % 21 AS VARCHAR) END AS event_id, '0x' || lower(to_hex(user_id)) AS hex_user,
  CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS BIGINT) END AS number, 'legacy' AS producer_version, 'legacy' AS bronze_file, ts AS silver_processed_at FROM events WHERE user_id IS NOT NULL""")
def old_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of files that lack provenance, keys with a missing part, bytes as hex, and numbers as hex or not at all."""
    e = _table(spark, sf_dir, "events").where("user_id IS NOT NULL")
    i, user = F.col("event_id"), F.regexp_replace(F.lower(F.hex("user_id")), "^0+(?=.)", "")
    raw = e.select(F.lit("arbitrum").alias("chain"), F.when(i % 3 != 0, F.concat(F.lit("0x"), F.lower(F.hex(i)))).alias("transaction_hash"), (i % 21).alias("log_index"), F.col("ts").alias("ingested_at"),
                   F.regexp_replace(abi.hex_string(F.unhex(user)), "^0x0(?=.)", "0x").alias("hex_user"), abi.hex_long(F.when(i % 2 == 0, F.concat(F.lit("0x"), user)).otherwise("0xzz")).alias("number"))
    return compatible(raw.withColumn("event_id", event_id()), ["event_id", "hex_user", "number", "producer_version", "bronze_file", "silver_processed_at"])


@query("SELECT DISTINCT 'event_date=' || CAST(CAST(ts AS DATE) AS VARCHAR) || '/part-0.parquet' AS file FROM events WHERE day(ts) % 6 <> 0")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each day; those that a saved manifest, replaced once and loaded again, does not list yet."""
    root = _scratch(spark, "manifest")
    days = [r.day for r in _table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct().collect()]
    found = {f"{root}/event_date={d}/part-0.parquet": d for d in sorted(days)}
    for done in (list(found)[:3], [f for f, d in found.items() if d.day % 6 == 0]):
        files.save_manifest(spark, f"{root}.json", [files.manifest_entry(f, root) for f in done])
    left = files.unprocessed(found, files.load_manifest(spark, f"{root}.json"), root)
    return spark.createDataFrame([(files.manifest_entry(f, root),) for f in left], "file string")
