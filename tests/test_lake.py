"""Bronze to Gold on fixtures with values worked out by hand."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from chainlake.plans import dashboard, gold, pipeline, quality, silver
from chainlake.schema import BRONZE_PARTITIONS, KAFKA, PAYLOAD
from chainlake.sources import files
from chainlake.sources.kafka import read_stream_files
from chainlake.streaming import bronze

LARGE = 2**255 + 12345
UTC = dt.UTC
DAY = dt.datetime(2026, 7, 20, tzinfo=UTC)


def record(offset, value, time=DAY, key=b"0xabc"):
    return (key, value if value is None or isinstance(value, bytes) else json.dumps(value).encode(), "t", 0, offset, time, 0)


def envelope(protocol="uniswap_v3", kind="swap", tx="0xabc", block=123, payload=None, **other):
    return {"protocol": protocol, "chain": "arbitrum", "event_type": kind, "block_number": block, "transaction_hash": tx, "log_index": 2, "producer_version": "1.0.0",
            "schema_version": "1.0.0", "ingested_at": "2026-07-20T00:00:01Z", "payload": {"pool_address": "0xpool", "raw_data": "0xdata", "raw_topics": ["0xtopic"]} if payload is None else payload} | other


def stream(spark, root, records, name):
    spark.createDataFrame(records, KAFKA).coalesce(1).write.mode("append").parquet(f"{root}/topic")
    rows = bronze.build(read_stream_files(spark, f"{root}/topic"), f"{root}/bronze")
    bronze.start(rows, f"{root}/bronze", f"{root}/checkpoint", once=True).awaitTermination()


def lending_records():
    b = {"reserve": "0xr", "user": "0xu", "on_behalf_of": "0xo", "amount_raw": str(LARGE), "interest_rate_mode": 2, "borrow_rate_raw": str(LARGE), "referral_code": 7}
    r = {"reserve": "0xr", "user": "0xu", "repayer": "0xp", "amount_raw": str(LARGE), "use_atokens": True}
    x = {"collateral_asset": "0xc", "debt_asset": "0xd", "user": "0xu", "debt_to_cover_raw": str(LARGE), "liquidated_collateral_amount_raw": "7", "liquidator": "0xl", "receive_atoken": False}
    time = {"block_timestamp": "2026-07-21T00:05:00Z"}
    return [
        record(10, envelope("aave_v3", "borrow", "0xborrow", payload=b, **time)),
        record(11, envelope("aave_v3", "repay", "0xrepay", payload=r, **time)),
        record(12, envelope("aave_v3", "liquidation", "0xliq", payload=x, **time)),
        record(13, envelope("uniswap_v3", "borrow", "0xwrong", payload={"amount_raw": "1"})),
    ]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    late = dt.datetime(2026, 7, 20, 23, 59, 59, 999999, tzinfo=UTC)
    records = [
        record(0, envelope()),
        record(1, envelope(), DAY + dt.timedelta(seconds=5)),  # the same event, later
        record(2, envelope(tx="0xdef"), late),
        record(3, b"garbage"),
        record(4, None),
        record(5, envelope(tx="0xbig", block=2**31)),
        record(6, envelope(tx="0xextra", payload={"pool_address": "0xp2", "unknown": 1}, ingested_at=None)),
        record(7, envelope(kind="mint", tx="0xmint")),
        *lending_records(),
    ]
    stream(spark, root, records, "a")
    return pipeline.Lake(root)


def test_bronze(spark, lake):
    rows = spark.read.parquet(lake.bronze)
    assert rows.count() == 12 and len(rows.columns) == 22 and rows.columns[-4:] == BRONZE_PARTITIONS
    assert rows.where("event_date = '2026-07-20' AND transaction_hash = '0xdef'").count() == 1
    assert rows.where("json_value = 'garbage'").first().protocol in (None, "__HIVE_DEFAULT_PARTITION__")
    assert rows.where("transaction_hash = '0xbig'").first().block_number is None
    extra = rows.where("transaction_hash = '0xextra'").first()
    assert extra.pool_address == "0xp2" and extra.ingested_at is not None and '"unknown"' in extra.json_value
    assert rows.where("transaction_hash = '0xabc'").first().bronze_file.endswith("/protocol=uniswap_v3/chain=arbitrum/event_type=swap/event_date=2026-07-20")
    assert tuple(bronze.bad_records(rows).first()) == (12, 2, 1)


def test_incremental_silver_gold_and_checks(spark, lake):
    assert pipeline.run_swap_silver(spark, lake) == (0, 3)
    assert pipeline.run_swap_silver(spark, lake) is None  # nothing new
    table = spark.read.parquet(lake.silver("swaps"))
    assert len(table.columns) == 19 and table.where("event_id = 'arbitrum-0xabc-2'").first().kafka_timestamp.second == 5
    stream(spark, lake.root, [record(20, envelope(tx="0xnew"), DAY + dt.timedelta(minutes=1)), record(21, envelope(), DAY + dt.timedelta(minutes=2))], "b")
    assert pipeline.run_swap_silver(spark, lake) == (3, 4)
    assert spark.read.parquet(lake.silver("swaps")).where("event_id = 'arbitrum-0xabc-2'").first().kafka_timestamp.minute == 2

    assert pipeline.run_lending_silver(spark, lake) == {"borrow_events": 1, "repay_events": 1, "liquidation_events": 1}
    borrow = spark.read.parquet(lake.silver("borrow_events"))
    assert [len(spark.read.parquet(lake.silver(m.name)).columns) for m in silver.MODELS] == [27, 25, 27]
    assert borrow.first().amount_raw == str(LARGE) and borrow.schema["interest_rate_mode"].dataType.typeName() == "integer"

    found = pipeline.run_gold(spark, lake)
    assert found == {"swaps_per_minute": 4, "top_pools": 2, "pipeline_summary": 1, "recent_swaps": 4, "daily_borrow_activity": 1, "daily_repayment_activity": 1, "daily_liquidation_activity": 1, "daily_lending_summary": 1}
    widths = {"swaps_per_minute": 15, "top_pools": 16, "pipeline_summary": 19, "recent_swaps": 18, "daily_borrow_activity": 16, "daily_repayment_activity": 16, "daily_liquidation_activity": 18, "daily_lending_summary": 17}
    for name, width in widths.items():
        table = spark.read.parquet(lake.gold(name))
        assert len(table.columns) == width, name
        assert table.agg(quality.nulls([c for c in quality.GOLD_REQUIRED if c in table.columns])).first()[0] == 0
    day = spark.read.parquet(lake.gold("daily_lending_summary")).first()
    assert (str(day.event_date), day.borrow_event_count, day.unique_liquidators) == ("2026-07-21", 1, 1)
    pipeline.run_checks(spark, lake)
    assert dashboard.kpis(spark, lake)["total_swaps"] == 4
    assert dashboard.swaps_over_time(spark, lake)["swap_count"].sum() == 4
    assert len(dashboard.top_pools(spark, lake)) == 2 and list(dashboard.recent_swaps(spark, lake, 3)["event_id"])[0] == "arbitrum-0xdef-2"
    with pytest.raises(FileNotFoundError):
        dashboard.read(spark, lake.gold("nothing"))


def test_silver_survives_a_crash_while_it_is_swapped(spark, tmp_path, monkeypatch):
    crashed = pipeline.Lake(str(tmp_path))
    stream(spark, crashed.root, [record(i, envelope(tx=f"0x{i}")) for i in range(5)], "a")
    assert pipeline.run_swap_silver(spark, crashed) == (0, 5)
    stream(spark, crashed.root, [record(10 + i, envelope(tx=f"0xnew{i}")) for i in range(2)], "b")
    move, settle, moves = files._move, files.settle, []

    def dying_move(fs, a, b):
        if moves:
            raise KeyboardInterrupt
        moves.append(b)
        move(fs, a, b)

    monkeypatch.setattr(files, "_move", dying_move)
    monkeypatch.setattr(files, "settle", lambda *_: None)
    with pytest.raises(KeyboardInterrupt):
        pipeline.run_swap_silver(spark, crashed)
    monkeypatch.setattr(files, "_move", move)
    monkeypatch.setattr(files, "settle", settle)
    assert pipeline.run_swap_silver(spark, crashed) == (5, 7)
    fs, p = files._fs(spark, crashed.silver("swaps"))
    fs.delete(p, True)
    stream(spark, crashed.root, [record(20, envelope(tx="0xlast"))], "c")
    with pytest.raises(FileNotFoundError, match="their table is missing"):
        pipeline.run_swap_silver(spark, crashed)


COMMON = "protocol string, chain string, event_date date, block_timestamp timestamp, transaction_hash string, log_index int, kafka_timestamp timestamp, ingested_at timestamp, producer_version string, schema_version string, bronze_processed_at timestamp, bronze_file string, silver_processed_at timestamp, silver_job_version string"


def events(spark, rows, extra):
    def common(tx, i, seconds):
        t = dt.datetime(2026, 7, 21, tzinfo=UTC)
        return ("aave_v3", "arbitrum", dt.date(2026, 7, 20), t + dt.timedelta(minutes=5), tx, i, t + dt.timedelta(seconds=seconds), t, "1.0.0", "1.0.0", t, "f", t, "1.0.0")

    return gold.lending_events(spark.createDataFrame([common(*r[:3]) + tuple(r[3:]) for r in rows], f"{COMMON}, {extra}"))


@pytest.fixture(scope="module")
def lending(spark):
    borrows = [("0xb1", 1, 2, "ra", "u1", str(LARGE), 2), ("0xb1", 1, 0, "ra", "u1", "999", 1), ("0xb2", 2, 2, "ra", "u2", "7", 1), ("0xb3", 3, 2, "rb", "u1", "5", 2)]
    repays = [("0xr1", 1, 2, "ra", "u1", "x", "10", True), ("0xr2", 2, 2, "ra", "u2", "x", "20", False), ("0xr3", 3, 2, "rb", "u1", "y", "30", True)]
    liquidations = [("0xl1", 1, 2, "ca", "da", "u1", "100", "200", "x", True), ("0xl2", 2, 2, "ca", "da", "u2", "50", "70", "y", False), ("0xl3", 3, 2, "cb", "da", "u1", "9", "11", "x", True)]
    return (
        events(spark, borrows, "reserve string, user string, amount_raw string, interest_rate_mode int"),
        events(spark, repays, "reserve string, user string, repayer string, amount_raw string, use_atokens boolean"),
        events(spark, liquidations, "collateral_asset string, debt_asset string, user string, debt_to_cover_raw string, liquidated_collateral_amount_raw string, liquidator string, receive_atoken boolean"),
    )


def test_lending_gold(lending):
    b, r, x = lending
    rows = [tuple(y)[3:9] for y in gold.daily_borrow_activity(b).collect()]
    assert rows == [("ra", 2, 2, str(LARGE + 7), 1, 1), ("rb", 1, 1, "5", 1, 0)]
    rows = [tuple(y)[3:9] for y in gold.daily_repayment_activity(r).collect()]
    assert rows == [("ra", 2, 2, 1, "30", 1), ("rb", 1, 1, 1, "30", 1)]
    rows = [tuple(y)[3:11] for y in gold.daily_liquidation_activity(x).collect()]
    assert rows == [("ca", "da", 2, 2, 2, "150", "270", 1), ("cb", "da", 1, 1, 1, "9", "11", 1)]
    rows = [tuple(y)[:10] for y in gold.daily_lending_summary(b, r, x).collect()]
    assert rows == [(dt.date(2026, 7, 21), "aave_v3", "arbitrum", 3, 3, 3, 2, 2, 2, 2)]
    assert gold.daily_lending_summary(*[e.limit(0) for e in lending]).count() == 0


def test_quality_finds_faults(lending):
    b, r, x = lending
    a, s = gold.daily_borrow_activity(b), gold.daily_lending_summary(b, r, x)
    assert quality.grain_violations(a, *quality.GRAINS["daily_borrow_activity"]) == 0
    assert quality.grain_violations(a.union(a), *quality.GRAINS["daily_borrow_activity"]) == 2
    assert quality.grain_violations(a.withColumn("reserve_address", F.lit(None).cast("string")), *quality.GRAINS["daily_borrow_activity"]) > 0
    parts = [a, gold.daily_repayment_activity(r), gold.daily_liquidation_activity(x)]
    assert quality.unreconciled(parts, s).count() == 0
    assert quality.unreconciled(parts, s.withColumn("repay_event_count", F.lit(4).cast("long"))).count() == 1
    assert quality.unreconciled(parts, s.limit(0)).count() == 1
    with pytest.raises(quality.DataQualityError):
        quality.run_check("x", 0)
    with pytest.raises(quality.DataQualityError):
        quality.run_check("x", 1, 0)


def test_lending_gold_inputs(spark, lending, tmp_path):
    lake = pipeline.Lake(str(tmp_path))
    assert pipeline.run_lending_gold(spark, lake) == {}
    files.publish(lending[0], lake.silver("borrow_events"))
    with pytest.raises(FileNotFoundError, match="missing inputs"):
        pipeline.run_lending_gold(spark, lake)
    for e, m in zip(lending, silver.MODELS, strict=True):
        files.publish(e.limit(0), lake.silver(m.name))
    assert set(pipeline.run_lending_gold(spark, lake).values()) == {0}
    assert quality.check_lending(spark, f"{lake.root}/gold")
    fs, p = files._fs(spark, f"{lake.root}/silver")
    fs.delete(p, True)
    with pytest.raises(FileNotFoundError, match="stale"):
        pipeline.run_lending_gold(spark, lake)
    assert not quality.check_lending(spark, f"{lake.root}/none")


def test_old_files(spark):
    old = spark.createDataFrame([("aave_v3", "c", "borrow", "0x1", 1, 1, ("r", "5"))], "protocol string, chain string, event_type string, transaction_hash string, log_index int, block_number int, payload struct<reserve: string, amount_raw: string>")
    for c in ("event_date", "block_timestamp", "kafka_timestamp", "ingested_at", "producer_version", "schema_version", "bronze_processed_at", "bronze_file"):
        old = old.withColumn(c, F.lit(None).cast("string" if c.endswith(("version", "file")) else "date" if c == "event_date" else "timestamp"))
    row = silver.lending(old, silver.MODELS[0]).first()
    assert (row.event_id, row.reserve, row.amount_raw, row.user, row.raw_topics) == ("c-0x1-1", "r", "5", None, None)
    with pytest.raises(ValueError, match="pool_address"):
        silver.swaps(old.drop("pool_address"))
    assert len(PAYLOAD.fieldNames()) == 30
