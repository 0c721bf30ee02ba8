import json

import pytest
from pyspark.sql import functions as F

from chainlake.functions import abi
from chainlake.operators import ingest
from chainlake.operators.plugins import AaveV3, Event, ProtocolPlugin, Registry, Subscription, UniswapV3, default_registry, parse_protocols
from chainlake.schema import ENVELOPE, PAYLOAD, RAW_LOG
from chainlake.sources import kafka, logs
from raw_logs import BORROW, BURN, LARGE, LIQUIDATION, MINT, REPAY, SWAP, TOPIC, addr, log

PLUGINS = default_registry().enabled(["uniswap_v3", "aave_v3"])


def decode(spark, *raw):
    frame = spark.createDataFrame([{k: r.get(k) for k in RAW_LOG.fieldNames()} for r in raw], RAW_LOG)
    return [r.asDict(recursive=True) for r in ingest.decode(frame, PLUGINS, "arbitrum").collect()]


EXPECTED = [
    (SWAP, "swap", {"sender": addr("20"), "recipient": addr("30"), "amount0": "-10", "amount1": "20", "sqrt_price_x96": str(2**96), "liquidity": "1000000", "tick": -120}),
    (MINT, "mint", {"owner": addr("40"), "sender": addr("20"), "tick_lower": -240, "tick_upper": 240, "amount": "500", "amount0": "1000", "amount1": "2000"}),
    (BURN, "burn", {"owner": addr("40"), "tick_lower": -120, "tick_upper": 120, "amount": "250", "amount0": "400", "amount1": "800"}),
    (BORROW, "borrow", {"reserve": addr("20"), "user": addr("30"), "on_behalf_of": addr("40"), "amount_raw": str(LARGE), "interest_rate_mode": 2, "borrow_rate_raw": str(LARGE - 1), "referral_code": 7}),
    (REPAY, "repay", {"reserve": addr("20"), "user": addr("30"), "repayer": addr("50"), "amount_raw": str(LARGE), "use_atokens": True}),
    (LIQUIDATION, "liquidation", {"collateral_asset": addr("60"), "debt_asset": addr("70"), "user": addr("30"), "debt_to_cover_raw": str(LARGE), "liquidated_collateral_amount_raw": str(LARGE - 1), "liquidator": addr("80"), "receive_atoken": False}),
]


def test_every_event_type_decodes(spark):
    rows = decode(spark, *[e[0] for e in EXPECTED])
    for row, (raw, kind, fields) in zip(rows, EXPECTED, strict=True):
        where = "pool_address" if kind in ("swap", "mint", "burn") else "contract_address"
        assert (row["status"], row["event_type"], row["chain"], row["block_number"], row["log_index"]) == ("decoded", kind, "arbitrum", 16, 2)
        payload = {k: v for k, v in row["payload"].items() if v is not None}
        assert payload == fields | {where: raw["address"].lower(), "raw_data": raw["data"], "raw_topics": raw["topics"]}
        assert row["transaction_hash"] == "0x" + "ab" * 32 and row["producer_version"] == row["schema_version"] == "1.0.0" and row["ingested_at"]


@pytest.mark.parametrize(
    ("raw", "status"),
    [
        (BORROW | {"data": "0x01"}, "malformed"),
        (SWAP | {"data": SWAP["data"][:-2]}, "malformed"),
        (SWAP | {"data": "0xzz" + SWAP["data"][4:]}, "malformed"),
        (SWAP | {"data": None}, "malformed"),
        (SWAP | {"topics": SWAP["topics"][:2]}, "malformed"),
        (SWAP | {"blockNumber": None}, "malformed"),
        (REPAY | {"data": REPAY["data"][:-1] + "2"}, "malformed"),
        (SWAP | {"topics": ["0x" + "ff" * 32]}, "unsupported"),
        (log(None, [], []), "unsupported"),
        (SWAP | {"topics": None}, "unsupported"),
        (SWAP | {"topics": [SWAP["topics"][0].upper().replace("0X", "0x"), *SWAP["topics"][1:]], "removed": True}, "decoded"),
    ],
)
def test_routes(spark, raw, status):
    row = decode(spark, raw)[0]
    assert row["status"] == status and (row["payload"] is not None) == (status == "decoded")


def test_wide_and_narrow_limits(spark):
    top = 2**256 - 1
    rows = decode(
        spark,
        log("swap", [addr("20"), addr("30")], [-(2**255), 2**255 - 1, top, 0, -(2**23)]),
        log("swap", [addr("20"), addr("30")], [0, 0, 0, 0, 2**23]),
    )
    p = rows[0]["payload"]
    assert (p["amount0"], p["amount1"], p["sqrt_price_x96"], p["tick"]) == (str(-(2**255)), str(2**255 - 1), str(top), -(2**23))
    assert rows[1]["status"] == "malformed"


def test_envelope_round_trip(spark):
    frame = spark.createDataFrame([SWAP, BORROW], RAW_LOG)
    found = kafka.messages(ingest.envelopes(ingest.decode(frame, PLUGINS, "arbitrum")))
    rows = found.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")).collect()
    assert [r.key for r in rows] == ["0x" + "ab" * 32] * 2
    first = json.loads(rows[0].value)
    assert set(first) | {"block_timestamp"} == set(ENVELOPE.fieldNames()) and first["payload"]["tick"] == -120


def test_hex_helpers(spark):
    row = spark.range(1).select(
        abi.hex_long(F.lit("0x1F")).alias("a"), abi.hex_long(F.lit("31")).alias("b"), abi.hex_long(F.lit("x")).alias("c"), abi.hex_string(F.lit(b"\xab\x01")).alias("d")
    ).first()
    assert tuple(row) == (31, 31, None, "0xab01")


def test_block_times_and_subscriptions(spark):
    frame = spark.createDataFrame([SWAP, BORROW | {"blockNumber": "0x11"}, log(None, [], [])], RAW_LOG)
    headers = spark.createDataFrame([("0x10", "0x65000000"), ("0x10", "0x65000000"), (None, None)], "number string, timestamp string")
    timed = ingest.with_block_time(frame, logs.blocks_from_headers(headers))
    assert [r.block_timestamp is not None for r in timed.orderBy("blockNumber").collect()] == [True, True, False]
    wanted = ingest.subscribed(frame, [UniswapV3(), AaveV3(SWAP["address"].upper().replace("0X", "0x"))])
    assert wanted.count() == 2
    assert ingest.subscribed(frame, [AaveV3(addr("99"))]).count() == 0
    assert logs.pool_swaps(frame, SWAP["address"], TOPIC["swap"]).count() == 1


class Stub(ProtocolPlugin):
    def __init__(self, protocol, topic):
        self._protocol, self._events = protocol, (Event("stub", topic, 1, 0, (), "contract_address"),)

    protocol = property(lambda self: self._protocol)
    events = property(lambda self: self._events)


def test_registry():
    registry = Registry([Stub("a", "0x1"), Stub("b", "0x2")])
    assert registry.topics(["b", "a", "b"]) == ["0x2", "0x1"]
    with pytest.raises(ValueError, match="registered already"):
        registry.register(Stub("a", "0x3"))
    with pytest.raises(ValueError, match="topics of another"):
        registry.register(Stub("c", "0x2"))
    with pytest.raises(ValueError, match="there are a, b"):
        registry.get("z")
    with pytest.raises(ValueError, match="address"):
        AaveV3("0x12").subscriptions()
    assert AaveV3().event_types == ("borrow", "repay", "liquidation")
    assert isinstance(UniswapV3().subscriptions()[0], Subscription)


def test_protocol_lists():
    assert parse_protocols(" b, a,b ,") == ["b", "a"]
    assert parse_protocols(None, "x") == parse_protocols(" ", "x") == ["x"]
    with pytest.raises(ValueError):
        parse_protocols(",", "x")


def test_payload_has_all_fields():
    names = {f.name for p in PLUGINS for e in p.events for f in e.fields}
    assert names <= set(PAYLOAD.fieldNames()) and len(PAYLOAD.fieldNames()) == 30


def test_single_log(spark):
    out = ingest.parse_swap_log(SWAP, "arbitrum", block_timestamp="2026-07-20T00:00:00Z", spark=spark)
    assert out["payload"]["tick"] == -120 and out["block_timestamp"].startswith("2026")
    with pytest.raises(ValueError, match="malformed"):
        ingest.parse_swap_log(SWAP | {"data": "0x"}, "arbitrum", spark=spark)


def test_node_requests():
    assert logs.subscription_request(["0x1"], ["0xa"])["params"] == ["logs", {"topics": [["0x1"]], "address": "0xa"}]
    assert logs.subscription_request(["0x1", "0x2"], ["0xa", "0xb"])["params"][1]["address"] == ["0xa", "0xb"]



class Socket:
    """A node: it confirms subscriptions, sends logs, and knows blocks and logs by number."""

    def __init__(self, logs, blocks):
        self.logs, self.blocks, self.sent, self.out = list(logs), blocks, [], []

    def send(self, text):
        request = json.loads(text)
        self.sent.append(request)
        answer = {"eth_subscribe": lambda p: "0x9", "eth_getBlockByNumber": lambda p: {"timestamp": self.blocks[p[0]]} if p[0] in self.blocks else None,
                  "eth_getLogs": lambda p: [x for x in self.all if int(p[0]["fromBlock"], 16) <= int(x["blockNumber"], 16) <= int(p[0]["toBlock"], 16) and x["topics"][0] in p[0]["topics"][0]]}
        if request["method"] == "eth_getBlockByNumber" and self.logs:
            self.out.append({"params": {"result": self.logs.pop(0)}})  # a log comes before the answer
        self.out.append({"id": request["id"], "result": answer[request["method"]](request["params"])})

    def recv(self):
        if self.out:
            return json.dumps(self.out.pop(0))
        if self.logs:
            return json.dumps({"params": {"result": self.logs.pop(0)}})
        raise TimeoutError


def test_node_reader():
    late = [SWAP | {"blockNumber": hex(n)} for n in (16, 17, 17)] + [BORROW | {"blockNumber": "0x12"}]
    socket = Socket(late, {"0x10": "0x65000000", "0x11": "0x65000001"})
    socket.all = late
    subscriptions = [{"topics": [TOPIC["swap"]]}, {"topics": [TOPIC["borrow"]], "addresses": ["0xa"]}]
    options = {"url": "ws://x", "subscriptions": json.dumps(subscriptions), "batch": "3", "wait": "0.5"}
    reader = logs.NodeLogReader(options, connect=lambda url, timeout: socket)
    rows, offset = reader.read(reader.initialOffset())
    first = list(rows)
    assert [r["method"] for r in socket.sent[:2]] == ["eth_subscribe"] * 2 and socket.sent[1]["params"][1]["address"] == "0xa" and "address" not in socket.sent[0]["params"][1]
    assert len(first) == 3 and [r[-1].timestamp() for r in first] == [0x65000000, 0x65000001, 0x65000001] and offset == {"received": 3, "block": 17}
    assert sum(r["method"] == "eth_getBlockByNumber" for r in socket.sent) == 2
    rows, last = reader.read(offset)
    rows = list(rows)
    assert len(rows) == 1 and rows[0][-1] is None and last == {"received": 4, "block": 18}  # the node does not know that block
    assert list(reader.read(last)[0]) == [] and reader.read(last)[1] == last
    again = logs.NodeLogReader(options, connect=lambda url, timeout: socket)
    assert [r[3] for r in again.readBetweenOffsets(offset, last)] == ["0x11", "0x11", "0x12"]  # at least what that batch had
    assert list(again.readBetweenOffsets(last, last)) == []
    socket.out.append({"error": {"code": 1}})
    with pytest.raises(RuntimeError, match="refused"):
        reader.read(last)


def test_from_the_node_to_gold(spark, tmp_path):
    """Raw logs with block times through the producer's steps, Bronze and Silver to Gold with a day."""
    from chainlake.plans import pipeline
    from chainlake.sources import files, kafka
    from chainlake.streaming import bronze

    socket = Socket([SWAP, BORROW, REPAY, LIQUIDATION], {"0x10": "0x65000000"})
    reader = logs.NodeLogReader({"url": "ws://x", "subscriptions": json.dumps([{"topics": list(TOPIC.values())}]), "wait": "0.5"}, connect=lambda url, timeout: socket)
    raw = spark.createDataFrame(list(reader.read(reader.initialOffset())[0]), logs.NodeLogs({}).schema())
    lake = pipeline.Lake(str(tmp_path))
    envelopes = ingest.envelopes(ingest.decode(ingest.subscribed(raw, [UniswapV3(), AaveV3(BORROW["address"])]), PLUGINS, "arbitrum"))
    kafka.as_records(kafka.messages(envelopes)).write.parquet(f"{lake.root}/topic")
    bronze.start(bronze.build(kafka.read_stream_files(spark, f"{lake.root}/topic"), lake.bronze), lake.bronze, f"{lake.root}/checkpoint", once=True).awaitTermination()
    pipeline.run_silver(spark, lake)
    pipeline.run_gold(spark, lake)
    pipeline.run_checks(spark, lake)
    days = {n: [str(r.event_date) for r in files.table(spark, lake.gold(n)).collect()] for n in pipeline.LENDING_GOLD}
    assert days == {n: ["2023-09-12"] for n in pipeline.LENDING_GOLD}
    assert files.table(spark, lake.gold("daily_borrow_activity")).first().total_borrow_amount_raw == str(LARGE)
