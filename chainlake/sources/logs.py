"""Subscriptions to a node as Spark sources. The engine reads replayed files; a node's websocket is a Python data source, usable
where the `websocket` client is installed."""

from __future__ import annotations

import json
import time
from collections import OrderedDict, deque
from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from chainlake.functions.abi import hex_long
from chainlake.schema import BLOCKS, RAW_LOG

#: Block times that a reader remembers.
BLOCK_TIMES = 256


def subscription_request(topics: list[str], addresses: list[str] = (), request_id: int = 1) -> dict:  # type: ignore[assignment]
    """The JSON-RPC request for logs with any of the topics, of one or several addresses if given."""
    wanted: dict = {"topics": [list(topics)]}
    if addresses:
        wanted["address"] = addresses[0] if len(addresses) == 1 else list(addresses)
    return {"jsonrpc": "2.0", "id": request_id, "method": "eth_subscribe", "params": ["logs", wanted]}


def blocks_from_headers(headers: DataFrame) -> DataFrame:
    """Block headers with hex numbers (number, timestamp) to the blocks dimension, each number once."""
    return headers.select(hex_long(F.col("number")).cast("int").alias("block_number"), F.timestamp_seconds(hex_long(F.col("timestamp"))).alias("block_timestamp")).dropna().groupBy("block_number").agg(F.max("block_timestamp").alias("block_timestamp"))


def pool_swaps(logs: DataFrame, pool: str, topic0: str) -> DataFrame:
    return logs.where((F.lower("address") == pool.lower()) & (F.lower(F.try_element_at("topics", F.lit(1))) == topic0))


class NodeLogs(DataSource):
    """`spark.dataSource.register(NodeLogs)`, then `readStream.format("node_logs").option("url", ...).option("subscriptions", JSON)`: a list of objects
    with "topics" and, where the contracts are known, "addresses"; the node gets one subscription for each."""

    @classmethod
    def name(cls) -> str:
        return "node_logs"

    def schema(self) -> StructType:
        return StructType([*RAW_LOG.fields, *BLOCKS.fields[1:]])

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return NodeLogReader(self.options)


class NodeLogReader(SimpleDataSourceStreamReader):
    """Logs of a node's subscriptions, with the times of their blocks. A batch is what has come within `wait` seconds, `batch` logs at most. Its offset holds
    the last block it has logs of, so a batch that a restart asks for again is fetched from the node by block range. That gives its logs at least
    once; Silver settles repeats."""

    def __init__(self, options: dict, connect=None):
        self.options, self._connect, self._socket = options, connect, None
        self._id, self._waiting, self._times = 0, deque(), OrderedDict()

    def _wanted(self) -> list[dict]:
        return json.loads(self.options["subscriptions"])

    def _open(self):
        if self._socket is None:
            connect = self._connect
            if connect is None:
                from websocket import create_connection as connect  # gated: not part of the base installation
            self._socket = connect(self.options["url"], timeout=float(self.options.get("timeout", 30)))
            for one in self._wanted():
                request = subscription_request(one["topics"], one.get("addresses", ()))
                self._ask(request["method"], request["params"])
        return self._socket

    def _receive(self) -> dict:
        message = json.loads(self._socket.recv())
        if "error" in message:
            raise RuntimeError(f"the node refused a request: {message['error']}")
        return message

    def _ask(self, method: str, params: list):
        """The node's answer; logs that come before it wait for the next batch."""
        self._id += 1
        self._socket.send(json.dumps({"jsonrpc": "2.0", "id": self._id, "method": method, "params": params}))
        while True:
            message = self._receive()
            if message.get("id") == self._id:
                return message.get("result")
            if log := message.get("params", {}).get("result"):
                self._waiting.append(log)

    def _time(self, number: str | None) -> datetime | None:
        """A block's time, asked for once; null if the node does not know the block."""
        if number is None:
            return None
        if number not in self._times:
            block = self._ask("eth_getBlockByNumber", [number, False])
            if not block:
                return None
            self._times[number] = datetime.fromtimestamp(int(block["timestamp"], 16), UTC)
            if len(self._times) > BLOCK_TIMES:
                self._times.popitem(last=False)
        return self._times[number]

    def _row(self, log: dict) -> tuple:
        return (*(log.get(f) for f in RAW_LOG.fieldNames()), self._time(log.get("blockNumber")))

    def initialOffset(self) -> dict:
        return {"received": 0, "block": None}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        socket, most, until = self._open(), int(self.options.get("batch", 1000)), time.monotonic() + float(self.options.get("wait", 1))
        while len(self._waiting) < most and (left := until - time.monotonic()) > 0:
            if hasattr(socket, "settimeout"):
                socket.settimeout(left)
            try:
                message = self._receive()
            except (TimeoutError, *_timeouts()):
                break
            if log := message.get("params", {}).get("result"):
                self._waiting.append(log)
        if hasattr(socket, "settimeout"):
            socket.settimeout(float(self.options.get("timeout", 30)))
        found = [self._waiting.popleft() for _ in range(min(most, len(self._waiting)))]
        rows = [self._row(log) for log in found]
        block = max([int(x["blockNumber"], 16) for x in found if x.get("blockNumber")], default=start["block"])
        return iter(rows), {"received": start["received"] + len(rows), "block": block if start["block"] is None else max(block, start["block"])}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        if end["received"] == start["received"] or end["block"] is None:
            return iter(())
        self._open()
        first = end["block"] if start["block"] is None else start["block"]
        rows = []
        for one in self._wanted():
            wanted = subscription_request(one["topics"], one.get("addresses", ()))["params"][1]
            rows += [self._row(log) for log in self._ask("eth_getLogs", [wanted | {"fromBlock": hex(first), "toBlock": hex(end["block"])}]) or ()]
        return iter(rows)


def _timeouts() -> tuple[type[Exception], ...]:
    try:
        from websocket import WebSocketTimeoutException
    except ImportError:
        return ()
    return (WebSocketTimeoutException,)
