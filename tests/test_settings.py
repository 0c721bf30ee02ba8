import json
import os
import signal
import threading
import time

import pytest

from chainlake import __main__ as cli
from chainlake.operators import ingest
from chainlake.operators.plugins import default_registry
from chainlake.schema import RAW_LOG
from chainlake.settings import Settings
from chainlake.sources import kafka
from chainlake.streaming import bronze
from raw_logs import BORROW, SWAP


def test_environment():
    s = Settings.from_env({"ENABLED_PROTOCOLS": " aave_v3, uniswap_v3,aave_v3 ", "LAKE_ROOT": "/lake"})
    assert s.protocols == ("aave_v3", "uniswap_v3") and s.chain == "arbitrum" and s.checkpoint == "/lake/checkpoints/bronze"
    assert Settings.from_env({}).protocols == ("uniswap_v3",) and Settings.from_env({"PROTOCOL": "aave_v3"}).protocols == ("aave_v3",)
    with pytest.raises(ValueError, match="NODE_WEBSOCKET_URL"):
        s.required("NODE_WEBSOCKET_URL")


def test_jobs_are_checked_first():
    assert cli.main([]) == cli.main(["nothing"]) == 2
    with pytest.raises(ValueError, match="AAVE_V3_POOL_ADDRESS"):
        cli.producer(Settings.from_env({"ENABLED_PROTOCOLS": "aave_v3"}))
    with pytest.raises(ValueError, match="unknown protocol"):
        cli.producer(Settings.from_env({"ENABLED_PROTOCOLS": "other"}))


def test_progress():
    log = bronze.ProgressLog(100)
    assert [log.add({"decoded": n, "malformed": 1}) for n in (0, 1, 50, 49, 1, 250)] == [False, True, False, True, False, True]
    assert log.totals == {"decoded": 351, "unsupported": 0, "malformed": 6}


def test_stream_of_raw_logs_stops_on_a_signal(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text("\n".join(json.dumps(x) for x in (SWAP, BORROW, {**SWAP, "data": "0x"})))
    plugins = default_registry().enabled(["uniswap_v3", "aave_v3"])
    raw = kafka.read_log_files(spark, str(tmp_path / "in"), streaming=True)
    assert raw.schema == RAW_LOG
    found = kafka.messages(ingest.envelopes(bronze.observed(ingest.decode(raw, plugins, "arbitrum"))))
    query = found.writeStream.format("memory").queryName("found").start()
    query.processAllAvailable()
    assert spark.table("found").count() == 2
    threading.Thread(target=lambda: (time.sleep(1), os.kill(os.getpid(), signal.SIGTERM))).start()
    bronze.until_stopped(query)
    assert not query.isActive
