"""Raw logs as a node would send them."""

from chainlake.operators.plugins import default_registry

TOPIC = {e.name: e.topic0 for p in ("uniswap_v3", "aave_v3") for e in default_registry().get(p).events}
LARGE = 2**255 + 12345


def addr(byte: str) -> str:
    return "0x" + byte * 20


def word(value: int | str | bool) -> str:
    if isinstance(value, str):
        return value.removeprefix("0x").rjust(64, "0")
    return format(int(value) % 2**256, "064x")


def log(event: str | None, topics: list, data: list, **other) -> dict:
    first = [TOPIC[event]] if event else []
    return {
        "address": "0x" + "10" * 10 + "AB" * 10, "topics": first + ["0x" + word(t) for t in topics], "data": "0x" + "".join(map(word, data)), "blockNumber": "0x10",
        "transactionHash": "0x" + "ab" * 32, "transactionIndex": "0x0", "blockHash": "0x" + "cd" * 32, "logIndex": "0x2", "removed": False,
    } | other


SWAP = log("swap", [addr("20"), addr("30")], [-10, 20, 2**96, 1000000, -120])
MINT = log("mint", [addr("40"), -240, 240], [addr("20"), 500, 1000, 2000])
BURN = log("burn", [addr("40"), -120, 120], [250, 400, 800])
BORROW = log("borrow", [addr("20"), addr("40"), 7], [addr("30"), LARGE, 2, LARGE - 1])
REPAY = log("repay", [addr("20"), addr("30"), addr("50")], [LARGE, True])
LIQUIDATION = log("liquidation", [addr("60"), addr("70"), addr("30")], [LARGE, LARGE - 1, addr("80"), False])
