"""Protocols as plugins: which logs are theirs, and their events' fields as column expressions."""

from __future__ import annotations

import re
from abc import ABC, abstractmethod
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainlake.functions import abi


@dataclass(frozen=True)
class Field:
    """A payload field: the word that holds it (topic 1 to 3, or data word) and its ABI type."""

    name: str
    place: str
    index: int
    kind: str

    def word(self) -> Column:
        return abi.topic_word(self.index) if self.place == "topic" else abi.data_word(self.index)


@dataclass(frozen=True)
class Event:
    """An event type: its topic0, how many topics and data words it has, and its fields."""

    name: str
    topic0: str
    topics: int
    words: int
    fields: tuple[Field, ...]
    address_field: str


@dataclass(frozen=True)
class Subscription:
    """Logs with any of the topics, of any of the addresses if there are some."""

    topics: tuple[str, ...]
    addresses: tuple[str, ...] = field(default=())

    def predicate(self) -> Column:
        found = abi.topic(0).isin(*self.topics)
        return found & F.lower("address").isin(*[a.lower() for a in self.addresses]) if self.addresses else found


class ProtocolPlugin(ABC):
    """What a protocol adds. Everything is an expression over raw log columns, evaluated by the executors."""

    @property
    @abstractmethod
    def protocol(self) -> str: ...

    @property
    @abstractmethod
    def events(self) -> tuple[Event, ...]: ...

    @property
    def subscription_topics(self) -> tuple[str, ...]:
        return tuple(e.topic0 for e in self.events)

    @property
    def event_types(self) -> tuple[str, ...]:
        return tuple(e.name for e in self.events)

    def subscriptions(self) -> tuple[Subscription, ...]:
        return (Subscription(self.subscription_topics),)

    def can_handle(self) -> Column:
        return F.coalesce(abi.topic(0).isin(*self.subscription_topics), F.lit(False))


def _fields(*texts: str) -> tuple[Field, ...]:
    """Fields from "name place index type"."""
    return tuple(Field(name, place, int(index), kind) for name, place, index, kind in map(str.split, texts))


class UniswapV3(ProtocolPlugin):
    """Concentrated-liquidity pools: swap, mint and burn. Topics are fixed values, the Keccak-256 of the events' signatures."""

    protocol = "uniswap_v3"
    events = (
        Event(
            "swap", "0xc42079f94a6350d7e6235f29174924f928cc2ac818eb64fed8004e115fbcca67", 3, 5,
            _fields("sender topic 1 address", "recipient topic 2 address", "amount0 data 0 int256", "amount1 data 1 int256",
             "sqrt_price_x96 data 2 uint256", "liquidity data 3 uint256", "tick data 4 int24"),
            "pool_address",
        ),
        Event(
            "mint", "0x7a53080ba414158be7ec69b987b5fb7d07dee101fe85488f0853ae16239d0bde", 4, 4,
            _fields("owner topic 1 address", "tick_lower topic 2 int24", "tick_upper topic 3 int24", "sender data 0 address",
             "amount data 1 uint256", "amount0 data 2 uint256", "amount1 data 3 uint256"),
            "pool_address",
        ),
        Event(
            "burn", "0x0c396cd989a39f4459b5fa1aed6a9a8dcdbc45908acfd67e028cd568da98982c", 4, 3,
            _fields("owner topic 1 address", "tick_lower topic 2 int24", "tick_upper topic 3 int24",
             "amount data 0 uint256", "amount0 data 1 uint256", "amount1 data 2 uint256"),
            "pool_address",
        ),
    )


class AaveV3(ProtocolPlugin):
    """A lending pool: borrow, repay and liquidation. With a pool address, its subscription is to that contract alone."""

    protocol = "aave_v3"
    events = (
        Event(
            "borrow", "0xb3d084820fb1a9decffb176436bd02558d15fac9b0ddfed8c465bc7359d7dce0", 4, 4,
            _fields("reserve topic 1 address", "on_behalf_of topic 2 address", "referral_code topic 3 uint16", "user data 0 address",
             "amount_raw data 1 uint256", "interest_rate_mode data 2 uint8", "borrow_rate_raw data 3 uint256"),
            "contract_address",
        ),
        Event(
            "repay", "0xa534c8dbe71f871f9f3530e97a74601fea17b426cae02e1c5aee42c96c784051", 4, 2,
            _fields("reserve topic 1 address", "user topic 2 address", "repayer topic 3 address",
             "amount_raw data 0 uint256", "use_atokens data 1 bool"),
            "contract_address",
        ),
        Event(
            "liquidation", "0xe413a321e8681d831f4dbccbca790d2952b56f977908e45be37335533e005286", 4, 4,
            _fields("collateral_asset topic 1 address", "debt_asset topic 2 address", "user topic 3 address",
             "debt_to_cover_raw data 0 uint256", "liquidated_collateral_amount_raw data 1 uint256",
             "liquidator data 2 address", "receive_atoken data 3 bool"),
            "contract_address",
        ),
    )

    def __init__(self, pool_address: str | None = None):
        self.pool_address = pool_address

    def subscriptions(self) -> tuple[Subscription, ...]:
        if not self.pool_address or not re.fullmatch(r"0x[0-9a-fA-F]{40}", self.pool_address):
            raise ValueError(f"the lending pool's address is not one: {self.pool_address!r}")
        return (Subscription(self.subscription_topics, (self.pool_address,)),)


class Registry:
    """Plugins by protocol. No topic may belong to two of them, so a log has one owner or none."""

    def __init__(self, plugins: Iterable[ProtocolPlugin] = ()):
        self._plugins: dict[str, ProtocolPlugin] = {}
        for p in plugins:
            self.register(p)

    def register(self, plugin: ProtocolPlugin) -> None:
        if plugin.protocol in self._plugins:
            raise ValueError(f"protocol {plugin.protocol!r} is registered already")
        taken = {t: p.protocol for p in self._plugins.values() for t in p.subscription_topics}
        if both := [f"{t} ({taken[t]})" for t in plugin.subscription_topics if t in taken]:
            raise ValueError(f"{plugin.protocol!r} claims topics of another protocol: {', '.join(both)}")
        self._plugins[plugin.protocol] = plugin

    def get(self, protocol: str) -> ProtocolPlugin:
        if protocol not in self._plugins:
            raise ValueError(f"unknown protocol {protocol!r}; there are {', '.join(sorted(self._plugins)) or 'none'}")
        return self._plugins[protocol]

    def enabled(self, protocols: Iterable[str]) -> list[ProtocolPlugin]:
        """The plugins by name, in order, each once."""
        return [self.get(p) for p in dict.fromkeys(protocols)]

    def topics(self, protocols: Iterable[str]) -> list[str]:
        return list(dict.fromkeys(t for p in self.enabled(protocols) for t in p.subscription_topics))


def parse_protocols(text: str | None, fallback: str | None = None) -> list[str]:
    """Names of a comma-separated list, each once, in order; the fallback if the list is not given."""
    found = list(dict.fromkeys(x for p in (text if text is not None and text.strip() else fallback or "").split(",") if (x := p.strip())))
    if not found:
        raise ValueError("no protocol is enabled")
    return found


def default_registry(pool_address: str | None = None) -> Registry:
    return Registry([UniswapV3(), AaveV3(pool_address)])
