"""Settings from the environment; names and defaults are fixed values."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from chainlake.operators.plugins import parse_protocols


@dataclass(frozen=True)
class Settings:
    protocols: tuple[str, ...]
    chain: str
    kafka_servers: str
    kafka_topic: str
    lake_root: str
    checkpoint: str
    env: Mapping[str, str]

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        root = env.get("LAKE_ROOT", "data")
        return cls(
            protocols=tuple(parse_protocols(env.get("ENABLED_PROTOCOLS"), env.get("PROTOCOL", "uniswap_v3"))),
            chain=env.get("CHAIN", "arbitrum"),
            kafka_servers=env.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"),
            kafka_topic=env.get("KAFKA_TOPIC", "uniswap_v3_swaps"),
            lake_root=root,
            checkpoint=env.get("SPARK_CHECKPOINT_PATH", f"{root}/checkpoints/bronze"),
            env=env,
        )

    def required(self, name: str) -> str:
        """A variable that only some jobs need."""
        if not self.env.get(name):
            raise ValueError(f"the environment variable {name} is required here")
        return self.env[name]
