"""All tunable values in one immutable object; every transform takes the ones it needs from here."""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class TrafficConfig:
    """Rules of the traffic model. The defaults are fixed values: results depend on them."""

    window: str = "5 minutes"
    watermark: str = "2 minutes"
    critical_speed: float = 10.0
    max_capacity: int = 100
    free_flow_speed: float = 60.0
    severe_from: float = 70.0
    moderate_from: float = 40.0
    police_ci: float = 60.0
    police_speed: float = 15.0
    # "sum" weighs a window by its total vehicles, "avg" by the mean count per reading.
    volume: str = "sum"
    # True limits the index to 0..100.
    clamp: bool = False

    def __post_init__(self) -> None:
        if self.volume not in ("sum", "avg"):
            raise ValueError(f"volume must be 'sum' or 'avg', not {self.volume!r}")


DEFAULTS = TrafficConfig()


def add_options(parser: argparse.ArgumentParser, kind: type, names: tuple[str, ...] | None = None) -> None:
    """An option per field of a configuration, or per named one; what is not given keeps its default."""
    for one in fields(kind):
        if one.name == "rules" or names is not None and one.name not in names:
            continue
        flag = "--" + one.name.replace("_", "-")
        if one.type == "bool":
            parser.add_argument(flag, action=argparse.BooleanOptionalAction, default=argparse.SUPPRESS)
        else:
            number = {"int": int, "int | None": int, "float": float}.get(one.type, str)
            parser.add_argument(flag, type=number, default=argparse.SUPPRESS, help=f"default: {one.default}")


def given(options: argparse.Namespace, kind: type) -> dict[str, object]:
    """Those fields of a configuration that the options name."""
    return {one.name: getattr(options, one.name) for one in fields(kind) if hasattr(options, one.name)}


@dataclass(frozen=True)
class StreamConfig:
    """Endpoints, triggers and sizes of a running stream."""

    broker: str = "kafka:9092"
    topic_in: str = "traffic-raw"
    topic_critical: str = "critical-traffic"
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    # Bound on one micro-batch and on the number of read tasks; None leaves Spark's default.
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    congestion_trigger: str = "30 seconds"
    critical_trigger: str = "5 seconds"
    # Hours and days end seldom.
    rollup_trigger: str = "5 minutes"
    # Each trigger leaves a file per topic partition; nothing waits for the archive.
    archive_trigger: str = "10 minutes"
    # Each query runs in the scheduler pool of this prefix and its name.
    pool_prefix: str = "traffic-"
    # Checkpoint root; None means the shared folder the session names.
    checkpoint_base: str | None = None
    # Tasks that write one batch to a file table; None takes the number of shuffle partitions.
    writers: int | None = None
    rules: TrafficConfig = field(default_factory=TrafficConfig)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> "StreamConfig":
        env = os.environ if env is None else env
        names = {
            "broker": "KAFKA_BROKER",
            "topic_in": "TOPIC_IN",
            "topic_critical": "TOPIC_CRITICAL",
            "checkpoint_base": "CHECKPOINT_DIR",
        }
        found = {key: env[name] for key, name in names.items() if env.get(name)}
        return cls(**{**found, **overrides})


@dataclass(frozen=True)
class JdbcConfig:
    """A JDBC endpoint. The password has no default and is never printed."""

    url: str = "jdbc:postgresql://postgres:5432/traffic"
    user: str = "admin"
    password: str = field(default="", repr=False)
    driver: str = "org.postgresql.Driver"
    # Most connections open at once, and rows sent per round trip.
    max_connections: int = 16
    batch_size: int = 10_000
    fetch_size: int = 10_000

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> "JdbcConfig":
        env = os.environ if env is None else env
        names = {"url": "PG_URL", "user": "PG_USER", "password": "PG_PASS"}
        found = {key: env[name] for key, name in names.items() if env.get(name)}
        return cls(**{**found, **overrides})
