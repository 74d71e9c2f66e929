"""Settings of the write and the read side, with their defaults and ordered checks."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

#: Names that both sides agree on (fixed values).
ENCODINGS = ("otlp_proto", "otlp_json")
CODECS = ("none", "gzip", "zstd", "snappy", "x-snappy-framed", "zlib", "deflate")
SOURCES = ("resource", "datapoint", "metric_name")
TRUNCATE, SPLIT, REJECT = "truncate_attribute_values", "split_half", "reject"


class ConfigError(ValueError):
    pass


def check(ok: bool, message: str) -> None:
    if not ok:
        raise ConfigError(message)


def registered(name: str, known: tuple[str, ...], what: str) -> None:
    check(name in known, f"unknown {what} {name!r}; known: {', '.join(known)}")


@dataclass(frozen=True)
class KeySource:
    """One component of a key plan: where its value is read, how it is reduced, and the
    attribute under which the result is written back."""

    source: str = "resource"
    name: str = ""
    regex: str = ""
    promote: str = ""


@dataclass(frozen=True)
class WriterConfig:
    stream_name: str = ""
    region: str = ""
    encoding: str = "otlp_proto"
    compression: str = "none"
    max_record_size: int = 1 << 20
    max_records: int = 500
    max_bytes: int = 5 << 20
    strategy: str = "random"
    hash: str = "xxhash"
    tags: tuple[str, ...] = ()
    keys: tuple[KeySource, ...] = ()
    policies: tuple[str, ...] = (SPLIT,)
    max_attempts: int = 8
    max_attribute_value_bytes: int = 4096
    legacy_policy: str | None = None

    def validate(self) -> WriterConfig:
        check(bool(self.stream_name), "stream_name is required")
        check(bool(self.region), "region is required")
        registered(self.encoding, ENCODINGS, "encoding")
        registered(self.compression, CODECS, "compression")
        for name in ("max_record_size", "max_records", "max_bytes"):
            check(getattr(self, name) > 0, f"{name} must be positive")
        check(self.max_record_size <= self.max_bytes, "max_record_size must not exceed max_bytes")
        registered(self.strategy or "random", ("random", "tag_hash"), "strategy")
        if self.strategy == "tag_hash":
            check(not (self.tags and self.keys), "tags and keys exclude each other")
            check(bool(self.tags or self.keys), "tag_hash needs tags or keys")
            for i, k in enumerate(self.keys):
                registered(k.source or "resource", SOURCES, f"keys[{i}] source")
                check(bool(k.name) != (k.source == "metric_name"), f"keys[{i}]: a name belongs to attribute sources only")
                compiled(k.regex, i)
        registered(self.hash or "xxhash", ("xxhash",), "hash")
        check(self.legacy_policy is None, f"oversize.policy was removed; write policies: [{self.legacy_policy!r}]")
        check(bool(self.policies), "policies must name at least one policy")
        for i, p in enumerate(self.policies):
            registered(p, (TRUNCATE, SPLIT, REJECT), "policy")
            check(p == TRUNCATE or i == len(self.policies) - 1, f"policies[{i}]={p!r} ends the chain and must come last")
        for name in ("max_attempts", "max_attribute_value_bytes"):
            check(getattr(self, name) > 0, f"{name} must be positive")
        return self


@dataclass(frozen=True)
class ReaderConfig:
    """Durations are in milliseconds."""

    stream_name: str = ""
    region: str = ""
    encoding: str = "otlp_proto"
    compression: str = "none"
    poll_interval: int = 250
    max_records: int = 10_000
    lease_backend: str = "memory"
    lease_table: str = ""
    lease_duration: int = 30_000
    heartbeat_interval: int = 5_000
    discovery_interval: int = 30_000
    dead_letter: bool = False
    worker_id: str = field(default_factory=lambda: f"otelcol-{uuid.uuid4()}")

    def validate(self) -> ReaderConfig:
        check(bool(self.stream_name), "stream_name is required")
        check(bool(self.region), "region is required")
        registered(self.encoding, ENCODINGS, "encoding")
        registered(self.compression, CODECS, "compression")
        check(self.poll_interval > 0, "poll_interval must be positive")
        check(0 < self.max_records <= 10_000, "max_records must be in (0, 10000]")
        registered(self.lease_backend, ("memory", "dynamodb"), "lease_backend")
        check(self.lease_backend == "memory" or bool(self.lease_table), "a stored lease backend needs lease_table")
        check(self.lease_duration > 0, "lease_duration must be positive")
        check(0 < self.heartbeat_interval < self.lease_duration, "heartbeat_interval must be positive and below lease_duration")
        check(self.discovery_interval > 0, "discovery_interval must be positive")
        return self


def compiled(pattern: str, index: int = 0) -> re.Pattern | None:
    """The pattern, checked on the driver; the error names the key's index."""
    try:
        return re.compile(pattern) if pattern else None
    except re.error as e:
        raise ConfigError(f"keys[{index}]: invalid regex: {e}") from e


def env_int(value: str | None, default: int) -> int:
    try:
        return int(value) if value else default
    except ValueError:
        return default
