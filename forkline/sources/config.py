"""Settings from a TOML file, with the environment laid over them."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path

from ..functions.scalars import overflow_policy


@dataclass
class Config:
    """Settings of streaming.service."""

    chain_tracker_max_slots: int = 10_000
    max_rollback_depth: int = 512
    overflow_policy: str = "block"
    max_files_per_trigger: int = 16
    batch_size: int = 500
    dlq_max_retries: int = 3
    default_page_size: int = 100
    max_page_size: int = 1000
    backfill_batch_size: int = 100
    max_reconnect_attempts: int = 10
    first_wait_ms: int = 500
    longest_wait_ms: int = 30_000
    archive_path: str = ""
    store_path: str = ""
    sources: dict[str, str] = field(default_factory=dict, repr=False)

    def validated(self) -> Config:
        self.overflow_policy = overflow_policy(self.overflow_policy)
        for f in fields(self):
            value = getattr(self, f.name)
            if f.type == "int" and value <= 0:
                raise ValueError(f"{f.name} must be positive, not {value}")
        if self.default_page_size > self.max_page_size:
            raise ValueError("default_page_size is larger than max_page_size")
        return self


def load(path: str | None = None, env: Mapping[str, str] | None = None, prefix: str = "FORKLINE_") -> Config:
    """Settings of a file's tables, whatever their headings, then of the environment; a malformed number is an error."""
    out, env = Config(), os.environ if env is None else env
    kinds = {f.name: f.type for f in fields(Config) if f.name != "sources"}

    def put(name: str, value, source: str) -> None:
        if kinds[name] == "int":
            try:
                value = int(value)
            except (TypeError, ValueError):
                raise ValueError(f"{name} from {source}: {value!r} is no whole number") from None
        setattr(out, name, value)
        out.sources[name] = source

    if path:
        for heading, table in tomllib.loads(Path(path).read_text()).items():
            for name, value in (table.items() if isinstance(table, dict) else [(heading, table)]):
                if name in kinds:
                    put(name, value, path)
    for name in kinds:
        if (value := env.get(prefix + name.upper())) is not None:
            put(name, value, "environment")
    return out.validated()


def source_mode(env: Mapping[str, str] | None = None) -> str:
    """`subscribe` unless the environment asks for the scripted demo."""
    env = os.environ if env is None else env
    return "scripted" if env.get("FORKLINE_SOURCE", "").lower() in ("scripted", "demo") else "subscribe"
