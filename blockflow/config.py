"""Options with defaults, environment overrides and the rules that tie them together."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Config:
    endpoint: str = ""
    token: str = ""
    start_round: str = "latest"  #: a round, or latest
    fetch_workers: int = 32
    fetch_window: int = 0  #: blocks that are fetched and not committed, at most; 0: twice the workers
    commit_batch: int = 10
    flush_ms: int = 200
    insert_mode: str = "unnest"  #: unnest or copy, accepted for compatibility: there is one way to write
    parquet_root: str = ""
    archive_root: str = ""
    segment_size: int = 1000

    @property
    def parquet_enabled(self) -> bool:
        return bool(self.parquet_root)

    @property
    def archive_enabled(self) -> bool:
        return bool(self.archive_root)

    @property
    def first_round(self) -> int | None:
        """The configured round, None for latest."""
        text = str(self.start_round).strip().lower()
        if text in ("", "latest"):
            return None
        if not text.isdigit():
            raise ValueError(f"start_round {self.start_round!r} is neither a round nor latest")
        return int(text)

    def validated(self) -> Config:
        if not (self.parquet_enabled or self.archive_enabled):
            raise ValueError("at least one sink is needed")
        if self.insert_mode not in ("unnest", "copy"):
            raise ValueError(f"insert_mode {self.insert_mode!r}")
        if self.segment_size <= 0:
            raise ValueError("segment_size must be positive")
        assert self.first_round is None or self.first_round >= 0
        workers = self.fetch_workers if self.fetch_workers > 0 else 32
        batch = self.commit_batch if self.commit_batch > 0 else 10
        window = max(self.fetch_window if self.fetch_window > 0 else 2 * workers, workers, batch)
        return replace(self, fetch_workers=workers, commit_batch=batch, fetch_window=window, flush_ms=self.flush_ms if self.flush_ms > 0 else 200)


def load(values: Mapping[str, object] | None = None, env: Mapping[str, str] = os.environ, prefix: str = "BLOCKFLOW_") -> Config:
    """Defaults, then ``values``, then the environment (BLOCKFLOW_FETCH_WORKERS=16)."""
    out: dict[str, object] = {}
    for f in fields(Config):
        v = env.get(prefix + f.name.upper(), (values or {}).get(f.name))
        if v is not None:
            out[f.name] = int(str(v)) if isinstance(f.default, int) else str(v)
    return Config(**out).validated()  # type: ignore[arg-type]
