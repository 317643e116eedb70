"""Delivery of single rounds to another system: a pull importer over an archive, and an adapter that pushes translated blocks."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from typing import Protocol

from pyspark.sql import DataFrame

from blockflow.functions.chain import translate
from blockflow.functions.durations import parse_duration
from blockflow.streaming.observe import Metrics

MODES = ("offline", "follow")


class RoundSource(Protocol):
    def get(self, round_: int) -> dict | None: ...

    def checkpoint(self) -> int | None: ...


def get_wait(source: RoundSource, round_: int, poll: float = 0.2, timeout: float = 0.0) -> dict:
    """Polls until the block is there; TimeoutError after ``timeout`` seconds, if that isn't 0."""
    began = time.monotonic()
    while (block := source.get(round_)) is None:
        if timeout and time.monotonic() - began > timeout:
            raise TimeoutError(f"round {round_} didn't come within {timeout} s")
        time.sleep(poll)
    return block


class ArchiveRounds:
    """An archive sink as a source of single rounds."""

    def __init__(self, sink) -> None:
        self.sink = sink

    def get(self, round_: int) -> dict | None:
        return self.sink.get_block(round_)

    def checkpoint(self) -> int | None:
        return self.sink.last_processed_round()


class Cursor:
    """Pulls round after round; it stays where it is while a round isn't there."""

    def __init__(self, source: RoundSource, start: int = 0) -> None:
        self.source, self.next_round = source, start

    def next(self) -> dict | None:
        block = self.source.get(self.next_round)
        if block is not None:
            self.next_round += 1
        return block

    def wait(self, poll: float = 0.2, timeout: float = 0.0) -> dict:
        block = get_wait(self.source, self.next_round, poll, timeout)
        self.next_round += 1
        return block


class Adapter:
    """Gets a round, translates it and delivers it; on an error the round isn't delivered, and none after it."""

    def __init__(self, source: RoundSource, deliver: Callable[[dict, dict], None], metrics: Metrics | None = None) -> None:
        self.source, self.deliver, self.metrics = source, deliver, metrics or Metrics()

    def deliver_round(self, round_: int) -> None:
        began = time.monotonic()
        try:
            block = self.source.get(round_)
            if block is None:
                raise LookupError(f"round {round_} isn't available")
            self.deliver(block, translate(block))
        except Exception:
            self.metrics.add("delivery_errors_total")
            raise
        self.metrics.add("blocks_delivered_total")
        self.metrics.observe("delivery_latency_seconds", time.monotonic() - began)
        cp = self.source.checkpoint()
        if cp is not None and cp >= round_:
            self.metrics.set("delivery_lag", cp - round_)

    def deliver_range(self, start: int, end: int) -> None:
        if end < start:
            raise ValueError(f"invalid range {start}-{end}")
        for r in range(start, end + 1):
            self.deliver_round(r)


class Importer:
    """Translated blocks of an archive by round. ``offline``: a missing round is an error; ``follow``: it is waited for.

    ``bootstrap`` is another name of ``follow``. Durations are texts such as 200ms; a timeout of 0 waits on.
    """

    def __init__(self, source: RoundSource, genesis_file: str, mode: str = "follow", poll: str = "200ms", timeout: str = "0s", metrics: Metrics | None = None) -> None:
        self.mode = "follow" if mode in ("", "bootstrap") else mode
        if self.mode not in MODES:
            raise ValueError(f"unsupported mode {mode!r} (offline, follow or bootstrap)")
        if not genesis_file.strip():
            raise ValueError("a genesis file is required")
        with open(genesis_file.strip()) as f:
            self._genesis = json.load(f)
        self.poll, self.timeout = parse_duration(poll), parse_duration(timeout)
        self.source, self.metrics = source, metrics or Metrics()

    def genesis(self) -> dict:
        return self._genesis

    def get_block(self, round_: int) -> dict:
        """header, payset, certificate."""
        began = time.monotonic()
        try:
            out = translate(self._fetch(round_))
        except Exception:
            self.metrics.add("delivery_errors_total")
            raise
        self.metrics.add("blocks_delivered_total")
        self.metrics.observe("delivery_latency_seconds", time.monotonic() - began)
        if (cp := self.source.checkpoint()) is not None:
            self.metrics.set("delivery_lag", cp - round_)
        return out

    def _fetch(self, round_: int) -> dict:
        if self.mode == "follow":
            return get_wait(self.source, round_, self.poll, self.timeout)
        block = self.source.get(round_)
        if block is None:
            cp = self.source.checkpoint()
            raise LookupError(f"round {round_} isn't in the archive ({'no checkpoint' if cp is None else f'checkpoint {cp}'})")
        return block


class SequentialSink:
    """A function that commits one block, as a sink of batches: in round order, up to the first error."""

    def __init__(self, commit_one: Callable[[dict], None], name: str = "sequential") -> None:
        self.commit_one, self.name, self.done = commit_one, name, None

    def commit(self, blocks: DataFrame | Iterable[dict]) -> None:
        rows = (r.asDict(recursive=True) for r in blocks.orderBy("round").toLocalIterator()) if isinstance(blocks, DataFrame) else blocks
        for b in rows:
            self.commit_one(b)
            self.done = b["round"]

    def last_processed_round(self) -> int | None:
        return self.done

    def max_block_round(self) -> int | None:
        return self.done

    def block_hash(self, round_: int) -> str | None:
        return None
