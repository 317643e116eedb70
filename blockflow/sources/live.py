"""Live blocks by round: the protocol of a node client, retries, availability, and reading a range in tasks.

A client has ``get_block(round) -> dict`` (round, block_hash, previous_block_hash, timestamp, txn_count, raw,
transactions), ``last_round()`` and ``account_balance(address)``. Clients are made in the tasks by a factory, so
connections are never sent around.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from blockflow.functions.chain import BLOCK, decode_block
from blockflow.functions.errors import SourceError, unavailable, with_retry
from blockflow.runtime import ship


class BlockClient(Protocol):
    def get_block(self, round_: int) -> dict: ...

    def last_round(self) -> int: ...


class HttpClient:
    """A node's REST interface: blocks as MessagePack, status and accounts as JSON."""

    def __init__(self, base: str, token: str = "", timeout: float = 30.0, header: str = "X-Api-Token") -> None:
        self.base, self.token, self.timeout, self.header = base.rstrip("/"), token, timeout, header

    def _get(self, path: str) -> bytes:
        request = urllib.request.Request(self.base + path, headers={self.header: self.token} if self.token else {})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as r:
                return r.read()
        except urllib.error.HTTPError as e:
            raise SourceError(f"HTTP {e.code}: {e.read()[:200].decode(errors='replace')}", e.code) from e
        except urllib.error.URLError as e:
            raise SourceError(str(e.reason)) from e

    def get_block(self, round_: int) -> dict:
        raw = with_retry(lambda: self._get(f"/v2/blocks/{round_}?format=msgpack"))
        return decode_block(raw) | {"raw": raw}

    def last_round(self) -> int:
        return int(json.loads(with_retry(lambda: self._get("/v2/status")))["last-round"])

    def wait_for_block_after(self, round_: int) -> int:
        return int(json.loads(with_retry(lambda: self._get(f"/v2/status/wait-for-block-after/{round_}")))["last-round"])

    def account_balance(self, address: str) -> int:
        return int(json.loads(with_retry(lambda: self._get(f"/v2/accounts/{address}"), first=0.2, attempts=3))["amount"])


class LiveSource:
    """Random access by round: None for a block that isn't there yet, an error for anything else."""

    def __init__(self, client: BlockClient) -> None:
        self.client = client

    def get(self, round_: int) -> dict | None:
        try:
            return self.client.get_block(round_)
        except Exception as e:
            if unavailable(e):
                return None
            raise

    def checkpoint(self) -> int | None:
        return self.client.last_round()

    def get_wait(self, round_: int, poll: float = 0.2, timeout: float = 0.0) -> dict:
        """Polls until the block is there; TimeoutError after ``timeout`` seconds, if that isn't 0."""
        began = time.monotonic()
        while True:
            block = self.get(round_)
            if block is not None:
                return block
            if timeout and time.monotonic() - began > timeout:
                raise TimeoutError(f"round {round_} didn't come within {timeout} s")
            time.sleep(poll)


def read_live(spark: SparkSession, factory: Callable[[], BlockClient], start: int, end: int, workers: int = 8, per_task: int = 256) -> DataFrame:
    """The blocks of an inclusive range, fetched in tasks of ``per_task`` rounds with ``workers`` requests at once in each."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(spark)
    schema = to_arrow_schema(StructType.fromDDL(BLOCK))
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = factory()
        with ThreadPoolExecutor(workers) as pool:
            for batch in batches:
                rounds = batch.column(0).to_pylist()
                for lo in range(0, len(rounds), 4 * workers):
                    got = list(pool.map(client.get_block, rounds[lo : lo + 4 * workers]))
                    for want, b in zip(rounds[lo:], got, strict=False):
                        if b["round"] != want:
                            raise SourceError(f"asked for round {want}, got {b['round']}")
                    yield pa.RecordBatch.from_pylist([{n: b.get(n) for n in names} for b in got], schema=schema)

    n = max(0, end - start + 1)
    return spark.range(start, end + 1, 1, max(1, -(-n // per_task))).mapInArrow(run, BLOCK)
