"""Durable sinks of blocks: Parquet tables, the segment archive, and several at once.

A commit is a DataFrame of blocks (round, block_hash, previous_block_hash, timestamp, txn_count, raw, transactions). It is
whole or not at all, and repeating it changes nothing: data is staged and renamed into place, the cursor is written
last, and readers stop at the cursor. Delivery is at least once; with these sinks its effect is exactly once.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockflow.functions.chain import explode_transactions
from blockflow.operators import integrity
from blockflow.sources import segments
from blockflow.streaming.observe import CommitTimings

#: Points at which a sink can be told to fail, for tests of recovery.
FAULTS = ("before_begin", "during_writes", "during_checkpoint", "before_commit", "after_commit")


class Fault(Exception):
    pass


class Sink(Protocol):
    name: str

    def commit(self, blocks: DataFrame) -> None: ...

    def last_processed_round(self) -> int | None: ...

    def max_block_round(self) -> int | None: ...

    def block_hash(self, round_: int) -> str | None: ...


def check_batch(blocks: DataFrame) -> tuple[int, int]:
    """(first, last round) of a batch that has each round between them once; ValueError otherwise."""
    a = blocks.agg(F.min("round"), F.max("round"), F.count(F.lit(1)), F.countDistinct("round")).first()
    if not a[2]:
        raise ValueError("empty batch")
    if a[1] - a[0] + 1 != a[2] or a[2] != a[3]:
        raise ValueError(f"batch of {a[2]} blocks isn't the rounds {a[0]} to {a[1]}")
    return a[0], a[1]


class ParquetSink:
    """Tables ``blocks`` and ``transactions`` and a cursor, in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str, name: str = "parquet", fault: str | None = None, on_commit: Callable[[int, int], None] | None = None, on_timings: Callable[[CommitTimings], None] | None = None) -> None:
        if segments.local(root) is None:
            raise ValueError(f"{root}: tables need a path that is mounted on the driver")
        self.spark, self.root, self.name, self.fault, self.on_commit, self.on_timings = spark, root.rstrip("/"), name, fault, on_commit, on_timings
        self.cursor = segments.CursorFile(f"{self.root}/last_processed_round")

    def _point(self, name: str) -> None:
        if self.fault == name:
            raise Fault(name)

    def _table(self, name: str) -> DataFrame | None:
        """A table up to the cursor, None before the first commit."""
        done = self.cursor.load()
        folder = segments.local(f"{self.root}/{name}")
        if done is None or not os.path.isdir(folder) or not os.listdir(folder):
            return None
        return self.spark.read.option("basePath", f"{self.root}/{name}").parquet(f"{self.root}/{name}").where(F.col("round") <= done).drop("batch")

    def blocks(self) -> DataFrame | None:
        return self._table("blocks")

    def transactions(self) -> DataFrame | None:
        return self._table("transactions")

    def commit(self, blocks: DataFrame) -> None:
        self._point("before_begin")
        done = self.cursor.load()
        new = blocks if done is None else blocks.where(F.col("round") > done)
        ends = new.agg(F.min("round"), F.max("round")).first()
        if ends[0] is None:
            return
        batch = f"batch={ends[0]:020d}-{ends[1]:020d}"
        at = [time.perf_counter_ns()]
        txs = integrity.first_writer(explode_transactions(new))
        if (old := self.transactions()) is not None:
            txs = integrity.only_new(txs, old, "txid")
        self._put(new.drop("transactions").withColumn("created_at", F.current_timestamp()), "blocks", batch)
        at.append(time.perf_counter_ns())
        self._point("during_writes")
        self._put(txs.withColumn("created_at", F.current_timestamp()), "transactions", batch)
        at.append(time.perf_counter_ns())
        self._point("during_checkpoint")
        self._point("before_commit")
        self.cursor.save(max(ends[1], done if done is not None else ends[1]))
        at.append(time.perf_counter_ns())
        if self.on_timings:
            a, b, c, d = at
            self.on_timings(CommitTimings("anti-join", ends[1] - ends[0] + 1, b - a, c - b, d - c, d - c, d - a))
        if self.on_commit:
            self.on_commit(*ends)
        self._point("after_commit")

    def _put(self, df: DataFrame, name: str, batch: str) -> None:
        """Write beside the table and rename; batches of an earlier attempt that the cursor never covered give way."""
        staged = f"{self.root}/_staging/{uuid.uuid4().hex}"
        df.write.parquet(staged)
        folder = segments.local(f"{self.root}/{name}")
        os.makedirs(folder, exist_ok=True)
        first, done = int(batch[6:26]), self.cursor.load()
        for n in os.listdir(folder):
            if n.startswith("batch=") and int(n[6:26]) >= (first if done is None else max(first, done + 1)):
                os.rename(f"{folder}/{n}", f"{segments.local(self.root)}/_staging/old-{uuid.uuid4().hex}")
        os.rename(segments.local(staged), f"{folder}/{batch}")

    def last_processed_round(self) -> int | None:
        return self.cursor.load()

    def max_block_round(self) -> int | None:
        t = self.blocks()
        return None if t is None else t.agg(F.max("round")).first()[0]

    def block_hash(self, round_: int) -> str | None:
        t = self.blocks()
        row = None if t is None else t.where(F.col("round") == round_).select("block_hash").first()
        return row[0] if row else None

    def truncate(self, start: int, end: int) -> None:
        """Drop a range of rounds from both tables, and put the cursor before it."""
        for name in ("blocks", "transactions"):
            t = self._table(name)
            if t is None:
                continue
            kept = f"{self.root}/_staging/{uuid.uuid4().hex}"
            t.where(~F.col("round").between(start, end)).write.parquet(kept)
            folder = segments.local(f"{self.root}/{name}")
            os.rename(folder, f"{segments.local(self.root)}/_staging/old-{uuid.uuid4().hex}")
            os.makedirs(folder)
            os.rename(segments.local(kept), f"{folder}/batch={0:020d}-{start:020d}")
        if start > 0:
            self.cursor.save(start - 1)


class ArchiveSink:
    """The segment archive as a sink."""

    def __init__(self, spark: SparkSession, root: str, size: int = segments.SEGMENT_SIZE, name: str = "archive", on_commit: Callable[[int, int], None] | None = None) -> None:
        self.spark, self.root, self.size, self.name, self.on_commit = spark, root, size, name, on_commit

    def commit(self, blocks: DataFrame) -> None:
        before = segments.read_checkpoint(self.root)
        after = segments.write_archive(blocks, self.root, self.size)
        if self.on_commit and after is not None and after != before:
            self.on_commit(-1 if before is None else before + 1, after)

    def last_processed_round(self) -> int | None:
        return segments.read_checkpoint(self.root)

    max_block_round = last_processed_round

    def get_block(self, round_: int) -> dict | None:
        """A durable block, None beyond the checkpoint or if it was pruned."""
        row = segments.read_archive(self.spark, self.root, round_, round_).where("round is not null").first()
        return row.asDict() if row else None

    def block_hash(self, round_: int) -> str | None:
        row = segments.read_archive(self.spark, self.root, round_, round_, raw=False).where("round is not null").first()
        return row["block_hash"] if row else None


class MultiSink:
    """Several sinks: a commit goes to all at the same time and succeeds if all do; a repeat completes a partial one."""

    def __init__(self, sinks: list[Sink]) -> None:
        if not sinks:
            raise ValueError("at least one sink is needed")
        self.sinks, self.name = sinks, "+".join(s.name for s in sinks)

    def commit(self, blocks: DataFrame) -> None:
        if len(self.sinks) == 1:
            return self.sinks[0].commit(blocks)
        with ThreadPoolExecutor(len(self.sinks)) as pool:
            waiting = [pool.submit(s.commit, blocks) for s in self.sinks]
        for w in waiting:
            w.result()
        return None

    def _least(self, values: list[int | None]) -> int | None:
        return None if any(v is None for v in values) else min(v for v in values if v is not None)

    def last_processed_round(self) -> int | None:
        return self._least([s.last_processed_round() for s in self.sinks])

    def max_block_round(self) -> int | None:
        return self._least([s.max_block_round() for s in self.sinks])

    def block_hash(self, round_: int) -> str | None:
        found = {h for h in (s.block_hash(round_) for s in self.sinks) if h}
        if len(found) > 1:
            raise ValueError(f"sinks disagree on the hash of round {round_}")
        return found.pop() if found else None


def build_sinks(spark: SparkSession, parquet: str = "", archive: str = "", size: int = segments.SEGMENT_SIZE) -> MultiSink:
    sinks: list[Sink] = [*([ParquetSink(spark, parquet)] if parquet else []), *([ArchiveSink(spark, archive, size)] if archive else [])]
    return MultiSink(sinks)


def replay(spark: SparkSession, root: str, sink: Sink, start: int, end: int, batch: int = 10_000) -> int | None:
    """Deliver an archive's range to a sink, in ranges of ``batch`` rounds, and return the sink's cursor."""
    for lo in range(start, end + 1, batch):
        hi = min(lo + batch - 1, end)
        sink.commit(decoded_archive(segments.iterate_archive(spark, root, lo, hi)))
    done = sink.last_processed_round()
    if done is None or done < end:
        raise ValueError(f"the sink stopped at {done}, before {end}")
    return done


def decoded_archive(records: DataFrame) -> DataFrame:
    """Records as blocks: what the payload holds where it decodes, else what the record says (no time, no transactions)."""
    from blockflow.functions.chain import TRANSACTION, decode_blocks

    d = decode_blocks(records.withColumn("_raw", F.col("raw")), "raw", ("round", "block_hash", "previous_block_hash", "_raw"))
    return d.select(
        "round", "block_hash", "previous_block_hash", F.coalesce("decoded.timestamp", F.lit(0).cast("bigint")).alias("timestamp"), F.coalesce("decoded.txn_count", F.lit(0)).alias("txn_count"),
        F.col("_raw").alias("raw"), F.coalesce("decoded.transactions", F.from_json(F.lit("[]"), f"array<{TRANSACTION}>")).alias("transactions"),
    )
