"""Following a chain: where to start, restoring order, committing batches, and consumers with cursors of their own.

A pull source (a node, an archive) gives each micro-batch a contiguous range, so order needs only a sort in the batch.
For pushed arrivals, in any order, ``release_in_order`` keeps what came early in the state of its chain and lets rounds
go one after the other; nothing is dropped, a missing round holds the rest back. Only round, hash and previous hash are
in the state; payloads stay in their files and are joined by round when they are committed.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from blockflow.config import Config
from blockflow.functions.durations import per_second
from blockflow.functions.errors import retryable, with_retry
from blockflow.operators import integrity
from blockflow.runtime import ship
from blockflow.sources import segments
from blockflow.sources.live import BlockClient, read_live
from blockflow.sources.sinks import Sink, decoded_archive, replay
from blockflow.streaming.observe import Health, Metrics

RELEASED = "chain string, round bigint, block_hash string, previous_block_hash string, linked boolean"


def start_round(checkpoint: int | None, configured: int | None, tip: int, max_stored: int | None) -> int:
    """The first round to fetch: after the checkpoint, else as configured, else the tip.

    A checkpoint more than 1000 beyond the tip is doubted: the next round is then after the last stored block, or the
    tip if there is none, or that is beyond the tip as well.
    """
    start = checkpoint + 1 if checkpoint is not None else configured if configured is not None else tip
    if start <= tip + 1000:
        return start
    return max_stored + 1 if max_stored is not None and max_stored <= tip else tip


def batch_size(next_round: int, tip: int, size: int, near: int = 2) -> int:
    """How many blocks a commit waits for: one at the tip, else the configured size."""
    return 1 if next_round + near >= tip else size


def should_flush(ready: int, size: int, at_tip: bool, reached_end: bool, stuck: bool, waited: float, interval: float) -> bool:
    """Whether ready blocks are committed now."""
    return ready > 0 and (ready >= size or at_tip or reached_end or stuck or waited >= interval)


# ---- order ------------------------------------------------------------------------------------------------------------


#: Rounds in a part of the waiting blocks: state is read and written by parts, which cost a call each.
PART = 1000
_WAITING = pa.schema([("round", pa.int64()), ("block_hash", pa.large_string()), ("previous_block_hash", pa.large_string())])
_RELEASE_ROWS = 1 << 16


def _first_by_round(blocks: pa.Table) -> pa.Table:
    """Sorted by round; of several rows of a round the first one."""
    rounds = blocks.column("round").to_numpy()
    order = np.argsort(rounds, kind="stable")
    rounds = rounds[order]
    return blocks.take(pa.array(order[np.concatenate(([True], rounds[1:] != rounds[:-1]))])) if len(order) else blocks


class OrderedBuffer(StatefulProcessor):
    """For each chain: the next round, the last released hash, and the blocks that came early, in parts of ``PART`` rounds."""

    def __init__(self, first: int) -> None:
        self.first = first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cursor = handle.getValueState("cursor", StructType([StructField("next", LongType()), StructField("hash", StringType())]))
        self.waiting = handle.getMapState("waiting", StructType([StructField("part", LongType())]), StructType([StructField("blocks", BinaryType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        next_, last = self.cursor.get() if self.cursor.exists() else (self.first, "")
        early = {k[0] for k in self.waiting.keys()}  # numbers of parts only
        come = [pa.Table.from_pandas(df[_WAITING.names], schema=_WAITING, preserve_index=False) for df in rows]
        new = pa.concat_tables([t.filter(pc.greater_equal(t.column("round"), next_)) for t in come] or [_WAITING.empty_table()]).combine_chunks()
        del come
        new = _first_by_round(new)
        parts, at = np.unique(new.column("round").to_numpy() // PART, return_index=True)
        ends = dict(zip(parts.tolist(), zip(at.tolist(), [*at[1:].tolist(), len(new)], strict=True), strict=True))

        def blocks_of(part: int) -> pa.Table:
            lo, hi = ends.pop(part, (0, 0))
            own = new.slice(lo, hi - lo)
            if part not in early:
                return own
            with pa.ipc.open_stream(bytes(self.waiting.getValue((part,))[0])) as f:
                return _first_by_round(pa.concat_tables([f.read_all(), own]).combine_chunks())  # the first to come stays

        def keep(part: int, blocks: pa.Table) -> None:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, _WAITING) as f:
                f.write_table(blocks.combine_chunks())
            self.waiting.updateValue((part,), (out.getvalue().to_pybytes(),))

        ready: list[pa.Table] = []
        while (part := next_ // PART) in ends or part in early:
            blocks = blocks_of(part)
            rounds = blocks.column("round").to_numpy()
            n = int(np.argmin(np.append(rounds == next_ + np.arange(len(rounds)), False)))
            ready.append(blocks.slice(0, n))
            next_ += n
            if n < len(blocks):  # only what has to wait is kept as state
                keep(part, blocks.slice(n))
            elif part in early:
                self.waiting.removeKey((part,))
            early.discard(part)
            if sum(map(len, ready)) >= _RELEASE_ROWS:
                df, last = self.released(key[0], ready, last)
                ready = []
                yield df
            if next_ // PART == part:
                break
        for part in list(ends):
            keep(part, blocks_of(part))
        df, last = self.released(key[0], ready, last)
        self.cursor.update((next_, last))
        yield df

    @staticmethod
    def released(chain: str, ready: list[pa.Table], last: str) -> tuple[pd.DataFrame, str]:
        """The rows of blocks in order, and the last one's hash."""
        df = pa.concat_tables([_WAITING.empty_table(), *ready]).to_pandas()
        df["block_hash"], df["previous_block_hash"] = df["block_hash"].fillna(""), df["previous_block_hash"].fillna("")
        before = df["block_hash"].shift(fill_value=last)
        df["linked"] = (df["block_hash"] != "") & ((before == "") | (df["previous_block_hash"] == "") | (df["previous_block_hash"] == before))
        df.insert(0, "chain", chain)
        return df, df["block_hash"].iloc[-1] if len(df) else last

    def close(self) -> None:
        pass


def release_in_order(arrivals: DataFrame, first: int = 0) -> DataFrame:
    """Streamed blocks (chain, round, block_hash, previous_block_hash) in order; ``linked``: whether each fits the one before.

    Needs the RocksDB state store. A chain is one key, as its order is global; different chains run in parallel.
    """
    ship(arrivals.sparkSession)
    arrivals.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    few = arrivals.select("chain", "round", "block_hash", "previous_block_hash")
    return few.groupBy("chain").transformWithStateInPandas(statefulProcessor=OrderedBuffer(first), outputStructType=RELEASED, outputMode="Append", timeMode="None")


# ---- commits ---------------------------------------------------------------------------------------------------------


def commit_to(sink: Sink, on_batch: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: a micro-batch is validated and committed; one that is already in does nothing."""
    def commit(blocks: DataFrame, batch_id: int) -> None:
        blocks = blocks.persist()
        try:
            if blocks.isEmpty():
                return
            done = sink.last_processed_round()
            new = blocks if done is None else blocks.where(F.col("round") > done)
            validate(new, sink, done)
            sink.commit(blocks)
            if on_batch:
                on_batch(batch_id)
        finally:
            blocks.unpersist()

    return commit


def validate(blocks: DataFrame, sink: Sink, done: int | None) -> None:
    """ValueError unless the blocks are contiguous, follow the cursor, have hashes, and link to each other and the last one."""
    a = blocks.agg(F.min("round"), F.max("round"), F.count(F.lit(1)), F.sum((F.coalesce("block_hash", F.lit("")) == "").cast("int")), F.min_by("previous_block_hash", "round")).first()
    if not a[2]:
        return
    if a[1] - a[0] + 1 != a[2] or (done is not None and a[0] != done + 1):
        raise ValueError(f"{a[2]} blocks from {a[0]} to {a[1]} don't follow {done} without a gap")
    if a[3]:
        raise ValueError(f"{a[3]} blocks have no hash")
    before = sink.block_hash(done) if done is not None else None
    if before and a[4] and a[4] != before:
        raise ValueError(f"hash linkage is broken at round {a[0]}")
    if broken := integrity.linkage_breaks(blocks, lenient=True).orderBy("round").first():
        raise ValueError(f"hash linkage is broken at round {broken['round']}")


def follow_archive(spark: SparkSession, root: str, sink: Sink, checkpoint: str, until: int | None = None, window: int = 0, start: int = 0):
    """A streaming query that delivers an archive, as it grows, to a sink; with ``until`` it ends when there is no more."""
    segments.register(spark)
    source = spark.readStream.format("blockseg").option("path", root).option("from", str(start))
    if window and getattr(sink, "cursor", None):
        source = source.option("window", str(window)).option("cursor", sink.cursor.path)
    rows = source.load().where("round is not null")
    if until is not None:
        rows = rows.where(F.col("round") <= until)
    writer = decoded_archive(rows).writeStream.foreachBatch(commit_to(sink)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until is not None else writer.trigger(processingTime="200 milliseconds")).start()


def follow_live(spark: SparkSession, factory: Callable[[], BlockClient], sink: Sink, config: Config, until: int | None = None, poll: float = 1.0, health: Health | None = None, stop: Callable[[], bool] = lambda: False, metrics: Metrics | None = None) -> int | None:
    """Fetch from a node and commit, round after round, until ``until`` (or ``stop()``); returns the sink's cursor.

    Each turn takes the rounds up to the tip, at most a window of them, fetched in tasks; at the tip that is one block.
    What is fetched waits for a commit until ``should_flush`` says so. After ``stop()`` what is ready is committed once more;
    if that fails the cursor stays. A failed turn changes nothing and is repeated; an error that no repeat can heal ends
    the run.
    """
    client, metrics = factory(), metrics or Metrics()
    tip = with_retry(client.last_round)
    next_ = fetched = start_round(sink.last_processed_round(), config.first_round, tip, sink.max_block_round())
    commit, turn, since = commit_to(sink), 0, time.monotonic()
    ready: list[DataFrame] = []
    metrics.set("workers_total", config.fetch_workers)

    def flush() -> None:
        nonlocal next_, turn, since
        began, n = time.monotonic(), fetched - next_
        commit(reduce(DataFrame.unionByName, ready), turn)
        took = time.monotonic() - began
        for df in ready:
            df.unpersist()
        ready.clear()
        metrics.observe("commit_latency_seconds", took, getattr(sink, "name", ""))
        metrics.add("blocks_processed_total", n)
        metrics.set("commit_blocks_per_second", per_second(n, took))
        next_, turn, since = fetched, turn + 1, time.monotonic()
        if health:
            health.update(sink_error="", has_checkpoint=True, checkpoint=fetched - 1)

    while not stop() and (until is None or next_ <= until):
        tip = with_retry(client.last_round)
        done = sink.last_processed_round()
        metrics.rounds(next_, tip, done)
        if health:
            health.update(tip=tip, next_commit=next_, has_checkpoint=done is not None, checkpoint=done or 0)
        last = min(tip, next_ + config.fetch_window - 1, tip if until is None else until)
        try:
            stuck = last < fetched
            if not stuck:
                began = time.monotonic()
                df = read_live(spark, factory, fetched, last, config.fetch_workers).persist()
                n = df.count()
                metrics.add("blocks_fetched_total", n)
                metrics.observe("fetch_latency_seconds", time.monotonic() - began)
                ready.append(df)
                fetched = last + 1
            metrics.set("awaiting_commit", fetched - next_)
            size = batch_size(next_, tip, config.commit_batch)
            if should_flush(fetched - next_, size, fetched > tip, until is not None and fetched > until, stuck, time.monotonic() - since, config.flush_ms / 1000):
                flush()
            elif stuck:
                time.sleep(poll)
        except ValueError:
            metrics.add("errors_total")
            if health:
                health.update(failed=True)
            raise  # the chain itself is wrong
        except Exception as e:
            metrics.add("errors_total")
            if not retryable(e):
                raise
            if health:
                health.update(sink_error=str(e)[:200])
            time.sleep(min(poll, 0.5))
    if ready:
        try:
            flush()
        except Exception as e:
            metrics.add("errors_total")
            if health:
                health.update(sink_error=str(e)[:200])
    return sink.last_processed_round()


def bootstrap(spark: SparkSession, root: str, factory: Callable[[], BlockClient], sink: Sink, config: Config, end: int, start: int = 0) -> int | None:
    """History from an archive, then live blocks up to ``end``, into one sink; a repeat goes on where the sink stands."""
    cp, done = segments.read_checkpoint(root), sink.last_processed_round()
    first = start if done is None else done + 1
    if cp is not None and first <= min(cp, end):
        replay(spark, root, sink, first, min(cp, end))
    return follow_live(spark, factory, sink, config, until=end)


# ---- handoff and consumers --------------------------------------------------------------------------------------------


class Handoff:
    """Blocks by round: from the archive up to its checkpoint, then live; the seam and each step must link.

    Phases: waiting (no archive checkpoint), historical, handoff (the first live round), live, failed.
    """

    def __init__(self, archive, live, on_phase: Callable[[str], None] | None = None) -> None:
        self.archive, self.live, self.on_phase = archive, live, on_phase
        self.phase, self.handoff_round = "historical", None
        self._last: tuple[int, str] | None = None

    def _to(self, phase: str) -> None:
        if phase != self.phase:
            self.phase = phase
            if self.on_phase:
                self.on_phase(phase)  # gets the value: the callback needs nothing from this object

    def checkpoint(self) -> int | None:
        a, b = self.archive.last_processed_round(), self.live.checkpoint()
        return b if a is None else a if b is None else max(a, b)

    def reset_cursor(self) -> None:
        self._last = None

    def get(self, round_: int) -> dict | None:
        cp = self.archive.last_processed_round()
        if cp is None:
            self._to("waiting")
            return None
        try:
            if round_ <= cp:
                block = self.archive.get_block(round_)
                if block is None:
                    raise segments.ArchiveError(f"round {round_} isn't in the archive up to {cp}")
                self._to("historical")
            else:
                block = self.live.get(round_)
                if block is None:
                    return None
                if round_ == cp + 1:
                    before = self.archive.block_hash(cp)
                    if before and block["previous_block_hash"] != before:
                        raise segments.ArchiveError(f"the live block {round_} doesn't link to the archive")
                    self.handoff_round = round_
                    self._to("handoff")
                else:
                    self._to("live")
            if self._last and self._last[0] == round_ - 1 and self._last[1] and block["previous_block_hash"] and block["previous_block_hash"] != self._last[1]:
                raise segments.ArchiveError(f"hash linkage is broken at round {round_}")
        except Exception:
            self._to("failed")
            raise
        self._last = round_, block["block_hash"]
        return block


class RoundError(Exception):
    """A round that a consumer can't get: not_yet_available, not_found, gap or corrupt."""

    def __init__(self, round_: int, kind: str, cause: object = "") -> None:
        super().__init__(f"round {round_}: {kind}" + (f" ({cause})" if cause else ""))
        self.round, self.kind = round_, kind


def consume(spark: SparkSession, root: str, handler: Callable[[dict], None], cursor: segments.CursorFile, start: int = 0, end: int = 0, batch: int = 10_000) -> int | None:
    """Hand an archive's blocks to a function, in order, at least once; the cursor moves when the handler has returned.

    Blocks come to the driver one partition at a time. ``end`` 0: up to the archive's checkpoint.
    """
    next_, done = cursor.resume(start), cursor.load()
    cp = segments.read_checkpoint(root)
    last = min(end, cp) if end and cp is not None else cp
    if end and (cp is None or cp < end):
        if cp is None or next_ > cp:
            raise RoundError(next_, "not_yet_available")
    while last is not None and next_ <= last:
        hi = min(next_ + batch - 1, last)
        try:
            rows = segments.iterate_archive(spark, root, next_, hi)
        except segments.ArchiveError as e:
            first = segments.read_archive(spark, root, next_, hi, raw=False).agg(F.min("round")).first()[0]
            raise RoundError(next_, "not_found" if first != next_ else "corrupt", e) from e
        for row in rows.orderBy("round").toLocalIterator():
            handler(row.asDict())
            cursor.save(row["round"])
            done = row["round"]
        next_ = hi + 1
    if end and (done is None or done < end):
        raise RoundError(next_, "not_yet_available")
    return done
