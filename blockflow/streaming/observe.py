"""Health and metrics of a running follower, as rows."""

from __future__ import annotations

import threading
import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

STATE = "failed boolean, sink_error string, has_checkpoint boolean, next_commit bigint, checkpoint bigint, tip bigint"


@dataclass
class Health:
    """The tracker's state; ``mode`` is integrity.health's rule for one row."""

    failed: bool = False
    sink_error: str = ""
    has_checkpoint: bool = False
    next_commit: int = 0
    checkpoint: int = 0
    tip: int = 0
    near: int = 2
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def update(self, **values) -> Health:
        with self._lock:
            for k, v in values.items():
                setattr(self, k, v)
        return self

    @property
    def lag(self) -> int:
        cursor = self.next_commit - 1 if not self.has_checkpoint and self.next_commit > 0 else self.checkpoint
        return max(self.tip - cursor, 0)

    @property
    def mode(self) -> str:
        if self.failed:
            return "failed"
        if self.sink_error:
            return "degraded"
        if not self.has_checkpoint and self.next_commit == 0:
            return "startup"
        return "catching_up" if self.lag > self.near else "live"

    @property
    def ready(self) -> bool:
        return self.mode in ("live", "catching_up")

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.failed, self.sink_error, self.has_checkpoint, self.next_commit, self.checkpoint, self.tip)], STATE)


class Progress(StreamingQueryListener):
    """Keeps each micro-batch's figures; ``frame`` gives them as rows."""

    def __init__(self, health: Health | None = None) -> None:
        self.health, self.rows, self._lock = health, [], threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        with self._lock:
            self.rows.append((str(p.id), p.batchId, float(p.numInputRows), float(p.processedRowsPerSecond or 0), float(p.durationMs.get("triggerExecution", 0)), time.time()))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if self.health and event.exception:
            self.health.update(failed=True)

    def frame(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            return spark.createDataFrame(self.rows, "query string, batch bigint, blocks double, blocks_per_second double, batch_ms double, at double")


#: Upper bounds of a latency histogram, in seconds.
SECONDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
#: Gauges and counters that a follower keeps.
GAUGES = ("current_round", "target_round", "last_processed_round", "catchup_lag", "checkpoint_lag", "blocks_per_second", "fetch_blocks_per_second", "commit_blocks_per_second", "workers_total", "workers_busy", "inflight_rounds", "buffer_depth", "awaiting_commit", "phase", "replay_blocks_per_second", "handoff_round")
COUNTERS = ("blocks_processed_total", "blocks_fetched_total", "errors_total", "archive_bytes_written_total", "archive_errors_total", "replay_blocks_total")


class Metrics:
    """Gauges, counters and latency histograms by name and label; ``frame`` gives them as rows, ``text`` for a scraper."""

    def __init__(self, prefix: str = "blockflow_") -> None:
        self.prefix, self._lock = prefix, threading.Lock()
        self.gauges: dict[str, float] = dict.fromkeys(GAUGES, 0.0)
        self.counters: dict[tuple[str, str], float] = {(c, ""): 0.0 for c in COUNTERS}
        self.histograms: dict[tuple[str, str], list[float]] = {}

    def set(self, name: str, value: float) -> None:
        with self._lock:
            self.gauges[name] = float(value)

    def add(self, name: str, n: float = 1, label: str = "") -> None:
        with self._lock:
            self.counters[name, label] = self.counters.get((name, label), 0.0) + n

    def observe(self, name: str, seconds: float, label: str = "") -> None:
        """Counts of observations up to each bound, of all, and their sum."""
        with self._lock:
            h = self.histograms.setdefault((name, label), [0.0] * (len(SECONDS) + 2))
            for k, bound in enumerate(SECONDS):
                h[k] += seconds <= bound
            h[-2] += 1
            h[-1] += seconds

    def rounds(self, next_: int, tip: int, done: int | None) -> None:
        for name, value in (("current_round", next_), ("target_round", tip), ("last_processed_round", done or 0), ("catchup_lag", max(tip - next_ + 1, 0)), ("checkpoint_lag", max(tip - (done or 0), 0))):
            self.set(name, value)

    def rows(self) -> list[tuple[str, str, str, str, float]]:
        """(name, kind, label, le, value)."""
        with self._lock:
            out = [(n, "gauge", "", "", v) for n, v in self.gauges.items()] + [(n, "counter", k, "", v) for (n, k), v in self.counters.items()]
            for (n, k), h in self.histograms.items():
                out += [(n, "bucket", k, le, v) for le, v in zip((*(repr(b) for b in SECONDS), "+Inf"), h, strict=False)]
                out += [(n, "count", k, "", h[-2]), (n, "sum", k, "", h[-1])]
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "name string, kind string, label string, le string, value double")

    def text(self) -> str:
        lines = []
        for name, kind, label, le, value in self.rows():
            own = ",".join([f'label="{label}"'] * bool(label) + [f'le="{le}"'] * bool(le))
            lines.append(f"{self.prefix}{name}{f'_{kind}' if kind in ('bucket', 'count', 'sum') else ''}{f'{{{own}}}' if own else ''} {value:g}")
        return "\n".join(lines) + "\n"


@dataclass
class CommitTimings:
    """Nanoseconds of a commit's parts."""

    mode: str = "unnest"
    batch: int = 0
    write_blocks: int = 0
    write_transactions: int = 0
    checkpoint: int = 0
    commit: int = 0
    total: int = 0


def timings_frame(spark: SparkSession, timings: list[CommitTimings]) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(t).values()) for t in timings], "mode string, batch int, write_blocks bigint, write_transactions bigint, checkpoint bigint, commit bigint, total bigint")


def timing_averages(timings: DataFrame) -> DataFrame:
    """mode, commits, and the mean of each part of a commit in whole nanoseconds."""
    from pyspark.sql import functions as F

    parts = ("write_blocks", "write_transactions", "checkpoint", "commit", "total")
    return timings.groupBy("mode").agg(F.count(F.lit(1)).alias("commits"), *(F.floor(F.sum(c) / F.count(F.lit(1))).alias(c) for c in parts))
