import json

import pytest
from pyspark.sql import functions as F

from blockflow.config import Config
from blockflow.functions.chain import make_chain
from blockflow.functions.durations import format_duration, parse_duration, per_second
from blockflow.operators import integrity as I
from blockflow.sources import delivery as D
from blockflow.sources import segments, sinks
from blockflow.streaming import follow, observe


class Rounds:
    def __init__(self, blocks):
        self.blocks = {b["round"]: b for b in blocks}

    def get(self, round_):
        return self.blocks.get(round_)

    def checkpoint(self):
        return max(self.blocks) if self.blocks else None


class Node(Rounds):
    def get_block(self, round_):
        return self.blocks[round_]

    def last_round(self):
        return max(self.blocks)


def test_adapter_stops_at_the_first_error():
    source, got = Rounds(make_chain(0, 5, 2)), []
    a = D.Adapter(source, lambda b, d: got.append((b["round"], len(d["payset"]), d["header"]["rnd"])))
    a.deliver_range(1, 3)
    assert got == [(1, 2, 1), (2, 2, 2), (3, 2, 3)] and a.metrics.gauges["delivery_lag"] == 1
    del source.blocks[3]
    with pytest.raises(LookupError):
        a.deliver_range(2, 4)
    assert got[3:] == [(2, 2, 2)]
    assert a.metrics.counters["blocks_delivered_total", ""] == 4 and a.metrics.counters["delivery_errors_total", ""] == 1
    with pytest.raises(ValueError):
        a.deliver_range(3, 2)


def test_importer(tmp_path):
    path = tmp_path / "genesis.json"
    path.write_text(json.dumps({"network": "x"}))
    source = Rounds(make_chain(0, 3, 1))
    one = D.Importer(source, str(path), "offline")
    assert one.genesis() == {"network": "x"} and one.get_block(2)["header"]["rnd"] == 2
    with pytest.raises(LookupError, match="checkpoint 2"):
        one.get_block(9)
    with pytest.raises(TimeoutError):
        D.Importer(source, str(path), "bootstrap", "1ms", "20ms").get_block(9)
    with pytest.raises(ValueError):
        D.Importer(source, str(path), "other")
    with pytest.raises(ValueError):
        D.Importer(source, "", "offline")


def test_cursor_stays_on_a_miss():
    source = Rounds(make_chain(0, 2))
    c = D.Cursor(source)
    assert [c.next()["round"], c.next()["round"], c.next(), c.next_round] == [0, 1, None, 2]
    source.blocks[2] = make_chain(2, 1)[0]
    assert c.wait()["round"] == 2
    with pytest.raises(TimeoutError):
        c.wait(0.001, 0.01)


def test_sequential_sink(spark):
    got = []
    sink = D.SequentialSink(lambda b: got.append(b["round"]))
    sink.commit(spark.createDataFrame([(3,), (1,), (2,)], "round bigint"))
    sink.commit([{"round": 4}])
    assert got == [1, 2, 3, 4] and sink.last_processed_round() == 4


@pytest.mark.parametrize("text, seconds", [("200ms", 0.2), ("1h2m3.5s", 3723.5), ("0", 0), ("-1.5h", -5400), ("7us", 7e-6)])
def test_durations(text, seconds):
    assert parse_duration(text) == pytest.approx(seconds) and parse_duration(format_duration(seconds)) == pytest.approx(seconds)


def test_duration_errors():
    for bad in ("", "5", "1x", "s", "1 s"):
        with pytest.raises(ValueError):
            parse_duration(bad)
    assert format_duration(3723.5) == "1h2m3.5s" and format_duration(0.2) == "200ms" and per_second(10, 2) == 5 and per_second(1, 0) == 0


def test_metrics(spark):
    m = observe.Metrics()
    m.observe("commit_latency_seconds", 0.02, "parquet")
    m.add("errors_total", label="fetch")
    m.rounds(5, 9, 4)
    rows = {(r.name, r.kind, r.label, r.le): r.value for r in m.frame(spark).collect()}
    assert rows["catchup_lag", "gauge", "", ""] == 5 and rows["checkpoint_lag", "gauge", "", ""] == 5
    assert rows["commit_latency_seconds", "bucket", "parquet", "0.01"] == 0 and rows["commit_latency_seconds", "bucket", "parquet", "0.025"] == 1
    assert 'blockflow_commit_latency_seconds_bucket{label="parquet",le="+Inf"} 1' in m.text() and 'blockflow_errors_total{label="fetch"} 1' in m.text()


def test_live_follow_flushes_drains_and_times(spark, tmp_path):
    chain, timings, m = make_chain(0, 12), [], observe.Metrics()
    sink = sinks.ParquetSink(spark, str(tmp_path / "t"), on_timings=timings.append)
    assert follow.follow_live(spark, lambda: Node(chain), sink, Config(start_round=0, commit_batch=4, fetch_window=4), until=9, metrics=m) == 9
    assert m.counters["blocks_processed_total", ""] == 10 and m.counters["blocks_fetched_total", ""] == 10
    avg = observe.timing_averages(observe.timings_frame(spark, timings)).first()
    assert avg.commits == len(timings) >= 3 and avg.total >= avg.write_blocks > 0
    # far from the tip, two rounds wait for a batch of eight; after stop() they are committed
    calls = iter([False, True, True])
    other = sinks.ParquetSink(spark, str(tmp_path / "u"))
    config = Config(start_round=0, commit_batch=8, fetch_window=2, flush_ms=3_600_000)
    assert follow.follow_live(spark, lambda: Node(chain), other, config, stop=lambda: next(calls)) == 1


def test_remote_paths_are_refused(spark):
    with pytest.raises(ValueError):
        sinks.ParquetSink(spark, "s3://bucket/x")
    with pytest.raises(segments.ArchiveError):
        segments.write_archive(spark.range(1), "s3://bucket/x")


def test_compare_in_step(spark):
    def frame(rounds, bad=None):
        return spark.createDataFrame([(r, "x" if r == bad else f"h{r}", f"h{r - 1}") for r in rounds], "round bigint, block_hash string, previous_block_hash string")

    full = frame(range(10))
    row = lambda a, b, lo=0, hi=9: tuple(I.compare(a, b, lo, hi).first())[2:]
    assert row(full, full) == (10, True, False, None, None)
    assert row(full, frame(range(10), 4)) == (5, False, True, 4, "block hash mismatch")
    assert row(full, frame([0, 1, 2, 4, 5])) == (4, False, True, 3, "round mismatch A=3 B=4 want=3")
    assert row(full, frame(range(6))) == (6, False, True, None, "A has extra blocks")
    assert row(frame(range(6)), full) == (6, False, True, 6, "B has extra blocks")
    assert row(full, full, 0, 19) == (10, False, False, None, "block count 10 want 20")


def test_segment_lookup(spark):
    starts = [0, 20, 50]
    got = I.segment_lookup(spark.range(-5, 90).select(F.col("id").alias("round")), spark.createDataFrame([(s,) for s in starts], "segment_start bigint"), 10)
    want = {r: max((s for s in starts if s <= r), default=None) for r in range(-5, 90)}
    assert {r.round: r.segment_start for r in got.collect()} == want


def test_cursor_in_a_store(tmp_path, monkeypatch):
    c = segments.CursorFile(f"file://{tmp_path}/a/cursor")
    assert c.load() is None
    c.save(7)
    assert segments.CursorFile(f"{tmp_path}/a/cursor").load() == 7
    from pyarrow import fs

    c.store = fs.LocalFileSystem()
    c.save(8)
    assert c.load() == 8
