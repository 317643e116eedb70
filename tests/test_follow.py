import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from blockflow.functions.chain import BLOCK, make_chain
from blockflow.functions.errors import SourceError
from blockflow.sources import segments as G
from blockflow.sources.live import LiveSource, read_live
from blockflow.sources.sinks import FAULTS, ArchiveSink, Fault, MultiSink, ParquetSink, build_sinks, check_batch, replay
from blockflow.streaming import follow as L
from tests.test_archive import chain, rounds, simple


class Node:
    """A client over a generated chain up to a tip."""

    def __init__(self, n, base=0, wrong=()):
        self.blocks = {b["round"]: b for b in make_chain(base, n, 1)}
        self.wrong = wrong

    def get_block(self, round_):
        if round_ not in self.blocks:
            raise SourceError(f"HTTP 404: round {round_} not found", 404)
        b = self.blocks[round_]
        return b | {"previous_block_hash": "X"} if round_ in self.wrong else b

    def last_round(self):
        return max(self.blocks)


def node():
    return Node(300)


@pytest.mark.parametrize("args, want", [((None, None, 50, None), 50), ((None, 7, 50, None), 7), ((9, 7, 50, 9), 10), ((1049, None, 50, 40), 1050), ((1050, None, 50, 40), 41), ((1050, None, 50, 60), 50), ((1050, None, 50, None), 50)])
def test_start(args, want):
    assert L.start_round(*args) == want


def test_flush_rules():
    assert not L.should_flush(0, 10, True, True, True, 9, 1) and L.should_flush(10, 10, False, False, False, 0, 1)
    assert L.should_flush(1, 10, False, False, False, 2, 1) and not L.should_flush(1, 10, False, False, False, 0, 1)
    assert L.batch_size(10, 100, 50) == 50 and L.batch_size(98, 100, 50) == 1


def test_ordered_buffer(spark, tmp_path):
    schema = "chain string, round long, block_hash string, previous_block_hash string"
    rows = [("a", r, f"h{r}", f"h{r - 1}" if r else "") for r in range(60)] + [("b", r, f"h{r}", "broken" if r == 4 else f"h{r - 1}") for r in range(10)]
    late = [r for r in rows if r[:2] == ("a", 12)]
    rest = [r for r in rows if r not in late]
    random.Random(1).shuffle(rest)
    for k in range(4):
        spark.createDataFrame(rest[k::4] + rest[k::4][:3], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        q = L.release_in_order(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        q.awaitTermination()
        return [(r.chain, r.round, r.linked) for r in spark.read.parquet(f"{tmp_path}/out").orderBy("chain", "round").collect()]

    assert run() == [("a", r, True) for r in range(12)] + [("b", r, r != 4) for r in range(10)]  # round 12 is missing
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == [("a", r, True) for r in range(60)] + [("b", r, r != 4) for r in range(10)]  # a restart goes on


def test_ordered_buffer_keeps_parts(monkeypatch):
    """Long waits cost a call a part, not a round; the first of a round to come stays, null hashes count as empty."""

    class State(dict):
        calls = 0
        getValue, exists = dict.__getitem__, lambda s: "c" in s  # noqa: N815
        get = lambda s: s["c"]
        update = lambda s, v: s.__setitem__("c", v)
        removeKey = dict.__delitem__  # noqa: N815

        def updateValue(self, k, v):  # noqa: N802
            self.calls += 1
            self[k] = v

    monkeypatch.setattr(L, "_RELEASE_ROWS", 1500)
    b = L.OrderedBuffer(7)
    b.cursor, b.waiting = State(), State()

    def send(*frames):
        return pd.concat(b.handleInputRows(("a",), iter([pd.DataFrame(f, columns=["round", "block_hash", "previous_block_hash"]) for f in frames]), None))

    row = lambda r, h="h": (r, f"{h}{r}", f"h{r - 1}")
    late = list(range(8, 4500))
    random.Random(2).shuffle(late)
    assert len(send([row(r) for r in late[:2000]], [row(r, "x") for r in late[:100]])) == 0
    assert len(send([row(r) for r in late[1900:]] + [(3, "old", ""), (4502, None, None)])) == 0
    assert b.waiting.calls <= 2 * 5 and sorted(b.waiting) == [(k,) for k in range(5)] and b.cursor["c"] == (7, "")
    got = send([row(7), row(7, "y"), (4500, None, None)], [(4501, "h", "other")])
    assert got["round"].tolist() == list(range(7, 4503)) and got["block_hash"].tolist()[:4493] == [f"h{r}" for r in range(7, 4500)]
    assert got["linked"].tolist() == [True] * 4493 + [False, True, False] and not b.waiting and b.cursor["c"] == (4503, "")
    assert len(send([(r, "z", "") for r in (4502, 4504)])) == 0 and list(b.waiting) == [(4,)]
    assert send([(4503, "h", "")])["round"].tolist() == [4503, 4504]


def test_batches(spark):
    assert check_batch(simple(spark, 4, 5)) == (4, 8)
    for bad in (simple(spark, 0, 5).where("round <> 2"), simple(spark, 0, 2).union(simple(spark, 0, 2)), simple(spark, 0, 2).limit(0)):
        with pytest.raises(ValueError):
            check_batch(bad)


def test_parquet_sink(spark, tmp_path):
    s = ParquetSink(spark, str(tmp_path / "p"))
    assert s.last_processed_round() is None and s.max_block_round() is None and s.block_hash(0) is None
    s.commit(chain(spark, 0, 10, 2))
    s.commit(chain(spark, 0, 10, 2))
    s.commit(chain(spark, 0, 15, 2))
    assert s.last_processed_round() == 14 == s.max_block_round()
    assert rounds(s.blocks()) == list(range(15)) and s.transactions().count() == 30
    assert s.block_hash(7) == make_chain(0, 8, 2)[7]["block_hash"]
    s.truncate(10, 14)
    assert s.last_processed_round() == 9 and rounds(s.blocks()) == list(range(10)) and s.transactions().count() == 20


def test_first_writer_wins(spark, tmp_path):
    def block(r, ids):
        return (r, f"H{r}", "", 0, len(ids), bytearray(b"x"), [(i, f"s{r}{k}", "pay", 0, bytearray(b"t")) for k, i in enumerate(ids)])

    s = ParquetSink(spark, str(tmp_path / "p"))
    s.commit(spark.createDataFrame([block(0, ["a", "b", "a"]), block(1, ["b"])], BLOCK))
    s.commit(spark.createDataFrame([block(2, ["a", "c"])], BLOCK))
    assert sorted((r.txid, r.sender) for r in s.transactions().collect()) == [("a", "s00"), ("b", "s01"), ("c", "s21")]


@pytest.mark.parametrize("point", FAULTS)
def test_faults(spark, tmp_path, point):
    root = str(tmp_path / "p")
    ParquetSink(spark, root).commit(chain(spark, 0, 5, 1))
    with pytest.raises(Fault):
        ParquetSink(spark, root, fault=point).commit(chain(spark, 0, 12, 1))
    s = ParquetSink(spark, root)
    if point != "after_commit":
        assert s.last_processed_round() == 4 and rounds(s.blocks()) == list(range(5)) and s.transactions().count() == 5
    s.commit(chain(spark, 0, 12, 1))
    assert s.last_processed_round() == 11 and rounds(s.blocks()) == list(range(12)) and s.transactions().count() == 12


def test_multi_sink(spark, tmp_path):
    p, a = ParquetSink(spark, str(tmp_path / "p")), ArchiveSink(spark, str(tmp_path / "a"), 5)
    m = MultiSink([p, a])
    assert m.last_processed_round() is None
    p.commit(chain(spark, 0, 4))
    assert m.last_processed_round() is None
    m.commit(chain(spark, 0, 9))
    assert m.last_processed_round() == 8 == m.max_block_round() and m.block_hash(3) == make_chain(0, 4)[3]["block_hash"] and m.block_hash(99) is None
    a.block_hash = lambda r: "other"
    with pytest.raises(ValueError):
        m.block_hash(3)
    with pytest.raises(ValueError):
        build_sinks(spark)


def test_replay_equals_direct(spark, tmp_path):
    root = str(tmp_path / "a")
    G.write_archive(chain(spark, 0, 30, 1), root, 7)
    direct, again = ParquetSink(spark, str(tmp_path / "d")), ParquetSink(spark, str(tmp_path / "r"))
    direct.commit(chain(spark, 0, 30, 1))
    assert replay(spark, root, again, 0, 29, batch=11) == 29
    for name in ("blocks", "transactions"):
        x, y = (getattr(s, name)().drop("created_at") for s in (direct, again))
        assert x.exceptAll(y).count() == 0 == y.exceptAll(x).count()


def test_follow_archive(spark, tmp_path):
    root, sink = str(tmp_path / "a"), ParquetSink(spark, str(tmp_path / "p"))
    G.write_archive(chain(spark, 0, 20, 1), root, 6)
    L.follow_archive(spark, root, sink, str(tmp_path / "cp"), until=100).awaitTermination()
    assert sink.last_processed_round() == 19
    G.write_archive(chain(spark, 0, 33, 1), root, 6)
    L.follow_archive(spark, root, sink, str(tmp_path / "cp"), until=27).awaitTermination()
    assert sink.last_processed_round() == 27 and rounds(sink.blocks()) == list(range(28)) and sink.transactions().count() == 28
    second = ParquetSink(spark, str(tmp_path / "q"))  # another consumer, its own cursor
    L.follow_archive(spark, root, second, str(tmp_path / "cp2"), until=100).awaitTermination()
    assert second.last_processed_round() == 32 and sink.last_processed_round() == 27


def test_validation_of_micro_batches(spark, tmp_path):
    sink = ParquetSink(spark, str(tmp_path / "p"))
    commit = L.commit_to(sink)
    commit(chain(spark, 0, 5), 0)
    commit(chain(spark, 0, 5), 0)
    commit(chain(spark, 0, 5).limit(0), 1)
    good = chain(spark, 0, 9)
    for bad in (good.where("round > 5"), good.where("round > 4 and round <> 6"), good.withColumn("block_hash", F.lit("")), good.withColumn("previous_block_hash", F.when(F.col("round") == 5, "X").otherwise(F.col("previous_block_hash"))), good.withColumn("previous_block_hash", F.when(F.col("round") == 7, "X").otherwise(F.col("previous_block_hash")))):
        with pytest.raises(ValueError):
            commit(bad, 2)
    assert sink.last_processed_round() == 4
    commit(good, 2)
    assert sink.last_processed_round() == 8


def test_live_range(spark):
    df = read_live(spark, node, 20, 99, workers=4, per_task=16)
    assert rounds(df) == list(range(20, 100)) and df.rdd.getNumPartitions() == 5
    assert LiveSource(node()).get(1000) is None
    with pytest.raises(TimeoutError):
        LiveSource(node()).get_wait(1000, poll=0.01, timeout=0.05)


def test_handoff(spark, tmp_path):
    root = str(tmp_path / "a")
    phases = []
    h = L.Handoff(ArchiveSink(spark, root), LiveSource(Node(12)), phases.append)
    assert h.get(0) is None and h.phase == "waiting"
    G.write_archive(chain(spark, 0, 6, 1), root)
    got = [h.get(r)["round"] for r in range(3, 12)]
    assert got == list(range(3, 12)) and phases == ["waiting", "historical", "handoff", "live"] and h.handoff_round == 6
    assert h.get(12) is None and h.checkpoint() == 11
    bad = L.Handoff(ArchiveSink(spark, root), LiveSource(Node(12, wrong=(6,))))
    with pytest.raises(G.ArchiveError):
        bad.get(6)
    assert bad.phase == "failed"
    later = L.Handoff(ArchiveSink(spark, root), LiveSource(Node(12, wrong=(9,))))
    later.get(8)
    with pytest.raises(G.ArchiveError):
        later.get(9)


def test_consumer(spark, tmp_path):
    root, cursor = str(tmp_path / "a"), G.CursorFile(str(tmp_path / "c" / "cursor"))
    G.write_archive(simple(spark, 0, 25), root, 10)
    seen = []

    def handler(b):
        if b["round"] == 13 and 13 not in seen:
            seen.append(13)
            raise RuntimeError("once")
        seen.append(b["round"])

    with pytest.raises(RuntimeError):
        L.consume(spark, root, handler, cursor, batch=7)
    assert cursor.load() == 12
    assert L.consume(spark, root, handler, cursor, batch=7) == 24 and seen == [*range(13), 13, *range(13, 25)]
    assert L.consume(spark, root, handler, cursor) == 24
    with pytest.raises(L.RoundError) as e:
        L.consume(spark, root, handler, cursor, end=40)
    assert e.value.kind == "not_yet_available"
    G.prune_archive(spark, root, 20, 10)
    with pytest.raises(L.RoundError) as e:
        L.consume(spark, root, handler, G.CursorFile(""), start=3)
    assert e.value.kind == "not_found"
    assert not os.path.exists("cursor")


def test_follow_live_and_bootstrap(spark, tmp_path):
    from blockflow import config
    from blockflow.streaming.observe import Health

    c = config.load({"archive_root": str(tmp_path / "x"), "start_round": "0", "fetch_workers": 4, "fetch_window": 40}, {})
    sink, health = ParquetSink(spark, str(tmp_path / "p")), Health()
    assert L.follow_live(spark, node, sink, c, until=99, health=health) == 99
    assert rounds(sink.blocks()) == list(range(100)) and sink.transactions().count() == 100 and health.checkpoint == 99 and health.ready
    assert L.follow_live(spark, node, sink, c, until=120) == 120  # goes on behind the cursor
    with pytest.raises(ValueError):
        L.follow_live(spark, lambda: Node(300, wrong=(130,)), sink, c, until=140, health=health)
    assert health.mode == "failed" and sink.last_processed_round() == 120
    root, other = str(tmp_path / "a"), ArchiveSink(spark, str(tmp_path / "b"), 50)
    G.write_archive(chain(spark, 0, 60, 1), root)
    assert L.bootstrap(spark, root, node, other, c, end=80) == 80
    assert G.compare_archives(spark, root, other.root, 0, 59).first().ok and G.verify_archive(spark, other.root).first().blocks == 81


def test_explorer_routes(spark):
    from blockflow.plans import views as V
    from blockflow.plans.api import Explorer

    d = "/root/testdata/sf0.001"
    e = Explorer(V.blocks(spark, d), V.transactions(spark, d, ordinal=True), 10, V.balances(spark, d))
    assert e.get("/api/status")[1]["last_processed_round"] == 10
    assert [b["round"] for b in e.get("/api/blocks", {"limit": "3", "before": "100"})[1]] == [99, 98, 97]
    assert len(e.get("/api/blocks", {"limit": "junk"})[1]) == 40
    assert e.get("/api/blocks/x")[0] == 400 and e.get("/api/blocks/99999999")[0] == 404 and e.get("/nothing")[0] == 404
    status, block = e.get("/api/blocks/77")
    assert status == 200 and len(block["transactions"]) == block["txn_count"]
    assert all(t.get("app_id", 1) > 0 for t in e.get("/api/transactions")[1])
    assert len(e.get("/api/senders")[1]) == 10 and "balance_known" in e.get("/api/senders")[1][0]
    assert len(e.get("/api/apps", {"limit": "5"})[1]) == 5 and len(e.get("/api/busy-blocks", {"limit": "51"})[1]) == 10


def test_tools(spark, tmp_path, capsys):
    from blockflow.__main__ import main

    a, b, p = (str(tmp_path / x) for x in "abp")
    G.write_archive(chain(spark, 0, 25, 1), a, 10)
    assert main(["verify", a]) == 0 and main(["info", a]) == 0
    assert main(["export", a, b, "--from", "5", "--to", "20"]) == 0 and main(["compare", a, b, "--from", "5", "--to", "20"]) == 0
    assert main(["compare", a, b]) == 1 and main(["import", a, b]) == 1
    assert main(["prune", b, "--keep", "4"]) == 0 and main(["prune", b, "--keep", "40"]) == 0
    assert main(["replay", a, "--parquet", p]) == 0 and ParquetSink(spark, p).last_processed_round() == 24
    out = capsys.readouterr().out
    assert "pruned before 17" in out and "nothing to prune" in out and '"segments": 3' in out


def test_app_ids_from_payloads(spark):
    from blockflow.functions.chain import derive_app_ids, make_block

    b = make_block(3, transactions=3, kind="appl")
    rows = [(t["txid"], "appl", None if k else 99, bytearray(t["raw"])) for k, t in enumerate(b["transactions"])] + [("x", "appl", 0, bytearray(b"junk")), ("y", "pay", None, None), ("z", None, None, None)]
    got = derive_app_ids(spark.createDataFrame(rows, "txid string, type string, app_id long, raw_transaction binary")).collect()
    assert sorted((r.app_id or 0) for r in got) == [0, 0, 0, 8, 9, 99]
