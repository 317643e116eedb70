import pytest
from pyspark.sql import functions as F

from blockflow.functions import chain as C
from blockflow.functions import errors as E
from blockflow.operators import explorer as X
from blockflow.operators import integrity as I
from blockflow.operators import summaries as S


@pytest.mark.parametrize(
    "value, data",
    [(None, "c0"), (True, "c3"), (0, "00"), (127, "7f"), (128, "cc80"), (65536, "ce00010000"), (1 << 40, "cf0000010000000000"), (-1, "ff"), (-33, "d0df"), (-129, "d1ff7f"), ("a", "a161"), (b"\1\2", "c4020102"), ([1, [2]], "9201" + "9102"), ({"b": 1, "a": "x", "z": 0, "e": "", "y": bytes(4)}, "82a161a178a16201"), (1.5, "cb3ff8000000000000"), ("x" * 40, "d928" + "78" * 40)],
)
def test_msgpack(value, data):
    assert C.encode(value).hex() == data
    back = C.decode(bytes.fromhex(data))
    assert back == ({"a": "x", "b": 1} if isinstance(value, dict) else value)


@pytest.mark.parametrize("bad", [b"", b"\x92\x01", b"\xc1", b"\xd9\x05ab", b"\x91" * 5000])
def test_broken_msgpack(bad):
    with pytest.raises(ValueError):
        C.decode(bad)


def test_hashes():
    # published test vector of SHA-512/256("abc")
    assert C.sha512_256(b"abc").hex() == "53048e2681941ef99b2e29b76b4c7dabe4c2d0c634fc6d46e0e2f13107e7af23"
    assert C.address(bytes(32)) == "A" * 52 + "Y5HFKQ"
    assert C.from_base32(C.base32(b"\1\2\3")) == b"\1\2\3"


def test_chain_is_linked_and_deterministic():
    a, b = C.make_chain(5, 4, 2), C.make_chain(5, 4, 2)
    assert a == b and a[0]["previous_block_hash"] == "A" * 52
    for x, y in zip(a, a[1:], strict=False):
        assert y["previous_block_hash"] == x["block_hash"] and len(x["block_hash"]) == 52
    assert a[1]["txn_count"] == 2 and len({t["txid"] for x in a for t in x["transactions"]}) == 8
    assert C.app_id_of(a[0]["transactions"][0]["raw"]) is None
    call = C.make_block(3, transactions=2, kind="appl")["transactions"][1]
    assert call["app_id"] == 8 == C.app_id_of(call["raw"])
    assert C.app_id_of(b"junk") is None and C.app_id_of(None) is None


def test_translate_checks_what_is_given():
    b = C.make_chain(7, 2, 1)[1]
    assert len(C.translate(b)["payset"]) == 1 and C.translate(b)["certificate"] == {"round": 8.0}
    assert C.translate({"raw": b["raw"], "round": 0, "block_hash": ""})["header"]["rnd"] == 8
    for name, wrong in (("round", 9), ("block_hash", "X"), ("previous_block_hash", "X"), ("txn_count", 5)):
        with pytest.raises(ValueError, match=name):
            C.translate(b | {name: wrong})
    with pytest.raises(ValueError):
        C.translate({"raw": b"raw-1"})


def test_decode_in_tasks(spark):
    chain = C.make_chain(0, 3, 2)
    rows = [(b["round"], bytearray(b["raw"])) for b in chain] + [(9, bytearray(b"raw-9")), (10, None)]
    got = {r.round: r.decoded for r in C.decode_blocks(spark.createDataFrame(rows, "round long, raw binary"), "raw", ("round",)).collect()}
    assert [got[i].decodable for i in (0, 1, 2, 9, 10)] == [True] * 3 + [False] * 2
    assert got[1].block_hash == chain[1]["block_hash"] and got[1].transactions[1].txid == chain[1]["transactions"][1]["txid"] and got[9].round is None
    t = C.explode_transactions(spark.createDataFrame([{k: b[k] for k in ("round", "transactions")} for b in chain], f"round long, transactions array<{C.TRANSACTION}>"))
    assert [(r.round, r.intra, r.app_id) for r in t.orderBy("round", "intra").collect()] == [(i, k, None) for i in range(3) for k in range(2)]


def test_errors(spark):
    for message, retry, gone in E.RETRY_CASES:
        assert (E.retryable(E.SourceError(message)), E.unavailable(E.SourceError(message))) == (retry, gone)
    assert not E.retryable(E.SourceError("x", 404)) and E.retryable(E.SourceError("http 404", 503)) and E.retryable(ConnectionResetError()) and not E.retryable(None)
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 4:
            raise E.SourceError("HTTP 503", 503)
        return "ok"

    assert E.with_retry(flaky, sleep=waits.append) == "ok" and len(waits) == 3 and waits[0] < waits[1] < waits[2]
    with pytest.raises(E.SourceError):
        E.with_retry(lambda: (_ for _ in ()).throw(E.SourceError("HTTP 401", 401)), sleep=waits.append)
    df = spark.createDataFrame([(None,)], "m string").select(E.retryable_column(F.col("m")).alias("r"))
    assert df.first().r is False


def test_arguments():
    assert [X.page(v) for v in (0, -1, 201, 200, "7", "x", None)] == [40, 40, 40, 200, 7, 40, 40]
    assert [X.top(v) for v in (0, 51, 50)] == [10, 10, 50]
    assert I.prune_from(10, 11) is None and I.prune_from(10, 3) == 8


def rounds(spark, values):
    return spark.createDataFrame([(v,) for v in values], "round long")


@pytest.mark.parametrize("segment", [1, 3, 1000])
def test_predecessors_cross_segments(spark, segment):
    df = spark.createDataFrame([(r, f"h{r}") for r in (1, 2, 5, 6, 7, 20, 21)], "round long, h string")
    got = {r.round: r.prev_h for r in I.with_previous(df, ["h"], segment=segment).collect()}
    assert got == {1: None, 2: "h1", 5: "h2", 6: "h5", 7: "h6", 20: "h7", 21: "h20"}
    assert [tuple(r) for r in I.gap_ranges(df, segment).orderBy("first_missing").collect()] == [(3, 4, 2), (8, 19, 12)]
    assert sorted(r.round for r in I.contiguous_prefix(df, 4, segment).collect()) == [5, 6, 7]
    assert I.contiguous_prefix(df, 2, segment).count() == 0 and I.contiguous_prefix(df, 19, segment).count() == 2


def test_linkage_variants(spark):
    df = spark.createDataFrame([(1, "a", ""), (2, "b", "a"), (3, "c", ""), (4, "", "x"), (5, "e", "q")], "round long, block_hash string, previous_block_hash string")
    assert {r.round for r in I.linkage_breaks(df).collect()} == {3, 4}
    assert {r.round for r in I.linkage_breaks(df, lenient=True).collect()} == {4}


def test_state(spark):
    rows = [(True, "x", True, 0, 0, 9), (False, "x", True, 0, 0, 9), (False, None, False, 0, 0, 9), (False, "", True, 0, 5, 9), (False, "", True, 0, 7, 9), (False, "", False, 8, 0, 9), (False, "", True, 0, 12, 9)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, failed boolean, sink_error string, has_checkpoint boolean, next_commit long, checkpoint long, tip long")
    got = [(r.mode, r.ready, r.lag) for r in I.health(df).orderBy("i").collect()]
    assert got == [("failed", False, 9), ("degraded", False, 9), ("startup", False, 9), ("catching_up", True, 4), ("live", True, 2), ("live", True, 2), ("live", True, 0)]
    from blockflow.streaming.observe import Health

    for r, want in zip(rows, got, strict=True):
        h = Health(r[0], r[1] or "", *r[2:])
        assert (h.mode, h.ready, h.lag) == want and I.health(h.frame(spark)).first()["mode"] == want[0]


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_latency_percentiles_are_floor_indexed(spark, n):
    values = [(i * 37) % 101 for i in range(n)]
    r = S.latency_summary(spark.createDataFrame([(v,) for v in values], "v long"), F.col("v"), cells=8).first()
    s = sorted(values)
    assert tuple(r) == (n, sum(s) // n, s[n * 50 // 100], s[min(n * 95 // 100, n - 1)])
    assert S.latency_summary(spark.createDataFrame([], "v long"), F.col("v")).count() == 0


def test_config():
    from blockflow import config

    c = config.load({"archive_root": "/a", "fetch_workers": 8}, {"BLOCKFLOW_COMMIT_BATCH": "50"})
    assert (c.fetch_workers, c.fetch_window, c.commit_batch, c.first_round) == (8, 50, 50, None)
    assert config.load({"archive_root": "/a", "start_round": "12", "fetch_window": 1}, {}).fetch_window == 32
    for bad in ({}, {"archive_root": "/a", "start_round": "x"}, {"archive_root": "/a", "insert_mode": "x"}):
        with pytest.raises(ValueError):
            config.load(bad, {})
