import io
import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from blockflow.functions.chain import BLOCK, make_chain
from blockflow.sources import segments as G


def simple(spark, base, n, damage=None):
    """Blocks with payloads that don't decode on purpose."""
    rows = [(r, f"H{r}", f"H{r - 1}" if r > base else "", r, 0, bytearray(f"raw-{r}".encode()), []) for r in range(base, base + n)]
    return spark.createDataFrame(damage(rows) if damage else rows, BLOCK)


def chain(spark, base, n, transactions=0):
    return spark.createDataFrame([(b["round"], b["block_hash"], b["previous_block_hash"], b["timestamp"], b["txn_count"], bytearray(b["raw"]), b["transactions"]) for b in make_chain(base, n, transactions)], BLOCK)


def rounds(df):
    return sorted(r[0] for r in df.where("round is not null").select("round").collect())


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "archive")


def test_write_read_append(spark, root):
    assert G.write_archive(simple(spark, 5, 30), root, 10) == 34
    assert [os.path.basename(p) for _, p in G.list_segments(root)] == [f"{s:020d}.seg" for s in (0, 10, 20, 30)]
    assert G.write_archive(simple(spark, 5, 30), root, 10) == 34  # again: nothing happens
    more = simple(spark, 30, 13).withColumn("previous_block_hash", F.concat(F.lit("H"), F.col("round") - 1))
    assert G.write_archive(more, root, 10) == 42
    got = {r.round: r for r in G.read_archive(spark, root).collect()}
    assert sorted(got) == list(range(5, 43)) and bytes(got[41].raw) == b"raw-41" and got[41].previous_block_hash == "H40"
    assert G.archive_info(root)["segments"] == 5
    r = G.verify_archive(spark, root).first()
    assert (r.ok, r.blocks, r.first_round, r.last_round, r.gaps, r.errors) == (True, 38, 5, 42, 0, [])


def test_conditions_prune_segments(spark, root):
    G.write_archive(simple(spark, 0, 100), root, 10)
    assert rounds(G.read_archive(spark, root, 33, 47, raw=False)) == list(range(33, 48))
    assert [p.path[-8:-4] for p in G.plan_segments(root, 33, 47)] == ["0030", "0040"]
    df = G.read_archive(spark, root).where("round = 77")
    assert df.rdd.getNumPartitions() == 1 and df.first().block_hash == "H77"
    assert G.read_archive(spark, root).where("round > 95 and round <= 97").rdd.getNumPartitions() == 1


@pytest.mark.parametrize("damage", [lambda r: r[:3] + r[4:], lambda r: [*r[:3], (*r[3][:1], "", *r[3][2:]), *r[4:]], lambda r: [*r[:3], (*r[3][:5], bytearray(), []), *r[4:]], lambda r: r + r[-1:]])
def test_bad_batches_leave_the_archive_as_it_was(spark, root, damage):
    G.write_archive(simple(spark, 0, 8), root, 5)
    with pytest.raises(G.ArchiveError):
        G.write_archive(simple(spark, 8, 9, damage), root, 5)
    with pytest.raises(G.ArchiveError):
        G.write_archive(simple(spark, 20, 3), root, 5)
    assert G.read_checkpoint(root) == 7 and rounds(G.read_archive(spark, root)) == list(range(8))
    assert not [n for n in os.listdir(f"{root}/segments") if not n.endswith(".seg")]


@pytest.mark.parametrize("point", ["before_rename", "before_checkpoint"])
def test_a_failed_write_is_repeated(spark, root, point):
    G.write_archive(simple(spark, 0, 8), root, 5)
    with pytest.raises(G.ArchiveError):
        G.write_archive(simple(spark, 8, 9), root, 5, fail_at=point)
    assert rounds(G.read_archive(spark, root)) == list(range(8))
    assert G.write_archive(simple(spark, 8, 9), root, 5) == 16
    assert rounds(G.read_archive(spark, root)) == list(range(17))


def test_what_lies_behind_the_checkpoint_is_not_read(spark, root):
    G.write_archive(simple(spark, 0, 4), root, 10)
    path = G.list_segments(root)[0][1]
    with open(path, "ab") as f:
        f.write(G.encode_record(4, "H4", "H3", b"x") + b"\xff" * 5)
    size = os.path.getsize(path)
    assert rounds(G.read_archive(spark, root)) == [0, 1, 2, 3] and G.verify_archive(spark, root).first().ok
    assert os.path.getsize(path) == size  # readers change nothing
    G.recover(root)
    assert os.path.getsize(path) < size


def test_damage_is_found(spark, root):
    G.write_archive(chain(spark, 0, 30, 1), root, 10)
    assert G.verify_archive(spark, root).first().ok
    path = G.list_segments(root)[1][1]
    whole = open(path, "rb").read()
    open(path, "wb").write(whole[:-7])  # the last record of a segment in the middle is cut
    r = G.verify_archive(spark, root).first()
    assert not r.ok and r.corrupt_records == 1 and r.gaps == 1 and r.errors == ["broken records"]
    with pytest.raises(Exception, match="broken record"):
        G.read_archive(spark, root, strict=True).count()
    open(path, "wb").write(whole.replace(make_chain(0, 13, 1)[12]["block_hash"].encode(), b"A" * 52, 1))
    r = G.verify_archive(spark, root).first()
    assert not r.ok and r.corrupt_records >= 1 and r.hash_errors >= 1
    open(path, "wb").write(struct.pack("<8sIQ", G.MAGIC, 99, 10) + whole[20:])
    with pytest.raises(Exception, match="version 99"):
        G.read_archive(spark, root).count()


def test_ranges(spark, root):
    G.write_archive(simple(spark, 10, 30), root, 7)
    assert G.verify_archive(spark, root, 12, 20).first().ok
    r = G.verify_archive(spark, root, 0, 20).first()
    assert not r.ok and r.gaps == 1
    assert not G.verify_archive(spark, root, 0, 5).first().ok
    assert rounds(G.iterate_archive(spark, root, 11, 30)) == list(range(11, 31))
    for a, b in ((20, 12), (5, 12), (30, 60)):
        with pytest.raises(G.ArchiveError):
            G.iterate_archive(spark, root, a, b)
    broken = str(root) + "-b"
    G.write_archive(simple(spark, 0, 9).withColumn("previous_block_hash", F.when(F.col("round") == 5, "Z").otherwise(F.col("previous_block_hash"))), broken)
    with pytest.raises(G.ArchiveError, match="round 5"):
        G.iterate_archive(spark, broken, 3, 8)


def test_export_import_compare_prune(spark, root, tmp_path):
    G.write_archive(chain(spark, 100, 40), root, 10)
    b, c = str(tmp_path / "b"), str(tmp_path / "c")
    assert G.export_archive(spark, root, b, 110, 129, 5) == 129
    r = G.compare_archives(spark, root, b, 110, 129).first()
    assert (r.ok, r.blocks, r.has_diff, r.diff_reason) == (True, 20, False, None)
    assert G.compare_archives(spark, root, b, 105, 129).first().first_diff == 105
    assert G.import_archive(spark, root, c) == 139
    with pytest.raises(G.ArchiveError):
        G.import_archive(spark, root, c)
    assert G.prune_archive(spark, c, 120, 10) and rounds(G.read_archive(spark, c)) == list(range(120, 140))
    assert not G.prune_archive(spark, c, 120, 10)
    for keep in (0, 140):
        with pytest.raises(G.ArchiveError):
            G.prune_archive(spark, c, keep)
    other = str(tmp_path / "d")
    G.write_archive(chain(spark, 100, 40).withColumn("raw", F.when(F.col("round") == 117, F.lit(b"x")).otherwise(F.col("raw"))), other)
    r = G.compare_archives(spark, root, other, 100, 139).first()
    assert (r.ok, r.first_diff, r.diff_reason) == (False, 117, "raw payload mismatch")


def test_empty_archives(spark, root):
    assert G.read_archive(spark, root).count() == 0 and G.read_checkpoint(root) is None
    assert G.verify_archive(spark, root).first().ok
    assert G.write_archive(simple(spark, 0, 3).limit(0), root) is None


@pytest.mark.parametrize("data, want", [(b"23371392\n", 23371392), (struct.pack("<Q", 42), 42), (b"12345678", 12345678), (b" \n", None), (b"", None)])
def test_checkpoint_forms(root, data, want):
    os.makedirs(root)
    with open(f"{root}/checkpoint", "wb") as f:
        f.write(data)
    assert G.read_checkpoint(root) == want


def test_many_segments_are_few_tasks(spark, root):
    G.write_archive(simple(spark, 3, 400), root, 2)
    df = G.read_archive(spark, root)
    assert len(G.list_segments(root)) == 201 and df.rdd.getNumPartitions() <= 64
    assert rounds(df) == list(range(3, 403))
    groups = G.group_segments(G.plan_segments(root, 0, 402), 5, 1 << 20)
    assert len(groups) == 5 and [p.path for g in groups for p in g.parts] == [p for _, p in G.list_segments(root)]
    assert len(G.group_segments(G.plan_segments(root, 0, 402), 5, 1000)) > 10


@pytest.mark.parametrize("raw", [True, False])
def test_records_across_what_is_read_ahead(raw):
    rng = random.Random(4)
    rows = [(r, "h" * rng.randrange(300), f"p{r}", rng.randbytes(rng.choice((0, 5, 1 << 16, (1 << 20) + 7)))) for r in range(60)]
    data = b"".join(G.encode_record(*x) for x in rows)
    got = list(G.read_records(io.BytesIO(data), raw))
    assert [x[1:] for x in got] == [(*x[:3], x[3] if raw else None) for x in rows]
    assert [x[0] for x in got] == [sum(len(G.encode_record(*y)) for y in rows[:k]) for k in range(60)]
    for cut in (1, 9, len(rows[-1][3]) + 3):
        cut_ = list(G.read_records(io.BytesIO(data[:-cut]), raw))
        assert len(cut_) == 60 and cut_[-1] == (got[-1][0],) and cut_[:-1] == got[:-1]


def test_one_pass_counts_what_the_sorted_way_counts(spark, root, monkeypatch):
    def damage(rows):
        bad = {5: (1, ""), 7: (2, "Z"), 11: (1, "Q")}
        return [(*r[: bad[r[0]][0]], bad[r[0]][1], *r[bad[r[0]][0] + 1 :]) if r[0] in bad else r for r in rows]

    def write(rows):
        for start in range(0, 40, 10):
            os.makedirs(f"{root}/segments", exist_ok=True)
            with open(f"{root}/segments/{start:020d}.seg", "wb") as f:
                f.write(struct.pack(G.HEADER, G.MAGIC, G.VERSION, start) + b"".join(G.encode_record(r[0], r[1], r[2], bytes(r[5])) for r in rows if r[0] // 10 * 10 == start) + (b"\x01" if start == 20 else b""))
        G.write_checkpoint(root, 37)

    own = [(b["round"], b["block_hash"], b["previous_block_hash"], 0, 0, b["raw"], []) for b in make_chain(0, 40)]
    gone = [r for r in damage(own) if r[0] not in (0, 14, 15, 20, 33)]
    ranges = ((None, None), (2, 30), (14, 15), (35, 50))
    write(gone)
    one = [G.verify_archive(spark, root, *x).first() for x in ranges]
    assert (one[0].blocks, one[0].gaps, one[0].corrupt_records, one[0].segments) == (33, 3, 4, 4) and not one[0].ok
    with monkeypatch.context() as m:
        m.setattr(G, "digest", lambda *_: None)
        assert [G.verify_archive(spark, root, *x).first() for x in ranges] == one
    write([*gone[:3], gone[4], gone[3], *gone[5:]])  # out of order in its file
    assert G.digest(G.read_archive(spark, root), True) is None and G.verify_archive(spark, root).first() == one[0]
