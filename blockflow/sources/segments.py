"""The segment archive: a folder with a checkpoint and files of blocks, read and written by Spark tasks.

    root/checkpoint                       the last durable round, in decimal
    root/segments/{start, 20 digits}.seg  header, then records in the order of their rounds

Header: 8 bytes of magic, u32 version, u64 start. Record: u64 round, u16 length and hash, u16 length and previous hash,
u32 length and payload; all little-endian. A segment holds the rounds from its start up to the next segment's. What is
behind the checkpoint isn't durable and no reader returns it. Readers never change a file.

The folder must be visible to the driver and all executors (a mounted path, or a URI that pyarrow opens).

As a data source: ``spark.read.format("blockseg").option("path", root)`` with options raw (false leaves payloads unread)
and strict; conditions on ``round`` prune segments. ``spark.readStream`` follows the checkpoint. Writing goes through
``write_archive``: tasks write whole segments beside the old ones, the driver checks them, renames, and moves the
checkpoint last, so a failed write leaves the archive as it was.
"""

from __future__ import annotations

import os
import shutil
import struct
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from blockflow.operators import integrity
from blockflow.runtime import ship

# fixed values of the file format
MAGIC, VERSION, SEGMENT_SIZE = b"VFFSEG01", 1, 1000
HEADER = "<8sIQ"

SCHEMA = "segment_start bigint, offset bigint, round bigint, block_hash string, previous_block_hash string, raw binary, corrupt boolean"
#: The same for tasks, which have no session to parse it.
ARROW = pa.schema([("segment_start", pa.int64()), ("offset", pa.int64()), ("round", pa.int64()), ("block_hash", pa.string()), ("previous_block_hash", pa.string()), ("raw", pa.binary()), ("corrupt", pa.bool_())])


class ArchiveError(Exception):
    """An archive that can't be read or written as asked."""


# ---- files ---------------------------------------------------------------------------------------------------------


def local(path: str) -> str | None:
    u = urlparse(path)
    return unquote(u.path) if u.scheme in ("", "file") else None


def open_read(path: str) -> BinaryIO:
    own = local(path)
    if own is not None:
        return open(own, "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def list_segments(root: str) -> list[tuple[int, str]]:
    """(start, path) of the segments, by start; files with other names are left out."""
    folder = f"{root.rstrip('/')}/segments"
    own = local(folder)
    if own is not None:
        names = os.listdir(own) if os.path.isdir(own) else []
    else:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(folder)
        names = [f.base_name for f in system.get_file_info(fs.FileSelector(inner, allow_not_found=True))]
    return sorted((int(n[:-4]), f"{folder}/{n}") for n in names if n.endswith(".seg") and n[:-4].isascii() and n[:-4].isdigit())


def read_checkpoint(root: str) -> int | None:
    """The last durable round; None without one. Also reads the old form, eight bytes little-endian."""
    try:
        with open_read(f"{root.rstrip('/')}/checkpoint") as f:
            data = f.read()
    except FileNotFoundError:
        return None
    text = data.strip()
    if not text:
        return None
    if len(text) == 8 and not text.isdigit():
        return int.from_bytes(text, "little")
    if not text.isdigit():
        raise ArchiveError(f"checkpoint isn't a number: {text[:20]!r}")
    return int(text)


def write_checkpoint(root: str, round_: int) -> None:
    """Durable and at once: a new file is synced and renamed over the old one."""
    own = local(root) or root
    os.makedirs(own, exist_ok=True)
    new = f"{own}/checkpoint.{uuid.uuid4().hex}"
    with open(new, "wb") as f:
        f.write(f"{round_}\n".encode())
        f.flush()
        os.fsync(f.fileno())
    os.replace(new, f"{own}/checkpoint")
    folder = os.open(own, os.O_RDONLY)
    try:
        os.fsync(folder)
    finally:
        os.close(folder)


# ---- records ---------------------------------------------------------------------------------------------------------


def encode_record(round_: int, block_hash: str, previous: str, raw: bytes) -> bytes:
    h, p = block_hash.encode(), previous.encode()
    if len(h) > 0xFFFF or len(p) > 0xFFFF or len(raw) > 0xFFFFFFFF:
        raise ArchiveError(f"round {round_} is too long for a record")
    return b"".join((struct.pack("<QH", round_, len(h)), h, struct.pack("<H", len(p)), p, struct.pack("<I", len(raw)), raw))


def read_header(f: BinaryIO, path: str) -> int:
    data = f.read(struct.calcsize(HEADER))
    if len(data) < struct.calcsize(HEADER):
        raise ArchiveError(f"{path}: no header")
    magic, version, start = struct.unpack(HEADER, data)
    if magic != MAGIC or version != VERSION:
        raise ArchiveError(f"{path}: unknown format {magic!r} version {version}")
    return start


_HEAD, _SHORT, _LONG = struct.Struct("<QH"), struct.Struct("<H"), struct.Struct("<I")


def read_records(f: BinaryIO, raw: bool = True) -> Iterator[tuple[int, int, str, str, bytes | None] | tuple[int]]:
    """(offset, round, hash, previous hash, payload) of each record; (offset,) for bytes at the end that aren't one.

    Reads ahead, less where payloads are left out: those that go beyond what was read are skipped.
    """
    ahead = 1 << 20 if raw else 1 << 16
    base, data, at = f.tell(), b"", 0  # the file's place where data begins; where the next record begins in it
    while True:
        try:
            round_, n = _HEAD.unpack_from(data, at)
            h_end = at + 10 + n
            p_start = h_end + 2
            p_end = p_start + _SHORT.unpack_from(data, h_end)[0]
            start = p_end + 4
            end = start + _LONG.unpack_from(data, p_end)[0]
            if end > len(data) and raw:
                raise EOFError
        except (struct.error, EOFError):
            data, base, at = data[at:], base + at, 0
            more = f.read(max(ahead, len(data)))
            if more:
                data += more
                continue
            if data:
                yield (base,)
            return
        place = base + at
        if end > len(data):
            f.seek(base + end - 1)
            if not f.read(1):
                yield (place,)
                return
        try:
            h, p = data[at + 10 : h_end].decode(), data[p_start:p_end].decode()
        except UnicodeDecodeError:
            yield (place,)
            return
        yield place, round_, h, p, data[start:end] if raw else None
        if end > len(data):
            base, data, at = base + end, b"", 0
        else:
            at = end


def segment_for(round_: Column, starts: list[int]) -> Column:
    """The largest of the sorted ``starts`` that isn't above a round; null if all are."""
    return F.array_max(F.filter(F.array(*(F.lit(s).cast("bigint") for s in starts)), lambda s: s <= round_)) if starts else F.lit(None).cast("bigint")


# ---- data source --------------------------------------------------------------------------------------------------------


class SegmentPartition(InputPartition):
    def __init__(self, path: str, low: int, high: int) -> None:
        super().__init__((path, low, high))
        self.path, self.low, self.high = path, low, high


def plan_segments(root: str, low: int, high: int) -> list[SegmentPartition]:
    """The segments that can hold rounds from ``low`` to ``high``: up to where the next one starts."""
    segments = list_segments(root)
    starts = [s for s, _ in segments]
    first = max(0, bisect_right(starts, low) - 1)
    return [SegmentPartition(path, low, high) for start, path in segments[first : bisect_right(starts, high)]]


class SegmentGroup(InputPartition):
    """Consecutive segments that one task reads."""

    def __init__(self, parts: list[SegmentPartition]) -> None:
        super().__init__(tuple(p.path for p in parts))
        self.parts = parts


def group_segments(parts: list[SegmentPartition], tasks: int = 64, most: int = 32 << 20) -> list[InputPartition]:
    """A task costs more than a small segment: at most ``tasks`` groups, or as many as ``most`` bytes for each make."""
    if len(parts) <= tasks:
        return [SegmentGroup([p]) for p in parts]
    if local(parts[0].path) is not None:
        sizes = [os.path.getsize(local(p.path) or p.path) for p in parts]
    else:
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(parts[0].path)
        sizes = [i.size or 0 for i in system.get_file_info([fs.FileSystem.from_uri(p.path)[1] for p in parts])]
    n, total, done = max(tasks, sum(sizes) // most), sum(sizes) + len(sizes), 0
    groups: dict[int, list[SegmentPartition]] = {}
    for p, size in zip(parts, sizes, strict=True):
        groups.setdefault(done * n // total, []).append(p)
        done += size + 1
    return [SegmentGroup(g) for g in groups.values()]


def read_segments(parts: list[SegmentPartition], raw: bool, strict: bool) -> Iterator[pa.RecordBatch]:
    """Arrow batches of the segments' records in the range, in the order of the files."""
    rows: list[tuple] = []
    size = 0
    for p in parts:
        with open_read(p.path) as f:
            start = read_header(f, p.path)
            last = None
            for record in read_records(f, raw):
                if len(record) == 1:  # bytes behind the last record: damage only if the checkpoint promises more
                    if last is None or last < p.high:
                        if strict:
                            raise ArchiveError(f"{p.path}: broken record at {record[0]}")
                        rows.append((start, record[0], None, None, None, None, True))
                    break
                at, round_, h, prev, data = record
                last = round_
                if p.low <= round_ <= p.high:
                    rows.append((start, at, round_, h, prev, data, False))
                    size += len(data or b"") + 200
                if size > 4 << 20:
                    yield _batch(rows)
                    rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


def _true(value: str | None, default: bool) -> bool:
    return default if value is None else str(value).lower() == "true"


class BlockSegments(DataSource):
    """``blockseg``: the records of an archive up to its checkpoint."""

    @classmethod
    def name(cls) -> str:
        return "blockseg"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return SegmentReader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return SegmentStreamReader(self.options)


class SegmentReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root, self.raw, self.strict = options["path"], _true(options.get("raw"), True), _true(options.get("strict"), False)
        self.low, self.high = int(options.get("from", 0)), int(options.get("to", (1 << 63) - 1))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if getattr(f, "attribute", None) == ("round",) and isinstance(getattr(f, "value", None), int):
                if isinstance(f, EqualTo | GreaterThanOrEqual | GreaterThan):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, EqualTo | LessThanOrEqual | LessThan):
                    self.high = min(self.high, f.value - isinstance(f, LessThan))
            yield f  # broken records have no round, so Spark checks the condition too

    def partitions(self) -> list[InputPartition]:
        cp = read_checkpoint(self.root)
        high = -1 if cp is None else min(cp, self.high)
        return group_segments(plan_segments(self.root, self.low, high)) if self.low <= high else []

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, SegmentGroup):
            return
        yield from read_segments(partition.parts, self.raw, self.strict)


class SegmentStreamReader(DataSourceStreamReader):
    """Follows an archive that grows: each batch is what the checkpoint has moved over.

    ``window``: at most so many rounds beyond the cursor that ``cursor`` (a file with a round) holds; without that, all.
    """

    def __init__(self, options: dict) -> None:
        self.root, self.raw = options["path"], _true(options.get("raw"), True)
        self.start, self.window, self.cursor = int(options.get("from", 0)), int(options.get("window", 0)), options.get("cursor")

    def initialOffset(self) -> dict:  # noqa: N802
        return {"next": self.start}

    def latestOffset(self) -> dict:  # noqa: N802
        cp = read_checkpoint(self.root)
        end = self.start if cp is None else max(self.start, cp + 1)
        if self.window and self.cursor:
            done = CursorFile(self.cursor).load()
            end = min(end, (self.start if done is None else done + 1) + self.window)
        return {"next": end}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return group_segments(plan_segments(self.root, start["next"], end["next"] - 1)) if start["next"] < end["next"] else []

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from read_segments(partition.parts, self.raw, True)

    def commit(self, end: dict) -> None:
        """Nothing to do: the archive keeps its records."""


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BlockSegments)


def read_archive(spark: SparkSession, root: str, start: int | None = None, end: int | None = None, raw: bool = True, strict: bool = False) -> DataFrame:
    """The durable records of an archive, of a range of rounds if one is given."""
    register(spark)
    reader = spark.read.format("blockseg").option("path", root).option("raw", str(raw).lower()).option("strict", str(strict).lower())
    df = reader.load()
    if start is not None:
        df = df.where(F.col("round") >= start)
    if end is not None:
        df = df.where(F.col("round") <= end)
    return df if raw else df.drop("raw")


# ---- writing ------------------------------------------------------------------------------------------------------------


def write_archive(blocks: DataFrame, root: str, size: int = SEGMENT_SIZE, fail_at: str | None = None) -> int | None:
    """Append blocks (round, block_hash, previous_block_hash, raw) and return the checkpoint.

    Rounds up to the checkpoint are left out, so a repeated write does nothing. The rest must be without gaps, start
    right after the checkpoint (anywhere in an empty archive), and have a hash and a payload. ``fail_at`` (before_rename,
    before_checkpoint) stops there, for tests of recovery.
    """
    own = local(root)
    if own is None:
        raise ArchiveError(f"{root}: an archive is written to a path that is mounted on the driver and the executors")
    ship(blocks.sparkSession)
    cp = read_checkpoint(root)
    new = blocks.select("round", "block_hash", "previous_block_hash", "raw")
    if cp is not None:
        new = new.where(F.col("round") > cp)
    if fail_at is None:
        recover(root)
    os.makedirs(f"{own}/segments", exist_ok=True)
    mark = f"new-{uuid.uuid4().hex}"
    names = ("round", "block_hash", "previous_block_hash", "raw", "_start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, start, first, last, n, bad = None, None, None, None, 0, ""
        done = []

        def finish() -> None:
            if writer is not None:
                writer.flush()
                os.fsync(writer.fileno())
                writer.close()
                done.append((start, first, last, n, writer.name, bad))

        for batch in batches:
            for round_, h, prev, raw, own_start in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if own_start != start:
                    finish()
                    start, first, last, n, bad = own_start, round_, None, 0, ""
                    path = f"{own}/segments/{start:020d}.seg"
                    writer = open(f"{path}.{mark}.{uuid.uuid4().hex}", "wb")  # noqa: SIM115
                    writer.write(struct.pack(HEADER, MAGIC, VERSION, start))
                    if cp is not None and os.path.exists(path):  # its durable records stay in front
                        with open(path, "rb") as old:
                            read_header(old, path)
                            for x in read_records(old):
                                if len(x) > 1 and x[1] <= cp:
                                    writer.write(encode_record(*x[1:]))
                if not bad and (not h or not raw or (last is not None and round_ != last + 1)):
                    bad = f"round {round_} is empty or doesn't follow {last}"
                last = round_
                n += 1
                writer.write(encode_record(round_, h or "", prev or "", raw or b""))
        finish()
        yield pa.RecordBatch.from_pylist([dict(zip(("start", "first", "last", "n", "path", "bad"), d, strict=True)) for d in done], schema=pa.schema([("start", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("n", pa.int64()), ("path", pa.string()), ("bad", pa.string())]))

    dealt = new.withColumn("_start", F.floor(F.col("round") / size) * size).repartition("_start").sortWithinPartitions("_start", "round")
    files = sorted(dealt.mapInArrow(run, "start bigint, first bigint, last bigint, n bigint, path string, bad string").collect(), key=lambda r: r["start"])  # a row for each segment

    def drop() -> None:
        for n in os.listdir(f"{own}/segments"):
            if f".seg.{mark}." in n:
                os.remove(f"{own}/segments/{n}")

    if not files:
        return cp
    bad = next((r["bad"] for r in files if r["bad"]), "")
    if cp is not None and files[0]["first"] != cp + 1:
        bad = bad or f"round {files[0]['first']} doesn't follow the checkpoint {cp}"
    for a, b in zip(files, files[1:], strict=False):
        if b["first"] != a["last"] + 1:
            bad = bad or f"round {b['first']} doesn't follow {a['last']}"
    if bad:
        drop()
        raise ArchiveError(bad)
    if fail_at == "before_rename":
        raise ArchiveError(fail_at)
    for r in files:
        os.replace(r["path"], f"{own}/segments/{r['start']:020d}.seg")
    drop()  # of attempts that were run twice
    if fail_at == "before_checkpoint":
        raise ArchiveError(fail_at)
    write_checkpoint(root, files[-1]["last"])
    return files[-1]["last"]


def recover(root: str) -> None:
    """For the writer: drop files of failed writes, and what lies behind the checkpoint: whole segments, and the end of the one that holds it."""
    own = local(root) or root
    if not os.path.isdir(f"{own}/segments"):
        return
    cp = read_checkpoint(root)
    for n in os.listdir(f"{own}/segments"):
        if ".seg.new-" in n:
            os.remove(f"{own}/segments/{n}")
    for start, path in reversed(list_segments(own)):
        if cp is None or start > cp:
            os.remove(path)
            continue
        with open(path, "rb") as f:
            read_header(f, path)
            end = next((x[0] for x in read_records(f, raw=False) if len(x) == 1 or x[1] > cp), None)
        if end is not None:
            with open(path, "r+b") as f:
                f.truncate(end)
                os.fsync(f.fileno())
        return  # all segments before are whole: a later one was begun, or the checkpoint is in this one


# ---- archive operations ------------------------------------------------------------------------------------------------------


_DIGEST = "first bigint, last bigint, n bigint, gaps bigint, hash_errors bigint, corrupt bigint, broken bigint, empty bigint, files array<bigint>, ordered boolean, previous string, hash string"


def digest(rows: DataFrame, payloads: bool) -> dict | None:
    """What one pass over ``rows`` of ``read_archive`` counts, where they lie in order; None where they don't.

    n, first, last, gaps, hash_errors (as ``integrity.verify_summary`` counts them), corrupt (payloads that decode and
    differ; only with ``payloads``), broken, empty (without a hash), files. A row a task comes to the driver.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    from blockflow.functions.chain import differs

    schema = to_arrow_schema(StructType.fromDDL(_DIGEST))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = dict.fromkeys(("n", "gaps", "hash_errors", "corrupt", "broken", "empty"), 0) | {"first": None, "last": None, "previous": None, "hash": None, "ordered": True}
        files: set[int] = set()
        for batch in batches:
            files.update(pc.unique(batch.column(0)).to_pylist())
            known = batch.column(1).is_valid()
            d["broken"] += len(known) - known.true_count
            batch = batch.filter(known)
            if not batch.num_rows:
                continue
            rounds, h, prev = batch.column(1).to_numpy(), batch.column(2), batch.column(3)
            if d["n"]:
                _step(d, d["last"], d["hash"], int(rounds[0]), prev[0].as_py())
            else:
                d["first"], d["previous"] = int(rounds[0]), prev[0].as_py()
            step = np.diff(rounds)
            d["ordered"] &= bool((step > 0).all())
            d["gaps"] += int((step != 1).sum())
            before = h.slice(0, len(h) - 1)
            d["hash_errors"] += pc.sum(pc.and_(pc.not_equal(before, ""), pc.not_equal(prev.slice(1), before))).as_py() or 0
            d["empty"] += pc.sum(pc.equal(h, "")).as_py()
            if payloads:
                d["corrupt"] += sum(map(differs, batch.column(4).to_pylist(), rounds.tolist(), h.to_pylist(), prev.to_pylist()))
            d |= {"n": d["n"] + len(rounds), "last": int(rounds[-1]), "hash": h[-1].as_py()}
        if files:
            yield pa.RecordBatch.from_pylist([d | {"files": sorted(files)}], schema=schema)

    columns = ["segment_start", "round", "block_hash", "previous_block_hash", *["raw"] * payloads]
    out = dict.fromkeys(("n", "gaps", "hash_errors", "corrupt", "broken", "empty"), 0) | {"first": None, "last": None, "ordered": True}
    files: set[int] = set()
    hash_ = ""
    tasks = [r.asDict() for r in rows.select(*columns).mapInArrow(run, _DIGEST).collect()]
    for d in sorted(tasks, key=lambda d: (d["first"] is not None, d["first"] or 0)):
        files.update(d["files"])
        for k in ("gaps", "hash_errors", "corrupt", "broken", "empty"):
            out[k] += d[k]
        if d["n"]:
            if out["n"]:
                _step(out, out["last"], hash_, d["first"], d["previous"])
            out |= {"n": out["n"] + d["n"], "first": d["first"] if out["first"] is None else out["first"], "last": d["last"], "ordered": out["ordered"] and d["ordered"]}
            hash_ = d["hash"]
    return out | {"files": len(files)} if out["ordered"] else None


def _step(d: dict, last: int, hash_: str, round_: int, previous: str) -> None:
    """Count what is wrong from one record to the next."""
    d["ordered"] &= round_ > last
    d["gaps"] += round_ != last + 1
    d["hash_errors"] += hash_ != "" and previous != hash_


def verify_archive(spark: SparkSession, root: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """One row: integrity.verify_summary's counts, and checkpoint, version and errors; payloads are checked where they decode.

    A broken record before the checkpoint counts as corrupt. A bounded range must be there as a whole.
    """
    cp = read_checkpoint(root)
    rows = read_archive(spark, root)
    if start is not None or end is not None:
        rows = rows.where(F.col("round").isNull() | F.col("round").between(start or 0, (1 << 62) if end is None else end))
    full = start is None and end is None
    stop = cp if full or cp is None else min(cp, end if end is not None else cp)
    if (d := digest(rows.where(F.col("round").isNull() | (F.col("round") <= (-1 if stop is None else stop))), True)) is not None:
        counts = (d["n"], d["first"], d["last"], d["gaps"], d["hash_errors"], d["corrupt"], d["broken"], d["files"])
        both = spark.createDataFrame([counts], "blocks bigint, first_round bigint, last_round bigint, gaps bigint, hash_errors bigint, corrupt_records bigint, broken bigint, files bigint")
    else:
        both = _verify_unordered(rows, cp, stop)
    want = 0 if cp is None or full else stop - (start or 0) + 1
    short = F.lit(not full) & (F.col("blocks") != want)
    errors = F.filter(F.array(
        F.when(F.col("broken") > 0, F.lit("broken records")), F.when(F.lit(full and cp is not None) & ~F.col("last_round").eqNullSafe(F.lit(cp)), F.lit("the last round isn't the checkpoint")),
        F.when(short, F.lit("rounds of the range are missing")),
    ), lambda e: e.isNotNull())
    return both.select(
        F.lit(root).alias("root"), "first_round", "last_round", "blocks", F.col("files").alias("segments"), (F.col("gaps") + short.cast("int")).alias("gaps"), "hash_errors",
        (F.col("corrupt_records") + F.col("broken")).alias("corrupt_records"), F.lit(cp).cast("bigint").alias("checkpoint"), F.lit(VERSION).alias("version"), errors.alias("errors"),
        (F.col("gaps") + F.col("hash_errors") + F.col("corrupt_records") + F.col("broken") + F.size(errors) == 0).alias("ok"),
    )


def _verify_unordered(rows: DataFrame, cp: int | None, stop: int | None) -> DataFrame:
    """The counts for records that don't lie in order, which are sorted first."""
    from blockflow.functions.chain import decode_blocks

    d = decode_blocks(rows, "raw", ("segment_start", "round", "block_hash", "previous_block_hash", "corrupt"))
    wrong = F.col("decoded.decodable") & ((F.col("decoded.round") != F.col("round")) | (F.col("decoded.block_hash") != F.col("block_hash")) | (F.col("decoded.previous_block_hash") != F.col("previous_block_hash")))
    checked = d.select("segment_start", F.coalesce("round", F.lit(cp)).alias("round"), F.coalesce("block_hash", F.lit("")).alias("block_hash"), F.coalesce("previous_block_hash", F.lit("")).alias("previous_block_hash"), (F.col("corrupt") | F.coalesce(wrong, F.lit(False))).alias("corrupt"), F.col("round").isNull().alias("broken"))
    good = checked.where("not broken").drop("broken", "segment_start")
    report = integrity.verify_summary(good, stop)
    broken = checked.agg(F.coalesce(F.sum(F.col("broken").cast("int")), F.lit(0)).cast("bigint").alias("broken"), F.countDistinct("segment_start").alias("files"))
    return report.crossJoin(broken)  # one row each


def format_report(report: dict) -> str:
    lines = [f"{k}: {', '.join(v) if isinstance(v, list) else v}" for k, v in report.items() if v not in (None, [])]
    return "\n".join(lines)


def archive_info(root: str) -> dict:
    """Checkpoint, segments, bytes and version, from the folder alone."""
    segments = list_segments(root)
    sizes = [os.path.getsize(local(p) or p) for _, p in segments] if local(root) is not None else []
    return {"root": root, "checkpoint": read_checkpoint(root), "segments": len(segments), "first_segment": segments[0][0] if segments else None, "bytes": sum(sizes), "version": VERSION}


def compare_archives(spark: SparkSession, a: str, b: str, start: int, end: int) -> DataFrame:
    """integrity.compare over two archives, payloads included."""
    if end < start:
        raise ArchiveError(f"invalid range {start}-{end}")
    columns = (("block_hash", "block hash mismatch"), ("previous_block_hash", "previous hash mismatch"), ("raw", "raw payload mismatch"))
    return integrity.compare(read_archive(spark, a, start, end), read_archive(spark, b, start, end), start, end, columns=columns)


def iterate_archive(spark: SparkSession, root: str, start: int, end: int) -> DataFrame:
    """The records of an inclusive range, which must be whole and linked; ArchiveError if it isn't."""
    cp = read_checkpoint(root)
    if end < start or cp is None or end > cp:
        raise ArchiveError(f"range {start}-{end} isn't within the checkpoint {cp}")
    rows = read_archive(spark, root, start, end, strict=True)
    light = read_archive(spark, root, max(0, start - 1), end, raw=False, strict=True)
    d = digest(light, False)
    if d and d["last"] == end and d["first"] in (start, max(0, start - 1)) and not (d["gaps"] or d["hash_errors"] or d["empty"]):
        return rows
    # what is wrong
    n = light.where(F.col("round") >= start).agg(F.count(F.lit(1)), F.countDistinct("round"), F.sum((F.col("block_hash") == "").cast("int"))).first()
    if n[0] != end - start + 1 or n[1] != n[0] or n[2]:
        raise ArchiveError(f"range {start}-{end} has {n[0]} records of {n[1]} rounds, {n[2]} without a hash")
    if broken := integrity.linkage_breaks(light).where(F.col("round") >= start).orderBy("round").first():
        raise ArchiveError(f"hash linkage is broken at round {broken['round']}")
    return rows


def export_archive(spark: SparkSession, source: str, target: str, start: int, end: int, size: int = SEGMENT_SIZE) -> int | None:
    """Copy a whole range to an empty archive and verify it."""
    if list_segments(target) or read_checkpoint(target) is not None:
        raise ArchiveError(f"{target} isn't empty")
    done = write_archive(iterate_archive(spark, source, start, end), target, size)
    if not verify_archive(spark, target).first()["ok"]:
        raise ArchiveError(f"{target} doesn't verify")
    return done


def import_archive(spark: SparkSession, source: str, target: str, size: int = SEGMENT_SIZE) -> int | None:
    """Verify an archive and copy all of it to an empty one."""
    report = verify_archive(spark, source).first()
    if not report["ok"]:
        raise ArchiveError(f"{source} doesn't verify: {report['errors']}")
    if report["blocks"] == 0:
        raise ArchiveError(f"{source} is empty")
    return export_archive(spark, source, target, report["first_round"], report["last_round"], size)


def prune_archive(spark: SparkSession, root: str, keep_from: int, size: int = SEGMENT_SIZE) -> bool:
    """Drop the rounds before ``keep_from``: rewrite the rest beside the archive and swap. False if nothing is to be dropped."""
    own, cp = local(root) or root, read_checkpoint(root)
    if keep_from <= 0 or cp is None or keep_from > cp:
        raise ArchiveError(f"can't keep from {keep_from} with the checkpoint {cp}")
    first = read_archive(spark, root, raw=False).agg(F.min("round")).first()[0]
    if first is not None and first >= keep_from:
        return False
    new, old = f"{own}.prune-{uuid.uuid4().hex}", f"{own}.old-{uuid.uuid4().hex}"
    export_archive(spark, root, new, keep_from, cp, size)
    os.rename(own, old)
    try:
        os.rename(new, own)
    except OSError:
        os.rename(old, own)  # as it was
        raise
    shutil.rmtree(old)
    return True


# ---- cursors ---------------------------------------------------------------------------------------------------------------------


class CursorFile:
    """A consumer's own cursor: the last round that it has finished. An empty path keeps nothing.

    A path that isn't on a mounted file system (hdfs://, s3:// ...) is reached through Arrow's file systems.
    """

    def __init__(self, path: str) -> None:
        self.path, self.store = path, None
        if path and local(path) is None:
            from pyarrow import fs

            self.store, self.path = fs.FileSystem.from_uri(path)
        elif path:
            self.path = local(path)

    def load(self) -> int | None:
        if not self.path:
            return None
        try:
            with self.store.open_input_stream(self.path) if self.store else open(self.path, "rb") as f:
                text = f.read().decode().strip()
        except FileNotFoundError:
            return None
        if text and not text.isdigit():
            raise ArchiveError(f"{self.path} doesn't hold a round")
        return int(text) if text else None

    def save(self, round_: int) -> None:
        if not self.path:
            return
        new = f"{self.path}.{uuid.uuid4().hex}"
        if self.store:
            self.store.create_dir(os.path.dirname(self.path), recursive=True)
            with self.store.open_output_stream(new) as f:
                f.write(f"{round_}\n".encode())
            self.store.move(new, self.path)
            return
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        with open(new, "w") as f:
            f.write(f"{round_}\n")
            f.flush()
            os.fsync(f.fileno())
        os.replace(new, self.path)

    def resume(self, start: int) -> int:
        done = self.load()
        return start if done is None else max(start, done + 1)
