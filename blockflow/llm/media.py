"""Chroma fingerprints of audio columns, and alignment of recordings by them.

A recording (a WAV file in a binary column) is mixed to mono, brought to ``rate`` and cut into overlapping frames; each
frame's spectrum is folded into twelve pitch classes, smoothed and normalised. Sixteen rectangle filters over those
frames, evaluated on their integral image, are quantised to two bits (Gray code) each: one packed 32-bit integer for
each position in time.

Alignment: recordings with the same integers are one class, represented by its smallest id, so copies make no pairs. An
inverted index has, for each class of the queries, the integers at which a run of equal ones begins (a sustained sound
counts once), in mapped arrays. Each class looks up its own, and those that differ in one bit, in the task that reads it;
hits are counted by (query, class, offset), the offset histogram; offsets of at least ``hits`` are verified by the share of bits that differ over the whole overlap. Nothing is
capped. At 110 integers whose bits differ independently with probability 0.1, 0.15, 0.2 a true offset has some 17, 4, 0.8
hits; real errors come in clusters, which is easier. An integer that many recordings share gives pairs of each with each
query, so that work grows with the queries times such recordings.

The driver's tables hold no audio, so the query renders each row's vector as a melody, a WAV file of one tone for each
number, and treats it as such a column.

Edge cases: a null, empty, broken or too short recording has no integers and matches nothing, all such are one class; a
null id is in its class but never its representative unless all are null; repeated rows are members each; several equal
peaks: the least bit errors, then the smallest offset; other columns are left out.
"""

from __future__ import annotations

import io
import math
import struct
import wave
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockflow.llm.arraystore import open_arrays, write_arrays
from blockflow.runtime import materialise, shared_path, ship


@dataclass(frozen=True)
class MediaParams:
    rate: int = 4000  #: samples a second
    frame: int = 1024  #: samples of a frame
    hop: int = 256  #: samples between frames
    low: float = 100.0  #: lowest and highest frequency that count
    high: float = 1900.0
    hits: int = 1  #: least hits of an offset that is verified
    overlap: float = 0.5  #: least overlap, as a share of the shorter recording
    error: float = 0.2  #: most differing bits, as a share


WIDTH = 16  #: frames that a filter spans at most


def filters() -> list[tuple[int, int, int, int]]:
    """(kind, first pitch class, pitch classes, frames) of the sixteen filters."""
    return [(k % 4, (5 * k) % 8, 3 + k % 3, WIDTH // (1, 2, 2, 4)[k // 4]) for k in range(16)]


# ---- recordings --------------------------------------------------------------------------------------------


def render(vector: list[float], rate: int = 4000, tone: float = 0.125) -> bytes:
    """A WAV file with a tone for each number; equal numbers up to rounding give equal tones."""
    v = np.asarray(vector, dtype=np.float64)
    steps = np.mod(np.floor(np.nan_to_num(v, posinf=0, neginf=0) * 32), 24)
    n = int(rate * tone)
    phase = np.cumsum(np.repeat(2 * math.pi * 220 * 2 ** (steps / 12) / rate, n))
    return wav((np.sin(phase) * 12000).astype("<i2"), rate)


def wav(samples: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(samples.astype("<i2").tobytes())
    return out.getvalue()


def samples_of(media: bytes | None, rate: int) -> np.ndarray:
    """The recording as mono samples at ``rate``; empty if it can't be read."""
    try:
        with wave.open(io.BytesIO(media or b"")) as w:
            width, channels, own, data = w.getsampwidth(), w.getnchannels(), w.getframerate(), w.readframes(w.getnframes())
        kind = {1: np.uint8, 2: "<i2", 4: "<i4"}[width]
        x = np.frombuffer(data[: len(data) // (width * channels) * width * channels], dtype=kind).astype(np.float64).reshape(-1, channels).mean(axis=1)
    except (wave.Error, EOFError, KeyError, ValueError, ZeroDivisionError, struct.error):
        return np.zeros(0)
    x = (x - 128) / 128 if width == 1 else x / float(1 << (8 * width - 1))
    if own != rate and len(x):
        x = np.interp(np.arange(int(len(x) * rate / own)) * own / rate, np.arange(len(x)), x)
    return x


@lru_cache(4)
def _tables(p: MediaParams) -> tuple[np.ndarray, np.ndarray]:
    """(the window, the matrix from spectrum to pitch classes)."""
    freq = np.fft.rfftfreq(p.frame, 1 / p.rate)
    fold = np.zeros((len(freq), 12))
    for i, f in enumerate(freq):
        if p.low <= f <= p.high:
            note = 12 * math.log2(f / 440)
            lower = math.floor(note)
            fold[i, lower % 12] += 1 - (note - lower)
            fold[i, (lower + 1) % 12] += note - lower
    return np.hanning(p.frame), fold


def chroma(x: np.ndarray, p: MediaParams = MediaParams()) -> np.ndarray:
    """Normalised pitch-class frames (frames x 12)."""
    if len(x) < p.frame:
        return np.zeros((0, 12))
    window, fold = _tables(p)
    frames = np.lib.stride_tricks.sliding_window_view(x, p.frame)[:: p.hop]
    out = []
    for lo in range(0, len(frames), 4096):
        power = np.abs(np.fft.rfft(frames[lo : lo + 4096] * window, axis=1)) ** 2
        out.append(power @ fold)
    c = np.concatenate(out)
    if len(c) >= 5:
        c = sum(w * c[k : len(c) - 4 + k] for k, w in enumerate((0.25, 0.75, 1.0, 0.75, 0.25)))
    norm = np.sqrt((c**2).sum(axis=1, keepdims=True))
    return np.where(norm > 1e-3, c / np.maximum(norm, 1e-12), 0.0)


def integers(c: np.ndarray) -> np.ndarray:
    """The packed integers (unsigned, 32 bits) of pitch-class frames, one for each place where all filters fit."""
    n = len(c) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint32)
    image = np.zeros((len(c) + 1, 13))
    image[1:, 1:] = c.cumsum(axis=0).cumsum(axis=1)
    t = np.arange(n)

    def area(t0: int, t1: int, y0: int, y1: int) -> np.ndarray:
        return image[t + t1, y1] - image[t + t0, y1] - image[t + t1, y0] + image[t + t0, y0]

    out = np.zeros(n, dtype=np.uint32)
    for kind, y, h, w in filters():
        z = min(y + h, 12)
        a = area(0, w, y, z)
        if kind == 0:  # a band against all
            a, b = a * 12 / (z - y), area(0, w, 0, 12)
        elif kind == 1:  # its first half against its second, in time
            a, b = area(0, w // 2, y, z), area(w // 2, w, y, z)
        elif kind == 2:  # its lower half against its upper
            m = (y + z) // 2
            a, b = area(0, w, y, m) / max(m - y, 1), area(0, w, m, z) / max(z - m, 1)
        else:  # a checkerboard
            m = (y + z) // 2
            a, b = area(0, w // 2, y, m) + area(w // 2, w, m, z), area(w // 2, w, y, m) + area(0, w // 2, m, z)
        v = np.log((1 + a) / (1 + b))
        q = (v > -0.25).astype(np.uint32) + (v > 0) + (v > 0.25)
        out = (out << np.uint32(2)) | (q ^ (q >> np.uint32(1))).astype(np.uint32)
    return out


def fingerprint(media: bytes | None, p: MediaParams = MediaParams()) -> np.ndarray:
    return integers(chroma(samples_of(media, p.rate), p))


def fingerprints(rows: DataFrame, id_column: str, media: str, p: MediaParams = MediaParams(), decode: Callable[[object], bytes | None] | None = None) -> DataFrame:
    """id, items array<int> (the integers as signed). ``decode`` makes a recording of the column's value."""
    ship(rows.sparkSession)
    kind = dict(rows.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                items = []
                for v in part.column(1):
                    v = v.as_py()
                    items.append(fingerprint(decode(v) if decode else v, p).view(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(items, type=pa.list_(pa.int32()))], names=["id", "items"])

    return rows.select(id_column, media).mapInArrow(run, f"id {kind}, items array<int>")


# ---- alignment -----------------------------------------------------------------------------------------------


def classes(fps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes: class_id, h, items, n_members; members: id, class_id), both written to the shared folder."""
    keyed = materialise(fps.withColumn("h", F.struct(F.xxhash64("items").alias("a"), F.hash("items").alias("b"), F.size("items").alias("n"))), "media")
    # sort-free: an array isn't aggregated in place, so the partial sums hold one array for each class and task
    table = materialise(keyed.groupBy("h").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n_members"), F.first("items").alias("items")), "media-classes")
    return table, keyed.join(table.select("h", "class_id"), "h").select("id", "class_id")


#: The integer and those that differ in one bit.
FLIPS = np.array([0, *(1 << k for k in range(32))], dtype=np.uint32)
#: Integers of queries in a file of the index, about; hits, and integers that are compared, at once.
SHARD, HITS, COMPARED = 1 << 21, 1 << 20, 1 << 22


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all integers as unsigned, where each list begins and the last one ends) of a column of lists."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False)).astype(np.int32).view(np.uint32), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def _runs(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The positions at which a run of equal integers begins within its list."""
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[starts[:-1][np.diff(starts) > 0]] = True
    return np.flatnonzero(new)


def _spread(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo, lo + 1 ... (n of them) for each pair, one after the other."""
    ends = np.cumsum(n)
    return np.repeat(lo - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)


def write_index(queries: DataFrame) -> list[str]:
    """Write the inverted index of the queries (h, items) as sorted arrays, whole queries in a file; returns the files."""
    ship(queries.sparkSession)
    shards = (queries.agg(F.sum(F.size("items"))).first()[0] or 0) // SHARD + 1
    folder = shared_path(queries.sparkSession, "media-index")

    def write(t: pa.Table) -> pa.Table:
        number = t.column("shard")[0].as_py()
        values, starts = _lists(t.column("items").combine_chunks())
        at = _runs(values, starts)
        owner = np.searchsorted(starts, at, "right") - 1
        order = np.argsort(values[at], kind="stable")
        h = {k: t.column(k).to_numpy() for k in "abn"}
        write_arrays(f"{folder}/{number}", h | {"values": values, "starts": starts, "keys": values[at][order], "owner": owner[order], "at": (at - starts[owner])[order], "runs": np.bincount(owner, minlength=len(starts) - 1)})
        return pa.table({"shard": pa.array([number], pa.int64())})

    dealt = queries.select(F.pmod("h.a", F.lit(shards)).cast("bigint").alias("shard"), "h.a", "h.b", "h.n", "items")
    return sorted(f"{folder}/{r[0]}" for r in dealt.groupBy("shard").applyInArrow(write, "shard bigint").collect())


def _errors(x: np.ndarray, x_at: np.ndarray, y: np.ndarray, y_at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The bits in which n integers of x from x_at differ from those of y from y_at, for each."""
    out = np.zeros(len(n), dtype=np.int64)
    cuts = np.searchsorted(np.cumsum(n), np.arange(COMPARED, int(n.sum()), COMPARED))
    for part in np.split(np.arange(len(n)), np.unique(cuts)):
        if len(part):
            bits = np.bitwise_count(x[_spread(x_at[part], n[part])] ^ y[_spread(y_at[part], n[part])])
            out[part] = np.add.reduceat(bits, np.cumsum(n[part]) - n[part], dtype=np.int64)
    return out


def _aligned(index: dict[str, np.ndarray], values: np.ndarray, starts: np.ndarray, h: dict[str, np.ndarray], p: MediaParams) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, query, offset, overlap, bit_error) of the best alignments of some recordings with an index's queries."""
    at = _runs(values, starts)
    row = np.searchsorted(starts, at, "right") - 1
    runs = np.bincount(row, minlength=len(starts) - 1)
    wanted = (values[at][:, None] ^ FLIPS).reshape(-1)
    lo = np.searchsorted(index["keys"], wanted)
    n = np.searchsorted(index["keys"], wanted, "right") - lo
    row, at = np.repeat(row, len(FLIPS)), np.repeat(at - starts[row], len(FLIPS))
    met = np.flatnonzero(n)
    lo, n, row, at = lo[met], n[met], row[met], at[met]
    first = np.flatnonzero(np.diff(row, prepend=-1))  # blocks are of whole rows
    done = np.cumsum(n)[first] - n[first]
    for block in np.split(np.arange(len(row)), first[1:][done[1:] // HITS != done[:-1] // HITS]):
        e = _spread(lo[block], n[block])
        q, r = index["owner"][e].astype(np.int64), np.repeat(row[block], n[block])
        offset = index["at"][e].astype(np.int64) - np.repeat(at[block], n[block])
        other = (index["a"][q] != h["a"][r]) | (index["b"][q] != h["b"][r]) | (index["n"][q] != h["n"][r])
        queries = len(index["a"])
        key, hits = np.unique((((r * queries + q) << 32) + offset + (1 << 31))[other], return_counts=True)
        offset = (key & 0xFFFFFFFF) - (1 << 31)
        r, q = np.divmod(key >> 32, queries)
        # a recording of few runs can't have more hits
        enough = (hits >= p.hits) | (index["runs"][q] < p.hits) | (runs[r] < p.hits)
        size_q, size_r = np.diff(index["starts"])[q], np.diff(starts)[r]
        q_at, r_at = np.maximum(offset, 0), np.maximum(-offset, 0)
        overlap = np.minimum(size_q - q_at, size_r - r_at)
        long = np.flatnonzero(enough & (overlap >= p.overlap * np.minimum(size_q, size_r)))
        r, q, offset, overlap = r[long], q[long], offset[long], overlap[long]
        error = _errors(index["values"], index["starts"][q] + q_at[long], values, starts[r] + r_at[long], overlap) / (32.0 * overlap)
        good = np.flatnonzero(error <= p.error)
        good = good[np.lexsort((offset[good], error[good], q[good], r[good]))]
        same = np.zeros(len(good), dtype=bool)
        same[1:] = (q[good[1:]] == q[good[:-1]]) & (r[good[1:]] == r[good[:-1]])
        best = good[~same]
        yield r[best], q[best], offset[best], overlap[best], error[best]


def align(table: DataFrame, queries: DataFrame, p: MediaParams = MediaParams()) -> DataFrame:
    """h, match_id, offset, overlap, bit_error: for each class of ``queries`` (h) the classes that align with it.

    ``offset``: how many integers the match starts after the query. Its own class isn't returned. The queries' index lies
    in mapped arrays; each class looks its integers up and is compared where it is read, so hits are never shuffled.
    """
    files = write_index(queries)
    kind = dict(table.dtypes)["class_id"]
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                values, starts = _lists(part.column(4))
                h = {k: part.column(i).to_numpy() for i, k in enumerate("abn")}
                for file in files:
                    index = open_arrays(file)[0]
                    for r, q, offset, overlap, error in _aligned(index, values, starts, h, p):
                        found = [index["a"][q], index["b"][q], index["n"][q], offset, overlap, error]
                        columns = [pa.array(c).cast(t) for c, t in zip(found, types, strict=True)]
                        yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(columns[:3], names=["a", "b", "n"]), part.column(3).take(pa.array(r)), *columns[3:]], names=["h", "match_id", "offset", "overlap", "bit_error"])

    rows = table.select("h.a", "h.b", "h.n", "class_id", "items")
    return rows.mapInArrow(run, f"h struct<a: bigint, b: int, n: int>, match_id {kind}, offset int, overlap int, bit_error double")


def media_digest(rows: DataFrame, p: MediaParams = MediaParams(), id_column: str = "vec_id", vector: str = "embedding", every: int = 100) -> DataFrame:
    """kind, id, class_id, match_class_id, offset, overlap, bit_error.

    ``member`` rows: each id and its class. ``match`` rows: for each class that holds a query (an id divisible by
    ``every``) each class that aligns with it; id is the query class's smallest query.
    """
    table, members = classes(fingerprints(rows, id_column, vector, p, _melody))
    asked = members.where(F.col("id") % every == 0).groupBy("class_id").agg(F.min("id").alias("query"))
    queries = materialise(table.where(F.size("items") > 0).join(asked, "class_id").select("h", "items", "class_id", "query"), "media-queries")
    found = align(table.where(F.size("items") > 0), queries, p).join(queries.select("h", "class_id", "query"), "h")
    match = found.select(F.lit("match").alias("kind"), F.col("query").alias("id"), "class_id", F.col("match_id").alias("match_class_id"), "offset", "overlap", "bit_error")
    null = lambda t: F.lit(None).cast(t)
    member = members.select(F.lit("member").alias("kind"), "id", "class_id", null("bigint").alias("match_class_id"), null("int").alias("offset"), null("int").alias("overlap"), null("double").alias("bit_error"))
    return member.unionByName(match)


def _melody(v: object) -> bytes | None:
    return None if not v or any(x is None for x in v) else render(v)
