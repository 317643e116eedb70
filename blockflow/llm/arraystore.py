"""Named arrays in one file of the shared folder, memory-mapped by whoever reads it.

A file is a JSON header and the arrays' bytes. It is written under another name and renamed, so a task that is
run twice, or lost halfway, leaves a whole file or none. Where the folder is on a mounted file system, readers
map the file itself; elsewhere (HDFS, an object store) a process copies it once to a local file that is unlinked
while open, so nothing stays behind.
"""

from __future__ import annotations

import json
import mmap
import os
import tempfile
import uuid
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockflow.runtime import shared_path, ship

_ALIGN = 64
#: Keys in a file of a set, about.
SET_KEYS = 1 << 20


def _local(uri: str) -> str | None:
    u = urlparse(uri)
    return unquote(u.path) if u.scheme in ("", "file") else None


def write_arrays(uri: str, arrays: dict[str, np.ndarray], **extra) -> None:
    """Write the arrays and JSON-like extras to ``uri``."""
    head, at = [], 0
    for name, a in arrays.items():
        at = -(-at // _ALIGN) * _ALIGN
        head.append((name, a.dtype.str, a.shape, at))
        at += a.nbytes
    text = json.dumps({"arrays": head, "extra": extra}).encode()
    start = -(-(8 + len(text)) // _ALIGN) * _ALIGN

    def fill(f) -> None:
        f.write(len(text).to_bytes(8, "little") + text)
        done = 8 + len(text)
        for (_, _, _, offset), a in zip(head, arrays.values(), strict=True):
            f.write(b"\0" * (start + offset - done))
            f.write(np.ascontiguousarray(a).data.cast("B") if a.size else b"")
            done = start + offset + a.nbytes

    path = _local(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        new = f"{path}.{uuid.uuid4().hex}"
        with open(new, "wb") as f:
            fill(f)
        os.replace(new, path)
        return
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    new = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(new) as f:
        fill(f)
    system.move(new, path)


def _map(uri: str) -> mmap.mmap:
    path = _local(uri)
    if path is not None:
        with open(path, "rb") as f:
            return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **_UNTRACKED)
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    with tempfile.TemporaryFile() as f, system.open_input_stream(path) as source:
        while chunk := source.read(1 << 22):
            f.write(chunk)
        f.flush()
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, **_UNTRACKED)


#: Maps that keep no file open, where Python can do that: a model may have more files than a process may open.
_UNTRACKED = {"trackfd": False} if os.sys.version_info >= (3, 13) else {}


@lru_cache(4096)
def open_arrays(uri: str) -> tuple[dict[str, np.ndarray], dict]:
    """(the arrays, the extras) of a file, mapped once per process."""
    m = _map(uri)
    n = int.from_bytes(m[:8], "little")
    head = json.loads(m[8 : 8 + n])
    start = -(-(8 + n) // _ALIGN) * _ALIGN
    out = {}
    for name, kind, shape, at in head["arrays"]:
        count = int(np.prod(shape))
        out[name] = np.frombuffer(m, dtype=np.dtype(kind), count=count, offset=start + at).reshape(shape) if count else np.zeros(shape, dtype=kind)
    return out, head["extra"]


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, found) of ``wanted`` in the sorted ``keys``; a position is meaningless where not found."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each pair, not symmetric."""
    with np.errstate(over="ignore"):
        z = a * np.uint64(0x9E3779B97F4A7C15) + b
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """The modified Kneser-Ney discounts of counts 1, 2 and above, from the counts of counts."""
    if not n1 or not n2:
        return 0.5, 0.75, 0.9  # too little data to estimate them
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return min(max(d1, 0.05), 0.95), min(max(d2, 0.05), 1.95), min(max(d3, 0.05), 2.95)


# ---- sets of keys: membership without a shuffle of what is filtered ----------------------------------------


def write_set(keys: DataFrame) -> dict:
    """Write the pairs of longs in the two columns of ``keys`` as sorted arrays; returns what ``in_set`` needs."""
    ship(keys.sparkSession)
    a, b = keys.columns
    shards = keys.count() // SET_KEYS + 1
    folder = shared_path(keys.sparkSession, "keys")

    def write(t: pa.Table) -> pa.Table:
        number, x, y = t.column("shard")[0].as_py(), t.column("a").to_numpy(), t.column("b").to_numpy()
        order = np.lexsort((y, x))
        write_arrays(f"{folder}/{number}", {"a": x[order], "b": y[order]})
        return pa.table({"shard": pa.array([number], pa.int64())})

    dealt = keys.select(F.pmod(F.col(a), F.lit(shards)).cast("bigint").alias("shard"), F.col(a).alias("a"), F.col(b).alias("b"))
    return {"folder": folder, "shards": shards, "present": {r[0] for r in dealt.groupBy("shard").applyInArrow(write, "shard bigint").collect()}}


def in_set(keys: dict, a: Column, b: Column) -> Column:
    """Whether the pair of longs is in the set; only the keys go to Python."""

    @F.pandas_udf("boolean")
    def found(x: pd.Series, y: pd.Series) -> pd.Series:
        x, y = x.to_numpy(np.int64), y.to_numpy(np.int64)
        shard, out = x % keys["shards"], np.zeros(len(x), dtype=bool)
        for s in np.unique(shard).tolist():
            if s in keys["present"]:
                arrays, own = open_arrays(f"{keys['folder']}/{s}")[0], np.flatnonzero(shard == s)
                lo, hi = np.searchsorted(arrays["a"], x[own]), np.searchsorted(arrays["a"], x[own], "right")
                for i, p, q in zip(own[lo < hi], lo[lo < hi], hi[lo < hi], strict=True):  # hardly ever more than one
                    out[i] = y[i] in arrays["b"][p:q]
        return pd.Series(out)

    return found(a, b)
