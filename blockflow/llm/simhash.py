"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Fingerprints: 64 bits, a bit is 1 if it is set in over half of the XXH64 hashes of a text's shingles.
2. All that follows works on distinct fingerprints, so copies cost nothing.
3. Correlated bits are grouped into partitions, from the co-occurrence counts of the bits over all fingerprints.
4. A threshold for each partition is allocated by dynamic programming. If the thresholds t_i (-1: not probed)
   of m partitions sum to at least D - m + 1, two fingerprints at D or fewer differing bits agree up to t_i bits
   in some partition i. The cost of t_i is the rows that it probes plus the candidate pairs that it makes,
   estimated from second-moment sketches of all fingerprints.
5. Each fingerprint is filed under its own value of each probed partition and the values within t_i bits of it;
   those that meet under a value are candidates and are verified by the bits that differ.
6. Values under which very many fingerprints meet would make pairs in the square of their number. Their members
   are linked exactly by another way: two fingerprints differ in at most D bits if and only if the balls around
   them of radius ceil(D/2) share a point (for even D). A point lies in the balls of a bounded number of
   fingerprints, so this is linear.
7. Components of the links: alternating large-star and small-star steps, each written to the shared folder.

Edge cases: null and empty texts, and texts without a word, have fingerprint zero and are linked like others; a
null id has its fingerprint and component and is never a component's smallest id, unless all are null; repeated
rows are returned as often as they occur; other columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockflow.llm.arraystore import in_set, write_set
from blockflow.llm.common import fresh, map_blocks, own, text_column
from blockflow.runtime import materialise, remove, ship

BITS = 64


@dataclass(frozen=True)
class SimHashParams:
    words: int = 3  #: words in a shingle
    distance: int = 2  #: most differing bits of linked fingerprints; even
    partitions: tuple[int, ...] = (2, 3, 4)  #: numbers of partitions that are considered
    bucket: int = 48  #: above this many members of a value the exact linear way is taken
    sketch: int = 1 << 11  #: counters of a second-moment sketch


# ---- fingerprints --------------------------------------------------------------------------------------


def fingerprint(text: bytes, words: int = 3) -> int:
    """The fingerprint of a text in UTF-8."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    n = len(tokens)
    digest = xxhash.xxh64_intdigest
    if n <= words:
        return digest(b" ".join(tokens), 42)
    line = b" ".join(tokens)
    ends = list(accumulate([len(t) + 1 for t in tokens]))
    starts = [0, *ends[: n - words]]
    h = np.array([digest(line[a : b - 1], 42) for a, b in zip(starts, ends[words - 1 :], strict=True)], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[lo : lo + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, p: SimHashParams = SimHashParams(), id_column: str = "doc_id", text: str = "text", keys: dict[str, Column] | None = None) -> DataFrame:
    """id, fp (the fingerprint as a signed long) for each row, and the longs ``keys``."""
    keys = keys or {}

    def block(c: dict) -> dict:
        values = np.array([fingerprint(t, p.words) for t in c["_text"]], dtype=np.uint64)
        return {"id": c["id"], "fp": pa.array(values.view(np.int64))} | {k: c[k] for k in names}

    names = list(keys)
    rows = docs.select(docs[id_column].alias("id"), text_column(docs, text).cast("binary").alias("_text"), *(v.alias(k) for k, v in keys.items()))
    return map_blocks(rows, block, ", ".join([f"id {dict(docs.dtypes)[id_column]}, fp bigint", *(f"{k} bigint" for k in names)]), "_text")


# ---- statistics of all fingerprints ---------------------------------------------------------------------


def co_occurrence(fps: DataFrame) -> np.ndarray:
    """For each pair of bits the number of fingerprints in which both are 1 (64 x 64), counted over all rows."""

    def run(batches):
        total = np.zeros((BITS, BITS), dtype=np.float64)
        for b in batches:
            v = np.ascontiguousarray(b.column(0).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(v, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
        yield pa.RecordBatch.from_pydict({"row": list(range(BITS)), "counts": list(total)}, schema=pa.schema([("row", pa.int32()), ("counts", pa.list_(pa.float64()))]))

    parts = fps.select("fp").mapInArrow(run, "row int, counts array<double>")
    sums = parts.select("row", F.posexplode("counts").alias("col", "n")).groupBy("row", "col").agg(F.sum("n").alias("n"))
    out = np.zeros((BITS, BITS))
    for r in sums.collect():  # 4096 rows
        out[r["row"], r["col"]] = r["n"]
    return out


def group_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of about equal size, correlated bits together.

    Each group starts with the bit that is least correlated with those already placed and takes, one at a time,
    the free bit with the highest mean absolute correlation to its members.
    """
    mean = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(mean, mean)
    dev = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(dev, dev))
    np.fill_diagonal(corr, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        placed = [b for g in groups for b in g]
        first = min(free, key=lambda b: (corr[b, placed].sum() if placed else -corr[b].sum(), b))
        group = [first]
        free.remove(first)
        while len(group) < size:
            best = max(free, key=lambda b: (corr[b, group].mean(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def mask_of(bits: list[int]) -> int:
    """The bits as a mask, as a signed long."""
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >> 63 else m


def _mix(v: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit mix of each value (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        z = v + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def estimated_pairs(fps: DataFrame, layouts: list[list[list[int]]], n: int, p: SimHashParams) -> dict[tuple[int, int, int], float]:
    """(layout, partition, t) -> estimated ordered pairs that agree up to t bits there, for t of 0 and 1.

    A sketch for each mask (the partition's bits, and those less one of them) sums signed counters over all rows;
    the sum of their squares estimates how many pairs agree under the mask.
    """
    masks: list[tuple[int, int, int, int]] = []  # layout, partition, missing bit or -1, mask
    for a, groups in enumerate(layouts):
        for i, g in enumerate(groups):
            masks.append((a, i, -1, sum(1 << b for b in g)))
            masks += [(a, i, b, sum(1 << c for c in g if c != b)) for b in g]
    values, size = np.array([m[3] for m in masks], dtype=np.uint64), p.sketch

    def run(batches):
        table = np.zeros((len(values), size), dtype=np.int64)
        for batch in batches:
            v = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).view(np.uint64)
            for k, m in enumerate(values):
                h = _mix(v & m, 1)
                cell, sign = (h >> np.uint64(8)) % np.uint64(size), (h & np.uint64(1)).astype(np.float64) * 2 - 1
                table[k] += np.bincount(cell.astype(np.int64), weights=sign, minlength=size).astype(np.int64)
        if table.any():
            yield pa.RecordBatch.from_pydict({"mask": list(range(len(values))), "c": list(table)}, schema=pa.schema([("mask", pa.int32()), ("c", pa.list_(pa.int64()))]))

    parts = fps.select("fp").mapInArrow(run, "mask int, c array<bigint>")
    cells = parts.select("mask", F.posexplode("c").alias("cell", "n")).groupBy("mask", "cell").agg(F.sum("n").cast("double").alias("n"))
    second = {r["mask"]: r["f2"] for r in cells.groupBy("mask").agg(F.sum(F.col("n") * F.col("n")).alias("f2")).collect()}
    exact = {k[:2]: max(0.0, second.get(j, 0.0) - n) for j, k in enumerate(masks) if k[2] < 0}
    out = {(a, i, 0): v for (a, i), v in exact.items()}
    for a, groups in enumerate(layouts):
        for i, g in enumerate(groups):
            near = sum(max(0.0, second.get(j, 0.0) - n - exact[a, i]) for j, k in enumerate(masks) if k[:2] == (a, i) and k[2] >= 0)
            out[a, i, 1] = exact[a, i] + near
    return out


def allocate(widths: list[int], pairs: dict[tuple[int, int], float], n: int, distance: int) -> tuple[float, tuple[int, ...]]:
    """The cheapest thresholds of -1, 0 or 1 whose sum is ``distance - m + 1``, and their cost, by dynamic programming."""
    m = len(widths)
    goal = distance - m + 1
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for i, w in enumerate(widths):
        new: dict[int, tuple[float, tuple[int, ...]]] = {}
        for total, (cost, chosen) in best.items():
            for t in (-1, 0, 1):
                add = 0.0 if t < 0 else 8.0 * n * sum(comb(w, k) for k in range(t + 1)) + pairs[i, t]
                if total + t not in new or cost + add < new[total + t][0]:
                    new[total + t] = (cost + add, (*chosen, t))
        best = new
    return best.get(goal, (float("inf"), ()))


# ---- probing ---------------------------------------------------------------------------------------------


def _variants(fp: Column, bits: list[int], t: int) -> Column:
    """The partition's value and those within t bits of it, as an array of longs."""
    own = fp.bitwiseAND(F.lit(mask_of(bits)))
    flips = [0, *(mask_of(list(c)) for k in range(1, t + 1) for c in combinations(bits, k))]
    return F.array(*(own.bitwiseXOR(F.lit(x)) for x in flips))


def _keys(part: int, bits: list[int], t: int) -> Column:
    return F.transform(_variants(F.col("fp"), bits, t), lambda v: F.struct(F.lit(part).alias("part"), v.alias("value")))


def links(fps: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """a, b (a < b): links between distinct fingerprints that join exactly those at most ``distance`` bits apart.

    Not every such pair is returned: members of a crowded value are linked by way of the points that they share.
    The components are the same. ``fps`` has the column fp, distinct; it is read several times.
    """
    ship(fps.sparkSession)
    n = fps.count()
    together = co_occurrence(fps)
    layouts = [group_bits(together, n, m) for m in p.partitions]
    pairs = estimated_pairs(fps, layouts, n, p)
    plans = []
    for a, groups in enumerate(layouts):
        cost, chosen = allocate([len(g) for g in groups], {(i, t): pairs[a, i, t] for i in range(len(groups)) for t in (0, 1)}, n, p.distance)
        plans.append((cost, a, chosen))
    _, a, chosen = min(plans)
    probes = [(i, g, t) for i, (g, t) in enumerate(zip(layouts[a], chosen, strict=True)) if t >= 0]
    filed = fps.select("fp", F.explode(F.flatten(F.array(*(_keys(*probe) for probe in probes)))).alias("k")).select("fp", "k.part", "k.value")
    sizes = filed.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = materialise(filed.join(sizes, ["part", "value"]), "met")
    # few under a value: compare them within the row, only verified links leave it
    few = met.where(F.col("n") <= p.bucket).groupBy("part", "value").agg(F.collect_set("fp").alias("m"))
    near = F.flatten(F.transform("m", lambda x: F.transform(F.filter("m", lambda y: (y > x) & (F.bit_count(x.bitwiseXOR(y)) <= p.distance)), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    direct = few.select(F.explode(near).alias("l")).select("l.a", "l.b")
    # many: by way of the shared points
    hot = met.where(F.col("n") > p.bucket).select("fp").distinct()
    return direct.unionByName(ball_links(hot, p.distance)).distinct()


def ball_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links that join all fingerprints at most ``distance`` (even) bits apart: through points in the balls of both."""
    points = F.explode(_variants_all(F.col("fp"), distance // 2))
    met = fps.select("fp", points.alias("point")).groupBy("point").agg(F.collect_set("fp").alias("m")).where(F.size("m") > 1)
    return met.select(F.array_min("m").alias("a"), F.explode("m").alias("b")).where("a < b").distinct()


def _variants_all(fp: Column, radius: int) -> Column:
    flips = [0, *(mask_of(list(c)) for k in range(1, radius + 1) for c in combinations(range(BITS), k))]
    return F.array(*(fp.bitwiseXOR(F.lit(x)) for x in flips))


# ---- components ------------------------------------------------------------------------------------------


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """node, root: the smallest node that can be reached, for each node of an edge (a, b), by star contraction."""
    tables: list[str] = []
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label, tables)
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: the larger neighbours of a node go to its smallest neighbour, or itself
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.where("a <> b").distinct(), label, tables)
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = materialise(small.where("a <> b").distinct(), label, tables)
        while len(tables) > 1:  # only the last is read again
            remove(edges.sparkSession, tables.pop(0))
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()).groupBy("node").agg(F.min("root").alias("root"))


def row_keys(docs: DataFrame, id_column: str, text: str) -> list[Column]:
    """Two hashes of a row's id and text."""
    return [F.xxhash64(F.lit(k), docs[id_column].isNull(), docs[id_column], text_column(docs, text)) for k in (1, 2)]


def grouped(rows: DataFrame, p: SimHashParams) -> DataFrame:
    """``rows`` (id, fp and others) with root, the same for each row of a component, and component, its smallest id."""
    distinct = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    joined = components(links(distinct.select("fp"), p))
    linked = joined.join(distinct, joined.node == distinct.fp).select("fp", "root", "least")
    by_root = linked.groupBy("root").agg(F.min("least").alias("component"))
    known = materialise(linked.join(by_root, "root").select("fp", "root", "component"), "linked")
    least = distinct.join(known, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component")).alias("component"))
    return rows.join(least, "fp", "left")


def near_duplicates(docs: DataFrame, p: SimHashParams = SimHashParams(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, fp, component: each row's fingerprint and the smallest id of its component."""
    rows = materialise(fingerprints(docs, p, id_column, text), "fingerprints")
    return grouped(rows, p).select("id", "fp", "component")


def simhash_digest(docs: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    out = near_duplicates(docs, p)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def first_rows(rows: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """unnamed, id, h1, h2: of each component of ``rows`` (id, fp, h1, h2) the row that stays.

    That is the one of its smallest id, and of that id's texts the one with the smallest hash. A null id comes after all
    others, so such a row stays only if its component has no named one.
    """
    member = F.struct(F.col("id").isNull().alias("unnamed"), "id", "h1", "h2")
    return grouped(rows, p).groupBy("root").agg(F.min(member).alias("x")).select("x.*")


def only(docs: DataFrame, rows: DataFrame, kept: DataFrame, id_column: str, text: str) -> DataFrame:
    """The rows of ``docs`` whose keys (h1, h2) are in ``kept``, repeated ones once. ``rows``: the keys of all rows.

    Keys are looked up in mapped arrays, so that no text is shuffled, but those of repeated rows.
    """
    h = row_keys(docs, id_column, text)
    times = materialise(rows.join(kept.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")), "kept")
    out = docs.where(in_set(write_set(times.where("n = 1").select("h1", "h2")), *h))
    many = times.where("n > 1").select("h1", "h2")
    if many.isEmpty():
        return out
    names = fresh(docs, "_h1", "_h2")
    repeated = docs.withColumns(dict(zip(names, h, strict=True))).where(in_set(write_set(many), *(F.col(n) for n in names)))
    return out.unionByName(repeated.dropDuplicates(names).select(*own(docs)))


def keep_one(docs: DataFrame, p: SimHashParams = SimHashParams(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with the columns of ``docs``: see ``first_rows``."""
    h = dict(zip(("h1", "h2"), row_keys(docs, id_column, text), strict=True))
    rows = materialise(fingerprints(docs, p, id_column, text, h), "fingerprints")
    return only(docs, rows, first_rows(rows, p), id_column, text)
