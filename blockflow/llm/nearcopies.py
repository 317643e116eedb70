"""Near duplicates with edits: documents that SimHash links or that share most shingles.

SimHash fingerprints of 64 bits at five-word similarity 0.8 differ in some 10 bits (up to 17 in one pair of a hundred). No
partition of 64 bits is selective at such a distance: by pigeonhole thresholds of 3 and more bits in parts of 16 would be
probed, hundreds of values of which each is shared by one document in a hundred. So fingerprints link what is at most two
bits apart, which are mostly exact copies; any two different texts, unless those links join them, are linked if the Jaccard
similarity of their sets of shingles is at least ``similarity``:

1. One pass over the texts writes, as numbers, each row's fingerprint and the keys of its bands: a key hashes ``rows`` minima
   of the shingles. Two documents of similarity s share one with probability 1 - (1 - s^rows)^bands: 0.999997 at 0.8.
2. Documents that meet under a key are candidates. Under a crowded key they are first compared with one of its members,
   another for each band, so pairs grow with the documents.
3. Candidates are verified by their whole sets, which are made again for candidates alone.
4. Crowded keys whose members are not all joined by that are finished exactly: see ``missed``.
5. Components of the links; the smallest id of each stays. Texts are filtered by keys in mapped arrays, not shuffled.

Edge cases: a text of fewer words than a shingle is one shingle; null and empty texts have no word and are exact copies of
each other; a null id goes before any other id does; of rows of equal id and text one stays; other columns are kept, whatever
their names; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockflow.llm.arraystore import in_set, mix, write_set
from blockflow.llm.common import map_blocks, text_column
from blockflow.llm.ngram import chain, tokens_of
from blockflow.llm.simhash import SimHashParams, components, fingerprint, grouped, only, row_keys
from blockflow.runtime import materialise


@dataclass(frozen=True)
class NearCopyParams:
    words: int = 5  #: words in a shingle
    similarity: float = 0.8  #: least Jaccard similarity of linked documents
    bands: int = 24
    rows: int = 4  #: minima in a band's key
    bucket: int = 48  #: above this many documents under a key they are compared with one of them, then as ``missed`` says


def shingles(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The hashes of each text's shingles, repeated as they occur."""
    codes, _, sizes = tokens_of(texts, 0)
    many = max(len(codes) - words + 1, 0)
    key = chain([codes[k : k + many] for k in range(words)])
    out, at = [], 0
    for size in sizes.tolist():
        n = size - 1  # without the end
        if n >= words or n == 0:
            out.append(key[at : at + max(n - words + 1, 0)])
        else:
            out.append(chain([codes[k : k + 1] for k in range(at, at + n)]))
        at += size
    return out


def band_keys(sets: list[np.ndarray], p: NearCopyParams) -> np.ndarray:
    """The keys (sets x bands) of sets that aren't empty."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    values = np.concatenate(sets)
    rng = np.random.default_rng(p.words)
    salts, factors = rng.integers(0, 1 << 63, (2, p.bands * p.rows), dtype=np.uint64)
    out = np.empty((len(sets), p.bands), dtype=np.uint64)
    for band in range(p.bands):
        key = np.full(len(sets), band, dtype=np.uint64)
        for k in range(band * p.rows, (band + 1) * p.rows):
            key = mix(key, np.minimum.reduceat((values ^ salts[k]) * (factors[k] | np.uint64(1)), starts))
        out[:, band] = key
    return out


def links(filed: DataFrame, texts: Callable[[DataFrame], DataFrame], p: NearCopyParams = NearCopyParams()) -> DataFrame:
    """a, b, group_a, group_b: verified links that join all groups of which nodes meet under a key and are similar enough.

    ``filed``: node, group and keys (of bands); nodes of one group are joined already and aren't compared. ``texts`` gives
    the rows (_node, _text as bytes) of the nodes asked for. Of nodes under crowded keys alone, links are left out whose
    groups others join.
    """

    def whole(c: dict) -> dict:
        sets = [np.unique(s).view(np.int64) for s in shingles(c["_text"], p.words)]
        offsets = pa.array(np.cumsum([0, *(len(s) for s in sets)], dtype=np.int32))
        return {"node": c["_node"], "s": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets)))}

    filed = filed.select("node", "group", F.explode("keys").alias("key"))
    one = F.min_by(F.struct("node", "group"), F.xxhash64("node", "key")).alias("one")
    sizes = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), one, F.min("group").alias("lo"), F.max("group").alias("hi"))
    met = materialise(filed.join(sizes.where("lo < hi").drop("lo", "hi"), "key"), "near-met")
    few = met.where(F.col("n") <= p.bucket).groupBy("key").agg(F.collect_set(F.struct("node", "group")).alias("m"))
    other = lambda x: F.filter("m", lambda y: (y.node > x.node) & (y.group != x.group))
    pair = F.flatten(F.transform("m", lambda x: F.transform(other(x), lambda y: _pair(x, y))))
    direct = few.select(F.explode(pair).alias("l")).select("l.*")
    crowded = met.where(F.col("n") > p.bucket)
    x, y = F.struct("node", "group"), F.col("one")
    starred = crowded.where(F.col("group") != F.col("one.group")).select(F.when(F.col("node") < F.col("one.node"), _pair(x, y)).otherwise(_pair(y, x)).alias("l")).select("l.*")
    pairs = materialise(direct.unionByName(starred).distinct(), "near-pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(crowded.select("node")).distinct()
    # written first: a task that filters by a Python function and maps by another would hold two workers
    wanted = materialise(texts(nodes), "near-texts")
    sets = materialise(map_blocks(wanted, whole, "node bigint, s array<bigint>", "_text").dropDuplicates(["node"]), "near-sets")
    found = materialise(verified(pairs, sets, p), "near-links")
    return found if crowded.isEmpty() else found.unionByName(missed(crowded.select("key", "node", "group"), found, sets, p))


def _pair(x: Column, y: Column) -> Column:
    return F.struct(x["node"].alias("a"), y["node"].alias("b"), x["group"].alias("group_a"), y["group"].alias("group_b"))


def verified(pairs: DataFrame, sets: DataFrame, p: NearCopyParams) -> DataFrame:
    """The pairs (a, b, group_a, group_b) whose sets are similar enough."""
    a, b = sets.select(F.col("node").alias("a"), F.col("s").alias("x")), sets.select(F.col("node").alias("b"), F.col("s").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return pairs.join(a, "a").join(b, "b").where(shared / (F.size("x") + F.size("y") - shared) >= p.similarity).select(*pairs.columns).distinct()


def missed(crowded: DataFrame, found: DataFrame, sets: DataFrame, p: NearCopyParams) -> DataFrame:
    """All links between nodes under one crowded key (key, node, group) which the links ``found`` don't join yet.

    One end of such a link is outside the key's largest component, so those outside are held against all that they
    share a rare member with: see ``candidates``. Copies of one text are joined already.
    """
    roots = materialise(components(found.select(F.col("group_a").alias("a"), F.col("group_b").alias("b")), "near-roots").withColumnRenamed("node", "group"), "near-roots")
    placed = materialise(crowded.join(roots, "group", "left").select("key", "node", "group", F.coalesce("root", "group").alias("root")), "near-placed")
    most = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.max(F.struct("n", "root")).alias("m"), F.count(F.lit(1)).alias("roots"))
    apart = placed.join(most.where("roots > 1").select("key", F.col("m.root").alias("largest")), "key")
    nodes = materialise(apart.groupBy("node", "group", "root").agg(F.max(F.col("root") != F.col("largest")).alias("outside")), "near-apart")
    return verified(materialise(candidates(nodes, sets, p), "near-more"), sets, p)


def candidates(nodes: DataFrame, sets: DataFrame, p: NearCopyParams) -> DataFrame:
    """a, b, group_a, group_b: all pairs of similar sets of ``nodes`` (node, group, root, outside), one of them outside, of other roots.

    Sets of n and m members of similarity s share at least t = s / (1 + s) * (n + m), so the rarest that they share is
    among the n - t + 1 first of one and the m - t + 1 first of the other, rarest first: some n / 9 for sets of one size,
    where a bound that holds for partners of any size is n / 5. Near copies that have more members of their own than
    that, of those that share a passage, meet nowhere.
    """
    members = materialise(nodes.join(sets, "node").select(*nodes.columns, F.size("s").alias("n"), F.explode("s").alias("x")), "near-members")
    counted = members.join(members.groupBy("x").agg(F.count(F.lit(1)).alias("times")), "x")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("times", "x"))
    # the small terms keep rounding from shortening a prefix or losing a pair
    prefix = counted.withColumn("rank", rank).where((F.col("rank") <= F.col("n") - F.ceil(p.similarity * F.col("n") - 1e-6) + 1) & (F.col("times") > 1))
    prefix = materialise(prefix.select("x", F.struct("node", "group", "root", "n", "outside", "rank").alias("m")), "near-prefix")
    a, b = prefix.select("x", F.col("m").alias("a")), prefix.select("x", F.col("m").alias("b"))
    shared = F.ceil(p.similarity / (1 + p.similarity) * (F.col("a.n") + F.col("b.n")) - 1e-6)
    similar = (F.col("a.root") != F.col("b.root")) & (F.col("a.rank") <= F.col("a.n") - shared + 1) & (F.col("b.rank") <= F.col("b.n") - shared + 1)
    ordered = F.when(F.col("a.node") < F.col("b.node"), _pair(F.col("a"), F.col("b"))).otherwise(_pair(F.col("b"), F.col("a")))
    return a.where("a.outside").join(b, "x").where(similar).select(ordered.alias("l")).select("l.*").distinct()


def features(docs: DataFrame, p: NearCopyParams = NearCopyParams(), simhash: SimHashParams = SimHashParams(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, fp, content, h1, h2, keys: of each row its fingerprint, a hash of its shingles, two of id and text, and keys of bands.

    One pass over the texts. Rows of equal fingerprint and content have the same shingles, each as often.
    """

    def block(c: dict) -> dict:
        sets = shingles(c["_text"], p.words)
        full = np.array([len(s) > 0 for s in sets], dtype=bool)
        keys = band_keys([s for s in sets if len(s)], p).view(np.int64) if full.any() else np.zeros(0, np.int64)
        offsets = pa.array(np.concatenate(([0], np.cumsum(full * p.bands))).astype(np.int32))
        values = np.array([fingerprint(t, simhash.words) for t in c["_text"]], dtype=np.uint64)
        content = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
        return {"id": c["id"], "fp": pa.array(values.view(np.int64)), "content": pa.array(content.view(np.int64)), "h1": c["h1"], "h2": c["h2"], "keys": pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1)))}

    h1, h2 = row_keys(docs, id_column, text)
    rows = docs.select(docs[id_column].alias("id"), h1.alias("h1"), h2.alias("h2"), text_column(docs, text).cast("binary").alias("_text"))
    return map_blocks(rows, block, f"id {dict(docs.dtypes)[id_column]}, fp bigint, content bigint, h1 bigint, h2 bigint, keys array<bigint>", "_text")


def keep_distinct(docs: DataFrame, p: NearCopyParams = NearCopyParams(), simhash: SimHashParams = SimHashParams(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates, with the columns of ``docs``: the one of the smallest id.

    Groups are the components of both kinds of links: of SimHash, and of similarity between any two different texts.
    """
    rows = materialise(features(docs, p, simhash, id_column, text), "near-features")
    # one row for each content; copies are compared with nothing
    row = F.struct(F.col("id").isNull().alias("unnamed"), "id", "h1", "h2")
    texts_once = materialise(rows.groupBy("fp", "content").agg(F.min(row).alias("m")).select("fp", "m.*"), "near-contents")
    first = materialise(grouped(texts_once, simhash).select("unnamed", "id", "h1", "h2", F.col("root").alias("group")), "near-first")

    def texts(nodes: DataFrame) -> DataFrame:
        h1, h2 = row_keys(docs, id_column, text)
        wanted = write_set(first.join(nodes.withColumnRenamed("node", "h1"), "h1", "left_semi").select("h1", "h2"))
        return docs.where(in_set(wanted, h1, h2)).select(h1.alias("_node"), text_column(docs, text).cast("binary").alias("_text"))

    filed = rows.select("h1", "h2", "keys").join(first.select("h1", "h2", "group"), ["h1", "h2"]).select(F.col("h1").alias("node"), "group", "keys")
    edges = links(filed, texts, p).select(F.col("group_a").alias("a"), F.col("group_b").alias("b"))
    joined = materialise(components(edges, "near").withColumnRenamed("node", "group"), "near-joined")
    members = first.join(joined, "group", "left").select(F.coalesce("root", "group").alias("root"), F.struct("unnamed", "id", "h1", "h2").alias("m"))
    best = members.groupBy("root").agg(F.min("m").alias("kept")).select("kept.h1", "kept.h2")
    return only(docs, rows.select("h1", "h2"), best, id_column, text)
