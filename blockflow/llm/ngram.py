"""Interpolated modified Kneser-Ney n-gram models, counted in Spark and scored from memory-mapped sorted arrays.

A token is a 48-bit hash of its lower-cased bytes; an n-gram's key chains 64-bit hashes of its tokens. Counting:

1. Each task counts the n-grams of the highest order in its part of the corpus and sends them, by key, to shards, in
   compressed blobs: a frequent word (of a bounded sample, which decides nothing else) is written as a short code.
2. A shard sums its n-grams, writes keys and counts as one sorted array file in the shared folder, and sends on, for
   the order below, what each shorter n-gram gets: distinct predecessors (as a suffix), and total and numbers of
   followers by count (as a context). So on down to single tokens. A very common word is spread over all shards,
   since shards go by the whole n-gram, and its partial sums are added per task first.
3. With more than ``fan`` shards blobs go to groups of shards first and are dealt anew there, so that their number
   doesn't grow with the square of the corpus.
4. Discounts come from the counts of counts of each order, summed over all shards.

An array file holds its keys sorted, 32 bits of each under an index of buckets by the bits above (with the shard's own
bits some 50 in all), and one byte for the counts of a row, rare ones apart.

Scoring looks up a block of texts at once: its n-grams are sorted and searched shard by shard in the mapped arrays.
Nothing of the model is broadcast or sent to the driver but a dozen totals for each order; a worker pages in what it
reads. Probabilities, for n-gram ``h w`` with adjusted count c (the count at the highest order, distinct predecessors
below), sum to one over the vocabulary and one unknown token:

    p(w | h) = max(c - D(c), 0) / total(h) + gamma(h) p(w | h'),    p(w) at the bottom mixed with 1 / (V + 1)

Edge cases: a null or empty text is just an end; a null id is learned from and carried through; repeated rows count
as often as they occur; with nothing to learn from every token is the unknown one; other columns are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockflow.llm.arraystore import discounts, find, mix, open_arrays, write_arrays
from blockflow.llm.common import fresh, map_blocks, text_column
from blockflow.runtime import materialise, release, remove, shared_path, ship

LOW48 = (1 << 48) - 1
#: These contain white space, so no token has them.
START = xxhash.xxh64_intdigest(b" start") & LOW48
END = xxhash.xxh64_intdigest(b" end") & LOW48


#: A shard is summed in one task's memory, so there are more of them for more text.
SHARD_BYTES = 6 << 20
#: Texts are scored in blocks of so many bytes: about 30 numbers are held for each token.
SCORED_BYTES = 5 << 18
#: Most words that get a code. A token is its hash, or CODED and the number of its code.
CODES = (1 << 20) - 1
CODED = np.uint64(1 << 48)
#: The code of counts that have none of their own.
OTHER = 255


@dataclass(frozen=True)
class NgramParams:
    order: int = 3  #: longest n-gram
    tokens: int = 600_000  #: a task counts so many tokens before it sends what it has
    shards: int | None = None  #: array files of an order; None: one for SHARD_BYTES of text, and as many as shuffle partitions at least
    fan: int = 1024  #: most shards, or groups of them, that a task deals its n-grams to
    sample: int = 6000  #: about so many texts say which words get a code
    rounds: int = 4  #: the orders below the highest are shuffled in so many parts, one after another, which bounds the disk in use


class Hashes(dict):
    """The hash of each token, with a bounded memory."""

    MOST = 250_000

    def __missing__(self, token: bytes) -> int:
        value = xxhash.xxh64_intdigest(token) & LOW48
        if len(self) < self.MOST:
            self[token] = value
        return value


_hashes = Hashes()


def tokens_of(texts: list[bytes], lead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes with ``lead`` starts before and an end after each text, the places that count, tokens of each text)."""
    get, starts = _hashes.__getitem__, [START] * lead
    parts, sizes = [], []
    for t in texts:
        words = t.lower().split()
        a = np.empty(lead + len(words) + 1, dtype=np.uint64)
        a[:lead] = starts
        a[lead:-1] = np.fromiter(map(get, words), dtype=np.uint64, count=len(words))
        a[-1] = END
        parts.append(a)
        sizes.append(len(words) + 1)
    if len(_hashes) >= Hashes.MOST:
        _hashes.clear()
    codes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    n = np.array(sizes, dtype=np.int64)
    keep = np.ones(len(codes), dtype=bool)
    first = np.cumsum(n + lead) - n - lead
    for k in range(lead):
        keep[first + k] = False
    return codes, np.flatnonzero(keep), n


def chain(columns: list[np.ndarray]) -> np.ndarray:
    """The keys of n-grams whose tokens are in ``columns``."""
    key = np.zeros(len(columns[0]), dtype=np.uint64)
    for c in columns:
        key = mix(key, c)
    return key


class Codes:
    """The hashes of the words that get a code, the most frequent one first: small numbers compress well."""

    def __init__(self, ranked: np.ndarray) -> None:
        self.ranked, self._order, self._sorted = ranked, None, None

    def __reduce__(self):
        return Codes, (self.ranked,)

    def coded(self, tokens: np.ndarray) -> np.ndarray:
        if self._sorted is None:
            self._order = np.argsort(self.ranked).astype(np.uint64)
            self._sorted = self.ranked[self._order.astype(np.int64)]
        at, ok = find(self._sorted, tokens)
        return np.where(ok, self._order[at] | CODED, tokens) if len(self._order) else tokens

    def plain(self, tokens: np.ndarray) -> np.ndarray:
        known = np.flatnonzero(tokens >= CODED)
        out = tokens.copy()
        out[known] = self.ranked[(tokens[known] ^ CODED).astype(np.int64)]
        return out

    def keys(self, columns: list[np.ndarray]) -> np.ndarray:
        """As ``chain``, of coded tokens."""
        key = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            key = mix(key, self.plain(c))
        return key


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


# ---- blobs: rows in byte planes, compressed ----------------------------------------------------------------


def _planes(a: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(data: np.ndarray, width: int) -> np.ndarray:
    n, wide = len(data) // width, 4 if width <= 4 else 8
    out = np.zeros((n, wide), dtype=np.uint8)
    out[:, :width] = data.reshape(width, n).T
    return out.reshape(-1).view(f"<u{wide}")


def _pack(tokens: list[np.ndarray], values: list[np.ndarray]) -> bytes:
    """Rows of coded tokens and values: planes of the codes (0: none), the hashes of tokens without one, planes of the values."""
    wide = [max(1, (int(v.max()).bit_length() + 7) // 8) for v in values]
    rest = [t[t < CODED] for t in tokens]
    planes = [_planes(np.where(t < CODED, 0, t - CODED + np.uint64(1)), 3) for t in tokens]
    data = b"".join([*planes, *(_planes(r, 6) for r in rest), *(_planes(v, w) for v, w in zip(values, wide, strict=True))])
    head = np.array([len(tokens[0]), len(data), *(len(r) for r in rest), *wide], dtype="<u4").tobytes()
    return head + pa.compress(data, codec="zstd", asbytes=True)


def _unpack(blob: bytes, tokens: int, values: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    head = np.frombuffer(blob, "<u4", 2 + tokens + values).tolist()
    rows, rest, wide = head[0], head[2 : 2 + tokens], head[2 + tokens :]
    data, at = np.frombuffer(pa.decompress(memoryview(blob)[4 * len(head) :], head[1], codec="zstd", asbytes=True), np.uint8), 0

    def take(n: int, width: int) -> np.ndarray:
        nonlocal at
        at += n * width
        return _unplanes(data[at - n * width : at], width)

    out = []
    for code in [take(rows, 3) for _ in range(tokens)]:
        out.append(code + (CODED - np.uint64(1)))
    for t, n in zip(out, rest, strict=True):
        t[t < CODED] = take(n, 6)
    return out, [take(rows, w) for w in wide]


def _group(key: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(sorted distinct keys, a row of each, the sums of the values)."""
    order = np.argsort(key)
    key = key[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[start], order[start], [np.add.reduceat(v[order], start, dtype=np.uint64) for v in values]


def _dealt(tokens: list[np.ndarray], values: list[np.ndarray], key: np.ndarray, shards: int) -> Iterator[tuple[int, bytes]]:
    """(shard, blob) of rows whose key is ``key``, in the order of their first tokens' codes, which compresses them."""
    shard = shard_of(key, shards)
    cuts = np.concatenate(([0], np.cumsum(np.bincount(shard.astype(np.int64), minlength=shards))))
    place = shard << np.uint64(40)
    for t, shift in zip(tokens, (20, 0), strict=False):
        place |= np.where(t < CODED, 0, t ^ CODED) << np.uint64(shift)
    order = np.argsort(place)
    del place, shard
    tokens, values = [t[order] for t in tokens], [v[order] for v in values]
    for s in np.flatnonzero(np.diff(cuts)).tolist():
        a, b = int(cuts[s]), int(cuts[s + 1])
        yield s, _pack([t[a:b] for t in tokens], [v[a:b] for v in values])


# ---- counting --------------------------------------------------------------------------------------------

#: What a lower-order n-gram gathers: as a suffix, its distinct predecessors and (single tokens) its occurrences; as a
#: context, the total of its followers' counts, and how many of them have count 1, 2, and more.
FIELDS = ("before", "raw", "total", "n1", "n2", "n3")
#: The fields that a blob of each kind has; the highest order's has counts.
KINDS = (("count",), ("before",), ("raw",), FIELDS[2:])
TOP, SUFFIX, RAW, CONTEXT = range(4)
_TOTALS = ("c1", "c2", "c3", "c4", "grams", "mass", "vocabulary", "tokens")
_ROW = f"level int, kind int, shard bigint, blob binary, {', '.join(f'{c} bigint' for c in _TOTALS)}"
_ARROW = pa.schema([("level", pa.int32()), ("kind", pa.int32()), ("shard", pa.int64()), ("blob", pa.binary()), *((n, pa.int64()) for n in _TOTALS)])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*[(*r, *[0] * (len(_ARROW) - len(r))) for r in rows], strict=True)) if rows else [[]] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def frequent(texts: DataFrame, rows: int, p: NgramParams) -> Codes:
    """The words that get a code: the most frequent ones of a sample. Only the sizes of blobs depend on them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                total.update(t.as_py().lower().split())
                if len(total) > 4 * CODES:
                    total = Counter(dict(total.most_common(CODES)))
        h = [xxhash.xxh64_intdigest(w) & LOW48 for w in total]
        yield pa.RecordBatch.from_pydict({"h": pa.array(h, pa.int64()), "n": pa.array(list(total.values()), pa.int64())})

    few = texts.sample(min(1.0, p.sample / max(rows, 1)), seed=1).mapInArrow(count, "h bigint, n bigint")
    top = few.groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(CODES - 2).toArrow()  # bounded by the code
    return Codes(np.concatenate(([START, END], top.column("h").to_numpy())).astype(np.uint64))


def _count(docs: DataFrame, p: NgramParams, words: Codes, shards: int) -> DataFrame:
    """Blobs of the highest order from a column ``_text`` of bytes."""
    order, most = p.order, p.tokens

    def flush(texts: list[bytes]) -> pa.RecordBatch:
        codes, at, _ = tokens_of(texts, order - 1)
        key, first, (n,) = _group(chain([codes[at - k] for k in range(order - 1, -1, -1)]), [np.ones(len(at), dtype=np.uint8)])
        codes, at = words.coded(codes), at[first]
        return _rows([(order, TOP, s, b) for s, b in _dealt([codes[at - k] for k in range(order - 1, -1, -1)], [n], key, shards)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        size = 0
        for batch in batches:
            for t in batch.column(0):
                texts.append(t.as_py())
                size += len(texts[-1]) // 6 + 1  # about a token for six bytes
                if size >= most:
                    yield flush(texts)
                    texts, size = [], 0
        if texts:
            yield flush(texts)

    return docs.select("_text").mapInArrow(run, _ROW)


def _spread(rows: DataFrame, level: int, p: NgramParams, words: Codes, shards: int) -> DataFrame:
    """Blobs of groups of shards, summed and dealt to the shards."""
    most = 2 * p.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        of, size = None, 0

        def flush() -> Iterator[pa.RecordBatch]:
            tokens = [np.concatenate([x[0][i] for x in held]) for i in range(level)]
            sums = [np.concatenate([x[1][i] for x in held]) for i in range(len(held[0][1]))]
            key, first, sums = _group(words.keys(tokens), sums)
            # of all shards those of the group have rows
            yield _rows([(level, of[1], s, b) for s, b in _dealt([t[first] for t in tokens], sums, key, shards)])

        for batch in batches:
            for shard, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if held and ((shard, kind) != of or size >= most):
                    yield from flush()
                    held, size = [], 0
                of = shard, kind
                held.append(_unpack(blob.as_py(), level, len(KINDS[kind])))
                size += len(held[-1][0][0])
        if held:
            yield from flush()

    grouped = rows.select("shard", "kind", "blob").repartition("shard").sortWithinPartitions("shard", "kind")
    return grouped.mapInArrow(run, _ROW)


def _merge(rows: DataFrame, level: int, p: NgramParams, words: Codes, shards: int, folder: str) -> DataFrame:
    """Sum the blobs of an order, write its shards; rows: blobs for the orders below, and a row of totals for each shard."""
    top = level == p.order
    groups = _groups(shards, p)

    def shard(data: pa.Table) -> pa.Table:
        number = data.column("shard")[0].as_py()
        fields = ("count",) if top else FIELDS if level == 1 else ("before", *FIELDS[2:])
        blobs, kinds = data.column("blob"), [KINDS[k] for k in data.column("kind").to_pylist()]
        sizes = [int.from_bytes(b.as_py()[:4], "little") for b in blobs]
        tokens = [np.empty(sum(sizes), dtype=np.uint64) for _ in range(level)]
        values = [np.zeros(sum(sizes), dtype=np.uint64) for _ in fields]
        at = 0
        for blob, kind, n in zip(blobs, kinds, sizes, strict=True):
            for own, got in zip((tokens, [values[fields.index(f)] for f in kind]), _unpack(blob.as_py(), level, len(kind)), strict=True):
                for x, y in zip(own, got, strict=True):
                    x[at : at + n] = y
            at += n
        key, first, values = _group(words.keys(tokens), values)
        tokens = [t[first] for t in tokens]
        named = dict(zip(fields, values, strict=True))
        counts = named["count" if top else "before"]
        if top and level == 1:
            named["raw"] = counts
        write_arrays(f"{folder}/{level}-{number}", _layout(key, named))
        seen = counts > 0
        of = [int(np.count_nonzero(counts == c)) for c in (1, 2, 3, 4)]
        raw = named.get("raw", counts[:0])
        out: list[tuple] = [(level, -1, -1 - number, None, *of, int(np.count_nonzero(seen)), int(counts.sum()), int(np.count_nonzero(raw)), int(raw.sum()))]
        if level > 1 and seen.any():
            out += _below([t[seen] for t in tokens], counts[seen], level, top, groups, words)
        return pa.Table.from_batches([_rows(out)])

    if groups < shards:
        rows = _spread(rows, level, p, words, shards)
    return rows.groupBy("shard").applyInArrow(shard, _ROW)


def _groups(shards: int, p: NgramParams) -> int:
    """What a task deals its n-grams to: the shards, or groups of about ``fan`` shards."""
    return shards if shards <= p.fan else -(-shards // p.fan)


def _layout(key: np.ndarray, fields: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The arrays of a shard: 32 bits of each key, sorted within buckets by the bits above them; a byte for all counts of a
    row, which names one of the shard's most frequent rows of counts, or OTHER: those are written apart."""
    bits = max(0, len(key).bit_length() - 4)
    low = key & np.uint64((1 << (32 + bits)) - 1)
    order = np.argsort(low)
    low = low[order]
    out = {"keys": low.astype(np.uint32), "buckets": np.searchsorted(low >> np.uint64(32), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.uint32)}
    values = {f: v[order] for f, v in fields.items()}
    # rows of small counts as one number each; the most frequent of those get a code
    bits = 60 // len(values)
    row, small = np.zeros(len(key), dtype=np.uint64), np.ones(len(key), dtype=bool)
    for k, v in enumerate(values.values()):
        row |= v << np.uint64(k * bits)
        small &= v < 1 << min(bits, 16)
    kinds, times = np.unique(row[small], return_counts=True)
    kinds = np.sort(kinds[np.argsort(-times, kind="stable")[:OTHER]])
    code, known = find(kinds, row)
    known &= small
    rest = np.flatnonzero(~known)
    out |= {"code": np.where(known, code, OTHER).astype(np.uint8), "rest": rest.astype(np.uint32)}
    for k, (f, v) in enumerate(values.items()):
        v = v[rest]
        out |= {f"{f}_of": ((kinds >> np.uint64(k * bits)) & np.uint64((1 << bits) - 1)).astype(np.uint16), f"{f}_rest": v if len(v) and int(v.max()) >> 32 else v.astype(np.uint32)}
    return out


def _places(arrays: dict[str, np.ndarray], key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, found) of keys in a shard; a position is meaningless where not found."""
    keys, buckets = arrays["keys"], arrays["buckets"]
    bits = (len(buckets) - 1).bit_length() - 1  # 2^bits buckets and an end
    low = key & np.uint64((1 << (32 + bits)) - 1)
    wanted, bucket = low.astype(np.uint32), (low >> np.uint64(32)).astype(np.int64)
    lo, hi = buckets[bucket].astype(np.int64), buckets[bucket + 1].astype(np.int64)
    end = hi.copy()
    last = max(len(keys) - 1, 0)
    while len(keys) and (lo < hi).any():
        mid = (lo + hi) >> 1
        less = keys[np.minimum(mid, last)] < wanted
        open_ = lo < hi
        lo = np.where(open_ & less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)
    ok = lo < end
    at = np.minimum(lo, last)
    return at, (ok & (keys[at] == wanted)) if len(keys) else ok


def _values(arrays: dict[str, np.ndarray], fields: tuple[str, ...], at: np.ndarray) -> list[np.ndarray]:
    """The fields of the rows ``at``."""
    code = arrays["code"][at]
    other = np.flatnonzero(code == OTHER)
    place = np.searchsorted(arrays["rest"], at[other]) if len(other) else other
    out = []
    for f in fields:
        table = np.zeros(OTHER + 1)
        table[: len(arrays[f"{f}_of"])] = arrays[f"{f}_of"]
        v = table[code]
        if len(other):
            v[other] = arrays[f"{f}_rest"][place]
        out.append(v)
    return out


def _below(tokens: list[np.ndarray], counts: np.ndarray, level: int, top: bool, shards: int, words: Codes) -> Iterator[tuple]:
    """Blobs of what distinct n-grams of an order give to shorter ones."""

    def deal(columns: list[np.ndarray], values: list[np.ndarray], to: int, kind: int) -> Iterator[tuple]:
        key, first, values = _group(words.keys(columns), values)
        for s, b in _dealt([c[first] for c in columns], values, key, shards):
            yield to, kind, s, b

    yield from deal(tokens[1:], [np.ones(len(counts), np.uint8)], level - 1, SUFFIX)
    yield from deal(tokens[:-1], [counts, *(x.astype(np.uint8) for x in (counts == 1, counts == 2, counts > 2))], level - 1, CONTEXT)
    if top:  # occurrences of single tokens
        yield from deal([tokens[-1]], [counts], 1, RAW)


def train(docs: DataFrame, p: NgramParams = NgramParams(), text: str = "text") -> dict:
    """Count the texts of ``docs`` and write the model; returns what ``Model`` needs (a small dictionary)."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(text_column(docs, text).cast("binary").alias("_text"))
    many, size = texts.agg(F.count(F.lit(1)), F.sum(F.octet_length("_text"))).first()
    shards = p.shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size or 0) // SHARD_BYTES)
    folder, words = shared_path(spark, "ngrams"), frequent(texts, many, p)
    rows = _count(texts, p, words, _groups(shards, p))
    model = {"folder": folder, "order": p.order, "shards": shards, "levels": {}}
    tables: list[str] = []
    for level in range(p.order, 0, -1):
        parts = 1 if level == p.order else p.rounds
        done = []
        for k in range(parts):
            part = rows.where(F.col("level") == level).where(F.pmod("shard", F.lit(parts)) == k).where("shard >= 0")
            done.append(materialise(_merge(part, level, p, words, shards, folder), f"ngrams-{level}", tables))
            release(spark)
        done = reduce(DataFrame.unionByName, done)
        totals = done.where("shard < 0").agg(*(F.sum(c).alias(c) for c in _TOTALS)).first().asDict()
        model["levels"][level] = {k: int(v or 0) for k, v in totals.items()}
        rows = done.unionByName(rows.where(F.col("level") < level)) if level < p.order else done
    for t in tables:
        remove(spark, t)
    return model


# ---- scoring ---------------------------------------------------------------------------------------------


@lru_cache(1 << 14)
def _shard(uri: str) -> dict[str, np.ndarray] | None:
    """A shard's arrays; None if no n-gram came to it, so that it has no file."""
    try:
        return open_arrays(uri)[0]
    except FileNotFoundError:
        return None


class Model:
    """A model's mapped arrays."""

    def __init__(self, model: dict) -> None:
        self.m, self.order, self.shards = model, model["order"], model["shards"]
        self.cuts, self.gammas = {}, {}
        for k in range(1, self.order + 1):
            s = model["levels"][k]
            self.cuts[k] = discounts(s["c1"], s["c2"], s["c3"], s["c4"])
        bottom = model["levels"][1]
        self.vocabulary, self.tokens, self.mass = bottom["vocabulary"], bottom["tokens"], bottom["mass"]

    def look(self, level: int, keys: np.ndarray, fields: tuple[str, ...]) -> list[np.ndarray]:
        """The fields of n-grams, zero where there is none."""
        order = np.argsort(keys)
        keys = keys[order]
        out = [np.zeros(len(keys)) for _ in fields]
        shard, first = np.unique(shard_of(keys, self.shards), return_index=True)
        for s, a, b in zip(shard.tolist(), first.tolist(), [*first[1:].tolist(), len(keys)], strict=True):
            arrays = _shard(f"{self.m['folder']}/{level}-{s}")
            if arrays is None:
                continue
            at, ok = _places(arrays, keys[a:b])
            for o, v in zip(out, _values(arrays, fields, at[ok]), strict=True):
                o[a:b][ok] = v
        result = []
        for o in out:
            back = np.empty_like(o)
            back[order] = o
            result.append(back)
        return result

    def _cut(self, level: int, c: np.ndarray) -> np.ndarray:
        d = self.cuts[level]
        return np.minimum(np.select([c < 1.5, c < 2.5], d[:2], d[2]), c)

    def score(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """n_tokens, n_known, base_score, score of each text."""
        codes, at, sizes = tokens_of(texts, self.order - 1)
        owner = np.repeat(np.arange(len(texts)), sizes)
        uniq, inverse = np.unique(codes, return_inverse=True)
        lowest = ("raw", "count") if self.order == 1 else FIELDS
        fields = dict(zip(lowest, self.look(1, chain([uniq]), lowest), strict=True))
        raw = fields["raw"][inverse[at]]
        adjusted = fields["count" if self.order == 1 else "before"]
        floor = 1.0 / (self.vocabulary + 1)
        if self.mass:
            s, d = self.m["levels"][1], self.cuts[1]
            freed = min(1, d[0]) * s["c1"] + min(2, d[1]) * s["c2"] + d[2] * (s["grams"] - s["c1"] - s["c2"])
            bottom = (adjusted - self._cut(1, adjusted)) / self.mass + freed / self.mass * floor
        else:
            bottom = np.full(len(uniq), floor)
        p = bottom[inverse[at]]
        context = {f: fields[f][inverse[at - 1]] for f in FIELDS[2:]} if self.order > 1 else {}
        # below the highest order an n-gram is looked up once, as what is scored and as the context of the next place
        ends = np.zeros(len(codes), dtype=bool)
        ends[at] = ends[at - 1] = self.order > 1
        near = np.flatnonzero(ends)
        place = np.cumsum(ends) - 1
        for k in range(2, self.order + 1):
            top = k == self.order
            wanted, last = (("count",), at) if top else (("before", *FIELDS[2:]), near)
            got = dict(zip(wanted, self.look(k, chain([codes[last - i] for i in range(k - 1, -1, -1)]), wanted), strict=True))
            c, total, d = got[wanted[0]] if top else got["before"][place[at]], context["total"], self.cuts[k]
            known = total > 0
            safe = np.where(known, total, 1)
            gamma = (d[0] * context["n1"] + d[1] * context["n2"] + d[2] * context["n3"]) / safe
            p = np.where(known, (c - self._cut(k, c)) / safe + gamma * p, p)
            if not top:  # the contexts of the next order end one place earlier
                context = {f: got[f][place[at - 1]] for f in FIELDS[2:]}
        n = len(texts)
        base = np.log10((raw + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1)))
        return {
            "n_tokens": sizes, "n_known": np.bincount(owner, weights=raw > 0, minlength=n).astype(np.int64),
            "base_score": np.bincount(owner, weights=base, minlength=n), "score": np.bincount(owner, weights=np.log10(p), minlength=n),
        }


_models: dict[str, Model] = {}


def opened(model: dict) -> Model:
    """The process's opened model."""
    if model["folder"] not in _models:
        _models.clear()
        _models[model["folder"]] = Model(model)
    return _models[model["folder"]]


def score(docs: DataFrame, model: dict, text: str = "text", to: str = "_lm") -> DataFrame:
    """All columns, and in ``to``, which ``docs`` may not have, a struct: n_tokens, n_known, train_tokens, base_score, score, perplexity (of a token)."""
    if fresh(docs, to) != [to]:
        raise ValueError(f"the column {to} is taken; name another in 'to'")
    names = docs.columns

    def block(c: dict) -> dict:
        m = opened(model)
        s = {k: v.tolist() for k, v in m.score([(t or "").encode("utf-8", "surrogatepass") for t in c[text]]).items()}
        rows = [{"n_tokens": n, "n_known": k, "train_tokens": m.tokens, "base_score": b, "score": x, "perplexity": 10 ** min(300.0, -x / n)} for n, k, b, x in zip(*s.values(), strict=True)]
        return {n: c[n] for n in names} | {to: rows}

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return map_blocks(docs, block, ", ".join([*kept, f"`{to}` struct<n_tokens: bigint, n_known: bigint, train_tokens: bigint, base_score: double, score: double, perplexity: double>"]), text, most=SCORED_BYTES)


def ngram_digest(docs: DataFrame, learn: Column, p: NgramParams = NgramParams()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity. ``learn``: the rows to learn from."""
    model = train(docs.where(learn), p)
    rows = docs.select("doc_id", (~learn).alias("held_out"), "text")
    return score(rows, model).select("doc_id", "held_out", "_lm.*")
