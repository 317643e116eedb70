"""Best-two-fit packing of tokenised documents into sequences of bounded length.

A document is the ids of its whole text and one id that ends it. One longer than a sequence is cut into full
pieces and a shorter last one; no other is cut. Only (document, piece, length) is packed, in groups of a bounded
number of pieces that are packed independently, so no task grows with the input; a group leaves at most a few
sequences part-filled. Pieces that fill a sequence are sequences as they are and aren't packed at all.

Within a group: a sequence is filled greedily with the largest piece that fits. Then its smallest piece may be
replaced by two unpacked pieces that together fit the expanded gap more tightly; the replaced one is packed later.

Edge cases: a null or empty text is a document of just the final id; a null id is packed like any other; repeated
rows are packed as often as they occur; ties go to the row that sorts first; other columns are left out.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable
from dataclasses import dataclass
from math import ceil
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockflow.llm.common import held, map_blocks, text_column
from blockflow.runtime import materialise


@dataclass(frozen=True)
class PackingParams:
    tokenizer: str | None = None  #: path of a tokenizers file; None: word_bpe_49k.json of public_tokenizers
    length: int = 2048  #: tokens of a sequence
    end: int = 0  #: the id that ends a document
    group: int = 20_000  #: documents that are packed together


def tokenizer_path(p: PackingParams) -> str:
    if p.tokenizer:
        return p.tokenizer
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The pre-tokenizer for which texts may be cut into chunks (fixed value: the pattern in word_bpe_49k.json).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """The letter that byte-level models use for each byte: itself if it prints, else the next from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class ChunkEncoder:
    """ids of whole texts as bytes (little-endian 32-bit), with a bounded cache of chunks between white space.

    For tokenizers that drop white space and split words from marks (WORD_PATTERN), a text's ids are those of its
    chunks, and a chunk that ends in plain marks is its core and its marks. A core of letters only is one word: the
    model gets it directly. Any other chunk goes through the whole tokenizer. Other tokenizers get whole texts.
    """

    #: Signs that may follow a word: none of those that special tokens or contractions are made of.
    MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'<>|")
    MOST = 400_000

    def __init__(self, path: str) -> None:
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [n.get("pattern") for n in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_chunk = kinds == ["NFC", "Replace", "Lowercase"] and splits == [{"Regex": WORD_PATTERN}, None] and not spec["post_processor"]
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.cores: dict[str, bytes] = {"": b""}  # words and marks
        self.chunks = _Chunks(self._chunk)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        """The ids of a word of lower-case letters."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text (UTF-8)."""
        if not self.by_chunk:
            return self._encode([t.decode() for t in texts])
        get = self.chunks.__getitem__
        out = [b"".join(map(get, t.split())) for t in texts]  # at ASCII white space; any other stays within its chunk
        if len(self.chunks) > self.MOST or len(self.cores) > self.MOST:
            self.chunks.clear()
            self.cores.clear()
            self.cores[""] = b""
        return out

    def _chunk(self, chunk: bytes) -> bytes:
        """The ids of a chunk."""
        c = chunk.decode()
        core, cores = c.rstrip(self.MARKS), self.cores
        low = core.lower()
        if low and not (low.isalpha() and (core.isascii() or is_normalized("NFC", core) and "\u03a3" not in core)):
            return self._encode([c])[0]
        tail = c[len(core) :]
        out = []
        for part, find in ((low, self._word), (tail, lambda t: self._encode([t])[0])):
            ids = cores.get(part)
            if ids is None:
                ids = find(part)
                if len(part) <= 200:
                    cores[part] = ids
            out.append(ids)
        return out[0] + out[1]


class _Chunks(dict):
    """ids of chunks, found once; very long ones aren't kept."""

    def __init__(self, find: Callable[[bytes], bytes]) -> None:
        super().__init__()
        self.find = find

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.find(chunk)
        if len(chunk) <= 200:
            self[chunk] = ids
        return ids


def encoder(path: str) -> ChunkEncoder:
    """The process's encoder of a tokenizer file."""
    return held(("encoder", path), lambda: ChunkEncoder(path))


def tokenise(docs: DataFrame, p: PackingParams = PackingParams(), with_ids: bool = True, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, piece, start, length, ids_crc32 and, if wanted, ids (array<int>): the pieces of each document."""
    path, step = tokenizer_path(p), 4 * p.length
    end = array("I", [p.end]).tobytes()

    def block(c: dict) -> dict:
        out: dict[str, list] = {"id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        parts = []
        for i, ids in zip(c["id"], encoder(path).texts(c["_text"]), strict=True):
            ids += end
            for k, lo in enumerate(range(0, len(ids), step)):
                part = ids[lo : lo + step]
                out["id"].append(i)
                out["piece"].append(k)
                out["start"].append(lo // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
                if with_ids:
                    parts.append(part)
        if with_ids:
            offsets = np.cumsum([0, *out["length"]], dtype=np.int32)
            out["ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))
        return out

    rows = docs.select(docs[id_column].alias("id"), text_column(docs, text).cast("binary").alias("_text"))
    schema = f"id {dict(docs.dtypes)[id_column]}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return map_blocks(rows, block, schema, "_text")


def best_two_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """The pieces (by position) of each sequence, in order; every length is from 1 to ``capacity``."""
    stock: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in range(len(lengths) - 1, -1, -1):
        stock[lengths[i]].append(i)
    have = back = 0  # the lengths in stock as bits, and mirrored
    for n in range(1, capacity + 1):
        if stock[n]:
            have |= 1 << n
            back |= 1 << (capacity - n)

    def take(n: int) -> int:
        nonlocal have, back
        i = stock[n].pop()
        if not stock[n]:
            have &= ~(1 << n)
            back &= ~(1 << (capacity - n))
        return i

    def put(i: int) -> None:
        nonlocal have, back
        n = lengths[i]
        stock[n].append(i)
        have |= 1 << n
        back |= 1 << (capacity - n)

    def two(total: int) -> tuple[int, int] | None:
        """The lengths in stock of two pieces with this total, the larger one as large as can be."""
        found = have & ((back << total) >> capacity if total <= capacity else back << (total - capacity))
        while found:
            x = found.bit_length() - 1
            if 2 * x < total:
                return None
            if 2 * x != total or len(stock[x]) > 1:
                return x, total - x
            found &= (1 << x) - 1
        return None

    out = []
    while have:
        gap, bin_ = capacity, []
        while gap and (fits := have & ((2 << gap) - 1)):
            n = fits.bit_length() - 1
            bin_.append(take(n))
            gap -= n
        if gap and have and len(bin_) > 1:
            small = bin_[-1]
            for total in range(gap + lengths[small], lengths[small], -1):
                if pair := two(total):
                    bin_[-1:] = [take(pair[0]), take(pair[1])]
                    put(small)
                    break
        out.append(bin_)
    return out


def pack(pieces: DataFrame, docs: int, p: PackingParams = PackingParams()) -> DataFrame:
    """The rows of ``pieces`` (id, piece, length ...) with sequence_id and offset. ``docs``: about how many there are.

    Only numbers are packed: pieces with their ids are written first, and what was packed is joined to them. Rows are dealt
    to groups by ``_row`` too, a written row number, so that repeated rows don't meet in one group.
    """
    if "_row" not in pieces.columns:
        rows = materialise(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
        if "ids" not in pieces.columns:
            return pack(rows, docs, p).drop("_row")
        placed = pack(rows.select("_row", "id", "piece", "length", "ids_crc32"), docs, p)
        return rows.join(placed.select("_row", "sequence_id", "offset"), "_row").drop("_row")
    groups = max(1, ceil(docs / p.group))
    names = pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id bigint, offset bigint"
    full = pieces.where(F.col("length") >= p.length)
    rest = pieces.where(F.col("length") < p.length)

    def group(df: pd.DataFrame) -> pd.DataFrame:
        g = int(df["_group"].iloc[0])
        df = df.sort_values([n for n in ("id", "piece", "ids_crc32", "_row") if n in names], kind="stable").reset_index(drop=True)
        lengths = df["length"].tolist()
        order, sequence, offset = [], [], []
        for k, members in enumerate(best_two_fit(lengths, p.length)):
            at = 0
            for i in members:
                order.append(i)
                sequence.append((g << 32) + k)
                offset.append(at)
                at += lengths[i]
        return df.iloc[order][names].assign(sequence_id=sequence, offset=offset)

    keyed = rest.withColumn("_group", F.pmod(F.xxhash64("id", "piece", "ids_crc32", "_row"), F.lit(groups)))
    packed = keyed.groupBy("_group").applyInPandas(group, schema)
    # ids of the full ones: negative, unique over all partitions
    alone = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint"))
    return packed.unionByName(alone)


def packing_digest(docs: DataFrame, p: PackingParams = PackingParams()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(tokenise(docs, p, with_ids=False), docs.count(), p).withColumnRenamed("id", "doc_id")


def pack_documents(docs: DataFrame, p: PackingParams = PackingParams(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """sequence_id, n_tokens, ids array<int>, members array<struct<id, piece, start, length, offset>>: whole sequences."""
    pieces = tokenise(docs, p, True, id_column, text)
    packed = pack(pieces, docs.count(), p)
    row = F.struct("offset", "id", "piece", "start", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(row)).alias("m"))  # at most ``length`` members
    return rows.select(
        "sequence_id", F.aggregate("m", F.lit(0).cast("bigint"), lambda a, x: a + x.length).alias("n_tokens"), F.flatten(F.transform("m", lambda x: x.ids)).alias("ids"),
        F.transform("m", lambda x: F.struct(x.id.alias("id"), x.piece.alias("piece"), x.start.alias("start"), x.length.alias("length"), x.offset.alias("offset"))).alias("members"),
    )


__all__ = ["ChunkEncoder", "PackingParams", "best_two_fit", "pack", "pack_documents", "packing_digest", "tokenise"]
