"""SentencePiece encoding and decoding: the N best segmentations over the lattice of pieces, by A-star.

A text becomes pieces of a published model's vocabulary (white space marked by U+2581, one mark in front). Forward
Viterbi scores of the lattice's nodes are exact heuristics for a backward A-star search, which yields segmentations
from the best on. A character in no piece becomes its bytes.

The lattice of a whole text falls apart where no piece can cross: before a run of marks, around characters that no
longer piece holds, and between a word and a sign. Each such unit is searched once and cached; the N best of the text are the N best sums over its
units, in which only the units with the smallest second-best losses can differ from their best. That is exact.

Scores: a unigram model's own. In a model of merges the score of a piece is its rank with a minus, which is no log
probability (three frequent pieces would beat any word); ranks are turned into -log(rank + 2), Zipf's law.

Edge cases: a null or empty text has no piece, one empty segmentation and score 0; a null id is carried through;
repeated rows are encoded one by one; a text with the mark U+2581 itself decodes to a space there, as the format has
it; segmentations of equal score are ordered by their ids; other columns are left out.
"""

from __future__ import annotations

import gc
import math
import re
import zlib
from array import array
from bisect import insort
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame

from blockflow.llm.common import held, map_blocks, text_column

MARK = "▁"
_first = itemgetter(0)


@dataclass(frozen=True)
class PieceParams:
    model: str | None = None  #: path of a sentencepiece model; None: piece_bpe_32k.model of public_tokenizers
    nbest: int = 3


def model_path(p: PieceParams) -> str:
    if p.model:
        return p.model
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Lattice:
    """N best segmentations of strings under pieces with scores."""

    def __init__(self, scores: dict[str, tuple[int, float]], byte_ids: list[int], byte_score: float) -> None:
        self.scores, self.byte_ids, self.byte_score = scores, byte_ids, byte_score
        self.trie: dict = {}  # by character; 0 is the piece that ends there, as (ids, score)
        for piece, (i, score) in scores.items():
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[0] = ((i,), score)

    def _bytes(self, c: str) -> tuple[tuple[int, ...], float]:
        data = c.encode("utf-8", "surrogatepass")
        return tuple(self.byte_ids[b] for b in data), self.byte_score * len(data)

    def edges(self, unit: str) -> tuple[list[list[tuple[int, tuple[tuple[int, ...], float]]]], list[float]]:
        """(the edges (start, (ids, score)) that end at each node, the best score from the start to each node)."""
        n, trie = len(unit), self.trie
        into: list[list] = [[] for _ in range(n + 1)]
        best = [-math.inf] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            node = trie.get(unit[i])
            j = i + 1
            if node is None or 0 not in node:
                piece = self._bytes(unit[i])
                into[j].append((i, piece))
                if here + piece[1] > best[j]:
                    best[j] = here + piece[1]
            while node is not None:
                piece = node.get(0)
                if piece is not None:
                    into[j].append((i, piece))
                    score = here + piece[1]
                    if score > best[j]:
                        best[j] = score
                if j == n:
                    break
                node = node.get(unit[j])
                j += 1
        return into, best

    def nbest(self, unit: str, n: int) -> list[tuple[float, list[int]]]:
        """(score, ids) of the n best segmentations, best first."""
        into, best = self.edges(unit)
        found: list[tuple[float, list[int]]] = []
        # (estimate with a minus, score from here, node, path): the entries stand for disjoint sets of segmentations, and
        # an estimate is the score of the best of its set, so entries behind the n best can't yield any of the n best
        agenda: list[tuple] = [(-best[len(unit)], 0.0, len(unit), None)]
        while agenda:
            estimate, g, node, path = agenda.pop(0)
            if node == 0:
                ids: list[int] = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                found.append((g, ids))
                continue
            room = n - len(found)
            for i, (ids, score) in into[node]:
                cost = -(g + score + best[i])
                if len(agenda) < room or cost < agenda[-1][0]:
                    del agenda[room - 1 :]
                    insort(agenda, (cost, g + score, i, (ids, path)), key=_first)
        found.sort(key=lambda f: (-f[0], f[1]))
        return found


def unit_pattern(pieces: dict) -> str:
    """An expression for runs of a text that no piece can leave: what follows the marks of a start, up to where a word
    character (but for the few that some piece has before a sign) meets a sign, a mark, or a character on its own."""
    pairs = {(p[i], p[i + 1]) for p in pieces for i in range(len(p) - 1)}
    word = re.compile(r"\w").match
    open_ = "".join(sorted(re.escape(x) for x in {x for x, y in pairs if word(x) and not word(y)}))
    inside = {c for pair in pairs for c in pair}
    alone = "".join(re.escape(c) for c in "\n\t\r" if c not in inside)
    sign = rf"[^\w{MARK}{alone}]"
    more = rf"(?:[^\W{open_}]*+[{open_}]{sign}*+)*+" if open_ else ""
    return (f"[{alone}]|" if alone else "") + rf"{MARK}*+{sign}*+{more}[^\W{open_}]*+"


class PieceModel:
    """A model's pieces: encoding to the N best, and decoding."""

    MOST = 1_200_000

    def __init__(self, path: str, nbest: int) -> None:
        import sentencepiece as sp
        from sentencepiece import sentencepiece_model_pb2 as pb

        spec = pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        self.nbest, kind = nbest, type(spec.pieces[0])
        assert sp.__version__ and spec.normalizer_spec.name == "identity", "only models without normalisation are supported"
        self.prefix = spec.normalizer_spec.add_dummy_prefix
        zipf = spec.trainer_spec.model_type == 2
        scores: dict[str, tuple[int, float]] = {}
        self.byte_ids, self.bytes = [0] * 256, []
        for i, p in enumerate(spec.pieces):
            if p.type == kind.BYTE:
                self.byte_ids[int(p.piece[3:-1], 16)] = i
                self.bytes.append(bytes([int(p.piece[3:-1], 16)]))
            else:
                self.bytes.append(p.piece.encode() if p.type in (kind.NORMAL, kind.USER_DEFINED) else b"")
            if p.type in (kind.NORMAL, kind.USER_DEFINED):
                scores[p.piece] = (i, -math.log(2 - p.score) if zipf else p.score)
        self.lattice = Lattice(scores, self.byte_ids, min(s for _, s in scores.values()) - 5)
        assert all(MARK not in p.lstrip(MARK) for p in scores), "a piece crosses a word's start"
        self.units = re.compile(unit_pattern(scores), re.DOTALL)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids: list[tuple[bytes, ...]] = []  # of each unit: the ids of its segmentations
        self.scores = np.zeros((1 << 12, self.nbest))

    def normalise(self, text: str) -> str:
        return (MARK if self.prefix and text else "") + text.replace(" ", MARK)

    def _add(self, unit: str) -> None:
        """Search a new unit."""
        n = len(self.known)
        if n == len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        found = self.lattice.nbest(unit, self.nbest)
        self.scores[n] = [*(s for s, _ in found), *[-math.inf] * (self.nbest - len(found))]
        self.ids.append(tuple([array("I", ids).tobytes() for _, ids in found]))
        self.known[unit] = n

    def encode(self, text: str | None) -> list[tuple[float, bytes]]:
        """(score, ids as little-endian 32-bit) of the N best segmentations of a whole text."""
        units = self.units.findall(self.normalise(text or ""))
        if units and not units[-1]:  # the empty match at the end
            units.pop()
        known = self.known
        long = False
        for u in dict.fromkeys(units):
            if u not in known:
                self._add(u)
                long |= len(u) > 1000
        row = list(map(known.__getitem__, units))
        ids = self.ids
        parts = [ids[i][0] for i in row]
        own = self.scores[np.array(row, dtype=np.int64)]
        best = float(own[:, 0].sum()) if row else 0.0
        out = [(best, b"".join(parts))]
        if self.nbest > 1 and row:
            second = own[:, 0] - own[:, 1]
            ways: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
            for place in sorted(_smallest(second, min(self.nbest - 1, len(row))).tolist()):
                loss = (own[place, 0] - own[place]).tolist()
                new = [(w + x, (*c, (place, k)) if k else c) for w, c in ways for k, x in enumerate(loss) if math.isfinite(x)]
                ways = sorted(new)[: self.nbest]
            for w, changes in ways:
                if changes:
                    for j, k in changes:
                        parts[j] = ids[row[j]][k]
                    out.append((best - w, b"".join(parts)))
                    for j, _ in changes:
                        parts[j] = ids[row[j]][0]
        if len(known) > self.MOST or long:
            self._clear()
        return out[: self.nbest]

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _smallest(a: np.ndarray, n: int) -> np.ndarray:
    """Places of the n smallest, the first of equal ones."""
    limit = np.partition(a, n - 1)[n - 1]
    below = np.flatnonzero(a < limit)
    return np.concatenate([below, np.flatnonzero(a == limit)[: n - len(below)]])


def opened(path: str, nbest: int) -> PieceModel:
    """The process's model."""
    return held(("pieces", path, nbest), lambda: PieceModel(path, nbest))


def encode_nbest(docs: DataFrame, p: PieceParams = PieceParams(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, segmentations array<struct<score, ids>>: the N best segmentations of each whole text."""
    path = model_path(p)

    def block(c: dict) -> dict:
        m = opened(path, p.nbest)
        return {id_column: c[id_column], "segmentations": [[{"score": s, "ids": array("i", b)} for s, b in m.encode(t)] for t in c["_text"]]}

    rows = docs.select(id_column, text_column(docs, text).alias("_text"))
    return map_blocks(rows, block, f"{id_column} {dict(docs.dtypes)[id_column]}, segmentations array<struct<score: double, ids: array<int>>>", "_text")


def decode(encoded: DataFrame, p: PieceParams = PieceParams(), ids: str = "ids", to: str = "text") -> DataFrame:
    """All columns and the text of a column of ids (null for null)."""
    path, names = model_path(p), encoded.columns

    def block(c: dict) -> dict:
        m = opened(path, p.nbest)
        return {n: c[n] for n in names} | {to: [None if x is None else m.decode(x) for x in c[ids]]}

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != to]
    return map_blocks(encoded, block, ", ".join([*kept, f"{to} string"]), ids)


def pieces_digest(docs: DataFrame, p: PieceParams = PieceParams()) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 and best_score of the best segmentation, scores and crc32 of all, round_trip."""
    path = model_path(p)

    def block(c: dict) -> dict:
        m = opened(path, p.nbest)
        gc.disable()  # millions of small tuples, no cycles
        out: dict[str, list] = {"doc_id": c["doc_id"], "n_pieces": [], "ids_crc32": [], "best_score": [], "nbest_scores": [], "nbest_crc32": [], "round_trip": []}
        for t in c["_text"]:
            found = m.encode(t)
            ids = np.frombuffer(found[0][1], dtype="<u4").tolist()
            out["n_pieces"].append(len(ids))
            out["ids_crc32"].append(zlib.crc32(found[0][1]))
            out["best_score"].append(found[0][0])
            out["nbest_scores"].append([s for s, _ in found])
            out["nbest_crc32"].append([zlib.crc32(b) for _, b in found])
            out["round_trip"].append(m.decode(ids) == t.replace(MARK, " "))
        gc.enable()
        return out

    return map_blocks(
        docs.select("doc_id", text_column(docs).alias("_text")), block,
        "doc_id bigint, n_pieces bigint, ids_crc32 bigint, best_score double, nbest_scores array<double>, nbest_crc32 array<bigint>, round_trip boolean", "_text",
    )
