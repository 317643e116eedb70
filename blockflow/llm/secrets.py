"""Secret scans over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that every match must contain.
A block of documents is indexed once (trigram -> documents that hold it, for the trigrams that some query
names), the postings are intersected and united as the queries say, and the expression itself runs only on
the candidates. A rule whose expression has no mandatory trigram scans every text.

Text and trigrams are compared in ASCII lower case, so one index serves rules with and without case.

Edge cases: a null text counts as empty and has no spans; a null id is carried through; repeated rows give
repeated results; equal starts are listed in the order of the rules; other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import cache, lru_cache
from itertools import product
from re import _constants as C
from re import _parser as P

import numpy as np
from pyspark.sql import DataFrame

from blockflow.llm.common import map_blocks, text_column

#: Sets of strings larger than this are cut to shorter ones, or given up.
MOST_STRINGS = 48


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``keep`` judges a match; a failing one is dropped, yet its characters stay consumed."""

    kind: str
    pattern: str
    keep: Callable[[re.Match], bool] | None = None
    ignore_case: bool = False
    base: bool = False
    compiled: re.Pattern = field(init=False, compare=False, repr=False, default=None)

    def __post_init__(self) -> None:
        flags = re.ASCII | (re.IGNORECASE if self.ignore_case else 0)
        object.__setattr__(self, "compiled", re.compile(self.pattern, flags))

    def __reduce__(self):
        return Rule, (self.kind, self.pattern, self.keep, self.ignore_case, self.base)


def _value_of_eight(m: re.Match) -> bool:
    return len(m[2]) >= 8


def _sixteen(m: re.Match) -> bool:
    return m.end() - m.start() >= 16


def _thirty_two(m: re.Match) -> bool:
    return m.end() - m.start() >= 32


#: The first three are the base rules; what the others look for are published token formats.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _value_of_eight, True, True),
    Rule("access", r"AKIA[A-Z0-9]+", _sixteen, False, True),
    Rule("hex", r"[0-9a-f]+", _thirty_two, False, True),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"\b[sr]k_live_[A-Za-z0-9]{16,}"),
)

# ---- from an expression to a Boolean query -------------------------------------------------------------
# A query is True (no condition), or ("and", parts) / ("or", parts) with trigrams (bytes) as leaves.


def _both(parts: Iterable) -> object:
    flat = [p for p in parts if p is not True]
    return True if not flat else flat[0] if len(flat) == 1 else ("and", tuple(flat))


def _either(parts: Iterable) -> object:
    parts = tuple(dict.fromkeys(parts))
    return True if not parts or True in parts else parts[0] if len(parts) == 1 else ("or", parts)


def _of_strings(strings: Iterable[str]) -> object:
    """What holds if the text contains one of these strings; one that contains another adds nothing."""
    few: list[str] = []
    for s in sorted(strings, key=lambda s: (len(s), s)):
        if not any(f in s for f in few):
            few.append(s)
    out = []
    for s in few:
        b = s.encode()
        out.append(_both(dict.fromkeys(b[i : i + 3] for i in range(len(b) - 2))))
    return _either(out)


def _fold(code: int) -> str:
    """The character in ASCII lower case."""
    return chr(code + 32 if 65 <= code <= 90 else code)


def _members(items: list) -> set[str] | None:
    """The characters of a class, folded, or None if they are many or not listed."""
    found: set[str] = set()
    for op, arg in items:
        if op is C.LITERAL:
            found.add(_fold(arg))
        elif op is C.RANGE:
            found |= {_fold(c) for c in range(arg[0], min(arg[1], arg[0] + 100) + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _item(op: object, arg: object) -> tuple[set[str] | None, object]:
    """(the strings that the item matches if they are few, else None; the query that its matches satisfy)."""
    if op is C.LITERAL:
        return {_fold(arg)}, True
    if op is C.IN:
        return _members(arg), True
    if op is C.AT:
        return {""}, True
    if op is C.SUBPATTERN:
        return _analyse(list(arg[3]))
    if op is C.BRANCH:
        branches = [_analyse(list(b)) for b in arg[1]]
        if all(e is not None for e, _ in branches):
            return set().union(*(e for e, _ in branches)), True
        return None, _either(_both((q, True if e is None else _of_strings(e))) for e, q in branches)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT):
        low, high, body = arg
        inner, query = _analyse(list(body))
        if (low, high) == (0, 1) and inner is not None:
            return inner | {""}, True
        if low == high <= 8 and inner is not None and len(inner) ** low <= MOST_STRINGS:
            return {"".join(x) for x in product(inner, repeat=low)}, True
        return None, _both((query, True if inner is None else _of_strings(inner))) if low else True
    return None, True


def _analyse(items: list) -> tuple[set[str] | None, object]:
    """The same of a sequence of items."""
    run: set[str] = {""}
    for i, (op, arg) in enumerate(items):
        own, query = _item(op, arg)
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        # the run of strings ends here; another starts behind the item, or with it
        after, rest = _analyse(items[i + 1 :])
        if own is not None:
            if after is not None and len(own) * len(after) <= MOST_STRINGS:
                after = {a + b for a in own for b in after}
            else:
                rest = _both((rest, _of_strings(own)))
        return None, _both((_of_strings(run), query, rest, True if after is None else _of_strings(after)))
    return run, True


@cache
def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of a regular expression; True if it has no mandatory trigram."""
    exact, query = _analyse(list(P.parse(pattern)))
    return _both([query, True if exact is None else _of_strings(exact)])


def trigrams_of(query: object) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*(trigrams_of(p) for p in query[1]))


# ---- the index of a block --------------------------------------------------------------------------------

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32


@lru_cache(1)
def _table(keys: bytes) -> np.ndarray:
    """Which of all trigrams are wanted."""
    table = np.zeros(1 << 24, dtype=bool)
    table[np.frombuffer(keys, dtype=np.uint32)] = True
    return table


class BlockIndex:
    """Postings of a block of texts: for each wanted trigram the rows that hold it."""

    def __init__(self, texts: list[bytes], wanted: list[bytes]) -> None:
        self.n = len(texts)
        ends = np.cumsum([len(t) + 3 for t in texts])
        data = _FOLD[np.frombuffer(b"\0\0\0".join(texts) + b"\0\0\0", dtype=np.uint8)]
        codes = data[:-2] << 16
        codes |= data[1:-1] << 8
        codes |= data[2:]
        keys = np.array(sorted(int.from_bytes(t, "big") for t in wanted), dtype=np.uint32)
        table = _table(keys.tobytes())
        at = np.flatnonzero(table[codes])
        rows = np.searchsorted(ends, at, side="right")
        which = np.searchsorted(keys, codes[at])
        self.postings = {int(k).to_bytes(3, "big"): np.unique(rows[which == i]) for i, k in enumerate(keys)}

    def rows(self, query: object) -> np.ndarray:
        """The rows that satisfy a query, in order."""
        if query is True:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.postings.get(query, np.empty(0, dtype=np.int64))
        parts = [self.rows(p) for p in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(parts))
        out = min(parts, key=len)
        for p in parts:
            out = np.intersect1d(out, p, assume_unique=True)
        return out


def scan_block(texts: list[str | None], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """For each text its spans (start, end, number of the rule), by start, then rule."""
    texts = [t or "" for t in texts]
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = set().union(*(trigrams_of(q) for q in queries))
    index = BlockIndex([t.encode("utf-8", "surrogatepass") for t in texts], sorted(wanted))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        search = rule.compiled.finditer
        for i in index.rows(query).tolist():
            for m in search(texts[i]):
                if rule.keep is None or rule.keep(m):
                    found[i].append((m.start(), m.end(), k))
    for spans in found:
        spans.sort(key=lambda s: (s[0], s[2]))
    return found


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, spans array<struct<kind, start, end>>: every match of every rule in each whole text, in code points."""
    kinds = [r.kind for r in rules]

    def block(c: dict) -> dict:
        spans = scan_block(c["_text"], rules)
        return {id_column: c[id_column], "spans": [[{"kind": kinds[k], "start": a, "end": b} for a, b, k in s] for s in spans]}

    kind = dict(docs.dtypes)[id_column]
    return map_blocks(docs.select(id_column, text_column(docs, text).alias("_text")), block, f"{id_column} {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>", "_text")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", mask: str = "<{kind}>") -> DataFrame:
    """The same rows and columns, each secret in ``text`` replaced by a mask that names its kind.

    Overlapping spans are replaced together, named by the first. A null text stays null.
    """
    names, kinds = docs.columns, [r.kind for r in rules]

    def block(c: dict) -> dict:
        out = []
        for t, spans in zip(c[text], scan_block(c[text], rules), strict=True):
            if not spans:
                out.append(t)
                continue
            parts, at = [], 0
            for a, b, k in spans:
                if a >= at:
                    parts += [t[at:a], mask.format(kind=kinds[k])]
                at = max(at, b)
            out.append("".join([*parts, t[at:]]))
        return c | {text: out}

    return map_blocks(docs, block, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), text)


def secret_digest(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: the contract's columns, made from find_secrets' spans."""
    kinds, base = [r.kind for r in rules], {k for k, r in enumerate(rules) if r.base}

    def block(c: dict) -> dict:
        out: dict[str, list] = {"doc_id": c["doc_id"], "n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
        for spans in scan_block(c["_text"], rules):
            for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                out[name].append(sum(s[2] == k for s in spans))
            show = lambda some: ",".join(f"{kinds[k]}:{a}:{b}" for a, b, k in some)
            out["base_sha256"].append(hashlib.sha256(show(s for s in spans if s[2] in base).encode()).hexdigest())
            out["spans"].append(show(spans))
        return out

    return map_blocks(
        docs.select("doc_id", text_column(docs).alias("_text")), block,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string", "_text",
    )


__all__ = ["RULES", "BlockIndex", "Rule", "find_secrets", "redact", "scan_block", "secret_digest", "trigram_query", "trigrams_of"]
