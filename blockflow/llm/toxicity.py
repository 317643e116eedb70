"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a lexicon (plain and obfuscated), nearness of its words to words of the
second person, and rates of capitals, punctuation, digits and obfuscated words. The lexicon is learned from labelled
documents: words and word beginnings that toxic documents hold far more often than others; so it knows no language.

Labels come from a bounded sample (``sample`` rows in the order of a hash of the id). Its rows are split in two
halves; the features of one half use the lexicon of the other, so that the trees see how well a lexicon does on
documents it wasn't made from. Probabilities are calibrated on out-of-fold margins.

Edge cases: a null or empty text has all features zero and still gets a score; a null id is carried through and never
learned from; null labels don't count, and neither do labels that contradict each other; without labels of both kinds
the score is the share of toxic labels, or 0; repeated rows are scored one by one; other columns are left out.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import asdict, dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockflow.llm.common import fresh, map_blocks, text_column
from blockflow.llm.gbt import BoostParams, Trees, boost, calibrated, isotonic, out_of_fold
from blockflow.runtime import materialise

#: Words that speak to the reader, in English, French, German and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deinen ihr euch euer tú ti usted ustedes vosotros contigo".split()
)
#: Signs that stand for letters in obfuscated words.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l", "*": None, ".": None, "-": None, "_": None})
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’…¿¡"
_PUNCT = frozenset(_EDGES)
PREFIXES = (4, 5)


@dataclass(frozen=True)
class ToxicityParams:
    sample: int = 20_000  #: most labelled documents that are learned from
    lexicon: int = 150  #: most entries of the lexicon
    support: float = 0.01  #: least share of toxic documents that hold an entry
    odds: float = 20.0  #: how much likelier an entry is in a toxic document, at least
    cut: float = 0.7  #: predicted toxic from this score on
    boost: BoostParams = field(default_factory=lambda: BoostParams(trees=50, depth=3))


def normal(chunk: str) -> str:
    return chunk.lower().strip(_EDGES)


def entries(word: str) -> list[str]:
    """What a word may match: itself and its beginnings (marked by a star)."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


def _is_obfuscated(word: str) -> bool:
    """Letters with digits or signs between them."""
    inner = word[1:-1]
    return len(word) > 2 and word[0].isalpha() and any(not c.isalpha() and c not in "'’-" for c in inner) and sum(c.isalpha() for c in word) * 2 >= len(word)


#: Columns of a chunk's cached row.
WORD, HIT, WEIGHT, HIDDEN, SECOND, CAPS, ODD, LETTER, UPPER_, PUNCT, SHOUT, DIGIT, LENGTH = range(13)
FEATURES = (
    "lexicon_density", "lexicon_hits", "lexicon_weight", "lexicon_heaviest", "hidden_density", "second_person", "near_second_person", "nearest_second_person",
    "caps_words", "upper_letters", "punctuation", "exclamation", "obfuscated", "digits", "length", "word_length",
)


class Features:
    """The features of texts under a lexicon (entry -> weight), with a bounded cache of chunks."""

    MOST = 400_000

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.lexicon = lexicon
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1 << 12, 13), dtype=np.float32)

    def chunk(self, c: str) -> list[float]:
        word = normal(c)
        weigh = lambda w: max((self.lexicon.get(e, 0.0) for e in entries(w)), default=0.0)
        weight = weigh(word) if word else 0.0
        odd = _is_obfuscated(word)
        plain = normal(word.translate(LEET)) if odd else ""
        hidden = weigh(plain) if plain and plain != word and not weight else 0.0
        letters = sum(map(str.isalpha, c))
        upper = sum(map(str.isupper, c))
        return [
            bool(word), weight > 0 or hidden > 0, weight or hidden, hidden > 0, word in SECOND_PERSON, letters >= 2 and upper == letters, odd,
            letters, upper, sum(x in _PUNCT for x in c), c.count("!") + c.count("?"), sum(map(str.isdigit, c)), len(c),
        ]

    def text(self, t: str | None) -> list[float]:
        split = t.split() if t else []
        if not split:
            return [0.0] * len(FEATURES)
        rows = self.rows
        for c in dict.fromkeys(split):
            if c not in rows:
                n = len(rows)
                if n == len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[n] = self.chunk(c)
                rows[c] = n
        m = self.table[np.fromiter(map(rows.__getitem__, split), dtype=np.int64, count=len(split))]
        s = m.sum(axis=0, dtype=np.float64)
        words, letters, length = max(s[WORD], 1), max(s[LETTER], 1), max(s[LENGTH], 1)
        hits, second = np.flatnonzero(m[:, HIT]), np.flatnonzero(m[:, SECOND])
        near, nearest = 0.0, 50.0
        if len(hits) and len(second):
            at = np.searchsorted(second, hits)
            gap = np.minimum(np.abs(second[np.minimum(at, len(second) - 1)] - hits), np.abs(second[np.maximum(at - 1, 0)] - hits))
            near, nearest = float((gap <= 5).mean()), float(min(gap.min(), 50))
        if len(rows) > self.MOST or s[LENGTH] > 100 * len(split) + 10_000:
            self._clear()
        return [
            s[HIT] / words, float(np.log1p(s[HIT])), s[WEIGHT] / words, float(m[:, WEIGHT].max()), s[HIDDEN] / words, s[SECOND] / words, near, nearest,
            s[CAPS] / words, s[UPPER_] / letters, s[PUNCT] / length, s[SHOUT] / words, s[ODD] / words, s[DIGIT] / length, float(np.log1p(words)), letters / words,
        ]


# ---- learning --------------------------------------------------------------------------------------------


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, p: ToxicityParams, id_column: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """_text, y (0 or 1), half (0 or 1), fold (0 to 2) of the sample, written to the shared folder."""
    given = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).groupBy(id_column).agg(F.min(label).alias("y"), F.max(label).alias("z")).where("y = z")
    given = given.where(learn).select(F.col(id_column).alias("_id"), "y", F.xxhash64(id_column).alias("h"))
    # a bound on the hash that about twice the wanted rows pass: few are left to be ranked
    bound = min(1.0, (2.0 * p.sample + 100) / max(given.count(), 1))
    few = given.where(F.pmod("h", F.lit(1 << 30)) < bound * (1 << 30)).orderBy("h", "_id").limit(p.sample)
    rows = docs.select(F.col(id_column).alias("_key"), text_column(docs, text).alias("_text"))
    # the sample is at most ``sample`` rows of three numbers; of the rows that share an id one counts, by its text's hash
    joined = rows.join(F.broadcast(few), F.col("_key") == F.col("_id")).groupBy("_id").agg(F.min(F.struct(F.xxhash64("_text").alias("k"), "_text", "y")).alias("x"))
    k = F.col("x.k")  # equal texts are in one half and one fold
    by_text, by_id = F.pmod(k, F.lit(2)).cast("int"), F.pmod(F.xxhash64("_id"), F.lit(2)).cast("int")
    written = materialise(joined.select("x._text", "x.y", by_text.alias("by_text"), by_id.alias("by_id"), F.pmod(F.shiftright(k, 1), F.lit(3)).cast("int").alias("fold")), "toxic-sample")
    # with so few different texts that a half lacks a label, rows are dealt instead
    half = "by_text" if len(written.select("by_text", "y").distinct().collect()) == 4 else "by_id"
    return written.select("_text", "y", F.col(half).alias("half"), "fold")


def learn_lexicons(sample: DataFrame, p: ToxicityParams) -> list[dict[str, float]]:
    """The lexicons of the halves 0 and 1 of the sample, and of all of it."""
    def block(c: dict) -> dict:
        count: Counter = Counter()
        for t, y, half in zip(c["_text"], c["y"], c["half"], strict=True):
            for e in {e for w in {normal(x) for x in set(t.split())} if 1 < len(w) <= 40 for e in entries(w)}:
                count[e, half, y] += 1
        keys = list(count)
        return {"entry": [k[0] for k in keys], "half": [k[1] for k in keys], "y": [k[2] for k in keys], "n": [count[k] for k in keys]}

    sizes = {(r["half"], r["y"]): r["n"] for r in sample.groupBy("half", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    counted = map_blocks(sample, block, "entry string, half int, y int, n bigint", "_text")
    wide = counted.groupBy("entry").agg(*(F.sum(F.when((F.col("half") == h) & (F.col("y") == y), F.col("n")).otherwise(0)).alias(f"n{h}{y}") for h in (0, 1) for y in (0, 1)))
    wide = materialise(wide.where("n01 + n11 >= 2"), "toxic-entries")
    out = []
    for halves in ((0,), (1,), (0, 1)):
        toxic, clean = (sum(sizes.get((h, y), 0) for h in halves) for y in (1, 0))
        a, b = (sum((F.col(f"n{h}{y}") for h in halves), F.lit(0)) for y in (1, 0))
        odds = ((a + 0.5) / (toxic + 1)) / ((b + 0.5) / (clean + 1))
        least = max(3.0, p.support * toxic)
        top = wide.select("entry", a.alias("a"), odds.alias("odds")).where((F.col("a") >= least) & (F.col("odds") >= p.odds))
        top = top.orderBy((F.col("a") * F.log("odds")).desc(), "entry").limit(p.lexicon).collect()
        out.append({r["entry"]: float(np.log(r["odds"])) for r in top})
    return out


def train(docs: DataFrame, labels: DataFrame, learn: Column, p: ToxicityParams = ToxicityParams(), id_column: str = "doc_id", text: str = "text", label: str = "toxic") -> dict:
    """Fit; the model is a small dictionary: lexicon, trees, calibration."""
    sample = labelled(docs, labels, learn, p, id_column, text, label)
    by_half = learn_lexicons(sample, p)
    crossed = by_half[1], by_half[0]

    def block(c: dict, state) -> dict:
        return {"y": c["y"], "fold": c["fold"], "x": [state[h].text(t) for t, h in zip(c["_text"], c["half"], strict=True)]}

    rows = map_blocks(sample, block, "y int, fold int, x array<double>", "_text", setup=lambda: [Features(lex) for lex in crossed])
    got = sorted((tuple(r["x"]), r["y"], r["fold"]) for r in rows.collect())  # at most ``sample`` rows of numbers
    x = np.array([g[0] for g in got]).reshape(len(got), len(FEATURES))
    y = np.array([g[1] for g in got], dtype=float)
    if not len(got) or y.min() == y.max():
        return {"lexicon": by_half[2], "trees": asdict(Trees()), "xs": [0.0], "ps": [float(y.mean()) if len(y) else 0.0]}
    fold = np.array([g[2] for g in got])
    if any(len(set(y[fold != k])) < 2 for k in range(3)):  # too few different texts to be dealt
        fold = np.arange(len(got)) % 3
    xs, ps = isotonic(out_of_fold(x, y, fold, p.boost), y)
    return {"lexicon": by_half[2], "trees": asdict(boost(x, y, p.boost)), "xs": xs, "ps": ps}


# ---- scoring ---------------------------------------------------------------------------------------------


@lru_cache(2)
def _opened(key: str) -> Features:
    import json

    return Features(json.loads(key))


def score_texts(texts: list[str | None], model: dict) -> np.ndarray:
    import json

    f = _opened(json.dumps(model["lexicon"], sort_keys=True))
    x = np.array([f.text(t) for t in texts]).reshape(len(texts), len(FEATURES))
    return np.clip(calibrated(model["xs"], model["ps"], Trees(**model["trees"]).margin(x)), 0, 1)


def score(docs: DataFrame, model: dict, p: ToxicityParams = ToxicityParams(), text: str = "text", to: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """All columns, the score and whether it is at least ``cut`` (1 or 0), in the columns ``to``, which ``docs`` may not have."""
    if fresh(docs, *to) != list(to):
        raise ValueError(f"the columns {', '.join(to)} are taken; name others in 'to'")
    names = docs.columns

    def block(c: dict) -> dict:
        s = score_texts(c[text], model)
        return {n: c[n] for n in names} | {to[0]: s.tolist(), to[1]: (s >= p.cut).astype(int).tolist()}

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return map_blocks(docs, block, ", ".join([*kept, f"{to[0]} double, {to[1]} int"]), text)


def toxicity_digest(docs: DataFrame, labels: DataFrame, learn: Column, p: ToxicityParams = ToxicityParams()) -> DataFrame:
    """doc_id, held_out, score, predicted. ``learn``: the ids to learn from."""
    model = train(docs, labels, learn, p)
    rows = docs.select("doc_id", (~learn).alias("held_out"), text_column(docs).alias("_text"))
    return score(rows, model, p, "_text").drop("_text")
