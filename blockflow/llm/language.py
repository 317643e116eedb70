"""Language identification by interpolated modified Kneser-Ney character models, one per language.

A model sees a text as its words (runs of letters in lower case), each with a start and an end. The models are
fitted on a bounded sample of labelled documents: of the distinct texts of each language, in the order of a hash of
the text, at most ``documents`` and about ``characters`` (the one that reaches it is still whole). They share sorted
arrays of n-gram hashes, one for each order, with the log probability in every language of the n-grams seen in any,
and the log back-off weight of the same n-gram as a context. The arrays are in the shared folder and memory-mapped.

A text gets the language of the lowest cross-entropy per symbol. ``score`` is the posterior of that language, at a
temperature fitted on labelled documents kept out of the models. A prediction is rejected if the posterior is below
``least_score``, or if the cross-entropy is higher than in the calibration documents of that language: above
``slack`` times the ``quantile`` of its standardised excess, which shrinks with the square root of the length.

Edge cases: a null text or one without a letter is ``und`` with score 0 and rejected; letters that no model knows
get a small probability; a null language is never learned; without any learned language all is ``und``; repeated
rows are predicted one by one; a null id is carried through, and learned from; other columns are left out.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockflow.llm.arraystore import discounts, find, mix, open_arrays, write_arrays
from blockflow.llm.common import fresh, held, map_blocks, own, text_column
from blockflow.runtime import shared_path

UNKNOWN = "und"
START, END = "\x02", "\x03"
_RUNS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """The runs of letters in lower case; number forms such as U+00BD aren't letters."""
    return [w for r in _RUNS.findall(text.lower()) if (w := r if r.isalpha() else "".join(filter(str.isalpha, r)))]


@dataclass(frozen=True)
class LanguageParams:
    order: int = 5  #: longest n-gram
    documents: int = 600  #: most documents of a language that are learned from or calibrated on
    characters: int = 2_000_000  #: about the most characters of a language
    calibration: int = 4  #: one in so many of these is kept for calibration
    least_score: float = 0.5
    quantile: float = 0.999
    slack: float = 2.0


# ---- fitting ---------------------------------------------------------------------------------------------


def sample(docs: DataFrame, p: LanguageParams, id_column: str, text: str, label: str) -> list[tuple[str, str, int]]:
    """(language, text, rank) of the sample; ``documents`` of a language at most."""
    rows = docs.select(F.col(label).cast("string").alias("lang"), F.col(text).cast("string").alias("t")).where("lang is not null and t is not null")
    distinct = rows.select("lang", F.xxhash64("t").alias("h"), F.length("t").alias("n")).groupBy("lang", "h").agg(F.max("n").alias("n"))
    # a hash below a bound that about twice the wanted texts of a language pass: few rows are left to be ranked
    totals = [(r["lang"], r["total"]) for r in distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("total")).collect()]  # a row for each language
    if not totals:
        return []
    share = F.least(F.lit(1.0), F.lit(2.0 * p.documents + 100) / F.col("total"))
    counts = F.broadcast(docs.sparkSession.createDataFrame(totals, "lang string, total bigint"))
    passed = distinct.join(counts, "lang").where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h"))
    few = passed.withColumn("rank", rank).where(F.col("rank") <= p.documents)
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("rank")) - F.col("n")
    few = few.withColumn("before", before).where(F.col("before") < p.characters).select("lang", "h", "rank")
    chosen = {(r["lang"], r["h"]): r["rank"] for r in few.collect()}  # bounded by the parameters, for each language
    if not chosen:
        return []
    keys = docs.sparkSession.createDataFrame([(k[0], k[1], v) for k, v in chosen.items()], "lang string, h bigint, rank int")
    texts = rows.withColumn("h", F.xxhash64("t")).join(F.broadcast(keys), ["lang", "h"]).groupBy("lang", "h").agg(F.first("t").alias("t"), F.first("rank").alias("rank"))
    return [(r["lang"], r["t"], r["rank"]) for r in texts.collect()]


def symbols(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words with their starts and ends, the number of the word of each)."""
    lead = START * (order - 1)
    line = "".join([lead + w + END for w in words])
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return codes, np.repeat(np.arange(len(words)), [len(w) + order for w in words])


def keys_by_order(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """[k] is the hash of the last k symbols at each place, [0] zero; places before k symbols are meaningless."""
    out = [np.zeros(len(codes), dtype=np.uint64)]
    for _ in range(order):
        out.append(mix(np.concatenate(([np.uint64(0)], out[-1][:-1])), codes))
    return out


def fit(counts: dict[str, Counter], order: int) -> dict[str, np.ndarray]:
    """The shared arrays ``keys{k}``, ``logp{k}``, ``logbow{k}`` of all languages (sorted by name), and ``floor``.

    ``counts``: how often each word occurs in each language.
    """
    langs = sorted(counts)
    stats = []  # for each language and order: keys, counts, contexts, suffixes
    alphabet = len({c for words in counts.values() for w in words for c in w}) + 1
    for lang in langs:
        words = list(counts[lang])
        codes, word = symbols(words, order)
        weight = np.array([counts[lang][w] for w in words], dtype=np.float64)[word] if words else np.zeros(0)
        keys = keys_by_order(codes, order)
        real = np.flatnonzero(codes != ord(START))
        levels: list = [None] * (order + 1)
        places, count = real, weight[real]
        for k in range(order, 0, -1):
            uniq, first, inverse = np.unique(keys[k][places], return_index=True, return_inverse=True)
            at = places[first]
            levels[k] = (uniq, np.bincount(inverse, weights=count, minlength=len(uniq)), keys[k - 1][at - 1] if k > 1 else np.zeros(len(uniq), np.uint64), keys[k - 1][at])
            places, count = at, np.ones(len(at))  # below the highest order: distinct predecessors
        stats.append(levels)
    arrays: dict[str, np.ndarray] = {}
    below: tuple[np.ndarray, np.ndarray] | None = None  # keys and probabilities of the order below
    for k in range(1, order + 1):
        union, where = np.unique(np.concatenate([s[k][0] for s in stats]), return_index=True)
        context = np.concatenate([s[k][2] for s in stats])[where]
        suffix = np.concatenate([s[k][3] for s in stats])[where]
        prob = np.full((len(union), len(langs)), 1.0 / (alphabet + 1)) if below is None else below[1][find(below[0], suffix)[0]]
        contexts = np.unique(context)
        bow = np.ones((len(contexts), len(langs)))
        for li, s in enumerate(stats):
            own, c, ctx, _ = s[k]
            if not len(own):
                continue
            d = discounts(*(np.count_nonzero(c == x) for x in (1, 2, 3, 4)))
            cut = np.select([c < 1.5, c < 2.5], d[:2], d[2])
            cut = np.minimum(cut, c)
            at, _ = find(contexts, ctx)
            total = np.bincount(at, weights=c, minlength=len(contexts))
            freed = np.bincount(at, weights=cut, minlength=len(contexts))
            seen = total > 0
            bow[seen, li] = freed[seen] / total[seen]
            prob[:, li] *= bow[find(contexts, context)[0], li]
            mine, _ = find(union, own)
            prob[mine, li] += (c - cut) / total[at]
        arrays[f"keys{k}"], arrays[f"logp{k}"] = union, np.log(np.maximum(prob, 1e-30)).astype(np.float32)
        if k == 1:
            arrays["floor"] = (np.log(np.maximum(bow[0] if len(bow) else np.ones(len(langs)), 1e-30)) - np.log(alphabet + 1)).astype(np.float32)
        else:  # the weight belongs to the context, an n-gram of the order below
            table = np.zeros((len(arrays[f"keys{k - 1}"]), len(langs)), dtype=np.float32)
            at, ok = find(arrays[f"keys{k - 1}"], contexts)
            table[at[ok]] = np.log(np.maximum(bow[ok], 1e-30))
            arrays[f"logbow{k - 1}"] = table
            # contexts of start symbols alone aren't predicted n-grams: kept beside
            arrays[f"extra_keys{k - 1}"], arrays[f"extra_bow{k - 1}"] = contexts[~ok], np.log(np.maximum(bow[~ok], 1e-30)).astype(np.float32)
        below = union, prob
    return arrays


# ---- scoring ---------------------------------------------------------------------------------------------


class Scorer:
    """Log probabilities of texts under all models, with a bounded cache of the chunks between white space."""

    MOST = 250_000

    def __init__(self, arrays: dict[str, np.ndarray], langs: list[str], order: int) -> None:
        self.a, self.langs, self.order = arrays, langs, order
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1 << 14, len(self.langs) + 1), dtype=np.float32)

    def words(self, words: list[str]) -> np.ndarray:
        """For each word the log probability in each language, and the number of its symbols."""
        out = np.zeros((len(words), len(self.langs) + 1))
        for lo in range(0, len(words), 20_000):
            part = words[lo : lo + 20_000]
            codes, word = symbols(part, self.order)
            keys = keys_by_order(codes, self.order)
            places = np.flatnonzero(codes != ord(START))
            total = np.zeros((len(codes), len(self.langs)))
            left = places
            for k in range(self.order, 0, -1):
                at, ok = find(self.a[f"keys{k}"], keys[k][left])
                total[left[ok]] += self.a[f"logp{k}"][at[ok]]
                left = left[~ok]
                if not len(left):
                    break
                if k > 1:
                    context = keys[k - 1][left - 1]
                    for names in (("keys", "logbow"), ("extra_keys", "extra_bow")):
                        at, ok = find(self.a[f"{names[0]}{k - 1}"], context)
                        total[left[ok]] += self.a[f"{names[1]}{k - 1}"][at[ok]]
                else:
                    total[left] += self.a["floor"]
            n = len(part)
            for j in range(len(self.langs)):
                out[lo : lo + n, j] = np.bincount(word, weights=total[:, j], minlength=n)
            out[lo : lo + n, -1] = [len(w) + 1 for w in part]
        return out

    def _learn(self, chunks: list[str]) -> None:
        """Cache the rows of new chunks; a chunk may hold several words or none."""
        found = [words_of(c) for c in chunks]
        words = list(dict.fromkeys(w for f in found for w in f))
        at = {w: i for i, w in enumerate(words)}
        values = self.words(words)
        n = len(self.rows)
        while len(self.table) < n + len(chunks):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for c, f in zip(chunks, found, strict=True):
            if len(f) == 1:
                self.table[n] = values[at[f[0]]]
            elif f:
                self.table[n] = values[[at[w] for w in f]].sum(axis=0)
            else:
                self.table[n] = 0
            self.rows[c] = n
            n += 1

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """For each text the log probability in each language, and the number of its symbols."""
        if len(self.rows) > self.MOST:
            self._clear()
        split = [t.split() if t else [] for t in texts]
        new = {c for s in split for c in s if c not in self.rows}
        if new:
            self._learn(sorted(new))
        get = self.rows.__getitem__
        out = np.zeros((len(texts), len(self.langs) + 1))
        for i, s in enumerate(split):
            if s:
                out[i] = self.table[np.fromiter(map(get, s), dtype=np.int64, count=len(s))].sum(axis=0, dtype=np.float64)
        if any(len(c) > 10_000 for c in new):
            self._clear()
        return out


def _posterior(sums: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """(number of the best language, its posterior) for rows of log probabilities and symbol counts."""
    n = np.maximum(sums[:, -1:], 1)
    x = sums[:, :-1] / n * np.sqrt(n) * t
    x -= x.max(axis=1, keepdims=True)
    e = np.exp(x)
    best = sums[:, :-1].argmax(axis=1)
    return best, e[np.arange(len(e)), best] / e.sum(axis=1)


def calibrate(sums: np.ndarray, truth: np.ndarray, langs: int, p: LanguageParams) -> dict:
    """The temperature, and for each language the mean and limit of the cross-entropy per symbol."""
    best, t = float("inf"), 1.0
    usable = sums[:, -1] > 0
    sums, truth = sums[usable], truth[usable]
    for x in np.geomspace(0.1, 30, 40):
        n = np.maximum(sums[:, -1:], 1)
        z = sums[:, :-1] / np.sqrt(n) * x
        m = z.max(axis=1, keepdims=True)
        loss = -np.mean(z[np.arange(len(z)), truth] - m[:, 0] - np.log(np.exp(z - m).sum(axis=1))) if len(z) else 0.0
        if loss < best - 1e-9:
            best, t = loss, float(x)
    mean, limit = [], []
    entropy = -sums[:, :-1].max(axis=1) / np.maximum(sums[:, -1], 1)
    for k in range(langs):
        own = truth == k
        if own.sum() < 10:
            mean.append(0.0)
            limit.append(float("inf"))
            continue
        mu = float(np.mean(entropy[own]))
        excess = (entropy[own] - mu) * np.sqrt(sums[own, -1])
        mean.append(mu)
        limit.append(float(np.quantile(excess, p.quantile)) * p.slack + 1e-9)
    return {"temperature": t, "mean": mean, "limit": limit}


def train(docs: DataFrame, p: LanguageParams = LanguageParams(), id_column: str = "doc_id", text: str = "text", label: str = "lang") -> str | None:
    """Fit on labelled documents; returns the URI of the model, or None if there is nothing to learn."""
    rows = sample(docs, p, id_column, text, label)
    kept = [r for r in rows if r[2] % p.calibration]
    counts: dict[str, Counter] = {}
    for lang, t, _ in kept or rows:
        words = words_of(t)
        if words:
            counts.setdefault(lang, Counter()).update(words)
    if not counts:
        return None
    langs = sorted(counts)
    arrays = fit(counts, p.order)
    rest = [(lang, t) for lang, t, rank in rows if rank % p.calibration == 0 and lang in counts]
    sums = Scorer(arrays, langs, p.order).texts([t for _, t in rest]) if rest else np.zeros((0, len(langs) + 1))
    extra = calibrate(sums, np.array([langs.index(lang) for lang, _ in rest], dtype=np.int64), len(langs), p)
    uri = f"{shared_path(docs.sparkSession, 'language')}/model.arrays"
    write_arrays(uri, arrays, langs=langs, order=p.order, **extra)
    return uri


def _scorer(uri: str) -> tuple[Scorer, dict]:
    def make() -> tuple[Scorer, dict]:
        arrays, extra = open_arrays(uri)
        return Scorer(arrays, extra["langs"], extra["order"]), extra

    return held(uri, make)


def judge(texts: list[str | None], uri: str | None, p: LanguageParams) -> tuple[list[str], list[float], list[bool]]:
    """(language, score, accepted) of each text."""
    if uri is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
    scorer, model = _scorer(uri)
    sums = scorer.texts(texts)
    best, score = _posterior(sums, model["temperature"])
    n = sums[:, -1]
    entropy = -sums[np.arange(len(sums)), best] / np.maximum(n, 1)
    excess = (entropy - np.array(model["mean"])[best]) * np.sqrt(n)
    none = n == 0
    accepted = ~none & (score >= p.least_score) & (excess <= np.array(model["limit"])[best])
    langs = [UNKNOWN if z else scorer.langs[b] for z, b in zip(none, best, strict=True)]
    return langs, np.where(none, 0.0, score).tolist(), accepted.tolist()


def identify(docs: DataFrame, uri: str | None, p: LanguageParams = LanguageParams(), text: str = "text", to: tuple[str, str, str] = ("lang_pred", "score", "accepted")) -> DataFrame:
    """All columns of ``docs`` and the prediction, its score, and whether it is accepted, in new columns ``to``, which ``docs`` may not have."""
    if set(fresh(docs, *to)) != set(to):
        raise ValueError(f"the columns {', '.join(to)} are taken; name others in 'to'")
    names = docs.columns

    def block(c: dict) -> dict:
        langs, score, accepted = judge(c[text], uri, p)
        return {n: c[n] for n in names} | dict(zip(to, (langs, score, accepted), strict=True))

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return map_blocks(docs, block, ", ".join([*kept, f"{to[0]} string, {to[1]} double, {to[2]} boolean"]), text)


def language_digest(docs: DataFrame, learn: Column, p: LanguageParams = LanguageParams()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted. ``learn``: which rows may be learned from."""
    uri = train(docs.where(learn), p)
    rows = docs.select("doc_id", (~learn).alias("held_out"), text_column(docs).alias("_text"))

    def block(c: dict) -> dict:
        langs, score, accepted = judge(c["_text"], uri, p)
        return {"doc_id": c["doc_id"], "held_out": c["held_out"], "lang_pred": langs, "score": score, "accepted": accepted}

    return map_blocks(rows, block, "doc_id bigint, held_out boolean, lang_pred string, score double, accepted boolean", "_text")


def keep_identified(docs: DataFrame, learn: Column, p: LanguageParams = LanguageParams()) -> DataFrame:
    """The rows whose language is identified, with the columns of ``docs``."""
    uri = train(docs.where(learn), p)
    to = tuple(fresh(docs, "_lang_pred", "_lang_score", "_lang_accepted"))
    return identify(docs, uri, p, to=to).where(to[2]).select(*own(docs))
