"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Fixed base rules reject first. On top of them rules compare ratios of a text with cutoffs, chosen for each stratum
(language) on labelled holdouts:

* cutoffs come from fixed grids, so the labels are used for nothing else before;
* a family of cutoffs is one rule's grid, or a ladder of ``STEPS`` steps on which all rules get stricter together and a text
  counts as rejected if any rule rejects it;
* a cutoff counts as safe if the exact (Clopper-Pearson) upper bound of the share of good documents that it rejects is at
  most ``alpha``, at confidence ``1 - delta / (strata * families)`` (Bonferroni);
* within a stratum and family cutoffs are tested from the most lenient to the strictest and the testing stops at the first
  failure (fixed-sequence testing), so the grid needs no further correction;
* of all safe cutoffs of a stratum the one is used that rejects most labelled bad documents, less ``cost`` for each good
  one; there is none where that is nothing. One family acts in a stratum, so ``alpha`` isn't divided.

So with probability 1 - delta every stratum loses at most ``alpha`` of its good documents. A stratum with too few
labels to prove that, or with none, gets no rule beyond the base.

Edge cases: a null text has no word (and fails the base rules); a null language is a stratum of its own; a null id
is carried through, never labelled; labels that are null or contradict each other count as not given; repeated
rows are judged one by one; other columns are left out of the counts and carried through by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, lgamma, log, log1p

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockflow.llm.common import SPACE, fresh, own, sql_words, text_column
from blockflow.runtime import materialise

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
#: Steps of the ladder on which all rules get stricter together.
STEPS = 20
ALL = "all"
#: Up to so many strata (a row of six values each) the rules are broadcast.
MOST_BROADCAST = 10_000


@dataclass(frozen=True)
class QualityParams:
    alpha: float = 0.05  #: most good documents that the learned rules may reject, as a share of a stratum
    cost: float = 10.0  #: how many bad documents a rejected good one weighs when a cutoff is chosen among the safe ones
    delta: float = 0.05  #: probability that this fails anywhere
    min_words: int = 10  #: base rule: fewer words fail
    max_repeat_percent: int = 20  #: base rule: more words than this in repeated windows fail
    stratum: str = "lang"


#: The learned rules and their grids: a text is rejected if the ratio is above the cutoff.
GRIDS: dict[str, list[float]] = {
    "symbols_per_char": [0.005 * i for i in range(1, 41)],
    "duplicate_line_share": [0.05 * i for i in range(1, 20)],
    "repeated_word_share": [0.01 * i for i in range(1, 21)],
    "long_words": [6.0 + 0.5 * i for i in range(29)],
    "short_words": [-4.0 + 0.25 * i for i in range(14)],
}


def ratio(name: str, c: Column) -> Column:
    """The ratio that a rule looks at, from the struct of counts ``c``."""
    words, chars = F.greatest(c.n_words, F.lit(1)), F.greatest(c.word_chars, F.lit(1))
    return {
        "symbols_per_char": lambda: c.n_symbols / chars,
        "duplicate_line_share": lambda: c.n_dup_lines / F.greatest(c.n_lines, F.lit(1)),
        "repeated_word_share": lambda: c.n_repeat_words / words,
        "long_words": lambda: c.word_chars / words,
        "short_words": lambda: -c.word_chars / words,
    }[name]()


def with_counts(docs: DataFrame, text: str = "text", to: str = "_counts") -> DataFrame:
    """All columns and a struct of counts of the whole text: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    kept = own(docs)
    t, w, ln, h, v = fresh(docs, *(f"{to}_{x}" for x in ("text", "words", "lines", "hashes", "windows")))
    step = docs.select(*kept, text_column(docs, text).alias(t))
    step = step.select(
        *kept, t, sql_words(F.col(t)).alias(w),
        F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias(ln),
    )
    step = step.select(*kept, t, w, ln, F.transform(w, lambda x: F.xxhash64(x)).alias(h))
    windows = F.transform(F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, WINDOW))))
    step = step.select(*kept, t, w, ln, windows.alias(v))
    counts = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(ln).cast("long").alias("n_lines"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(_covered(F.col(v))).cast("long").alias("n_repeat_words"),
    )
    # a generator keeps filters on the counts above this point: pushed below, they would repeat the work for each use
    return step.select(*kept, F.explode(F.array(counts)).alias(to))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(windows: Column) -> Column:
    """How many words lie in a window whose hash occurs twice or more; ``windows`` has one hash for each start."""
    def repeated(s: Column) -> Column:
        at = F.transform(s, lambda x, k: F.when((F.get(s, k - 1).h == x.h) | (F.get(s, k + 1).h == x.h), x.i))
        return F.sort_array(F.filter(at, lambda i: i.isNotNull()))

    starts = _bind(F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), repeated)
    zero = F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(starts, zero, lambda a, i: F.struct((a.total + F.least(F.lit(WINDOW), i - a.last)).alias("total"), i.alias("last")), lambda a: a.total)


def base_failed(c: Column, p: QualityParams = QualityParams()) -> Column:
    return (c.n_words < p.min_words) | (100 * c.n_repeat_words > p.max_repeat_percent * c.n_words)


def log_tail(k: int, n: int, share: float) -> float:
    """log P(Binomial(n, share) <= k)."""
    if k >= n:
        return 0.0
    top = lgamma(n + 1)
    logs = [top - lgamma(j + 1) - lgamma(n - j + 1) + j * log(share) + (n - j) * log1p(-share) for j in range(k + 1)]
    m = max(logs)
    return m + log(sum(exp(x - m) for x in logs))


def is_safe(rejected: int, n: int, share: float, delta: float) -> bool:
    """Whether the exact upper confidence bound of the rejected share is at most ``share``."""
    return n > 0 and rejected < share * n and log_tail(rejected, n, share) <= log(delta)


def calibrate(counts: DataFrame, labels: DataFrame, p: QualityParams = QualityParams(), id_column: str = "doc_id") -> list[tuple]:
    """(stratum, rule, cutoff, good, good rejected, bad rejected) of the rules that are on.

    ``counts`` has the id, ``_stratum`` and ``_counts``; ``labels`` the id and quality (1 good, 0 bad). What comes
    to the driver is a histogram: strata x rules x grid cells, however many documents there are.
    """
    given = labels.where("quality is not null").groupBy(F.col(id_column).alias("_label_id")).agg(F.min("quality").alias("q"), F.max("quality").alias("q2")).where("q = q2")
    holdout = counts.join(given, counts[id_column] == given._label_id).where(~base_failed(F.col("_counts"), p))
    below = lambda value: lambda x: x < value
    cell = {r: F.size(F.filter(F.array(*map(F.lit, g)), below(ratio(r, F.col("_counts"))))) for r, g in GRIDS.items()}
    # on the ladder: the step at which the first rule rejects, counted from the strictest
    step = F.greatest(*(F.when(c > 0, STEPS - F.floor((len(GRIDS[r]) - c) * STEPS / len(GRIDS[r]))).otherwise(0).cast("int") for r, c in cell.items()))
    cells = holdout.select("_stratum", (F.col("q") == 1).alias("good"), F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), c.alias("cell")) for r, c in (cell | {ALL: step}).items()))).alias("c"))
    table = cells.groupBy("_stratum", "good", "c.rule", "c.cell").agg(F.count(F.lit(1)).alias("n")).collect()
    return choose({(r["_stratum"], r["rule"], r["cell"], r["good"]): r["n"] for r in table}, p)


def ladder(rule: str, step: int) -> float:
    """The rule's cutoff at a step from 1 (lenient) to STEPS."""
    grid = GRIDS[rule]
    return grid[len(grid) - -(-step * len(grid) // STEPS)]


def choose(table: dict[tuple[str, str, int, bool], int], p: QualityParams) -> list[tuple]:
    """The rules that are on, from the counts of (stratum, family, cell, good)."""
    strata = sorted({k[0] for k in table})
    sizes = {r: len(g) for r, g in GRIDS.items()} | {ALL: STEPS}
    out = []
    for s in strata:
        best = None
        for r, size in sizes.items():
            count = lambda good, above: sum(table.get((s, r, c, good), 0) for c in range(above, size + 1))  # noqa: E731, B023
            n = count(True, 0)
            for j in range(size - 1, -1, -1):  # the cutoff j rejects the cells above j
                if not is_safe(count(True, j + 1), n, p.alpha, p.delta / (len(strata) * len(sizes))):
                    break
                gain = count(False, j + 1) - p.cost * count(True, j + 1)
                if gain > (best[0] if best else 0):
                    best = (gain, r, j, n, count(True, j + 1), count(False, j + 1))
        if best:
            _, r, j, *seen = best
            out += [(s, x, ladder(x, STEPS - j) if r == ALL else GRIDS[x][j], *seen) for x in (GRIDS if r == ALL else (r,))]
    return out


def judge(counts: DataFrame, rules: list[tuple], p: QualityParams = QualityParams(), at: tuple[str, str] = ("_stratum", "_counts"), to: str = "_verdict") -> DataFrame:
    """All columns of ``counts`` and in ``to`` a struct of base_failed, kept, rejected_by (the learned rules that reject, in order)."""
    by: dict[str, dict[str, float]] = {}
    for stratum, rule, cutoff, *_ in rules:
        by.setdefault(stratum, {})[rule] = cutoff
    stratum, c = F.col(at[0]), F.col(at[1])
    name = fresh(counts, "_cuts")[0]
    wide = counts.sparkSession.createDataFrame([(s, tuple(x.get(r) for r in GRIDS)) for s, x in by.items()], f"{name}_of string, {name} struct<{', '.join(f'{r}: double' for r in GRIDS)}>")
    if len(by) <= MOST_BROADCAST:  # its size is known here
        wide = F.broadcast(wide)
    judged = counts.join(wide, stratum == F.col(f"{name}_of"), "left")
    hit = F.filter(F.array(*(F.when(ratio(r, c) > F.col(name)[r], F.lit(r)) for r in GRIDS)), lambda x: x.isNotNull())
    failed = base_failed(c, p)
    return judged.select(*own(counts), F.struct(failed.alias("base_failed"), (~failed & (F.size(hit) == 0)).alias("kept"), hit.alias("rejected_by")).alias(to))


def _stratum(p: QualityParams) -> Column:
    return F.coalesce(F.col(p.stratum).cast("string"), F.lit(""))


def quality_digest(docs: DataFrame, labels: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rejected_by."""
    few = docs.select("doc_id", "text", _stratum(p).alias("_stratum"))
    counts = materialise(with_counts(few).drop("text"), "quality")
    out = judge(counts, calibrate(counts, labels, p), p)
    return out.select("doc_id", *(f"_counts.{n}" for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), "_verdict.*")


def keep_good(docs: DataFrame, labels: DataFrame, p: QualityParams = QualityParams(), id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns. Rows and counts are written once, so no text is shuffled."""
    at, to = tuple(fresh(docs, "_stratum", "_counts")), fresh(docs, "_verdict")[0]
    rows = materialise(with_counts(docs, to=at[1]).withColumn(at[0], _stratum(p)), "quality-rows")
    rules = calibrate(rows.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(at[0]).alias("_stratum"), F.col(at[1]).alias("_counts")), labels, p)
    return judge(rows, rules, p, at, to).where(F.col(to)["kept"]).select(*own(docs))
