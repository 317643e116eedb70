"""URL filters in DataFrame functions: rules on hosts and paths, and boosted trees on lexical features for the rest.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path then goes
up to ``?``, ``#`` or the end. A rule fits its host and all subdomains, if the path starts with the rule's; of those
that fit the longest decides (then the one with the longer host, then a block). URLs that a rule decides are the
labelled ones from which the trees learn: a sample of at most ``sample`` rows of numbers is fitted on the driver, and
the trees become a column expression. Scores are calibrated by isotonic regression on out-of-fold margins. URLs of equal host
and path are one row of the sample and of one fold; a labelled URL's suffix statistics leave out its own fold.

Features: lengths of URL, host, path and query, depth, labels of the host, share of digits, entropy of the host,
numbers of parameters and hyphens, a fragment, a file ending, and suffix statistics: the share of blocked URLs among
the labelled ones with the same last label, the same last two labels, and the same first part of the path, drawn
towards the overall share where there are few. Those tables grow with the number of hosts and are joined, not sent
to the driver; Spark broadcasts one only if its size is under the configured threshold.

Edge cases: a URL that is null or has no ``://`` has an empty host and path, no rule, and a verdict by its features;
a null id is carried through; repeated rows are judged one by one, without labelled URLs nothing is blocked; an empty table
gives none; other columns are carried through by ``judge_urls`` whatever their names, and left out of the query.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockflow.llm.common import LOWER, UPPER, fresh, own
from blockflow.llm.gbt import BoostParams, Trees, boost, isotonic, out_of_fold
from blockflow.runtime import materialise


@dataclass(frozen=True)
class UrlRule:
    verdict: str  #: allow or block
    text: str  #: host and path, such as example.org/es/

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (UrlRule("allow", "org/"), UrlRule("block", "example.org/es/"), UrlRule("block", "example.org/en/1"), UrlRule("allow", "com/fr/"), UrlRule("block", "com/de/"))


@dataclass(frozen=True)
class UrlParams:
    sample: int = 20_000  #: most labelled URLs that the trees are fitted on
    prior: float = 5.0  #: weight of the overall share in suffix statistics
    cut: float = 0.5  #: blocked from this score on
    boost: BoostParams = field(default_factory=lambda: BoostParams(trees=30, depth=3))


def parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, what follows the path) of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.coalesce(F.regexp_extract(rest, r"\A([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))
    tail = F.coalesce(F.substr(rest, F.length(host) + F.length(path) + 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), path, tail


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """(text, verdict) of the rule that decides, null if none fits."""
    order = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != "block", r.text))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in order]
    pick = lambda name: F.coalesce(*(F.when(f, F.lit(getattr(r, name))) for f, r in zip(fits, order, strict=True)), F.lit(None).cast("string"))
    return pick("text"), pick("verdict")


def _count(s: Column, chars: str) -> Column:
    return F.length(s) - F.length(F.translate(s, chars, ""))


def entropy(s: Column) -> Column:
    """Bits per character of a short string."""
    chars = F.filter(F.split(s, ""), lambda c: c != "")
    def of(c: Column) -> Column:
        share = F.size(F.filter(chars, lambda x: x == c)) / F.size(chars)
        return -share * F.log2(share)

    return F.aggregate(F.transform(F.array_distinct(chars), of), F.lit(0.0), lambda a, x: a + x)


PLAIN = ("url_length", "host_length", "path_length", "tail_length", "depth", "host_labels", "digit_share", "host_digits", "host_entropy", "parameters", "hyphens", "fragment", "file_ending")
SUFFIXES = ("last_label", "last_two_labels", "first_part")
FEATURES = (*PLAIN, *(f"{s}_blocked" for s in SUFFIXES))
FOLDS = 3


def with_features(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, url: str = "url") -> DataFrame:
    """All columns, and in ``_u`` a struct of host, path, rule, verdict, the plain features and the suffixes."""
    kept = [F.col(f"`{c}`") for c in pages.columns]
    u = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    host, path, tail = parts(u)
    step = pages.select(*kept, u.alias("_url"), host.alias("_host"), path.alias("_path"), tail.alias("_tail"))
    u, host, path, tail = (F.col(c) for c in ("_url", "_host", "_path", "_tail"))
    rule, verdict = rule_of(host, path, rules)
    labels = F.split(host, r"\.")
    features = {
        "url_length": F.length(u), "host_length": F.length(host), "path_length": F.length(path), "tail_length": F.length(tail),
        "depth": _count(path, "/"), "host_labels": F.size(labels), "digit_share": _count(u, "0123456789") / F.greatest(F.length(u), F.lit(1)),
        "host_digits": _count(host, "0123456789"), "host_entropy": entropy(host), "parameters": _count(tail, "="), "hyphens": _count(u, "-"),
        "fragment": F.contains(tail, F.lit("#")).cast("int"), "file_ending": path.rlike(r"\.[A-Za-z0-9]{1,5}\z").cast("int"),
    }
    suffixes = {"last_label": F.element_at(labels, -1), "last_two_labels": F.substring_index(host, ".", -2), "first_part": F.regexp_extract(path, r"\A/([^/]*)", 1)}
    return step.select(*kept, F.struct(
        host.alias("host"), path.alias("path"), rule.alias("rule"), verdict.alias("verdict"),
        *(v.cast("double").alias(k) for k, v in features.items()), *(v.alias(k) for k, v in suffixes.items()),
    ).alias("_u"))


def _hash() -> Column:
    return F.xxhash64("_u.host", "_u.path")


def _fold() -> Column:
    return F.pmod(_hash(), F.lit(FOLDS))


def suffix_shares(features: DataFrame, p: UrlParams) -> tuple[dict[str, DataFrame], float]:
    """(for each kind of suffix a table of suffix, blocked and all labelled URLs by fold, the overall blocked share)."""
    known = features.where("_u.verdict is not null").select("_u.*", (F.col("_u.verdict") == "block").cast("double").alias("y"), _fold().alias("fold"))
    total = known.agg(F.avg("y")).first()[0] or 0.0
    by_fold = lambda c: F.array(*(F.sum(F.when(F.col("fold") == k, c).otherwise(0.0)) for k in range(FOLDS)))
    return {s: known.groupBy(F.col(s).alias(f"_{s}")).agg(by_fold(F.col("y")).alias(f"{s}_y"), by_fold(F.lit(1.0)).alias(f"{s}_n")) for s in SUFFIXES}, total


def with_shares(features: DataFrame, shares: dict[str, DataFrame], total: float, p: UrlParams, without_own_fold: bool = False) -> DataFrame:
    """All columns and the suffixes' blocked shares, the overall share for an unknown suffix."""
    kept = own(features)
    for s, table in shares.items():
        features = features.join(table, F.col(f"_u.{s}") == F.col(f"_{s}"), "left").drop(f"_{s}")

    def seen(c: str) -> Column:
        every = F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
        return F.coalesce(every - F.get(F.col(c), _fold().cast("int")) if without_own_fold else every, F.lit(0.0))

    return features.select(*kept, *(((seen(f"{s}_y") + p.prior * total) / (seen(f"{s}_n") + p.prior)).alias(f"{s}_blocked") for s in SUFFIXES))


def _columns() -> list[Column]:
    return [*(F.col(f"_u.{n}") for n in PLAIN), *(F.col(f"{s}_blocked") for s in SUFFIXES)]


def fit(features: DataFrame, shares: dict[str, DataFrame], total: float, p: UrlParams) -> dict:
    """Trees and calibration from a sample of labelled URLs, those with the smallest hashes of host and path."""
    known = features.where("_u.verdict is not null").withColumn("_h", _hash())
    many = known.select("_h").distinct().count()
    # a bound on the hash that about twice the wanted URLs pass: few rows are left to be ranked
    bound = min(1.0, (2.0 * p.sample + 100) / max(many, 1))
    few = known.where(F.pmod(F.shiftright(F.col("_h"), 2), F.lit(1 << 30)) < bound * (1 << 30)).select("_u", "_h").dropDuplicates(["_h"])
    full = with_shares(few, shares, total, p, without_own_fold=True)
    rows = full.select((F.col("_u.verdict") == "block").cast("double").alias("y"), "_h", *(c.alias(f"f{i}") for i, c in enumerate(_columns()))).orderBy("_h").limit(p.sample).collect()
    x = np.array([list(r)[2:] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    y = np.array([r["y"] for r in rows])
    if not len(rows) or y.min() == y.max():
        return {"trees": Trees(), "xs": [0.0], "ps": [float(y.mean()) if len(y) else 0.0]}
    fold = np.array([r["_h"] for r in rows], dtype=np.int64) % FOLDS
    xs, ps = isotonic(out_of_fold(x, y, fold, p.boost), y)
    return {"trees": boost(x, y, p.boost), "xs": xs, "ps": ps}


def calibrated(margin: Column, xs: list[float], ps: list[float]) -> Column:
    """The piecewise linear calibration as an expression."""
    out = F.lit(ps[-1])
    for a, b, p, q in reversed(list(zip(xs, xs[1:], ps, ps[1:], strict=False))):
        line = F.lit(p) + (margin - F.lit(a)) * F.lit((q - p) / (b - a)) if b > a else F.lit(q)
        out = F.when(margin <= F.lit(b), line).otherwise(out)
    return F.when(margin <= F.lit(xs[0]), F.lit(ps[0])).otherwise(out)


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, p: UrlParams = UrlParams(), url: str = "url", to: str = "_u") -> DataFrame:
    """All columns of ``pages``, and in ``to``, which it may not have, a struct with host, path, rule, verdict, score."""
    if fresh(pages, to) != [to]:
        raise ValueError(f"the column {to} is taken; name another in 'to'")
    wrapped = pages.select(F.struct(*own(pages)).alias("_row"), F.col(f"`{url}`").alias("_in"))
    features = materialise(with_features(wrapped, rules, "_in").drop("_in"), "urls")
    shares, total = suffix_shares(features, p)
    model = fit(features, shares, total, p)
    full = with_shares(features, shares, total, p)
    margin = full.select("_row", "_u", model["trees"].expression(_columns()).alias("_margin"))
    scored = margin.select("_row", "_u", calibrated(F.col("_margin"), model["xs"], model["ps"]).alias("_score"))
    verdict = F.coalesce(F.col("_u.verdict"), F.when(F.col("_score") >= p.cut, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select(*(F.col("_row")[c].alias(c) for c in pages.columns), F.struct("_u.host", "_u.path", "_u.rule", verdict.alias("verdict"), F.col("_score").alias("score")).alias(to))


def url_digest(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, p: UrlParams = UrlParams()) -> DataFrame:
    """page_id, host, path, rule, verdict, score."""
    return judge_urls(pages.select("page_id", "url"), rules, p).select("page_id", "_u.*")
