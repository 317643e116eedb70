import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockflow.llm import urls as U


def slow(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_rules_equal_brute_force(spark):
    rng = random.Random(1)
    parts = ["http", "://", "www.", "Example.", "example.", "org", "com", "net", "xorg", "/", "/es/", "/en/1", "/fr/", "/de/", "?", "#", "Ä", "\n", "a=1&b=2", ":80", "/p.html", "İ"]
    urls = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(1500)]
    urls += ["".join(["https://", rng.choice(["", "m.", "a.b."]), rng.choice(["example.org", "org", "x.com", "com", "y.net"]), *rng.choices(["/es/", "/en/1", "/fr/", "/de/", "/", "?q", "#f"], k=2)]) for _ in range(1500)]
    urls += [None, "", "http://" + "a" * 20000 + "/b"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in U.url_digest(pages).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule, verdict = slow(u)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), u
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


def test_entropy(spark):
    words = ["", "a", "abab", "example.org", "ÄÄb"]
    df = spark.createDataFrame([(w,) for w in words], "s string").select("s", U.entropy(F.col("s")).alias("e"))
    for r in df.collect():
        n = Counter(r.s).values()
        assert abs(r.e - sum(-c / len(r.s) * math.log2(c / len(r.s)) for c in n)) < 1e-9


def test_verdicts_follow_the_labelled(spark):
    rng = random.Random(2)
    rows = [f"https://h{rng.randint(0, 50)}.com/{rng.choice(['fr', 'de'])}/{rng.randint(0, 999)}" for _ in range(1500)]
    rest = [f"https://h{i}.net/{'fr' if i % 2 else 'de'}/{i}" for i in range(200)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(rows + rest)] + [(None, None)], "page_id long, url string")
    got = U.url_digest(pages).where("rule is null and page_id is not null").collect()
    assert len(got) == 200 and all((r.verdict == "block") == ("/de/" in r.path) for r in got)


def test_no_labels_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (None, None)], "page_id long, url string")
    assert [r.verdict for r in U.url_digest(pages).collect()] == ["allow"] * 3
    assert U.url_digest(pages.limit(0)).count() == 0


def test_python_free(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://a.com/de/1")], "page_id long, url string")
    plan = U.url_digest(pages)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_clashing_columns_are_carried_through(spark):
    names = ["_url", "_host", "_row", "_in", "_margin", "_score", "first_part_blocked", "first_part_y", "_h", "kept"]
    pages = spark.createDataFrame([(i, f"http://h{i}.com/{'fr' if i % 2 else 'de'}/{i}") for i in range(60)] + [(None, None)], "page_id long, url string")
    wide = pages.select("*", *(F.concat(F.lit(n), F.col("page_id").cast("string")).alias(n) for n in names))
    got = U.judge_urls(wide).collect()
    assert len(got) == 61 and all(r[n] == (None if r.page_id is None else f"{n}{r.page_id}") for r in got for n in names)
    plain = {r.page_id: (r.verdict, r.score) for r in U.url_digest(pages).collect()}
    assert all(plain[r.page_id] == (r._u.verdict, r._u.score) for r in got)
    with pytest.raises(ValueError):
        U.judge_urls(pages.withColumn("_U", F.lit(1)))


def test_shares_leave_out_the_own_fold(spark):
    """A suffix that is seen once says nothing about its own URL."""
    pages = spark.createDataFrame([(i, f"http://x{i}.h{i}.com/{'fr' if i % 3 else 'de'}/{i}") for i in range(90)], "page_id long, url string")
    p = U.UrlParams()
    f = U.with_features(pages).drop("page_id", "url")
    shares, total = U.suffix_shares(f, p)
    rows = U.with_shares(f, shares, total, p, without_own_fold=True).select("last_two_labels_blocked", "first_part_blocked", "_u.verdict").collect()
    assert all(abs(r[0] - total) < 1e-9 for r in rows)
    assert min(r[1] for r in rows if r.verdict == "block") > max(r[1] for r in rows if r.verdict == "allow")


def test_verdict_against_brute_force_trees(spark):
    """The expressions of trees and calibration give what walking the trees in Python gives."""
    rng = random.Random(4)
    rows = [f"https://h{rng.randint(0, 9)}.{rng.choice(['com', 'net', 'example.org', 'io'])}/{rng.choice(['fr', 'de', 'en'])}/{rng.randint(0, 99)}{rng.choice(['', '?a=1&b=2', '#x', '.html'])}" for _ in range(600)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    p = U.UrlParams()
    f = U.with_features(pages).drop("url")
    shares, total = U.suffix_shares(f, p)
    model = U.fit(f, shares, total, p)
    full = U.with_shares(f, shares, total, p)
    x = full.select("page_id", *(c.cast("double").alias(f"f{i}") for i, c in enumerate(U._columns()))).collect()
    margin = model["trees"].margin(np.array([list(r)[1:] for r in x]))
    want = dict(zip((r.page_id for r in x), np.interp(margin, model["xs"], model["ps"]), strict=True))
    got = {r.page_id: r.score for r in U.url_digest(pages).collect()}
    assert len({round(v, 6) for v in want.values()}) > 1
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)
