"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from blockflow.llm.quality import ALL, GRIDS, STEPS, QualityParams

_RATIO = {
    "symbols_per_char": "n_symbols::DOUBLE / greatest(word_chars, 1)",
    "duplicate_line_share": "n_dup_lines::DOUBLE / greatest(n_lines, 1)",
    "repeated_word_share": "n_repeat_words::DOUBLE / greatest(n_words, 1)",
    "long_words": "word_chars::DOUBLE / greatest(n_words, 1)",
    "short_words": "(-word_chars)::DOUBLE / greatest(n_words, 1)",
}


def quality_sql(p: QualityParams = QualityParams()) -> str:
    """op5_quality: the counts, and the rules with their exact binomial bounds.

    A cutoff is safe if P(Binomial(n, share) <= rejected) is at most its part of delta; the tail is summed in logs.
    """
    share = p.alpha
    grid = {r: f"{list(map(float, g))}::DOUBLE[]" for r, g in GRIDS.items()}
    rules = " UNION ALL ".join(f"SELECT row, q, stratum, '{r}' AS rule, {k} AS place, {len(GRIDS[r])} AS size, len(list_filter({grid[r]}, lambda x: x < {_RATIO[r]})) AS cell FROM passed" for k, r in enumerate(GRIDS))
    cutoff = {r: f"list_extract({grid[r]}, {n} - ((({STEPS} - j + 1) * {n} + {STEPS - 1}) // {STEPS}) + 1)" for r, n in ((r, len(g)) for r, g in GRIDS.items())}
    cutoffs = " UNION ALL ".join(f"SELECT stratum, '{r}' AS rule, CASE rule WHEN '{r}' THEN list_extract({grid[r]}, j) ELSE {cutoff[r]} END AS cutoff FROM chosen WHERE rule IN ('{r}', '{ALL}')" for r in GRIDS)
    over = ", ".join(f"CASE WHEN {_RATIO[r]} > (SELECT cutoff FROM cutoffs c WHERE c.rule = '{r}' AND c.stratum = k.stratum) THEN '{r}' END" for r in GRIDS)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS stratum FROM documents),
words AS (SELECT row, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM docs),
pos AS (SELECT row, unnest(range(1, len(w) - 3)) AS i, w FROM words WHERE len(w) >= 5),
win AS (SELECT row, i, hash(w[i:i+4]) AS h, w[i:i+4] AS x FROM pos),
rep AS (SELECT row, x FROM win GROUP BY row, x HAVING count(*) > 1),
cover AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(i, i + 5)) AS p FROM win SEMI JOIN rep USING (row, x)) GROUP BY row),
lines AS (SELECT row, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM docs),
counts AS (
  SELECT d.row, d.doc_id, d.stratum, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM docs d JOIN words USING (row) JOIN lines USING (row) LEFT JOIN cover c USING (row)),
judged AS (SELECT *, n_words < {p.min_words} OR 100 * n_repeat_words > {p.max_repeat_percent} * n_words AS base_failed FROM counts),
given AS (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1 HAVING min(quality) = max(quality)),
passed AS (SELECT j.*, g.q FROM judged j JOIN given g USING (doc_id) WHERE NOT base_failed),
single AS ({rules}),
cells AS (
  SELECT stratum, rule, place, size, cell, q FROM single UNION ALL
  SELECT stratum, '{ALL}', {len(GRIDS)}, {STEPS}, max(CASE WHEN cell > 0 THEN {STEPS} - ((size - cell) * {STEPS}) // size ELSE 0 END), q FROM single GROUP BY row, stratum, q),
cuts AS (SELECT stratum, rule, any_value(place) AS place, any_value(size) AS size FROM cells GROUP BY 1, 2),
tests AS (
  SELECT c.stratum, c.rule, j, any_value(c.place) AS place, count(*) FILTER (e.q = 1) AS n, count(*) FILTER (e.q = 1 AND e.cell >= j) AS k, count(*) FILTER (e.q = 0 AND e.cell >= j) AS bad
  FROM (SELECT *, unnest(range(1, size + 1)) AS j FROM cuts) c JOIN cells e ON e.stratum = c.stratum AND e.rule = c.rule GROUP BY 1, 2, 3),
tails AS (
  SELECT stratum, rule, j,
         sum(exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln({share!r}) + (n - x) * ln(1 - {share!r}))) AS tail
  FROM (SELECT *, unnest(range(0, least(k, n - 1) + 1)) AS x FROM tests WHERE n > 0 AND k < {share!r} * n) GROUP BY 1, 2, 3),
safe AS (
  SELECT t.stratum, t.rule, t.place, t.j, t.bad - {p.cost!r} * t.k AS gain,
         coalesce(s.tail <= {p.delta!r} / ((SELECT count(DISTINCT stratum) FROM cells) * {len(GRIDS) + 1}), false) AS ok
  FROM tests t LEFT JOIN tails s USING (stratum, rule, j)),
open AS (SELECT *, min(ok::INTEGER) OVER (PARTITION BY stratum, rule ORDER BY j DESC) = 1 AS reached FROM safe),
chosen AS (
  SELECT stratum, rule, j FROM open WHERE reached AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, place, j DESC) = 1),
cutoffs AS ({cutoffs}),
hits AS (SELECT k.*, list_filter([{over}], lambda x: x IS NOT NULL) AS rejected_by FROM judged k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND len(rejected_by) = 0 AS kept, rejected_by FROM hits"""
