"""DuckDB statements of the operators that SQL can express."""

from __future__ import annotations

QUALITY_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, ws[i:i + 4] AS gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, cast(sum(least(5, i - before)) AS bigint) AS n_repeat_words
      FROM (SELECT rid, i, coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), -5) AS before FROM r) GROUP BY rid),
m AS (SELECT d.rid, doc_id, lang, cast(len(ws) AS bigint) AS n_words,
        cast(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS bigint) AS word_chars,
        cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
        length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
        len(ls) AS n_lines, cast(len(ls) - len(list_distinct(ls)) AS bigint) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d JOIN w ON d.rid = w.rid LEFT JOIN c ON d.rid = c.rid),
v AS (SELECT *, [n_symbols / greatest(word_chars, 1), n_dup_lines / greatest(n_lines, 1),
        n_repeat_words / greatest(n_words, 1), n_capitals / greatest(word_chars, 1)] AS measure FROM m),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1),
h AS (SELECT lang, measure FROM v WHERE doc_id IN (SELECT doc_id FROM good)),
cell AS (SELECT lang, rule, j, count(*) AS n, count_if(measure[rule] > j / 40.0::double) AS k
         FROM h, range(1, 5) a(rule), range(1, 33) b(j) GROUP BY lang, rule, j),
tail AS (SELECT lang, rule, j, n, k, CASE WHEN k >= n * 0.01 THEN 1 ELSE (
           SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))
           FROM range(0, 1000000) z(i) WHERE i <= k) END AS p FROM cell),
bad AS (SELECT lang, rule, max(CASE WHEN p * (SELECT count(*) FROM cell) > 0.05 THEN j ELSE 0 END) AS last_bad FROM tail GROUP BY lang, rule),
cut AS (SELECT lang, rule, (last_bad + 1) / 40.0::double AS cutoff FROM bad WHERE last_bad < 32),
hit AS (SELECT DISTINCT rid FROM v JOIN cut ON v.lang IS NOT DISTINCT FROM cut.lang WHERE measure[rule] > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND rid NOT IN (SELECT rid FROM hit)) AS kept
FROM v
"""
