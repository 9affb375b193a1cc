"""DuckDB SQL of the quality rules (same counts, exact binomial tail through lgamma)."""

from lakeward.llm.quality import ALPHA_TOTAL, CUTOFFS, DELTA

_ALPHA = ALPHA_TOTAL / len(CUTOFFS)
_GRID = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, unnest({cuts}) AS cutoff" for rule, cuts in CUTOFFS.items())


def judged_sql(docs: str) -> str:
    """CTEs ending in ``judged(doc_id, text, ..., base_failed, kept)`` over the relation ``docs``."""
    return f"""
d AS (SELECT row_number() OVER () AS rid, * FROM {docs}),
w AS (SELECT rid, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
             lambda x: x <> '') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)),
             lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls,
        length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g'))
             AS n_symbols
      FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
rw AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r)
       GROUP BY rid),
f AS (SELECT d.*, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(w.n_symbols AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(rw.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN w USING (rid) LEFT JOIN rw USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        coalesce(lang, '') AS stratum FROM f),
s AS (SELECT rid, stratum, base_failed, unnest([
        {{'rule': 'symbols', 'score': 1000 * n_symbols // greatest(word_chars, 1)}},
        {{'rule': 'dup_lines', 'score': 1000 * n_dup_lines // greatest(n_lines, 1)}},
        {{'rule': 'repeats', 'score': 1000 * n_repeat_words // greatest(n_words, 1)}},
        {{'rule': 'word_length', 'score': 100 * word_chars // greatest(n_words, 1)}}]) AS r FROM b),
l AS (SELECT doc_id, min(quality) AS q FROM labels
      WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
h AS (SELECT s.stratum, s.r.rule AS rule, s.r.score AS score, l.q
      FROM s JOIN d USING (rid) JOIN l USING (doc_id) WHERE NOT s.base_failed),
t AS (SELECT h.stratum, h.rule, c.cutoff, count(*) FILTER (h.q = 1) AS n,
        count(*) FILTER (h.q = 1 AND h.score > c.cutoff) AS k,
        count(*) FILTER (h.q <> 1 AND h.score > c.cutoff) AS bad
      FROM h JOIN ({_GRID}) c USING (rule) GROUP BY ALL),
m AS (SELECT count(*) AS tests FROM (SELECT DISTINCT stratum, rule FROM h)),
p AS (SELECT *, CASE WHEN k >= n * {_ALPHA!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
        lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                 + i * ln({_ALPHA!r}) + (n - i) * ln(1 - {_ALPHA!r})))) END AS tail
      FROM t WHERE n > 0 AND bad > k),
c AS (SELECT stratum, rule, arg_max(cutoff, (bad - k) * 100000 + cutoff) AS cutoff
      FROM p, m WHERE tail <= {DELTA} / tests GROUP BY ALL),
x AS (SELECT DISTINCT s.rid FROM s JOIN c ON s.stratum = c.stratum AND s.r.rule = c.rule
      WHERE s.r.score > c.cutoff),
judged AS (SELECT b.*, NOT base_failed AND x.rid IS NULL AS kept FROM b LEFT JOIN x USING (rid))"""


SQL = f"""WITH {judged_sql('documents')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM judged"""
