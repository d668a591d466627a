"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from gridmix.llm.quality_rules import LISTED, RULES, STOP_WORDS

_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
_LANGUAGES = ", ".join(f"'{x}'" for x in LISTED)


def _rule(rule) -> str:
    tests = [f"{rule.count} >= {rule.low} * {rule.base}"] * (rule.low > 0)
    tests += [f"{rule.count} <= {rule.high} * {rule.base}"] * (rule.high < float("inf"))
    return f"({rule.base} < {max(rule.least, 1)} OR ({' AND '.join(tests) or 'true'}))"


# A stop word counts where it begins a word and is followed by its end or by a mark.
_QUALITY = rf"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS body, coalesce(split_part(lower(lang), '-', 1) IN ({_LANGUAGES}), false) AS listed,
         regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS k
  FROM documents
), hashed AS (
  SELECT *, CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: hash(w[i:i + 4])) ELSE [] END AS h
  FROM words
), repeated AS (
  SELECT doc_id, count(DISTINCT spot) AS n FROM (
    SELECT doc_id, unnest(range(p, p + 5)) AS spot FROM (
      SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, v) AS times
      FROM (SELECT doc_id, unnest(h) AS v, unnest(range(1, len(h) + 1)) AS p FROM hashed))
    WHERE times > 1) GROUP BY doc_id
), counted AS (
  SELECT doc_id, len(w) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(body) - length(translate(body, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(k) - len(list_distinct(k)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, len(k) AS n_lines,
         CAST(len(list_filter(w, lambda x: regexp_extract(lower(x), '^([^.,;:?]*)') IN ({_STOPS}))) AS BIGINT) AS n_stop_words,
         CAST(CASE WHEN listed THEN len(w) ELSE 0 END AS BIGINT) AS listed_words
  FROM hashed LEFT JOIN repeated USING (doc_id)
), based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT *, NOT base_failed AND {' AND '.join(map(_rule, RULES))} AS kept FROM based
"""

ORACLES: dict[str, str] = {"op2_quality_rules": _QUALITY}
