"""The same in DuckDB SQL, where SQL can express a query."""

from __future__ import annotations

from reviewloom.llm import quality, url_rules

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"


def _url_filters() -> str:
    rest = r"CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    host = _LOWER.format(r"regexp_extract(rest, '^[^/?#]*')")
    listed = ", ".join(
        f"({i}, '{r.name}', '{r.verdict}', {len(r.name)})" for i, r in enumerate(url_rules.LISTED))
    fits = " ".join(f"WHEN {i} THEN regexp_matches(host || path, '{r.regex}')"
                    for i, r in enumerate(url_rules.LISTED))
    unwanted = "|".join(url_rules.UNWANTED)
    return rf"""
WITH rests AS (SELECT page_id, coalesce({rest}, '') AS rest FROM pages),
places AS (
  SELECT row_number() OVER () AS k, page_id, {host} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
best AS (
  SELECT k, max({{'size': size, 'name': name, 'verdict': verdict}}) AS b
  FROM places, (VALUES {listed}) r(id, name, verdict, size)
  WHERE CASE id {fits} END GROUP BY k)
SELECT page_id, host, path, b.name AS rule, coalesce(b.verdict,
  CASE WHEN regexp_matches(host, '(^|[^a-z0-9])({unwanted})([^a-z0-9]|$)')
    THEN 'block' ELSE 'allow' END) AS verdict
FROM places LEFT JOIN best USING (k)"""


def _quality() -> str:
    size = lambda pattern: f"length(regexp_replace(t, '{pattern}', '', 'g'))"
    names = [name for name, _, _ in quality.RULES]
    rounds = []
    value = {k: repr(v) for k, v in quality.first_parameters(names).items()}
    for i in range(quality.ROUNDS):
        steps = ", ".join(f"{sql} AS {k}" for k, sql in quality.maximised_sql(names).items())
        before = f", e{i - 1}" if i else ""
        rounds.append(f"""
e{i} AS MATERIALIZED (SELECT {steps} FROM (
  SELECT patterns.*, {quality.posterior_sql(names, value)} AS p FROM patterns{before}))""")
        value = {k: f"e{i}.{k}" for k in value}
    votes = ", ".join(f"{quality.vote(good, bad)} AS vote_{name}" for name, bad, good in quality.RULES)
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS k, doc_id, coalesce("text", '') AS t FROM documents),
split AS MATERIALIZED (
  SELECT *, regexp_extract_all(t, '{_SPACED}') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_SPACED}')) AS lines FROM texts),
windows AS (
  SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
  FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3)),
repeated AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, x) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT k, count(DISTINCT i + d) AS n FROM repeated, (VALUES (0), (1), (2)) v(d) GROUP BY k),
counts AS (
  SELECT split.k, doc_id, len(w) AS n_words, {size(quality.SPACES)} AS word_chars,
    {size('[^' + quality.SYMBOLS[1:] + '+')} AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    {size(r'[^\p{Lu}]+')} AS n_capitals, {size(r'[^\p{L}]+')} AS n_letters, {size('[^!]+')} AS n_shouts
  FROM split LEFT JOIN covered ON split.k = covered.k),
voted AS MATERIALIZED (SELECT *, {votes} FROM counts),
patterns AS MATERIALIZED (
  SELECT {', '.join('vote_' + x for x in names)}, count(*) AS n FROM voted GROUP BY ALL),
{','.join(rounds)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND {quality.posterior_sql(names, value)} >= 0.5 AS kept
FROM voted, e{quality.ROUNDS - 1}"""


_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _decontamination() -> str:
    split = lambda table, key: f"""
  SELECT row_number() OVER () AS k, {key} AS id,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_PLAIN}') AS w FROM {table}"""  # noqa: E731
    return rf"""
WITH docs AS MATERIALIZED ({split('documents', 'doc_id')}),
items AS ({split('benchmark', 'item_id')}),
item_windows AS (
  SELECT DISTINCT id AS item_id, len(v) AS n, array_to_string(v, ' ') AS v
  FROM (SELECT id, w[i:i + least(13, len(w)) - 1] AS v
    FROM (SELECT id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT n FROM item_windows),
found AS (
  SELECT k, i, n, item_id
  FROM (SELECT k, n, i, array_to_string(w[i:i + n - 1], ' ') AS v
    FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n))
  JOIN item_windows USING (n, v)),
hits AS (
  SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM found) GROUP BY k),
named AS (
  SELECT k, count(DISTINCT item_id) AS n_items,
    sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS items
  FROM found GROUP BY k)
SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (k) LEFT JOIN named USING (k)"""


def _phrases() -> str:
    return r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM split, (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m)),
counted AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counted WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE m > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.m, k, l.f AS l, r.f AS r,
    (1000000 * CAST(c.a AS HUGEINT) * c.a) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(list_slice(w, 1, k), ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(w, k + 1, c.m), ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
  SELECT lang, array_to_string(list_slice(w, i, i + 1), ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE m = 3) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM worst LEFT JOIN around USING (lang, phrase)
  WHERE most IS NULL OR m = 3 OR 100 * most < 50 * a)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


ORACLES = {
    "op3_benchmark_decontamination": _decontamination(),
    "op7_url_filters": _url_filters(),
    "op10_quality_rules": _quality(),
    "op11_phrase_collocations": _phrases(),
}
