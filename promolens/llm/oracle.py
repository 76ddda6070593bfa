"""SQL counterparts of the queries that SQL can express, for DuckDB.

The others have none: SQL has no tokenizer, CRC-32, XXH64 with a seed or Feistel network there.
"""

from __future__ import annotations

import string

from promolens.llm import licenses, quality


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_WORDS = r"[x for x in string_split_regex({text}, '{breaks}') if x <> '']"


def _licenses() -> str:
    entries = [(t, label, True) for t, label in licenses.PHRASES.items()] + [(t, label, False) for label, texts in licenses.TEMPLATES.items() for t in texts]
    values = ", ".join(f"({n}, {_text(label)}, {str(exact).lower()}, string_split({_text(t)}, ' '))" for n, (t, label, exact) in enumerate(entries))
    lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    words = _WORDS.format(text=lower, breaks=r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents),
t AS (SELECT * FROM (VALUES {values}) AS v(template, label, exact, w)),
tg AS (SELECT template, label, exact, len(w) - 2 AS grams, p AS pos, w[p + 1 : p + 3] AS gram FROM t, unnest(range(0, len(w) - 2)) AS u(p)),
g AS (SELECT r, p AS place, w[p + 1 : p + 3] AS gram FROM d, unnest(range(0, len(w) - 2)) AS u(p)),
met AS (SELECT r, template, label, exact, grams, place - pos AS diagonal, place, pos FROM g JOIN tg USING (gram)),
votes AS (SELECT DISTINCT r, template, exact, diagonal FROM met),
starts AS (
  SELECT *, CASE WHEN exact OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {licenses.DRIFT}, true) THEN 1 ELSE 0 END AS apart
  FROM votes
),
grouped AS (SELECT r, template, diagonal, sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS grp FROM starts),
merged AS (
  SELECT r, template, label, exact, grams, grp, count(DISTINCT pos) AS votes, min(place) AS first, max(place) AS last
  FROM met JOIN grouped USING (r, template, diagonal) GROUP BY ALL
),
found AS (
  SELECT *, least(1.0::DOUBLE, votes::DOUBLE / grams) AS coverage FROM merged
  WHERE CASE WHEN exact THEN votes = grams ELSE least(1.0::DOUBLE, votes::DOUBLE / grams) >= {licenses.COVERAGE} END
),
summed AS (
  SELECT r, count(*) FILTER (exact) AS n_base, min(first) FILTER (exact) AS first_word, max(first) FILTER (exact) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (exact)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(coverage) AS score
  FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN summed USING (r)
"""


_TOP_K = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) for x in embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def _quality() -> str:
    share = lambda part, whole, scale: f"CAST(floor({scale}::DOUBLE * {part} / greatest({whole}, 1)) AS BIGINT)"
    measures = {
        "symbols": share("n_symbols", "word_chars", 1000),
        "duplicate_lines": share("n_dup_lines", "n_lines", 1000),
        "repeated": share("n_repeat_words", "n_words", 1000),
        "stutter": share("n_same", "n_words", 1000),
        "word_length": share("word_chars", "n_words", 100),
    }
    rest = lambda m: f"greatest(0, length(bin({m})) - {quality.BITS})"
    buckets = ", ".join(f"(({r.measure} >> {rest(r.measure)}) << {rest(r.measure)}) AS {r.measure}_bucket" for r in quality.RULES)
    n = quality.REPEAT
    levels = ((0, ["lang", "source"]), (1, ["lang"]), (2, []))
    read, joins = [], []
    for level, by in levels:
        keys = "".join(f"{b}, " for b in by)
        for rule in quality.RULES:
            if rule.scripted and not by:
                continue
            name = f"l{level}_{rule.measure}"
            read.append(
                f"{name} AS (SELECT {keys}count(*) AS texts, greatest({rule.floor}::DOUBLE, quantile_disc({rule.measure}_bucket, 0.5) + {rule.spread}::DOUBLE * "
                f"(quantile_disc({rule.measure}_bucket, {rule.quantile}) - quantile_disc({rule.measure}_bucket, 0.5))) AS limit_ FROM b WHERE NOT base_failed "
                f"{'GROUP BY ' + ', '.join(by) if by else ''} HAVING count(*) >= {quality.MIN_GROUP if by else 1})"
            )
            on = " AND ".join(f"b.{c} IS NOT DISTINCT FROM {name}.{c}" for c in by) or "true"
            joins.append(f"LEFT JOIN {name} ON {on}")
    limit = lambda r: ", ".join(f"l{level}_{r.measure}.limit_" for level in range(2 if r.scripted else 3))
    over = " OR ".join(f"coalesce({r.measure} > coalesce({limit(r)}), false)" for r in quality.RULES)
    words = _WORDS.format(text="coalesce(text, '')", breaks=r"[\x20\x09-\x0D]+")
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS content, {words} AS w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
),
windows AS (SELECT r, i, w[i + 1 : i + {n}] AS body FROM d, unnest(range(0, len(w) - {n - 1})) AS u(i)),
twice AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, body) AS times FROM windows) WHERE times > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, unnest(range(0, {n})) AS u(k) GROUP BY r),
m AS (
  SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(content, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    len(lines) AS n_lines, len([i for i in range(1, len(w)) if w[i] = w[i + 1]]) AS n_same, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (r)
),
measures AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed,
    {", ".join(f"{measures[r.measure]} AS {r.measure}" for r in quality.RULES)}
  FROM m
),
b AS (SELECT *, {buckets} FROM measures),
{(", " + chr(10)).join(read)}
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({over}) AS kept
FROM b {" ".join(joins)}
"""


_WARC = """
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS body FROM pages),
d AS (
  SELECT page_id, strlen(body) AS payload_bytes, CAST(CAST(unhex(sha1(body)) AS BIT) AS VARCHAR) AS bits,
    row_number() OVER (PARTITION BY body ORDER BY page_id NULLS LAST, r) AS place, first(page_id) OVER (PARTITION BY body ORDER BY page_id NULLS LAST, r) AS first_id
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(list_sum([CAST(substr(bits, 5 * k + b + 1, 1) AS INTEGER) << (4 - b) for b in range(0, 5)]) AS INTEGER) + 1, 1) for k in range(0, 32)], '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN first_id END AS refers_to
FROM d
"""


def _codes(scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round as tables of their own: all parts against all entries, then floored means."""
    away = "CAST(list_sum([(s.x[j] - c.x[j]) * (s.x[j] - c.x[j]) for j in range(1, len(s.x) + 1)]) AS BIGINT)"
    steps = []
    for k in range(rounds + 1):
        steps.append(
            f"a{k} AS MATERIALIZED (SELECT s.r, s.part, min({away} * {entries} + c.entry) AS nearest FROM s JOIN c{k} c USING (part) GROUP BY s.r, s.part)"
        )
        if k < rounds:
            steps.append(f"""m{k} AS (
  SELECT part, nearest % {entries} AS entry, j, sum(x[j])::HUGEINT AS total, count(*) AS n FROM a{k} JOIN s USING (r, part), unnest(range(1, len(x) + 1)) AS u(j) GROUP BY ALL
),
c{k + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(means.x, c{k}.x) AS x FROM c{k} LEFT JOIN (
    SELECT part, entry, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x FROM m{k} GROUP BY part, entry
  ) means USING (part, entry)
)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
s AS MATERIALIZED (SELECT r, part, q[part * len(q) // {parts} + 1 : (part + 1) * len(q) // {parts}] AS x FROM v, unnest(range(0, {parts})) AS u(part)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x FROM s WHERE r <= {entries}),
{(", " + chr(10)).join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', nearest % {entries}), '' ORDER BY part) AS code, CAST(sum(nearest // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY r
),
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN coded USING (r), book
"""


_NEGATIVES = """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
near AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scored WHERE same),
pairs AS (
  SELECT n.anchor_id, n.vec_id AS positive_id, f.vec_id AS negative_id, n.score AS positive_score, f.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY n.anchor_id, n.place ORDER BY f.score DESC, f.vec_id) AS INTEGER) AS rank
  FROM near n JOIN scored f ON n.anchor_id = f.anchor_id AND NOT f.same AND 50 * n.score <= 100 * f.score AND 100 * f.score <= 95 * n.score
  WHERE n.place <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM pairs WHERE rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_licenses": _licenses(),
        "op5_top_k": _TOP_K,
        "op10_quality": _quality(),
        "op11_warc": _WARC,
        "op12_codes": _codes(),
        "op13_negatives": _NEGATIVES,
    }
