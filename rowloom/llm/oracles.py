"""SQL of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from rowloom.llm import line_dedup, quality_rules

#: Every document under every prefix of its bits: a shard is the first prefix that fits.
SHARDING = """
WITH rows AS (
    SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
        lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT), 60, '0') AS bits
    FROM documents
), nodes AS (
    SELECT substr(bits, 1, depth) AS shard, sum(n_bytes)::BIGINT AS shard_bytes, count(*)::BIGINT AS shard_rows
    FROM rows, range(0, 61) AS d(depth) GROUP BY ALL
), leaves AS (
    SELECT shard, shard_bytes, shard_rows FROM nodes
    WHERE (shard_bytes <= {limit} OR shard_rows <= 1)
      AND (shard = '' OR substr(shard, 1, length(shard) - 1) NOT IN (
          SELECT shard FROM nodes WHERE shard_bytes <= {limit} OR shard_rows <= 1))
)
SELECT doc_id, n_bytes, shard, shard_bytes, shard_rows FROM rows JOIN leaves ON starts_with(bits, shard)
"""

#: Lines and their variants as strings; equal variants at a place, and lines that are a variant.
LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS nr
    FROM documents
), counted AS (
    SELECT *, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS counts FROM lines
), firsts AS (
    SELECT line, min(struct_pack(d := doc_id, a := nr)) AS first FROM counted WHERE counts GROUP BY line
), variants AS (
    SELECT line, first, i, substr(line, 1, i - 1) || substr(line, i + 1) AS v FROM firsts, LATERAL (SELECT unnest(range(1, length(line) + 1)) AS i) WHERE length(line) >= {line_dedup.MIN_CHARS}
), changed AS (
    SELECT line, first, min(first) OVER (PARTITION BY i, v) AS partner FROM variants
), inserted AS (
    SELECT x.line, x.first, y.line AS other, y.first AS its_first FROM variants x JOIN firsts y ON x.v = y.line AND length(y.line) >= {line_dedup.MIN_CHARS}
), near AS (
    SELECT line FROM changed WHERE partner < first
    UNION SELECT line FROM inserted WHERE its_first < first
    UNION SELECT other FROM inserted WHERE first < its_first
), judged AS (
    SELECT c.doc_id, c.nr, c.line,
        coalesce(c.counts AND struct_pack(d := c.doc_id, a := c.nr) <> f.first, false) AS is_exact,
        coalesce(c.counts AND struct_pack(d := c.doc_id, a := c.nr) = f.first AND c.line IN (SELECT line FROM near), false) AS is_near
    FROM counted c LEFT JOIN firsts f ON c.counts AND c.line = f.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (is_exact) AS n_exact, count(*) FILTER (is_near) AS n_near,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT is_exact AND NOT is_near), '')) AS text_sha256
FROM judged GROUP BY doc_id
"""

_RATES = ", ".join(
    f"({r}_failed + {r}_mean * w_{r}) / (n_docs + w_{r}) AS {r}_rate" for r in quality_rules.RULES
)
_MEANS = ", ".join(f"sum({r}_failed) / sum(n_docs) AS {r}_mean, sum({r}_failed * {r}_failed / n_docs) / sum(n_docs) AS {r}_square" for r in quality_rules.RULES)
_WEIGHTS = ", ".join(
    f"CASE WHEN {r}_square - {r}_mean * {r}_mean > 1e-12 THEN least(greatest({r}_mean * (1 - {r}_mean) / ({r}_square - {r}_mean * {r}_mean) - 1,"
    f" {quality_rules.PRIOR_LEAST}), {quality_rules.PRIOR_MOST}) ELSE {quality_rules.PRIOR_MOST} END AS w_{r}"
    for r in quality_rules.RULES
)
_FAILED = ", ".join(f"count(*) FILTER ({r})::DOUBLE AS {r}_failed" for r in quality_rules.RULES)

QUALITY_RULES = f"""
WITH words AS (
    SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) > 2
), repeated AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) > 1 AS twice FROM windows
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(0, 3) AS r(k) WHERE twice GROUP BY doc_id
), lines AS (
    SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM words
), measured AS (
    SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), ruled AS (
    SELECT *, n_words < {quality_rules.MIN_WORDS} AS few_words,
        100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS repeats,
        100 * n_symbols > {quality_rules.MAX_SYMBOL_PERCENT} * n_words AS symbols
    FROM measured
), hosts AS (
    SELECT source, count(*)::DOUBLE AS n_docs, {_FAILED} FROM ruled GROUP BY source
), means AS (
    SELECT {_MEANS} FROM hosts
), weights AS (
    SELECT *, {_WEIGHTS} FROM means
), rates AS (
    SELECT source, {_RATES} FROM hosts, weights
), verdicts AS (
    SELECT source, greatest({", ".join(f"{r}_rate" for r in quality_rules.RULES)}) AS host_rate FROM rates
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words OR repeats AS base_failed,
    NOT (few_words OR repeats) AND host_rate <= {quality_rules.HOST_LIMIT} AS kept,
    round(host_rate, 6) AS host_rate, host_rate > {quality_rules.HOST_LIMIT} AS host_failed
FROM ruled LEFT JOIN verdicts ON ruled.source IS NOT DISTINCT FROM verdicts.source
"""

#: Every anchor against every row.
HARD_NEGATIVES = """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.c, b.c), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
      other_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5"""
