"""DuckDB SQL for the operators that SQL can express."""

OP4 = r"""
WITH texts AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts
), grams AS (
  SELECT doc_id, i, w[i:i + 4] AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM cut WHERE len(w) >= 5)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM grams) WHERE c > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(5) AS r(k) GROUP BY doc_id
), counted AS (
  SELECT c.doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS n_capitals,
    length(text) - length(regexp_replace(text, '[!?|]', '', 'g')) AS n_marks,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM cut c LEFT JOIN repeats r USING (doc_id)
), measured AS (
  SELECT *, coalesce(n_symbols / nullif(word_chars, 0), 0) AS m1, coalesce(n_capitals / nullif(word_chars, 0), 0) AS m2,
    coalesce(n_marks / nullif(word_chars, 0), 0) AS m3, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS m4,
    coalesce(n_repeat_words / nullif(n_words, 0), 0) AS m5 FROM counted
), levels AS (
  SELECT lang, source, grouping(lang, source) AS level, count(*) AS n,
    quantile_disc(m1, 0.25) AS a1, quantile_disc(m1, 0.75) AS b1, quantile_disc(m2, 0.25) AS a2, quantile_disc(m2, 0.75) AS b2,
    quantile_disc(m3, 0.25) AS a3, quantile_disc(m3, 0.75) AS b3, quantile_disc(m4, 0.25) AS a4, quantile_disc(m4, 0.75) AS b4,
    quantile_disc(m5, 0.25) AS a5, quantile_disc(m5, 0.75) AS b5
  FROM measured GROUP BY ROLLUP (lang, source)
), limits AS (
  SELECT g.lang, g.source, unnest([p]) AS p FROM levels g
  JOIN levels l ON l.level = 1 AND l.lang IS NOT DISTINCT FROM g.lang
  JOIN levels t ON t.level = 3,
  LATERAL (SELECT CASE WHEN g.n >= 100 THEN g WHEN l.n >= 100 THEN l ELSE t END AS p)
  WHERE g.level = 0
)
SELECT m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words,
  m.n_words < 10 OR 100 * m.n_repeat_words > 20 * m.n_words AS base_failed,
  NOT (m.n_words < 10 OR 100 * m.n_repeat_words > 20 * m.n_words)
    AND m1 <= round(p.b1 + 6 * greatest(p.b1 - p.a1, 0.01), 6) AND m2 <= round(p.b2 + 6 * greatest(p.b2 - p.a2, 0.04), 6)
    AND m3 <= round(p.b3 + 6 * greatest(p.b3 - p.a3, 0.02), 6) AND m4 <= round(p.b4 + 6 * greatest(p.b4 - p.a4, 0.05), 6)
    AND m5 <= round(p.b5 + 6 * greatest(p.b5 - p.a5, 0.03), 6) AS kept
FROM measured m JOIN limits q ON q.lang IS NOT DISTINCT FROM m.lang AND q.source IS NOT DISTINCT FROM m.source
"""

OP7 = r"""
WITH cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS passage
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM cut WHERE len(w) >= 50)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY passage) AS least FROM windows) WHERE least < doc_id
), gone AS (
  SELECT doc_id, list(DISTINCT i + k) AS places FROM later, range(50) AS r(k) GROUP BY doc_id
), kept AS (
  SELECT c.doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
    CASE WHEN places IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
      lambda x: NOT list_contains(places, x[2])), lambda x: x[1]) END AS k
  FROM cut c LEFT JOIN gone g USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept
"""

OP10 = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM cut WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM cut LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""

OP13 = r"""
WITH sized AS (
  SELECT doc_id, source, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 16) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source
), weighed AS (
  SELECT *, ((rank - 1) % 3 + 1)::DOUBLE AS weight, (sum(source_size) OVER ())::BIGINT AS budget FROM sources
), levels AS (
  SELECT *, (budget - coalesce((SELECT sum(3 * b.source_size) FROM weighed b
      WHERE (3 * b.source_size / b.weight, b.rank) < (3 * a.source_size / a.weight, a.rank)), 0))::DOUBLE
    / (SELECT sum(b.weight) FROM weighed b
      WHERE (3 * b.source_size / b.weight, b.rank) >= (3 * a.source_size / a.weight, a.rank)) AS level FROM weighed a
), targets AS (
  SELECT *, least((3 * source_size)::DOUBLE, max(level) OVER () * weight) AS target FROM levels
), queued AS (
  SELECT s.*, source_size, target, rank, budget, row_number() OVER () AS r,
    (sum(size) OVER (PARTITION BY rank ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, epoch * source_size + before AS start FROM queued, range(3) AS e(epoch) WHERE size > 0 AND epoch * source_size + before < target
), cut AS (
  SELECT *, least(size, ceil(target)::BIGINT - start) AS words, least(1.0, (start + size) / target) AS finish FROM copies
), placed AS (
  SELECT *, sum(words) OVER (ORDER BY finish, rank, epoch, key, doc_id ROWS UNBOUNDED PRECEDING) - words AS mix_at FROM cut
), taken AS (
  SELECT r, sum(least(words, budget - mix_at))::BIGINT AS taken FROM placed WHERE mix_at < budget GROUP BY r
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM queued LEFT JOIN taken USING (r)
"""

ORACLES = {
    "op4_quality_rules": OP4, "op7_substring_dedup": OP7, "op10_near_duplicates": OP10, "op13_mixing": OP13,
}
