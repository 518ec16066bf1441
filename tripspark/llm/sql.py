"""DuckDB twins of the queries that SQL can express, over the same tables."""

from __future__ import annotations

from tripspark.llm import chat_format, mixture, quality_rules, vector_codes

SQL: dict[str, str] = {}

SQL["op5_source_mix"] = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::BIGINT AS size,
         ('0x' || substr(md5('{mixture.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 12))::BIGINT::DOUBLE
           / {float(mixture.STEPS)} AS draw
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [{', '.join(map(str, mixture.WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixture.WEIGHTS)} + 1] AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, ({mixture.MOST} * source_size)::DOUBLE AS most, ({mixture.MOST} * source_size)::DOUBLE / weight AS ratio FROM s
), l AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * {mixture.SHARE / 100}
    - coalesce(sum(most) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r
), t AS (
  SELECT source, source_size,
         least(most, coalesce(weight * (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, level LIMIT 1), most)) AS target
  FROM l
), p AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, {float(mixture.MOST)}) ELSE 0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""

_T = chat_format.CHATML
_MARKS = len(_T.start) + len(_T.after_role) + len(_T.end)

SQL["op7_chat_format"] = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), o AS (
  SELECT *, length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|'))
           + length(replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(10), '\\n')) + {_MARKS} AS chars,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         count(*) OVER (PARTITION BY conv_id) AS turns
  FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       bool_and(CASE WHEN place = 1 THEN role IN ('system', 'user')
                     WHEN role = 'user' THEN before IN ('assistant', 'system') AND (before <> 'system' OR place = 2)
                     WHEN role = 'assistant' THEN before = 'user' ELSE FALSE END)
         AND bool_or(place = turns AND role = 'assistant') AS valid
FROM o GROUP BY conv_id
"""

_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))


def _broken(rule: quality_rules.Rule) -> str:
    sides = [f"{rule.measure} < {rule.low}"] if rule.low is not None else []
    sides += [f"{rule.measure} > {rule.high}"] if rule.high is not None else []
    return "coalesce(" + " OR ".join(sides) + ", FALSE)"


SQL["op8_quality_rules"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^ \\t-\\r]')) AS lines
  FROM documents
), w AS (
  SELECT r, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS a FROM d
), g AS (
  SELECT r, i, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY r ORDER BY i)
), n AS (
  SELECT *, c IS NOT NULL AND count(*) OVER (PARTITION BY r, a, b, c) > 1 AS twice FROM g
), k AS (
  SELECT r, twice OR coalesce(lag(twice) OVER o, FALSE) OR coalesce(lag(twice, 2) OVER o, FALSE) AS covered
  FROM n WINDOW o AS (PARTITION BY r ORDER BY i)
), q AS (
  SELECT r, count(*) FILTER (covered) AS n_repeat_words FROM k GROUP BY r
), m AS (
  SELECT d.r, doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(x, '[ \\t-\\r]', '', 'g'))::BIGINT AS word_chars,
         (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines,
         length(x) - length(regexp_replace(x, '[A-Z]', '', 'g')) AS n_upper,
         length(x) - length(replace(x, '!', '')) AS n_exclamations,
         len(list_intersect(words, [{_STOPS}])) AS n_stop_words,
         len(list_filter(lines, lambda s: regexp_matches(ltrim(s, ' '), '^[-*•]'))) AS n_bullets,
         len(list_filter(lines, lambda s: ends_with(rtrim(s, ' '), '...'))) AS n_ellipses
  FROM d LEFT JOIN q ON d.r = q.r
), v AS (
  SELECT *, word_chars / nullif(n_words, 0)::DOUBLE AS mean_word_length,
         n_symbols / nullif(n_words, 0)::DOUBLE AS symbols_per_word,
         n_upper / nullif(word_chars, 0)::DOUBLE AS upper_case_share,
         n_exclamations / nullif(n_words, 0)::DOUBLE AS exclamations_per_word,
         n_dup_lines / nullif(n_lines, 0)::DOUBLE AS repeated_lines_share,
         n_bullets / nullif(n_lines, 0)::DOUBLE AS bullet_lines_share,
         n_ellipses / nullif(n_lines, 0)::DOUBLE AS ellipsis_lines_share,
         n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED} * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({' OR '.join(_broken(r) for r in quality_rules.RULES)}) AS kept
FROM v
"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL["op9_decontamination"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents
), b AS (
  SELECT item_id, {_WORDS} AS words FROM benchmark
), g AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[p:p + least(len(words), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS p FROM b WHERE len(words) > 0)
), h AS (
  SELECT DISTINCT r, p, n, item_id
  FROM (SELECT r, p, n, array_to_string(words[p:p + n - 1], ' ') AS gram
        FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS p
              FROM d, (SELECT DISTINCT n FROM g) WHERE len(words) >= n)) JOIN g USING (n, gram)
), c AS (
  SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS w FROM h) GROUP BY r
), i AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM h) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.r = c.r LEFT JOIN i ON d.r = i.r
"""

SQL["op6_ngram_jaccard"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ \t-\r]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p + least(len(words), 5) - 1], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - least(len(words), 5) + 2)) AS p FROM d WHERE len(words) > 0)
), z AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), o AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
  FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT u, v FROM o JOIN z x ON x.doc_id = u JOIN z y ON y.doc_id = v WHERE 100 * common >= 80 * (x.n + y.n - common)
), c AS (
  SELECT doc_id, doc_id AS reached FROM z
  UNION
  SELECT c.doc_id, e.v FROM c JOIN e ON c.reached = e.u
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(m, d.doc_id) AS component_id
FROM d LEFT JOIN z ON d.doc_id = z.doc_id
LEFT JOIN (SELECT doc_id, min(reached) AS m FROM c GROUP BY doc_id) k ON d.doc_id = k.doc_id
"""

SQL["op1_backoff_scores"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents
), w AS (
  SELECT r, len(words) AS m, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS c FROM d
), g AS (
  SELECT *, lag(c) OVER o AS b, lag(c, 2) OVER o AS a FROM w WINDOW o AS (PARTITION BY r ORDER BY i)
), n AS (
  SELECT *, count(*) OVER () AS words,
         count(*) OVER (PARTITION BY c) - count(*) OVER (PARTITION BY r, c) AS c1,
         count(*) OVER (PARTITION BY b, c) - count(*) OVER (PARTITION BY r, b, c) AS c2,
         count(*) OVER (PARTITION BY a, b, c) - count(*) OVER (PARTITION BY r, a, b, c) AS c3
  FROM g
), x AS (
  SELECT *, lag(c1) OVER o AS d1, lag(c2) OVER o AS d2 FROM n WINDOW o AS (PARTITION BY r ORDER BY i)
), s AS (
  SELECT r, i, m, c3 > 0 AND i > 2 AS full_order,
         CASE WHEN i > 2 AND c3 > 0 THEN ln(c3) - ln(d2)
              WHEN i > 1 AND c2 > 0 THEN CASE WHEN i > 2 THEN ln(0.4::DOUBLE) ELSE 0 END + ln(c2) - ln(d1)
              ELSE least(i - 1, 2) * ln(0.4::DOUBLE)
                   + CASE WHEN c1 > 0 THEN ln(c1) - ln(words - m) ELSE ln(0.4::DOUBLE) - ln(words - m + 1) END
         END AS v
  FROM x
), t AS (
  SELECT r, count(*) FILTER (full_order) AS n_full, round(sum(v) / count(*), 6) AS score FROM s GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_full, 0)::BIGINT AS n_full, score
FROM d LEFT JOIN t ON d.r = t.r
"""

SQL["op10_repeated_spans"] = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS k, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), w AS (
  SELECT r, k, s, md5_number(substr(x, 2 * s + 1, 100)) AS g
  FROM (SELECT r, k, x, unnest(range(0, length(x) // 2 - 49)) AS s FROM d WHERE length(x) >= 100)
), m AS (
  SELECT r, s FROM (SELECT r, k, s, min(k) OVER (PARTITION BY g) AS least FROM w) WHERE k > least
), i AS (
  SELECT r, s, sum(CASE WHEN s <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY s) AS run
  FROM (SELECT r, s, coalesce(lag(s) OVER (PARTITION BY r ORDER BY s), -100) AS before FROM m)
), u AS (
  SELECT r, run, min(s) AS a, max(s) + 50 AS b FROM i GROUP BY r, run
), v AS (
  SELECT r, run, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM u
), t AS (
  SELECT v.r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
         string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM v JOIN d ON v.r = d.r GROUP BY v.r
)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t ON d.r = t.r
"""


def _vector_codes(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """Plain Lloyd rounds, each a pair of tables: codes of all parts, and the moved entries."""
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS (
  SELECT row, part, min(struct_pack(d := d, e := entry)) AS best FROM (
    SELECT p.row, p.part, c.entry, list_sum(list_transform(list_zip(p.v, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT AS d
    FROM p JOIN c{r} c ON p.part = c.part) GROUP BY row, part
)"""
        )
        if r < rounds:
            steps.append(
                f"""c{r + 1} AS (
  SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY place) AS v FROM (
      SELECT part, entry, place, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean
      FROM (SELECT p.part, a.best.e AS entry, unnest(range(1, len(p.v) + 1)) AS place, unnest(p.v) AS x
            FROM p JOIN a{r} a ON p.row = a.row AND p.part = a.part)
      GROUP BY part, entry, place) GROUP BY part, entry) m ON c.part = m.part AND c.entry = m.entry
)"""
            )
    chain = ", ".join(steps)
    return f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label,
         list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS v, len(embedding) // {parts} AS width
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), FALSE))) = len(embedding)
), p AS (
  SELECT row, part, v[part * width + 1:(part + 1) * width] AS v FROM k, range({parts}) r(part)
), c0 AS (
  SELECT part, row - 1 AS entry, v FROM p WHERE row <= {entries}
), {chain}, e AS (
  SELECT row, string_agg(format('{{:02x}}', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY row
), s AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds}
)
SELECT k.vec_id, e.code, e.error, (sum(e.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, s.codebooks_sha256
FROM k JOIN e ON k.row = e.row, s
"""


SQL["op11_vector_codes"] = _vector_codes()
