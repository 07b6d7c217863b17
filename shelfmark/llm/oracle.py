"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from shelfmark.llm.secrets import BASE, RULES

LLM_ORACLE: dict[str, str] = {}

# The source turns are read in order; a turn is escaped where its rendered form would not be read
# back: a control string in it, or one that already carries backslashes.
LLM_ORACLE["op10_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, regexp_matches(role || chr(1) || text, '[<\[]\\*/?(s>|INST\])') AND (
    regexp_matches(role || chr(1) || text, '<s>|</s>|\[INST\]|\[/INST\]|[<\[]\\+/?(s>|INST\])')) AS conflict
  FROM rows
), written AS (
  SELECT *,
    CASE WHEN conflict THEN regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g') ELSE role END AS wrole,
    CASE WHEN conflict THEN regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g') ELSE text END AS wtext
  FROM marked
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('<s>[INST]' || wrole || '[/INST]' || wtext || '</s>'))::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""

# Every window of every document is compared with every window of every item as text.
LLM_ORACLE["op2_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_starts AS (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM item_starts
), starts AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n
), hits AS (
  SELECT doc_id, s, x.n, item_id FROM (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win FROM starts) AS x
  JOIN item_windows AS y ON x.n = y.n AND x.win = y.win
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

LLM_ORACLE["op13_lexical_search"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), sizes AS (
  SELECT count(*) FILTER (WHERE len(w) > 0)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d
), tf AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) AS x
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
), df AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, sizes GROUP BY term, n_docs
), scored AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN df USING (term), sizes GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 20
"""

# All pairs of a label; components by the ids reachable over any number of links.
LLM_ORACLE["op11_embedding_duplicates"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND list_sum(list_transform(embedding, lambda e: CASE WHEN e IS NULL OR NOT isfinite(e) THEN 1 ELSE 0 END)) = 0
    AND list_sum(list_transform(embedding, lambda e: abs(e)::DOUBLE)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93
), reach AS (
  SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), lowest AS (
  SELECT u, min(v) AS low FROM reach GROUP BY u
), counts AS (
  SELECT u, count(*) AS n FROM links GROUP BY u
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN counts ON counts.u = vec_id LEFT JOIN lowest ON lowest.u = vec_id
"""


def _secrets_sql() -> str:
    """All spans of every rule: a match ends where the texts between matches and the matches so far end."""
    listed = ", ".join(f"({i}, '{r.kind}', {r.least})" for i, r in enumerate(RULES))
    base = ", ".join(f"'{r.kind}'" for r in BASE)

    def matches(i: int) -> str:
        pattern = "'" + RULES[i].pattern.replace("'", "''") + "'"
        return (
            f"SELECT doc_id, {i} AS rule, unnest(range(1, len(m) + 1)) AS i, m, g, s FROM (SELECT doc_id, "
            f"regexp_extract_all(t, {pattern}) AS m, regexp_extract_all(t, {pattern}, {RULES[i].group}) AS g, "
            f"regexp_split_to_array(t, {pattern}) AS s FROM d)"
        )

    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), rules(rule, kind, least) AS (VALUES {listed}), found AS (
  {" UNION ALL ".join(map(matches, range(len(RULES))))}
), placed AS (
  SELECT doc_id, rule, len(m[i]) AS size, len(g[i]) AS asked,
    list_sum(list_transform(m[1:i], lambda x: len(x))) + list_sum(list_transform(s[1:i], lambda x: len(x))) AS until FROM found
), spans AS (
  SELECT doc_id, rule, kind, (until - size)::BIGINT AS a, kind || ':' || (until - size)::BIGINT || ':' || until::BIGINT AS span
  FROM placed JOIN rules USING (rule) WHERE asked >= least
), listed AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY a, rule) FILTER (WHERE kind IN ({base})) AS base,
    string_agg(span, ',' ORDER BY a, rule) AS spans FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed ON listed.doc_id = d.doc_id
"""


LLM_ORACLE["op9_secret_scan"] = _secrets_sql()

# Lines by host and distinct document, as the method counts them, beside the base measures.
LLM_ORACLE["op4_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), split AS (
  SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM d
), lines AS (
  SELECT doc_id, source, t, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    trim(regexp_replace(regexp_replace(lower(line), '\p{Nd}', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain
  FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), repeated AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id
), starts AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 3)
), twice AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM starts
    QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1) GROUP BY doc_id
), hosts AS (
  SELECT source, greatest(20.0, count(*) * 0.01) AS most FROM (SELECT DISTINCT source, doc_id, t FROM d) GROUP BY source
), frequent AS (
  SELECT c.source, plain FROM (SELECT source, plain, count(DISTINCT (doc_id, t)) AS n FROM lines GROUP BY source, plain) AS c
  JOIN hosts ON c.source IS NOT DISTINCT FROM hosts.source WHERE n > most
), lost AS (
  SELECT doc_id, sum(n) AS n FROM lines JOIN frequent ON lines.source IS NOT DISTINCT FROM frequent.source AND lines.plain = frequent.plain GROUP BY doc_id
), judged AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: len(x))), 0)::BIGINT AS word_chars,
    len(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(twice.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_removed_words
  FROM d LEFT JOIN repeated ON repeated.doc_id = d.doc_id LEFT JOIN twice ON twice.doc_id = d.doc_id LEFT JOIN lost ON lost.doc_id = d.doc_id
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM judged
)
SELECT *, NOT base_failed AND 2 * n_removed_words <= n_words AND n_words - n_removed_words >= 25 AS kept FROM based
"""

# Every string of 100 bytes of every text, as it is. A byte is two hexadecimal digits; texts are cut in overlapping
# pieces first, since a substring far inside a long string is found by counting from its start.
LLM_ORACLE["op7_suffix_dedup"] = r"""
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), cuts AS (
  SELECT doc_id, h, len(h) // 2 AS n, unnest(range(0, (len(h) // 2 - 100) // 1000 + 1)) AS k FROM bytes WHERE len(h) >= 200
), windows AS (
  SELECT doc_id, 1000 * k + j AS i, md5(substr(c, 2 * j - 1, 200)) AS bytes_of
  FROM (SELECT doc_id, k, c, unnest(range(1, least(1000, n - 99 - 1000 * k) + 1)) AS j
    FROM (SELECT doc_id, n, k, substr(h, 2000 * k + 1, 2198) AS c FROM cuts))
), repeats AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY bytes_of ORDER BY doc_id, i) > 1
), islands AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS island
  FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM repeats)
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 99 AS z FROM islands GROUP BY doc_id, island
), pieces AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS a, a - 1 AS z FROM spans
  UNION ALL SELECT doc_id, coalesce(max(spans.z), 0) + 1, any_value(len(h) // 2) FROM bytes LEFT JOIN spans USING (doc_id) GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * pieces.a - 1, 2 * (pieces.z - pieces.a + 1)), '' ORDER BY pieces.a) AS left_over
  FROM pieces JOIN bytes USING (doc_id) GROUP BY doc_id
), gone AS (
  SELECT doc_id, sum(z - a + 1) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(left_over)) AS kept_sha256
FROM bytes JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""
