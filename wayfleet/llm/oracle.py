"""SQL (DuckDB) of the registered queries that SQL can express.

Not there: fingerprints (no XXH64), trained models, code-point spans of
leftmost matches, exact packing order and iterative moves.
"""

from __future__ import annotations

import string

from wayfleet.llm import licenses, linerules, preferences

_WORDS = r"'[^\x20\x09-\x0D]+'"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _preferences() -> str:
    end = _quoted(preferences.END)
    return f"""
WITH said AS (
  SELECT conv_id // 2 AS pair_id, conv_id, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), pairs AS (
  SELECT pair_id, min(conv_id) AS chosen_id, max(conv_id) AS rejected_id
  FROM said GROUP BY pair_id HAVING min(conv_id) < max(conv_id)
), sides AS (
  SELECT p.pair_id, p.chosen_id, p.rejected_id, s.conv_id = p.chosen_id AS is_chosen, s.n, s.role, s.text
  FROM pairs p JOIN said s ON s.conv_id IN (p.chosen_id, p.rejected_id)
), differ AS (
  SELECT pair_id, min(n) - 1 AS n_common FROM (
    SELECT pair_id, n FROM sides GROUP BY pair_id, n
    HAVING count(*) < 2 OR min(role) <> max(role) OR min(text) <> max(text)
  ) GROUP BY pair_id
), cut AS (
  SELECT s.*, coalesce(d.n_common, (SELECT max(n) FROM sides x WHERE x.pair_id = s.pair_id)) AS n_common,
         '<|' || role || '|>' || chr(10) AS head
  FROM sides s LEFT JOIN differ d USING (pair_id)
), placed AS (
  SELECT *, head || text || {end} AS shown,
         sum(length(head || text || {end})) OVER (PARTITION BY pair_id, is_chosen, n <= n_common ORDER BY n) AS stop
  FROM cut
), spans AS (
  SELECT *, (stop - length(text || {end}))::BIGINT || ':' || stop::BIGINT AS span FROM placed
)
SELECT pair_id, any_value(chosen_id) AS chosen_id, any_value(rejected_id) AS rejected_id,
  any_value(n_common)::INTEGER AS n_common,
  coalesce(string_agg(shown, '' ORDER BY n) FILTER (is_chosen AND n <= n_common), '') AS prompt,
  coalesce(string_agg(shown, '' ORDER BY n) FILTER (is_chosen AND n > n_common), '') AS chosen,
  coalesce(string_agg(span, ',' ORDER BY n) FILTER (is_chosen AND n > n_common AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(shown, '' ORDER BY n) FILTER (NOT is_chosen AND n > n_common), '') AS rejected,
  coalesce(string_agg(span, ',' ORDER BY n) FILTER (NOT is_chosen AND n > n_common AND role = 'assistant'), '') AS rejected_mask
FROM spans GROUP BY pair_id
"""


def _line_rules() -> str:
    letters, digits = string.ascii_uppercase + "123456789", string.ascii_lowercase + "0" * 9
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w
  FROM documents
), places AS (
  SELECT row, unnest(w) AS a, generate_subscripts(w, 1) AS p FROM d
), three AS (
  SELECT row, p, a, lead(a) OVER x AS b, lead(a, 2) OVER x AS c FROM places WINDOW x AS (PARTITION BY row ORDER BY p)
), often AS (
  SELECT row, p FROM three WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY row, a, b, c) > 1
), repeats AS (
  SELECT row, count(DISTINCT p + k) AS n_repeat_words FROM often, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row
), base AS (
  SELECT row, doc_id, host, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_WORDS})) AS l,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN repeats USING (row)
), lines AS (
  SELECT row, host, line, sum(words) AS words FROM (
    SELECT row, host, array_to_string(regexp_extract_all(x, {_WORDS}), ' ') AS line, len(regexp_extract_all(x, {_WORDS})) AS words
    FROM (SELECT row, host, unnest(list_transform(l, lambda y: translate(y, '{letters}', '{digits}'))) AS x FROM base)
  ) GROUP BY row, host, line
), common AS (
  SELECT host, line FROM lines GROUP BY host, line
  HAVING count(*) > CASE WHEN min(words) < {linerules.SHORT_WORDS} THEN {linerules.MOST_DOCS_SHORT} ELSE {linerules.MOST_DOCS} END
), removed AS (
  SELECT row, sum(words)::BIGINT AS n FROM lines JOIN common
    ON lines.line = common.line AND lines.host IS NOT DISTINCT FROM common.host GROUP BY row
), judged AS (
  SELECT *, n_words < {linerules.LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    coalesce(n, 0) AS n_removed_words
  FROM base LEFT JOIN removed USING (row)
)
SELECT doc_id, n_words, word_chars, n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, n_repeat_words,
  base_failed, n_removed_words,
  NOT base_failed AND n_words - n_removed_words >= {linerules.LEAST_KEPT} * n_words AS kept
FROM judged
"""


def _licences() -> str:
    known = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in licenses.SENTENCES.items())
    rules = ", ".join(
        f"({k}, {_quoted(name)}, [{', '.join(map(_quoted, ids))}], {len(ids)})"
        for k, (name, ids) in enumerate(licenses.RULES)
    )
    longest = max(len(ids) for _, ids in licenses.RULES)
    sentences, plain = ", ".join(map(_quoted, licenses.SENTENCES)), ", ".join(map(_quoted, licenses._PLAIN))
    end, gap = licenses._SENTENCE_END, licenses._GAP
    normal_x = "trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))"
    return f"""
WITH known(sentence, identifier) AS (VALUES {known}),
rules(rule, licence, ids, size) AS (VALUES {rules}),
cut AS (
  SELECT DISTINCT coalesce('i' || doc_id, 't' || md5(coalesce(text, ''))) AS doc, doc_id,
    string_split(regexp_replace(regexp_replace(coalesce(text, ''), '{end}', '\\1' || chr(1), 'g'), '{gap}', chr(1), 'g'), chr(1)) AS u
  FROM documents
), pieces AS (
  SELECT doc, doc_id, list_filter(
    list_transform(
      flatten(list_transform(u, lambda x: CASE WHEN contains(x, chr(10)) AND NOT list_contains([{sentences}], {normal_x})
        THEN string_split(x, chr(10)) ELSE [x] END)),
      lambda x: CASE WHEN regexp_matches(x, '{licenses._ADDRESS}') THEN '' ELSE {normal_x} END),
    lambda y: length(y) > 1) AS l
  FROM cut
), found AS (
  SELECT DISTINCT doc, doc_id, place, sentence
  FROM (SELECT doc, doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS place FROM pieces)
), named AS (
  SELECT doc, doc_id, place, sentence, coalesce(identifier,
    CASE WHEN regexp_matches(sentence, '{licenses._COPYRIGHT}') THEN '{licenses.COPYRIGHT}' END) AS identifier
  FROM found LEFT JOIN known USING (sentence)
  WHERE identifier IS NOT NULL OR regexp_matches(sentence, '{licenses._MENTION}')
), runs AS (
  SELECT *, place - row_number() OVER (PARTITION BY doc ORDER BY place) AS run FROM named
), ahead AS (
  SELECT *, list(coalesce(identifier, '')) OVER (PARTITION BY doc, run ORDER BY place
    ROWS BETWEEN CURRENT ROW AND {longest - 1} FOLLOWING) AS have FROM runs
), best AS (
  SELECT doc, doc_id, run, place, sentence, coalesce(min(rule), {len(licenses.RULES)}) AS rule FROM (
    SELECT a.*, r.rule FROM ahead a LEFT JOIN rules r ON a.have[1:r.size] = r.ids
  ) GROUP BY doc, doc_id, run, place, sentence
), chosen AS (
  SELECT b.*, licence, coalesce(size, 1) AS size FROM best b LEFT JOIN rules USING (rule)
)
SELECT c.doc_id, c.place::INTEGER AS place,
  coalesce(c.licence, '{licenses.UNRECOGNISED}') AS licence,
  (CASE WHEN c.rule < {len(licenses.RULES)} THEN c.rule END)::INTEGER AS rule, c.size::INTEGER AS n_sentences
FROM chosen c
WHERE (c.rule < {len(licenses.RULES)} OR c.sentence NOT IN ({plain})) AND NOT EXISTS (
  SELECT 1 FROM chosen x WHERE x.doc = c.doc AND x.run = c.run
    AND (x.rule < c.rule AND x.place < c.place + c.size OR x.rule = c.rule AND x.place < c.place)
    AND x.place + x.size > c.place)
"""


def _top_k() -> str:
    return """
WITH whole AS (
  SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_preference_formatting": _preferences(),
        "op7_line_frequency_rules": _line_rules(),
        "op9_licence_sentence_rules": _licences(),
        "op11_mtree_top_k": _top_k(),
    }
