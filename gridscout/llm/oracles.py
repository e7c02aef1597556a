"""DuckDB SQL for the operators' queries, where SQL can express them: written apart from their code."""

from __future__ import annotations

from gridscout.llm.licenses import LOWER, RULES, UPPER, cuts, more_specific, normal_sentences

SUBSTRING_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS words FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM texts)
), later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later
), word AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM texts)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM texts WHERE len(w) BETWEEN 1 AND 4
), sizes AS (
  SELECT doc_id, count(*) AS n, string_agg(s, '|' ORDER BY s) AS members FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON r.other = l.a
), components AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept,
  CASE WHEN n IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY members) END AS class_id
FROM components LEFT JOIN sizes USING (doc_id)
"""

DECONTAMINATION = rf"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), items AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM items WHERE len(w) > 0)
), places AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows))
), found AS (
  SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, words)
), hits AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM found) GROUP BY doc_id
), by_doc AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN by_doc USING (doc_id)
"""

WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
firsts AS (SELECT h, min(page_id) AS first FROM payloads WHERE strlen(h) >= 100 GROUP BY h)
SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to, true AS valid
FROM payloads LEFT JOIN firsts USING (h)
"""


def _license_scan() -> str:
    known = ", ".join(f"('{sentence}', '{name}')" for sentence, name in normal_sentences().items())
    holds = [
        "(" + " OR ".join(f"'|' || array_to_string({c}, '||') || '|' LIKE '%{'%'.join(f'|{x}|' for x in names)}%'" for c in "ab") + ")"
        for _, names in RULES
    ]
    found = [f"CASE WHEN {holds[i]}{''.join(f' AND NOT {holds[j]}' for j in more)} THEN '{RULES[i][0]}' END" for i, more in more_specific().items()]
    ended = f"translate(coalesce(text, '') || ' ', '{UPPER}', '{LOWER}')"
    for pattern, replacement in cuts():
        by = replacement.replace(r"\n", "\n").replace("\n", "' || chr(10) || '")
        ended = f"regexp_replace({ended}, '{pattern}', '{by}', 'g')"
    return rf"""
WITH known(sentence, name) AS (VALUES {known}),
ended AS (
  SELECT doc_id, {ended} AS t FROM documents
), sentences AS (
  SELECT doc_id, 'a' AS reading, unnest(string_split(t, chr(10))) AS s, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM ended
  UNION ALL
  SELECT doc_id, 'b', unnest(string_split_regex(t, '\n[\x09-\x0D\x20]*\n')), generate_subscripts(string_split_regex(t, '\n[\x09-\x0D\x20]*\n'), 1) FROM ended
), named AS (
  SELECT doc_id, reading, i, name FROM sentences JOIN known ON trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g')) = sentence
), sequences AS (
  SELECT doc_id, coalesce(list(name ORDER BY i) FILTER (reading = 'a'), []) AS a, coalesce(list(name ORDER BY i) FILTER (reading = 'b'), []) AS b
  FROM documents LEFT JOIN named USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, greatest(len(a), len(b)) AS n_sentences, array_to_string(CASE WHEN len(b) > len(a) THEN b ELSE a END, ',') AS sentence_ids,
  array_to_string(list_sort(list_distinct([{", ".join(found)}])), ',') AS licenses
FROM sequences
"""


FILL_IN_MIDDLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || doc_id) AS h FROM documents
), drawn AS (
  SELECT *, len(u) AS n, [('0x' || substr(h, 8 * i + 1, 8))::BIGINT FOR i IN range(4)] AS d FROM units
), cut AS (
  SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS a, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR d[3] % 100 >= 100 THEN 'plain' WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM cut
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

ORACLES = {
    "op1_substring_dedup": SUBSTRING_DEDUP,
    "op4_license_scan": _license_scan(),
    "op5_near_dedup": NEAR_DEDUP,
    "op7_decontamination": DECONTAMINATION,
    "op9_warc": WARC,
    "op11_fill_in_middle": FILL_IN_MIDDLE,
}
