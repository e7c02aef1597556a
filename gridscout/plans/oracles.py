"""DuckDB SQL that gives the same rows as the registered queries."""

from __future__ import annotations

from gridscout.functions import extract as X
from gridscout.functions.tokens import MAX_TERM
from gridscout.plans import fixtures as fx
from gridscout.plans import queries as Q
from gridscout.schemas import (
    DOUBLE_COLUMNS,
    ENRICHED_COLUMNS,
    INT_COLUMNS,
    PROFILE_COLUMNS,
    TEXT_FIELDS,
    WEIGHTS,
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def group1(column: str, pattern: str) -> str:
    return f"regexp_extract({column}, {quoted(pattern)}, 1)"


def listed(items) -> str:
    return ", ".join(items)


# ---- pages and profiles

STRIP = "regexp_replace(regexp_replace(html, '<script[^>]*>[\\s\\S]*?</script[^>]*>', ' ', 'g'), '<.*?>', ' ', 'g')"
STRIP_CONTENT = STRIP.replace("(html,", "(content,")
TITLE = group1("html", r"<title>([^<]*)</title>")

# Fixed values, written apart from the code under test: what the patterns must find.
SERIES = r"</div>\n*?\s*?</div>\n*?\s*?<div class=\"[\w ]*?\">([\w -]+)</div>\n*\s*</div>"
# Section values by one pattern over the whole page.
_SECTION = r">Driver Stats</h2>[\s\S]*?"
ATTRIBUTES = {
    "name": X.NAME_PATTERN,
    "series": SERIES,
    "driverdb_score": X.SCORE_PATTERN,
    **{c: rf"<div>{c}</div>\n*?\s*?<div>([^<]*)</div>" for c in X.VALUE_LABELS},
    **{c: rf"{_SECTION}{label}</div>\n?[ \t]*<div>([0-9]*)</div>" for c, label in X.COUNT_LABELS.items()},
    **{
        c: rf"{_SECTION}{label}</div>\n?[ \t]*<div>([0-9.]*)(?:<!-- -->)*%"
        for c, label in X.PERCENTAGE_LABELS.items()
    },
}
JSON_RAW = group1("content", X.JSON_PATTERN)
WITH_PAGES = f"""pg AS ({fx.PAGES_SQL}),
attr AS (SELECT filename, content, {listed(f"{group1('content', p)} AS {c}" for c, p in ATTRIBUTES.items())},
  CASE WHEN NOT contains(content, 'Driver Stats') AND json_valid({JSON_RAW}) THEN {JSON_RAW} END AS j FROM pg)"""


def _json(c: str, literal: bool) -> str:
    path = f"'$.{X.JSON_KEYS[c]}'"
    if not literal:
        return f"coalesce(json_extract_string(j, {path}), {c}) AS {c}"
    return f"""CASE WHEN j IS NULL THEN {c} WHEN json_type(j, {path}) IS NULL THEN 'N/A'
      WHEN json_type(j, {path}) = 'NULL' THEN 'None' ELSE json_extract_string(j, {path}) END AS {c}"""


def profile_select(literal: bool = False) -> str:
    columns = listed(_json(c, literal) if c in X.JSON_KEYS else c for c in PROFILE_COLUMNS)
    return f"SELECT {columns} FROM attr WHERE contains(filename, 'com_drivers')"


WITH_PROFILES = f"{WITH_PAGES}, prof AS ({profile_select()})"
NUMBER_TYPES = {c: "INTEGER" for c in INT_COLUMNS} | {c: "DOUBLE" for c in DOUBLE_COLUMNS}


def number(c: str) -> str:
    return f"coalesce(TRY_CAST({c} AS {NUMBER_TYPES[c]}), 0) AS {c}"


def bad_columns(columns) -> str:
    flags = listed(
        f"CASE WHEN {c} NOT IN ('', 'None') AND TRY_CAST({c} AS {t}) IS NULL THEN '{c}' END"
        for c, t in NUMBER_TYPES.items()
        if c in columns
    )
    return f"concat_ws(',', {flags}) AS bad_columns"


# ---- wiki, redirects, enrichment

LEAD = group1("text", X.LEAD_LINE)
INFOBOX = {
    "current_team": r"(?:t|T)eam\s*=\s*\[{0,2}(.*?)(?:\n|<|]]|\|)",
    "all_teams": r"(?:t|T)eam\(*s\)*\s*=\ *(.*)\n",
    "car_number": r"car(?:_| )number\s*=\s*(\d+)",
    "championships": r"(?:c|C)hampionships\s*=\s*(\d+)",
    "bio": X.LEAD_LINE,
}
INFOBOX_COLUMNS = listed(f"{group1('text', p)} AS {c}" for c, p in INFOBOX.items())


def with_titles(pages_sql: str) -> str:
    return f"""pages_in AS ({pages_sql}),
edges AS (SELECT id, title AS source, target FROM pages_in WHERE is_redirect),
articles AS (SELECT id, title, text FROM pages_in WHERE NOT is_redirect),
walk(source, id, target, hop) AS (
  SELECT source, id, target, 0 FROM edges UNION ALL
  SELECT w.source, w.id, e.target, hop + 1 FROM walk w JOIN edges e ON w.target = e.source WHERE hop < 60),
ends AS (SELECT source, id, arg_max(target, hop) AS target, max(hop) = 60 AS is_cycle FROM walk GROUP BY source, id),
titles AS (SELECT id, title, title AS article_title, id AS article_id, false AS is_cycle FROM articles UNION ALL
  SELECT e.id, source, CASE WHEN NOT is_cycle THEN target END, CASE WHEN NOT is_cycle THEN a.id END, is_cycle
  FROM ends e LEFT JOIN articles a ON a.title = e.target)"""


def info(name: str, keys: str, columns: str, where: str = "true") -> str:
    return f"""{name} AS (SELECT title, {columns} FROM found WHERE title IN ({keys}) AND {where}
  QUALIFY row_number() OVER (PARTITION BY title ORDER BY id) = 1)"""


PERSON_WHERE = "regexp_matches(text, 'racing driver', 'i')"
WITH_INFO = f"""{WITH_PROFILES}, {with_titles(fx.WIKI_SQL)},
found AS (SELECT t.id, t.title, a.text FROM titles t JOIN articles a ON a.id = t.article_id),
{info('series_info', "SELECT series FROM prof WHERE series <> ''", f"{LEAD} AS series_description")},
{info('person_info', "SELECT name FROM prof WHERE name <> ''", INFOBOX_COLUMNS, PERSON_WHERE)},
{info('team_info', "SELECT current_team FROM person_info WHERE current_team <> ''", f"{LEAD} AS team_description")},
enriched AS (SELECT {listed(f'prof.{c}' for c in PROFILE_COLUMNS)}, coalesce(series_description, '') AS series_description,
  {listed(f"coalesce(person_info.{c}, '') AS {c}" for c in INFOBOX)}, coalesce(team_description, '') AS team_description
  FROM prof LEFT JOIN series_info ON prof.series = series_info.title
  LEFT JOIN person_info ON prof.name = person_info.title
  LEFT JOIN team_info ON person_info.current_team = team_info.title)"""
DOCUMENTS_SELECT = f"""SELECT e.filename, {listed(number(c) if c in NUMBER_TYPES else f'e.{c}' for c in ENRICHED_COLUMNS if c != 'filename')},
  {bad_columns(ENRICHED_COLUMNS)}, {STRIP_CONTENT} AS content FROM enriched e JOIN pg ON pg.filename = e.filename"""

# ---- index and search

# Runs are found whole and cut after that: RE2 is slow at long counted repeats of letter classes.
TOKENS = f"""flatten(list_transform(regexp_extract_all(lower(%s), '[\\p{{L}}\\p{{N}}_]+'),
  lambda t: CASE WHEN length(t) <= {MAX_TERM} THEN [t] ELSE regexp_extract_all(t, '.{{1,{MAX_TERM}}}') END))"""


def wordbreak_tokens(column: str) -> str:
    """Tokens that keep joiners between letters or digits. RE2 cannot look around, so a joiner in such a place is
    first replaced by a private character, twice because matches overlap, and put back in the tokens."""
    joiners = [(r"[\p{L}\p{M}]", r"\p{L}", c) for c in "'’.:·"] + [(r"\p{N}", r"\p{N}", c) for c in ".,;'’"]
    private = [chr(0xE000 + i) for i in range(len(joiners))]
    text = f"lower({column})"
    for (before, after, joiner), mark in zip(joiners, private, strict=True):
        pattern = f"({before})[{joiner}]({after})".replace("'", "''")
        for _ in range(2):
            text = f"regexp_replace({text}, '{pattern}', '\\1{mark}\\2', 'g')"
    text = rf"regexp_replace({text}, '([\p{{Han}}\p{{Hiragana}}]\p{{M}}*)', ' \1 ', 'g')"
    plain = "".join(c for _, _, c in joiners).replace("'", "''")
    found = rf"regexp_extract_all({text}, '[\p{{L}}\p{{M}}\p{{N}}_{''.join(private)}]+')"
    return f"""flatten(list_transform({found}, lambda t: CASE WHEN length(t) <= {MAX_TERM} THEN [translate(t, '{''.join(private)}', '{plain}')]
      ELSE regexp_extract_all(translate(t, '{''.join(private)}', '{plain}'), '.{{1,{MAX_TERM}}}') END))"""


def simple_tokens(column: str) -> str:
    return TOKENS % column


def with_index(texts: str, tokens=simple_tokens) -> str:
    """tf, dl, fs and dfs over `texts`, a query for (doc_id, field, text)."""
    return f"""txt AS ({texts}), tok AS (SELECT doc_id, field, unnest({tokens('text')}) AS term FROM txt),
tf AS (SELECT doc_id, field, term, count(*) AS tf FROM tok GROUP BY ALL),
dl AS (SELECT doc_id, field, count(*) AS dl FROM tok GROUP BY ALL),
fs AS (SELECT field, count(*) AS n, avg(dl) AS avgdl FROM dl GROUP BY field),
dfs AS (SELECT field, term, count(*) AS df FROM tf GROUP BY ALL)"""


def melted(table: str, key: str, columns: dict[str, str], value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {key} AS doc_id, '{name}' AS field, {column} AS {value} FROM {table}"
        for name, column in columns.items()
    )


def with_matches(
    texts: str, numbers: str, requests: str, weights: dict[str, float], tokens=simple_tokens, word_bounds=False, positive=False
) -> str:
    """hits(query_id, doc_id, score): every matching document of every request."""
    bounds = r"(\w+)" if word_bounds else r"(-?\w+(?:\.\d+)?)"
    inside = "value BETWEEN lo AND hi"
    if positive:
        inside += " AND (NOT contains(field, 'percentage') OR lo > CAST('-inf' AS DOUBLE) OR value > 0)"
    parts = {"m": r"@(\w+)=(\w+)", "hi": rf"\$(\w+)={bounds}", "lo": rf"\^(\w+)={bounds}"}
    text = "q"
    for p in parts.values():
        text = f"trim(regexp_replace({text}, '{p}', '', 'g'))"
    lists = listed(
        f"regexp_extract_all(q, '{p}', {i}) AS {n}{i}" for n, p in parts.items() for i in (1, 2)
    )
    boosts = listed(f"('{f}', {w})" for f, w in weights.items())
    return f"""{with_index(texts, tokens)}, num AS ({numbers}), req AS ({requests}),
parsed AS (SELECT query_id, {text} AS text, {lists} FROM req),
sized AS (SELECT query_id, CAST(text <> '' AS INTEGER) + len(m1) AS nc, len(hi1) + len(lo1) AS nr FROM parsed),
musts AS (SELECT query_id, i, m1[i] AS field, replace(m2[i], '_', ' ') AS value
  FROM (SELECT *, unnest(range(1, len(m1) + 1)) AS i FROM parsed)),
clauses AS (
  SELECT query_id, 0 AS clause, field, term, count(*) * max(boost) AS boost
    FROM (SELECT query_id, unnest({tokens('text')}) AS term FROM parsed) t, (VALUES {boosts}) w(field, boost) GROUP BY ALL
  UNION ALL SELECT query_id, i, field, term, count(*)
    FROM (SELECT query_id, i, field, unnest({tokens('value')}) AS term FROM musts) GROUP BY ALL),
clause_scores AS (SELECT query_id, doc_id, clause,
    sum(boost * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) AS s
  FROM clauses JOIN dfs USING (field, term) JOIN fs USING (field) JOIN tf USING (field, term) JOIN dl USING (doc_id, field)
  GROUP BY ALL),
by_terms AS (SELECT query_id, doc_id, sum(s) AS s, count(*) AS nc FROM clause_scores GROUP BY ALL),
bounds AS (SELECT query_id, i, lo1[i] AS field, TRY_CAST(lo2[i] AS DOUBLE) AS lo, CAST('inf' AS DOUBLE) AS hi
    FROM (SELECT *, unnest(range(1, len(lo1) + 1)) AS i FROM parsed)
  UNION ALL SELECT query_id, -i, hi1[i], CAST('-inf' AS DOUBLE), TRY_CAST(hi2[i] AS DOUBLE)
    FROM (SELECT *, unnest(range(1, len(hi1) + 1)) AS i FROM parsed)),
by_ranges AS (SELECT query_id, doc_id, count(*) AS nr FROM bounds JOIN num USING (field)
  WHERE {inside} GROUP BY ALL),
hits AS (SELECT query_id, doc_id, coalesce(t.s, 0) + coalesce(r.nr, 0) AS score
  FROM by_terms t FULL JOIN by_ranges r USING (query_id, doc_id) JOIN sized z USING (query_id)
  WHERE coalesce(t.nc, 0) = z.nc AND coalesce(r.nr, 0) = z.nr AND z.nc + z.nr > 0)"""


def ranked(k: int) -> str:
    return f"""best AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 8) DESC, doc_id) AS INTEGER) AS rank
  FROM hits QUALIFY rank <= {k})"""


def one(request: str) -> str:
    return f"SELECT 0 AS query_id, {quoted(request)} AS q"


NO_NUMBERS = "SELECT NULL AS doc_id, '' AS field, CAST(NULL AS DOUBLE) AS value"
DOC_TEXTS = melted("documents", "doc_id", Q.DOC_FIELDS, "text")
DOC_NUMBERS = melted("labelled", "doc_id", {c: c for c in ["n_chars", "quality", "toxic"]}, "value")


def document_search(requests: str, k: int, columns: str) -> str:
    return f"""WITH labelled AS ({fx.DOCS_SQL}), {with_matches(DOC_TEXTS, DOC_NUMBERS, requests, Q.DOC_WEIGHTS)}, {ranked(k)}
SELECT {columns} FROM best JOIN labelled USING (doc_id)"""


def profile_matches(**options) -> str:
    return f"""{WITH_INFO}, pdocs AS ({DOCUMENTS_SELECT}),
{with_matches(
    melted("pdocs", "filename", {f: c for f, (c, _) in TEXT_FIELDS.items()}, "text"),
    melted("pdocs", "filename", {c: f"CAST({c} AS DOUBLE)" for c in NUMBER_TYPES}, "value"),
    fx.PROFILE_REQUESTS_SQL,
    WEIGHTS,
    **options,
)}"""


PROFILE_MATCHES = profile_matches()


def shown(column: str) -> str:
    if column in NUMBER_TYPES:
        return f"coalesce(CAST({column} AS VARCHAR), 'Not specified') AS {column}"
    return f"coalesce({CLEAN % column}, 'Not specified') AS {column}"


PARSED = r"""SELECT query_id, trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(q, '@(\w+)=(\w+)', '', 'g')),
    '\$(\w+)=(-?\w+(?:\.\d+)?)', '', 'g')), '\^(\w+)=(-?\w+(?:\.\d+)?)', '', 'g')) AS text,
  concat('lang=', replace(regexp_extract_all(q, '@(\w+)=(\w+)', 2)[1], '_', ' '), ';source=',
    replace(regexp_extract_all(q, '@(\w+)=(\w+)', 2)[2], '_', ' ')) AS must,
  {min}, {max} FROM (""" + fx.TEXT_REQUESTS_SQL + ") t"
for _name, _mark in (("min", r"\^"), ("max", r"\$")):
    _pattern = _mark + r"(\w+)=(-?\w+(?:\.\d+)?)"
    PARSED = PARSED.replace(
        "{" + _name + "}",
        f"array_to_string(regexp_extract_all(q, '{_pattern}', 1), ';') AS {_name}s_fields, CAST(len(regexp_extract_all(q, '{_pattern}', 1)) AS INTEGER) AS n_{_name}s, "
        + listed(f"TRY_CAST(regexp_extract_all(q, '{_pattern}', 2)[{i + 1}] AS DOUBLE) AS {_name}s_{i}" for i in range(2)),
    )
EDGES = f"e AS (SELECT title AS source, target FROM ({fx.REDIRECT_SQL}) p WHERE is_redirect)"
AFTER = """s AS (SELECT a.source, CASE WHEN b.target IS NOT NULL THEN b.target ELSE a.source END AS target
  FROM e a LEFT JOIN e b ON a.target = b.source)"""
WITH_DOC_INDEX = f"WITH {with_index(DOC_TEXTS)}"
CLEAN = "regexp_replace(replace(replace(%s, '[', ''), ']', ''), '''''''', '', 'g')"
TRIMMED = r"regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '')"


XML_PAGES = f"""SELECT doc_id AS id, concat('Doc ', doc_id) AS title, {fx.XML_REDIRECT} AS is_redirect,
  CASE WHEN {fx.XML_REDIRECT} THEN concat('Doc ', doc_id + 1, ' & more') END AS target,
  CASE WHEN NOT {fx.XML_NO_TEXT} THEN {TRIMMED} END AS text FROM documents WHERE NOT {fx.XML_BROKEN}"""


def attributes(*columns: str) -> str:
    return f"WITH {WITH_PAGES} SELECT filename, {listed(columns)} FROM attr"


ORACLES = {
    "pages_title": f"SELECT page_id, {TITLE} AS title FROM pages",
    "pages_strip_tags": f"SELECT page_id, {STRIP} AS content FROM pages",
    "pages_path_filter": f"SELECT filename, split_part(filename, ':', 2) AS path FROM ({fx.PAGES_SQL}) p WHERE contains(filename, 'com_drivers')",
    "profile_attributes": attributes("name", *X.VALUE_LABELS),
    "profile_series": attributes("series"),
    "profile_section_stats": attributes(*X.COUNT_LABELS, *X.PERCENTAGE_LABELS),
    "profile_score": attributes(
        "driverdb_score", "coalesce(TRY_CAST(replace(driverdb_score, ',', '') AS INTEGER), 0) AS score"
    ),
    "profile_json_stats": f"""WITH {WITH_PAGES} SELECT filename,
      {listed(f"json_extract_string(j, '$.{k}') AS {c}" for c, k in X.JSON_KEYS.items())} FROM attr""",
    "profile_override": f"WITH {WITH_PAGES} {profile_select()}",
    "profile_override_literal": f"WITH {WITH_PAGES} {profile_select(literal=True)}",
    "keys_distinct": f"WITH {WITH_PROFILES} SELECT DISTINCT series FROM prof WHERE series <> ''",
    "tsv_roundtrip": f"WITH {WITH_PAGES} {profile_select()}",
    "typed_defaults": f"""WITH {WITH_PROFILES} SELECT filename,
      {listed(number(c) for c in NUMBER_TYPES if c in PROFILE_COLUMNS)}, {bad_columns(PROFILE_COLUMNS)} FROM prof""",
    "wiki_from_xml": f"""SELECT doc_id, CASE WHEN NOT {fx.XML_BROKEN} THEN concat('Doc ', doc_id) END AS title,
      CASE WHEN NOT {fx.XML_BROKEN} THEN doc_id END AS page_id, CASE WHEN NOT ({fx.XML_BROKEN} OR {fx.XML_NO_TEXT}) THEN {TRIMMED} END AS text,
      CASE WHEN NOT {fx.XML_BROKEN} THEN CASE WHEN {fx.XML_NO_TEXT} THEN 0 ELSE n_chars END END AS n_bytes FROM documents""",
    "wiki_dump_file": f"SELECT id, title, is_redirect, target, text FROM ({XML_PAGES}) p",
    "articles_project": f"SELECT id, title, title AS article_title, is_redirect, target, text FROM ({XML_PAGES}) p",
    "malformed_count": f"SELECT count(*) AS n_malformed FROM documents WHERE {fx.XML_BROKEN}",
    "pages_files": "SELECT concat('com_drivers_', page_id) AS name, html AS content FROM pages WHERE page_id % 4 <> 0",
    "pages_packed": "SELECT concat('com_drivers_', page_id) AS name, html AS content FROM pages WHERE page_id % 4 <> 0",
    "wiki_lead_line": f"""WITH d AS (SELECT doc_id, concat('Intro', chr(10), {fx.BOLD}, source, {fx.BOLD}, ' ', text) AS text FROM documents)
      SELECT doc_id, {LEAD} AS lead, {group1('text', "('''[^" + chr(92) + "n]*)")} AS lead_or_end FROM d""",
    "wiki_infobox": f"SELECT id, {INFOBOX_COLUMNS} FROM ({fx.WIKI_SQL}) w",
    "wiki_clean": f"SELECT id, {CLEAN % 'text'} AS text FROM ({fx.WIKI_SQL}) w",
    "person_predicate": f"SELECT id, title FROM ({fx.WIKI_SQL}) w WHERE contains(lower(text), 'racing driver')",
    "articles_dedup": "SELECT DISTINCT lang, text FROM documents",
    "redirect_split": f"""SELECT id, CASE WHEN is_redirect THEN 'redirect' ELSE 'article' END AS kind, target
      FROM ({fx.REDIRECT_SQL}) p""",
    "redirect_resolve": f"""WITH RECURSIVE {with_titles(fx.REDIRECT_SQL)}
      SELECT t.title, article_title, article_id, is_cycle, text FROM titles t LEFT JOIN articles a ON a.id = t.article_id""",
    "redirect_recursive": f"WITH RECURSIVE {with_titles(fx.REDIRECT_SQL)} SELECT title, article_title, article_id, is_cycle FROM titles",
    "redirect_resolve_compat": f"""WITH a AS (SELECT title, text FROM ({fx.REDIRECT_SQL}) p WHERE NOT is_redirect), {EDGES}, {AFTER}
      SELECT title, title AS article_title, text FROM a UNION ALL
      SELECT s.source, s.target, a.text FROM s LEFT JOIN a ON a.title = s.target""",
    "redirect_fixpoint": f"""WITH {EDGES}, {AFTER} SELECT (SELECT count(*) FROM e JOIN s USING (source, target)) AS n_same,
      (SELECT count(*) FROM e) AS n_before""",
    "articles_semi": f"""WITH RECURSIVE {WITH_PROFILES}, {with_titles(fx.WIKI_SQL)}
      SELECT id, title, article_id FROM titles WHERE EXISTS (SELECT 1 FROM prof WHERE prof.name = titles.title)""",
    "enrich_series": f"WITH RECURSIVE {WITH_INFO} SELECT filename, series, series_description FROM enriched",
    "enrich_person": f"WITH RECURSIVE {WITH_INFO} SELECT filename, name, {listed(INFOBOX)} FROM enriched",
    "enrich_team": f"WITH RECURSIVE {WITH_INFO} SELECT filename, current_team, team_description FROM enriched",
    "enriched_profile": f"WITH RECURSIVE {WITH_INFO} SELECT {listed(ENRICHED_COLUMNS)} FROM enriched",
    "enriched_tsv": f"""WITH RECURSIVE {WITH_INFO} SELECT {listed(
        "'' AS hometown" if c == "hometown" else f"CASE WHEN {c} = '' THEN '0' ELSE {c} END AS {c}" if c in NUMBER_TYPES else c
        for c in ENRICHED_COLUMNS)} FROM enriched""",
    "index_postings": f"{WITH_DOC_INDEX} SELECT term, field, doc_id, CAST(tf AS INTEGER) AS tf, CAST(dl AS INTEGER) AS length FROM tf JOIN dl USING (doc_id, field)",
    "index_postings_wordbreak": f"""WITH {with_index("SELECT concat('d', doc_id) AS doc_id, 'text' AS field, text FROM documents UNION ALL SELECT concat('p', page_id), 'text', html FROM pages", wordbreak_tokens)}
      SELECT term, field, doc_id, CAST(tf AS INTEGER) AS tf, CAST(dl AS INTEGER) AS length FROM tf JOIN dl USING (doc_id, field)""",
    "index_term_stats": f"{WITH_DOC_INDEX} SELECT term, field, df FROM dfs",
    "index_doc_stats": f"{WITH_DOC_INDEX} SELECT doc_id, field, CAST(dl AS INTEGER) AS length FROM dl",
    "index_field_stats": f"{WITH_DOC_INDEX} SELECT field, n AS n_docs, round(avgdl, 6) AS mean_length FROM fs",
    "index_count": f"WITH {WITH_PROFILES} SELECT count(*) AS n_documents FROM prof",
    "index_documents": f"WITH RECURSIVE {WITH_INFO} {DOCUMENTS_SELECT}",
    "index_build": f"""{WITH_DOC_INDEX} SELECT 'document' AS kind, CAST(doc_id AS VARCHAR) AS key, lang AS field, n_chars AS n FROM documents
      UNION ALL SELECT 'df', term, field, df FROM dfs UNION ALL SELECT 'length', CAST(doc_id AS VARCHAR), field, dl FROM dl""",
    "index_updated": f"""WITH docs AS ({fx.AFTER_UPDATE_SQL}), {with_index(melted("docs", "doc_id", Q.DOC_FIELDS, "text"))}
      SELECT term, field, df AS n, CAST(NULL AS DOUBLE) AS mean_length FROM dfs
      UNION ALL SELECT NULL, field, n, round(avgdl, 6) FROM fs UNION ALL SELECT NULL, '', count(*), NULL FROM docs""",
    "requests_parse": PARSED,
    "search_text": document_search(one(Q.TEXT_REQUEST), 10, "rank, doc_id, round(score, 5) AS score, lang, source, n_chars"),
    "search_weighted": f"""WITH flat AS (SELECT page_id, url, {TITLE} AS title, {STRIP} AS body FROM pages),
      {with_matches(melted("flat", "page_id", Q.PAGE_FIELDS, "text"), NO_NUMBERS, one(Q.PAGE_REQUEST), Q.PAGE_WEIGHTS)}, {ranked(10)}
      SELECT rank, doc_id, round(score, 5) AS score, title, url FROM best JOIN flat ON flat.page_id = best.doc_id""",
    "search_must": document_search(one(Q.MUST_REQUEST), 10, "rank, doc_id, round(score, 5) AS score, lang, source"),
    "search_range": document_search(one(Q.RANGE_REQUEST), 10, "rank, doc_id, round(score, 5) AS score, n_chars, quality"),
    "search_batch": document_search(fx.DOC_REQUESTS_SQL, 3, "query_id, rank, doc_id, round(score, 5) AS score, n_chars"),
    "search_every_hundredth": document_search(fx.HUNDREDTH_REQUESTS_SQL, 5, "query_id, rank, doc_id, round(score, 5) AS score, lang"),
    "search_ranges_batch": f"""WITH labelled AS ({fx.DOCS_SQL}), {with_matches(DOC_TEXTS, DOC_NUMBERS, fx.RANGE_REQUESTS_SQL, Q.DOC_WEIGHTS)}
      SELECT query_id, doc_id, round(score, 5) AS score FROM hits""",
    "search_updated": f"""WITH docs AS ({fx.AFTER_UPDATE_SQL}), {with_matches(melted("docs", "doc_id", Q.DOC_FIELDS, "text"),
      melted("docs", "doc_id", {"n_chars": "n_chars"}, "value"), fx.DOC_REQUESTS_SQL, Q.DOC_WEIGHTS)}, {ranked(3)}
      SELECT query_id, rank, doc_id, round(score, 5) AS score, n_chars FROM best JOIN docs USING (doc_id)""",
    "search_profiles": f"""WITH RECURSIVE {PROFILE_MATCHES}, {ranked(10)} SELECT query_id, rank, doc_id, round(score, 5) AS score,
      name, series, current_team, wins, podium_percentage FROM best JOIN pdocs ON pdocs.filename = best.doc_id""",
    "search_all_matches": f"""WITH labelled AS ({fx.DOCS_SQL}), {with_matches(DOC_TEXTS, DOC_NUMBERS, fx.DOC_REQUESTS_SQL, Q.DOC_WEIGHTS)}
      SELECT query_id, doc_id, round(score, 5) AS score FROM hits""",
    "search_wordbreak": f"""WITH {with_matches(DOC_TEXTS, melted("documents", "doc_id", {"n_chars": "n_chars"}, "value"), one(Q.WORDBREAK_REQUEST), Q.DOC_WEIGHTS, wordbreak_tokens)}, {ranked(10)}
      SELECT rank, doc_id, round(score, 5) AS score, lang, source FROM best JOIN documents USING (doc_id)""",
    "search_word_bounds": f"WITH RECURSIVE {profile_matches(word_bounds=True)} SELECT query_id, doc_id, round(score, 5) AS score FROM hits",
    "search_positive_percentages": f"WITH RECURSIVE {profile_matches(positive=True)} SELECT query_id, doc_id, round(score, 5) AS score FROM hits",
    "profile_hits_display": f"""WITH RECURSIVE {PROFILE_MATCHES}, {ranked(10)} SELECT query_id, rank,
      {listed(map(shown, ["name", "series", "nationality", "hometown", "age", "wins", "podium_percentage", "current_team"]))}
      FROM best JOIN pdocs ON pdocs.filename = best.doc_id""",
    "search_total_hits": f"""WITH RECURSIVE {PROFILE_MATCHES} SELECT req.query_id, count(hits.doc_id) AS n_hits
      FROM req LEFT JOIN hits ON hits.query_id = req.query_id GROUP BY req.query_id""",
    "hits_display": f"""SELECT event_id, strftime(ts, '%d.%m.%Y') AS ts, {CLEAN % 'event_type'} AS event_type,
      CAST(user_id AS VARCHAR) AS user_id, {CLEAN % "concat_ws(', ', event_type, props)"} AS parts,
      coalesce(CAST(quality AS VARCHAR), 'Not specified') AS quality
      FROM events LEFT JOIN labels ON events.event_id = labels.doc_id""",
}
