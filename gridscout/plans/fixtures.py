"""Inputs of the registered queries, derived from the given tables.

The expressions are plain SQL that Spark and DuckDB both read, so a query and its check start from
the same pages. Every row of the tables named is used.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TASK_CUSTOMERS = 5_000  # whose pages and articles one task makes

NL = "chr(10)"
BOLD = "chr(39), chr(39), chr(39)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The SQL text over the Parquet files of `sf_dir`. Customers are dealt to tasks by number: a row group of a few
    bytes a customer grows to as many pages and articles, too many for the one task that its bytes would get."""
    sql = re.sub(r"\b(FROM|JOIN) (nation|documents|labels)\b", rf"\1 parquet.`{sf_dir}/\2.parquet` \2", sql)
    if not re.search(r"\bFROM customer\b", sql):
        return spark.sql(sql)
    tasks = -(-table(spark, sf_dir, "customer").count() // TASK_CUSTOMERS) or 1
    dealt = f"(SELECT /*+ REPARTITION({tasks}) */ * FROM parquet.`{sf_dir}/customer.parquet`) customer"
    return spark.sql(re.sub(r"\bFROM customer\b", lambda _: f"FROM {dealt}", sql))


def _labelled(label: str, value: str) -> str:
    return f"'<div>{label}</div>', {NL}, '  <div>', {value}, '</div>', {NL}"


def _percent(label: str, value: str) -> str:
    return f"'<div>{label}</div><div>', {value}, '.5<!-- -->%</div>', {NL}"


K = "c_custkey"
NL_OR_BLANK = f"CASE WHEN {K} % 3 = 0 THEN 10 ELSE 32 END"
COUNTRY = "replace(n_name, '_', ' ')"
STATS_JSON = f"""CASE
  WHEN c_mktsegment <> 'BUILDING' THEN '{{}}'
  WHEN {K} % 7 = 1 THEN '{{bad'
  WHEN {K} % 7 = 2 THEN concat('{{"races":', {K} % 300, ',"wins":null,"score":"1,5"}}')
  ELSE concat('{{"races":', {K} % 300, ',"racesEntered":', {K} % 300 + 2, ',"wins":', {K} % 9,
    ',"podiums":', {K} % 21, ',"polePositions":', {K} % 5, ',"fastestLaps":null,"racewinpercentage":',
    {K} % 90, '.25,"podiumpercentage":', {K} % 80, ',"score":', 100 + {K} % 900, '}}') END"""
SECTION = f"""CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE concat(
  '<h2 class="h">Driver Stats</h2>', {NL},
  {_labelled('races started', f'{K} % 300')}, {_labelled('races entered', f'{K} % 300 + 1')},
  {_labelled('wins', f'{K} % 7')}, {_labelled('podiums', f'{K} % 20')},
  {_labelled('pole positions', f'{K} % 6')}, {_labelled('fastest laps', f'{K} % 8')},
  {_percent('race win percentage', f'{K} % 100')}, {_percent('podium percentage', f'{K} % 95')}) END"""

# Texts that a table file must not lose: line ends, tabs, quotes, backslashes, outer blanks.
HOMETOWN = f"""concat(CASE {K} % 8 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN chr(34) ELSE 'Port' END, chr({NL_OR_BLANK}), {COUNTRY},
  CASE {K} % 7 WHEN 0 THEN chr(92) WHEN 1 THEN concat(chr(92), 'n') WHEN 2 THEN concat(chr(9), 'x ') WHEN 3 THEN concat(chr(13), 'y') WHEN 4 THEN chr(34) ELSE '' END)"""

# (k, filename, content): a crawled page per customer; overdrawn accounts are team pages.
PAGES_SQL = f"""SELECT {K} AS k,
  concat('file:/crawl/com_', CASE WHEN c_acctbal < 0 THEN 'teams' ELSE 'drivers' END, '_', {K}, '.html') AS filename,
  concat('<html><head><title>Driver: ', c_name, ' | Driver Database</title></head><body>', {NL},
    '<script>var page={{"stats":', {STATS_JSON}, ',"careerOverview":[]}};</script>', {NL},
    {_labelled('nationality', f"concat(CASE WHEN {K} % 5 = 2 THEN '  ' ELSE '' END, {COUNTRY}, CASE WHEN {K} % 5 < 2 THEN ' ' ELSE '' END)")}, {_labelled('age', f'{K} % 60')},
    {_labelled('birthday', f"concat(1 + {K} % 28, ' May ', 1950 + {K} % 50)")},
    {_labelled('hometown', HOMETOWN)},
    '<div><div>series</div>', {NL}, '</div>', {NL}, '<div class="badge big">', c_mktsegment, '</div>', {NL}, '</div>', {NL},
    {SECTION}, '<div>driverdb score</div>', {NL}, '<div>1,', 100 + {K} % 900, '</div>', {NL},
    '<p>', c_name, ' has a balance of ', CAST(round(c_acctbal) AS bigint), ' and drives for ', n_name, '.</p></body></html>') AS content
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

# (id, title, is_redirect, target, text): persons, series and teams, some behind a redirect.
_PERSON_TEXT = f"""concat('{{{{Infobox', {NL}, '| team = [[', n_name, '|x]]', {NL}, '| teams = ', n_name, ', Other', {NL},
  '| car_number = ', {K} % 99, {NL}, '| championships = ', {K} % 5, {NL}, '}}}}', {NL}, {BOLD}, c_name, {BOLD},
  CASE WHEN {K} % 2 = 0 THEN ' is a Racing Driver.' ELSE ' is a cook.' END, {NL}, 'More.')"""
_MOVED = f"{K} % 10 = 4"
WIKI_SQL = f"""SELECT {K} * 10 + 1 AS id, c_name AS title, {_MOVED} AS is_redirect,
    CASE WHEN {_MOVED} THEN concat(c_name, ' (racer)') END AS target,
    CASE WHEN {_MOVED} THEN '#REDIRECT' ELSE {_PERSON_TEXT} END AS text
  FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT {K} * 10 + 2, concat(c_name, CASE WHEN {_MOVED} THEN ' (racer)' ELSE ' (talk)' END), false, NULL, {_PERSON_TEXT}
  FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT min({K}) * 10 + 3, c_mktsegment, false, NULL, concat({BOLD}, c_mktsegment, {BOLD}, ' is a series.', {NL}, 'It has ', count(*), ' entries.')
  FROM customer GROUP BY c_mktsegment
UNION ALL
SELECT n_nationkey * 10 + 4, n_name, n_regionkey = 0, CASE WHEN n_regionkey = 0 THEN concat('Team ', n_name) END,
    CASE WHEN n_regionkey = 0 THEN '#REDIRECT' ELSE concat({BOLD}, n_name, {BOLD}, ' is a team.', {NL}, 'End.') END
  FROM nation
UNION ALL
SELECT n_nationkey * 10 + 5, concat('Team ', n_name), false, NULL, concat('See also.', {NL}, {BOLD}, 'Team ', n_name, {BOLD}, ' races.', {NL}, 'End.')
  FROM nation"""

# (doc_id, xml): a dump record per document. Some are broken, redirect, have two revisions or no text.
XML_BROKEN, XML_REDIRECT, XML_TWICE, XML_NO_TEXT = "doc_id % 17 = 3", "doc_id % 9 = 4", "doc_id % 6 = 1", "doc_id % 13 = 5"
XML_SQL = f"""SELECT doc_id, CASE WHEN {XML_BROKEN} THEN concat('<page><title>Doc ', doc_id, '<id>', doc_id, '</page>')
  ELSE concat('<page><title>Doc ', doc_id, '</title><id>', doc_id, '</id>',
    CASE WHEN {XML_REDIRECT} THEN concat('<redirect title="Doc ', doc_id + 1, ' &amp; more" />') ELSE '' END,
    CASE WHEN {XML_NO_TEXT} THEN '<revision><id>1</id><text bytes="0" /></revision>' ELSE concat('<revision><id>1</id><text bytes="', n_chars, '">',
      replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '</text></revision>') END,
    CASE WHEN {XML_TWICE} THEN '<revision><id>2</id><text bytes="9">not first</text></revision>' ELSE '' END, '</page>') END AS xml
FROM documents """

# (id, title, is_redirect, target, text): documents as pages; chains of several lengths, and cycles.
_STEP = """CASE WHEN doc_id % 50 = 7 THEN 1 WHEN doc_id % 50 = 8 THEN -1
  WHEN doc_id % 40 BETWEEN 20 AND 26 THEN 1 WHEN doc_id % 5 = 0 THEN 1 WHEN doc_id % 15 = 6 THEN 1 END"""
REDIRECT_SQL = f"""SELECT doc_id AS id, concat('Doc ', doc_id) AS title, step IS NOT NULL AS is_redirect,
  CASE WHEN step IS NOT NULL THEN concat('Doc ', doc_id + step) END AS target, text
FROM (SELECT doc_id, text, {_STEP} AS step FROM documents ) d"""

# (doc_id, lang, source, n_chars, quality, toxic, text)
DOCS_SQL = """SELECT documents.doc_id, lang, source, n_chars, quality, toxic, text
FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id"""

# (query_id, q): a request per language and source of the documents.
DOC_REQUESTS_SQL = """SELECT concat(lang, '-', source) AS query_id,
  concat('the inion de letre @lang=', lang, ' @source=', source, '_src1 ^n_chars=500 $n_chars=', 2 * min(n_chars) + 3000) AS q
FROM documents GROUP BY lang, source"""

# (query_id, q): a request per nation against the enriched profiles, in all shapes.
PROFILE_REQUESTS_SQL = """SELECT n_nationkey AS query_id, CASE n_nationkey % 7
  WHEN 0 THEN concat('racing driver ', n_name, ' driver')
  WHEN 1 THEN concat('more drives @nationality=', n_name)
  WHEN 2 THEN concat('^wins=', n_nationkey % 5, ' $wins=5 ^age=18')
  WHEN 3 THEN concat('is a @series=HOUSEHOLD ^races_started=20.5 $podium_percentage=50 @hometown=', n_nationkey)
  WHEN 4 THEN concat('racing @nofield=x ', n_name)
  WHEN 5 THEN concat('^nofield=1 racing ^wins=-3 ', n_name)
  ELSE '' END AS q
FROM nation """

# (query_id, q): the first line of every hundredth document, as a request.
HUNDREDTH_REQUESTS_SQL = """SELECT doc_id AS query_id, translate(split_part(coalesce(text, ''), chr(10), 1), '@^$=', '    ') AS q
FROM documents WHERE doc_id % 100 = 0"""

# (query_id, q): a request per language and source with ranges over three fields, with and without a word.
RANGE_REQUESTS_SQL = """SELECT concat(lang, '-', source) AS query_id, concat(CASE WHEN length(source) % 2 = 0 THEN 'the ' ELSE '' END,
  '^n_chars=', min(n_chars), ' $n_chars=', 2 * min(n_chars) + 1500, ' ^quality=1 $toxic=0') AS q
FROM documents GROUP BY lang, source"""

# The documents before and after an update that adds, replaces and removes some, and what it consists of.
_UPDATED_TEXT = "CASE WHEN doc_id % 20 = 2 THEN concat(source, ' estion ', text) ELSE text END AS text"
BEFORE_UPDATE_SQL = "SELECT doc_id, text, lang, source, n_chars FROM documents WHERE doc_id % 20 <> 1"
ADDED_SQL = f"SELECT doc_id, {_UPDATED_TEXT}, lang, source, n_chars FROM documents WHERE doc_id % 20 IN (1, 2)"
REMOVED_SQL = "SELECT doc_id FROM documents WHERE doc_id % 20 = 3"
AFTER_UPDATE_SQL = f"SELECT doc_id, {_UPDATED_TEXT}, lang, source, n_chars FROM documents WHERE doc_id % 20 <> 3"

# (query_id, q): a request per document, to be taken apart.
TEXT_REQUESTS_SQL = """SELECT doc_id AS query_id, concat(' ', source, ' word @lang=', lang, ' ^n_chars=', n_chars, '.5 and $n_chars=',
  n_chars * 2, ' @source=', source, '_', lang, CASE WHEN doc_id % 3 = 0 THEN ' ^x=-4 $y=abc' ELSE '' END) AS q
FROM documents """


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, PAGES_SQL)


def wiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, WIKI_SQL)


def xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, XML_SQL)


def redirect_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, REDIRECT_SQL)


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, DOCS_SQL)


def document_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, DOC_REQUESTS_SQL)


def profile_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, PROFILE_REQUESTS_SQL)


def text_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, TEXT_REQUESTS_SQL)


def hundredth_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, HUNDREDTH_REQUESTS_SQL)


def range_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, RANGE_REQUESTS_SQL)
