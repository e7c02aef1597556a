"""The registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscout.functions import extract as X
from gridscout.functions.text import clean_wiki, display, path_of_uri, strip_tags
from gridscout.functions.tokens import TOKEN_SIMPLE, TOKEN_WORDBREAK
from gridscout.functions.typed import to_int
from gridscout.operators import enrich as E
from gridscout.operators import index as I
from gridscout.operators import profiles as P
from gridscout.operators import redirects as R
from gridscout.operators import search as S
from gridscout.operators.requests import parse_requests
from gridscout.pipeline import write_profile_index
from gridscout.plans import fixtures as fx
from gridscout.schemas import (
    DOUBLE_COLUMNS,
    ENRICHED_COLUMNS,
    ENRICHED_SCHEMA,
    INT_COLUMNS,
    PROFILE_COLUMNS,
    PROFILE_SCHEMA,
    WEIGHTS,
)
from gridscout.sources import wiki
from gridscout.sources.pages import PAGE_END, pack_pages, read_packed, read_pages, write_pages
from gridscout.sources.tables import (
    materialize,
    path_exists,
    read_tsv,
    with_columns_or,
    work_dir,
    write_tsv,
)
from gridscout.sources.wiki import pages_from_xml_column, read_wiki_xml, wiki_pages

TASK_FILES = 200  # page files that one task writes

# Weights and requests of the searches over pages and documents.
PAGE_FIELDS = {"title": "title", "body": "body"}
PAGE_WEIGHTS = {"title": 3.0, "body": 1.0}
DOC_FIELDS = {"text": "text", "lang": "lang", "source": "source"}
DOC_WEIGHTS = {"text": 1.0, "source": 3.0}
PAGE_REQUEST = "the attion de onaiaux the"
TEXT_REQUEST = "the estion letre eau inion"
MUST_REQUEST = "estion letre @lang=en @source=src1_src7_src9"
WORDBREAK_REQUEST = "the estion eau inion $n_chars=6000"
RANGE_REQUEST = "the estion ^n_chars=800 $n_chars=4000 ^quality=1"


def _shared(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where this application keeps the table `name` derived from `sf_dir`."""
    key = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    return f"{work_dir(spark)}/gridscout-{spark.sparkContext.applicationId}/{key}/{name}"


# ---- pages and profiles


def pages_title(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select(
        "page_id", X.capture(F.col("html"), r"<title>([^<]*)</title>").alias("title")
    )


def pages_strip_tags(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select("page_id", strip_tags(F.col("html")).alias("content"))


def pages_path_filter(spark, sf_dir):
    return (
        fx.pages(spark, sf_dir)
        .where(F.col("filename").contains(X.PATH_MARK))
        .select("filename", path_of_uri(F.col("filename")).alias("path"))
    )


def _attributes(*columns):
    def query(spark, sf_dir):
        return P.page_attributes(fx.pages(spark, sf_dir)).select("filename", *columns)

    return query


def profile_score(spark, sf_dir):
    found = P.page_attributes(fx.pages(spark, sf_dir)).select("filename", "driverdb_score")
    return found.withColumn(
        "score", to_int(F.replace(F.col("driverdb_score"), F.lit(","), F.lit("")))
    )


def profile_json_stats(spark, sf_dir):
    parsed = P.with_json(fx.pages(spark, sf_dir))
    return parsed.select(
        "filename",
        *[F.try_element_at("_json", F.lit(key)).alias(c) for c, key in X.JSON_KEYS.items()],
    )


def profile_override(spark, sf_dir):
    return P.extract_profiles(fx.pages(spark, sf_dir))


def profile_override_literal(spark, sf_dir):
    return P.extract_profiles(fx.pages(spark, sf_dir), literal_missing=True)


def _profiles(spark, sf_dir):
    return materialize(
        spark, _shared(spark, sf_dir, "profiles"), lambda: P.extract_profiles(fx.pages(spark, sf_dir))
    )


def keys_distinct(spark, sf_dir):
    return E.distinct_keys(_profiles(spark, sf_dir), "series")


def tsv_roundtrip(spark, sf_dir):
    path = _shared(spark, sf_dir, "profiles-tsv")
    write_tsv(_profiles(spark, sf_dir), path)
    return read_tsv(spark, path, PROFILE_SCHEMA, defaults="")


def typed_defaults(spark, sf_dir):
    typed = P.typed_profiles(_profiles(spark, sf_dir))
    numbers = [c for c in INT_COLUMNS + DOUBLE_COLUMNS if c in PROFILE_COLUMNS]
    return typed.select("filename", *numbers, F.concat_ws(",", "bad_columns").alias("bad_columns"))


# ---- wiki articles


def _nested(spark, sf_dir):
    return pages_from_xml_column(fx.xml_records(spark, sf_dir), "xml", keep=["doc_id"])


def wiki_from_xml(spark, sf_dir):
    return _nested(spark, sf_dir).select(
        "doc_id",
        "title",
        F.col("id").alias("page_id"),
        F.get(F.col("revision.text._VALUE"), F.lit(0)).alias("text"),
        F.get(F.col("revision.text._bytes"), F.lit(0)).alias("n_bytes"),
    )


def articles_project(spark, sf_dir):
    return wiki_pages(_nested(spark, sf_dir)).select(
        "id", "title", F.col("title").alias("article_title"), "is_redirect", "target", "text"
    )


def wiki_dump_file(spark, sf_dir):
    """The same records written as a dump and read back from its files."""
    path = _shared(spark, sf_dir, "dump")
    fx.xml_records(spark, sf_dir).select("xml").write.mode("overwrite").text(path)
    return wiki_pages(read_wiki_xml(spark, path))


def malformed_count(spark, sf_dir):
    return wiki.malformed_count(_nested(spark, sf_dir))


def _page_files(spark, sf_dir):
    """The folder with a file for every page."""
    folder = _shared(spark, sf_dir, "page-files")
    html = fx.table(spark, sf_dir, "pages").select(
        F.col("html"), F.concat(F.when(F.col("page_id") % 4 == 0, "teams").otherwise("com_drivers"), F.lit("_"), F.col("page_id")).alias("name")
    )
    if not path_exists(spark, f"{folder}/_SUCCESS"):
        write_pages(html, folder, -(-html.count() // TASK_FILES) or 1)  # a file costs the same however small it is, so tasks are not joined by their bytes
    return folder


def _named(read):
    return read.select(
        F.regexp_extract("filename", r"name=([^/]*)/", 1).alias("name"), F.rtrim(F.col("content"), F.lit(PAGE_END)).alias("content")
    )


def pages_files(spark, sf_dir):
    """Every page written as a file of its own and read back by path."""
    return _named(read_pages(spark, _page_files(spark, sf_dir), X.PATH_MARK))


def pages_packed(spark, sf_dir):
    """The same files packed into an archive, which is read."""
    folder, archive = _page_files(spark, sf_dir), _shared(spark, sf_dir, "page-archive")
    pack_pages(spark, folder, archive)
    return _named(read_packed(spark, archive, X.PATH_MARK))


def wiki_lead_line(spark, sf_dir):
    marked = F.concat(F.lit("Intro\n'''"), F.col("source"), F.lit("''' "), F.col("text"))
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id",
        X.lead_line(marked).alias("lead"),
        X.lead_line(marked, allow_eof=True).alias("lead_or_end"),
    )


def wiki_infobox(spark, sf_dir):
    return fx.wiki(spark, sf_dir).select("id", *[e.alias(c) for c, e in E.person_extracts().items()])


def wiki_clean(spark, sf_dir):
    return fx.wiki(spark, sf_dir).select("id", clean_wiki(F.col("text")).alias("text"))


def person_predicate(spark, sf_dir):
    return fx.wiki(spark, sf_dir).where(F.col("text").rlike(X.PERSON_MARK)).select("id", "title")


def articles_dedup(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("lang", "text").dropDuplicates()


# ---- redirects


def redirect_split(spark, sf_dir):
    pages = fx.redirect_pages(spark, sf_dir)
    edges = R.redirect_edges(pages).select("id", F.lit("redirect").alias("kind"), "target")
    real = R.real_articles(pages).select(
        "id", F.lit("article").alias("kind"), F.lit(None).cast("string").alias("target")
    )
    return edges.unionByName(real)


def redirect_resolve(spark, sf_dir):
    pages = fx.redirect_pages(spark, sf_dir)
    resolved = R.article_texts(R.title_map(pages), pages)
    goal = F.when(~F.col("is_cycle"), F.col("article_title"))
    return resolved.select("title", goal.alias("article_title"), "article_id", "is_cycle", "text")


def redirect_recursive(spark, sf_dir):
    """The same titles by a recursive query."""
    pages = fx.redirect_pages(spark, sf_dir)
    titles = R.title_map(pages, follow=R.follow_edges_recursive)
    return titles.select("title", F.when(~F.col("is_cycle"), F.col("article_title")).alias("article_title"), "article_id", "is_cycle")


def redirect_resolve_compat(spark, sf_dir):
    return R.one_pass_titles(fx.redirect_pages(spark, sf_dir))


def redirect_fixpoint(spark, sf_dir):
    edges = R.redirect_edges(fx.redirect_pages(spark, sf_dir)).select("source", "target")
    return R.unchanged_count(edges, R.step_or_source(edges))


# ---- enrichment


def _wiki(spark, sf_dir):
    return materialize(spark, _shared(spark, sf_dir, "wiki"), lambda: fx.wiki(spark, sf_dir))


def _titles(spark, sf_dir):
    return materialize(
        spark, _shared(spark, sf_dir, "titles"), lambda: R.title_map(_wiki(spark, sf_dir))
    )


def _info(spark, sf_dir, key, extracts, predicate=None):
    keys = E.distinct_keys(_profiles(spark, sf_dir), key)
    return E.article_info(_titles(spark, sf_dir), _wiki(spark, sf_dir), keys, extracts, predicate)


def articles_semi(spark, sf_dir):
    keys = E.distinct_keys(_profiles(spark, sf_dir), "name").toDF("title")
    return _titles(spark, sf_dir).join(keys, "title", "left_semi").select("id", "title", "article_id")


def enrich_series(spark, sf_dir):
    info = _info(spark, sf_dir, "series", {"series_description": X.lead_line(F.col("text"))})
    return E.add_info(
        _profiles(spark, sf_dir).select("filename", "series"), info, "series", ["filename"]
    )


def _person_info(spark, sf_dir):
    return _info(
        spark, sf_dir, "name", E.person_extracts(), F.col("text").rlike(X.PERSON_MARK)
    )


def enrich_person(spark, sf_dir):
    return E.add_info(
        _profiles(spark, sf_dir).select("filename", "name"),
        _person_info(spark, sf_dir),
        "name",
        ["filename"],
    )


def enrich_team(spark, sf_dir):
    persons = enrich_person(spark, sf_dir).select("filename", "current_team")
    info = E.article_info(
        _titles(spark, sf_dir),
        _wiki(spark, sf_dir),
        E.distinct_keys(persons, "current_team"),
        {"team_description": X.lead_line(F.col("text"))},
    )
    return E.add_info(persons, info, "current_team", ["filename"])


def enriched_profile(spark, sf_dir):
    return E.enrich_profiles(_profiles(spark, sf_dir), _titles(spark, sf_dir), _wiki(spark, sf_dir))


def _enriched(spark, sf_dir):
    return materialize(
        spark, _shared(spark, sf_dir, "enriched"), lambda: enriched_profile(spark, sf_dir)
    )


def enriched_tsv(spark, sf_dir):
    path = _shared(spark, sf_dir, "enriched-tsv")
    write_tsv(_enriched(spark, sf_dir), path)
    numbers = INT_COLUMNS + DOUBLE_COLUMNS
    defaults = {c: "0" if c in numbers else "" for c in ENRICHED_COLUMNS}
    return with_columns_or(read_tsv(spark, path, ENRICHED_SCHEMA).drop("hometown"), defaults)


# ---- index


def _document_index(spark, sf_dir) -> I.Index:
    path = _shared(spark, sf_dir, "document-index")
    if not I.index_exists(spark, path):
        docs = fx.labelled_documents(spark, sf_dir)
        I.write_index(
            docs, path, "doc_id", DOC_FIELDS, ["n_chars", "quality", "toxic"], ["lang", "source"]
        )
    return I.read_index(spark, path)


def _page_index(spark, sf_dir) -> I.Index:
    path = _shared(spark, sf_dir, "page-index")
    if not I.index_exists(spark, path):
        html = F.col("html")
        docs = fx.table(spark, sf_dir, "pages").select(
            "page_id",
            "url",
            X.capture(html, r"<title>([^<]*)</title>").alias("title"),
            strip_tags(html).alias("body"),
        )
        I.write_index(docs, path, "page_id", PAGE_FIELDS, [], ["title", "url"])
    return I.read_index(spark, path)


def _profile_index(spark, sf_dir) -> I.Index:
    path = _shared(spark, sf_dir, "profile-index")
    if not I.index_exists(spark, path):
        write_profile_index(_enriched(spark, sf_dir), fx.pages(spark, sf_dir), path, TOKEN_SIMPLE)
    return I.read_index(spark, path)


def _wordbreak_index(spark, sf_dir) -> I.Index:
    """Documents by the tokens that the pipeline takes unless told otherwise."""
    path = _shared(spark, sf_dir, "wordbreak-index")
    if not I.index_exists(spark, path):
        I.write_index(fx.table(spark, sf_dir, "documents"), path, "doc_id", DOC_FIELDS, ["n_chars"], ["lang", "source"], TOKEN_WORDBREAK)
    return I.read_index(spark, path)


def index_postings_wordbreak(spark, sf_dir):
    """Of the documents' texts and the raw html of the pages."""
    docs = fx.table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    pages = fx.table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), F.col("html").alias("text"))
    return I.postings(I.field_terms(docs.unionByName(pages), "id", {"text": "text"}, TOKEN_WORDBREAK))


def _document_terms(spark, sf_dir):
    return I.field_terms(fx.table(spark, sf_dir, "documents"), "doc_id", DOC_FIELDS)


def index_postings(spark, sf_dir):
    return I.postings(_document_terms(spark, sf_dir))


def index_term_stats(spark, sf_dir):
    return I.term_stats(I.postings(_document_terms(spark, sf_dir))).select("term", "field", "df")


def index_doc_stats(spark, sf_dir):
    return I.doc_stats(_document_terms(spark, sf_dir))


def index_field_stats(spark, sf_dir):
    stats = I.field_stats(_document_terms(spark, sf_dir))
    return stats.withColumn("mean_length", F.round("mean_length", 6))


def index_count(spark, sf_dir):
    return _profile_index(spark, sf_dir).docs.agg(F.count(F.lit(1)).alias("n_documents"))


def index_documents(spark, sf_dir):
    return P.profile_documents(_enriched(spark, sf_dir), fx.pages(spark, sf_dir)).withColumn(
        "bad_columns", F.concat_ws(",", "bad_columns")
    )


def index_build(spark, sf_dir):
    """Write the document index anew; its documents, document frequencies and field lengths."""
    path = _shared(spark, sf_dir, "document-index-build")
    I.write_index(fx.labelled_documents(spark, sf_dir), path, "doc_id", DOC_FIELDS, ["n_chars"], ["lang"])
    built = I.read_index(spark, path)
    key = F.col("doc_id").cast("string").alias("key")
    docs = built.docs.select(F.lit("document").alias("kind"), key, F.col("lang").alias("field"), F.col("n_chars").alias("n"))
    terms = built.term_stats.select(F.lit("df"), "term", "field", "df")
    lengths = built.postings.select(F.lit("length"), key, "field", F.col("length").cast("long")).distinct()
    return docs.union(terms).union(lengths)


def _updated_index(spark, sf_dir) -> I.Index:
    """An index of most documents, and an update that adds, replaces and removes some."""
    path = _shared(spark, sf_dir, "updated-index")
    if not I.index_exists(spark, path):
        I.write_index(fx.run(spark, sf_dir, fx.BEFORE_UPDATE_SQL), path, "doc_id", DOC_FIELDS, ["n_chars"], ["lang", "source"])
    if len(I.read_index(spark, path).segments) == 1:
        I.update_index(spark, path, fx.run(spark, sf_dir, fx.ADDED_SQL), fx.run(spark, sf_dir, fx.REMOVED_SQL))
    return I.read_index(spark, path)


def index_updated(spark, sf_dir):
    """Document frequencies, statistics of the fields, and number of documents after the update."""
    index = _updated_index(spark, sf_dir)
    fields = index.field_stats.select(F.lit(None).cast("string").alias("term"), "field", F.col("n_docs").alias("n"), F.round("mean_length", 6).alias("mean_length"))
    terms = index.term_stats.select("term", "field", F.col("df").alias("n"), F.lit(None).cast("double").alias("mean_length"))
    n_docs = index.docs.agg(F.lit(None).cast("string").alias("term"), F.lit("").alias("field"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("mean_length"))
    return terms.unionByName(fields).unionByName(n_docs)


def search_updated(spark, sf_dir):
    hits = S.search(_updated_index(spark, sf_dir), fx.document_requests(spark, sf_dir), DOC_WEIGHTS, k=3)
    return _rounded(hits).select("query_id", "rank", "doc_id", "score", "n_chars")


# ---- search


def requests_parse(spark, sf_dir):
    parsed = parse_requests(fx.text_requests(spark, sf_dir))
    named = lambda c, v: F.array_join(
        F.transform(c, lambda m: F.concat(m["field"], F.lit("="), F.coalesce(m[v].cast("string"), F.lit("?")))), ";"
    )
    return parsed.select(
        "query_id",
        "text",
        named("must", "value").alias("must"),
        *[column for c in ("mins", "maxs") for column in _bounds(c)],
    )


def _bounds(c: str):
    """All fields of a list of bounds, and all bounds by their place."""
    yield F.array_join(F.transform(c, lambda m: m["field"]), ";").alias(f"{c}_fields")
    for i in range(2):
        yield F.get(c, F.lit(i))["bound"].alias(f"{c}_{i}")
    yield F.size(c).alias(f"n_{c}")


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 5))


def search_text(spark, sf_dir):
    hits = S.search_one(_document_index(spark, sf_dir), TEXT_REQUEST, DOC_WEIGHTS)
    return _rounded(hits).select("rank", "doc_id", "score", "lang", "source", "n_chars")


def search_weighted(spark, sf_dir):
    hits = S.search_one(_page_index(spark, sf_dir), PAGE_REQUEST, PAGE_WEIGHTS)
    return _rounded(hits).select("rank", "doc_id", "score", "title", "url")


def search_must(spark, sf_dir):
    hits = S.search_one(_document_index(spark, sf_dir), MUST_REQUEST, DOC_WEIGHTS)
    return _rounded(hits).select("rank", "doc_id", "score", "lang", "source")


def search_range(spark, sf_dir):
    hits = S.search_one(_document_index(spark, sf_dir), RANGE_REQUEST, DOC_WEIGHTS)
    return _rounded(hits).select("rank", "doc_id", "score", "n_chars", "quality")


def search_batch(spark, sf_dir):
    hits = S.search(
        _document_index(spark, sf_dir), fx.document_requests(spark, sf_dir), DOC_WEIGHTS, k=3
    )
    return _rounded(hits).select("query_id", "rank", "doc_id", "score", "n_chars")


def search_every_hundredth(spark, sf_dir):
    """Every hundredth document's first line against all documents, as a large table of requests."""
    hits = S.search(_document_index(spark, sf_dir), fx.hundredth_requests(spark, sf_dir), DOC_WEIGHTS, k=5, large=True)
    return _rounded(hits).select("query_id", "rank", "doc_id", "score", "lang")


def search_ranges_batch(spark, sf_dir):
    hits = S.matches(_document_index(spark, sf_dir), fx.range_requests(spark, sf_dir), DOC_WEIGHTS)
    return _rounded(hits).select("query_id", "doc_id", "score")


def search_profiles(spark, sf_dir):
    hits = S.search(_profile_index(spark, sf_dir), fx.profile_requests(spark, sf_dir), WEIGHTS)
    return _rounded(hits).select(
        "query_id", "rank", "doc_id", "score", "name", "series", "current_team", "wins", "podium_percentage"
    )


def search_all_matches(spark, sf_dir):
    hits = S.matches(_document_index(spark, sf_dir), fx.document_requests(spark, sf_dir), DOC_WEIGHTS)
    return _rounded(hits).select("query_id", "doc_id", "score")


def search_wordbreak(spark, sf_dir):
    hits = S.search_one(_wordbreak_index(spark, sf_dir), WORDBREAK_REQUEST, DOC_WEIGHTS)
    return _rounded(hits).select("rank", "doc_id", "score", "lang", "source")


def search_word_bounds(spark, sf_dir):
    """Bounds read as one run of word characters: ^races_started=20.5 is 20 and the word 5."""
    hits = S.matches(_profile_index(spark, sf_dir), fx.profile_requests(spark, sf_dir), WEIGHTS, word_bounds=True)
    return _rounded(hits)


def search_positive_percentages(spark, sf_dir):
    hits = S.matches(_profile_index(spark, sf_dir), fx.profile_requests(spark, sf_dir), WEIGHTS, positive_percentages=True)
    return _rounded(hits)


def profile_hits_display(spark, sf_dir):
    """The hits of the profile search as they are shown."""
    hits = S.search(_profile_index(spark, sf_dir), fx.profile_requests(spark, sf_dir), WEIGHTS)
    shown = ["name", "series", "nationality", "hometown", "age", "wins", "podium_percentage", "current_team"]
    return hits.select("query_id", "rank", *[display(hits, c).alias(c) for c in shown])


def search_total_hits(spark, sf_dir):
    requests = fx.profile_requests(spark, sf_dir)
    return S.total_hits(S.matches(_profile_index(spark, sf_dir), requests, WEIGHTS), requests)


def hits_display(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").withColumn("parts", F.array("event_type", "props"))
    labelled = events.join(
        fx.table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "event_id"), "event_id", "left"
    )
    shown = ["ts", "event_type", "user_id", "parts", "quality"]
    return labelled.select("event_id", *[display(labelled, c).alias(c) for c in shown])


QUERIES = {
    "pages_title": pages_title,
    "pages_strip_tags": pages_strip_tags,
    "pages_path_filter": pages_path_filter,
    "profile_attributes": _attributes("name", *X.VALUE_LABELS),
    "profile_series": _attributes("series"),
    "profile_section_stats": _attributes(*X.COUNT_LABELS, *X.PERCENTAGE_LABELS),
    "profile_score": profile_score,
    "profile_json_stats": profile_json_stats,
    "profile_override": profile_override,
    "profile_override_literal": profile_override_literal,
    "keys_distinct": keys_distinct,
    "tsv_roundtrip": tsv_roundtrip,
    "typed_defaults": typed_defaults,
    "wiki_from_xml": wiki_from_xml,
    "wiki_dump_file": wiki_dump_file,
    "articles_project": articles_project,
    "malformed_count": malformed_count,
    "pages_files": pages_files,
    "pages_packed": pages_packed,
    "wiki_lead_line": wiki_lead_line,
    "wiki_infobox": wiki_infobox,
    "wiki_clean": wiki_clean,
    "person_predicate": person_predicate,
    "articles_dedup": articles_dedup,
    "redirect_split": redirect_split,
    "redirect_resolve": redirect_resolve,
    "redirect_recursive": redirect_recursive,
    "redirect_resolve_compat": redirect_resolve_compat,
    "redirect_fixpoint": redirect_fixpoint,
    "articles_semi": articles_semi,
    "enrich_series": enrich_series,
    "enrich_person": enrich_person,
    "enrich_team": enrich_team,
    "enriched_profile": enriched_profile,
    "enriched_tsv": enriched_tsv,
    "index_postings": index_postings,
    "index_postings_wordbreak": index_postings_wordbreak,
    "index_term_stats": index_term_stats,
    "index_doc_stats": index_doc_stats,
    "index_field_stats": index_field_stats,
    "index_count": index_count,
    "index_documents": index_documents,
    "index_build": index_build,
    "index_updated": index_updated,
    "requests_parse": requests_parse,
    "search_text": search_text,
    "search_weighted": search_weighted,
    "search_must": search_must,
    "search_range": search_range,
    "search_batch": search_batch,
    "search_every_hundredth": search_every_hundredth,
    "search_ranges_batch": search_ranges_batch,
    "search_updated": search_updated,
    "search_profiles": search_profiles,
    "search_all_matches": search_all_matches,
    "search_wordbreak": search_wordbreak,
    "search_word_bounds": search_word_bounds,
    "search_positive_percentages": search_positive_percentages,
    "profile_hits_display": profile_hits_display,
    "search_total_hits": search_total_hits,
    "hits_display": hits_display,
}
