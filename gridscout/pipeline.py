"""The three jobs end to end: parse and enrich, index, search.

All tables are kept below one folder `out`: profiles, wiki, titles, enriched and index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscout.functions.extract import PATH_MARK
from gridscout.functions.tokens import TOKEN_WORDBREAK
from gridscout.operators.enrich import enrich_profiles
from gridscout.operators.index import field_terms, read_index, update_index, write_index
from gridscout.operators.profiles import extract_profiles, page_texts, profile_values
from gridscout.operators.redirects import title_map
from gridscout.operators.search import search, search_one
from gridscout.schemas import (
    DOUBLE_COLUMNS,
    ENRICHED_COLUMNS,
    INT_COLUMNS,
    TEXT_FIELDS,
    WEIGHTS,
)
from gridscout.sources.pages import read_pages
from gridscout.sources.tables import materialize, stage, staging
from gridscout.sources.wiki import read_wiki_xml, wiki_pages


def parse_and_enrich(
    spark: SparkSession, pages_path: str, dump_path: str, out: str, path_contains: str = PATH_MARK
) -> DataFrame:
    """The enriched table. A stage whose table is complete is read, not computed again; a table made
    from other inputs is an error."""
    pages = {"pages": pages_path, "path_contains": path_contains}
    dump = {"dump": dump_path}
    profiles = materialize(
        spark,
        f"{out}/profiles",
        lambda: extract_profiles(read_pages(spark, pages_path, path_contains), None),
        pages,
    )
    wiki = materialize(spark, f"{out}/wiki", lambda: wiki_pages(read_wiki_xml(spark, dump_path)), dump)
    titles = materialize(spark, f"{out}/titles", lambda: title_map(wiki), dump)
    return materialize(spark, f"{out}/enriched", lambda: enrich_profiles(profiles, titles, wiki), pages | dump)


def write_profile_index(
    enriched: DataFrame,
    pages: DataFrame,
    path: str,
    token_pattern: str = TOKEN_WORDBREAK,
    buckets: int | None = None,
) -> None:
    """Index of enriched profiles and the text of their (filename, content) pages, built anew.

    Page texts become counted terms before they meet the profiles, so that no text is shuffled.
    """
    write_index(
        profile_values(enriched),
        path,
        "filename",
        {field: column for field, column in _COLUMNS.items() if field not in _OF_PAGES},
        INT_COLUMNS + DOUBLE_COLUMNS,
        [c for c in ENRICHED_COLUMNS if c != "filename"] + ["bad_columns"],
        token_pattern,
        buckets,
        _page_terms(enriched, pages, token_pattern),
    )


_COLUMNS = {field: column for field, (column, _) in TEXT_FIELDS.items()}
_OF_PAGES = {field: column for field, column in _COLUMNS.items() if column == "content"}


def _page_terms(enriched: DataFrame, pages: DataFrame, token_pattern: str) -> DataFrame:
    ids = enriched.select(F.col("filename").alias("doc_id"))
    return field_terms(page_texts(pages), "filename", _OF_PAGES, token_pattern).join(ids, "doc_id", "left_semi")


def build_index(
    spark: SparkSession, pages_path: str, out: str, path_contains: str = PATH_MARK, **options
) -> None:
    enriched = spark.read.parquet(f"{out}/enriched")
    pages = read_pages(spark, pages_path, path_contains)
    write_profile_index(enriched, pages, f"{out}/index", **options)


def add_pages(spark: SparkSession, pages_path: str, out: str, path_contains: str = PATH_MARK) -> None:
    """Profiles of further pages, enriched from the kept titles and articles, into the index; a page that is there already
    is replaced. Only these pages are read. The kept tables stay as they are: a new build takes the pages of its folder."""
    pages = read_pages(spark, pages_path, path_contains)
    with staging(spark):
        profiles = stage(extract_profiles(pages, None))
        enriched = stage(enrich_profiles(profiles, spark.read.parquet(f"{out}/titles"), spark.read.parquet(f"{out}/wiki")))
        terms = _page_terms(enriched, pages, read_index(spark, f"{out}/index").token_pattern)
        update_index(spark, f"{out}/index", profile_values(enriched), more_terms=terms)


def search_index(spark: SparkSession, out: str, request: str, k: int = 10, **options) -> DataFrame:
    """The k best profiles for one request text; `doc_id` is the file name of the page."""
    return search_one(read_index(spark, f"{out}/index"), request, WEIGHTS, k, **options)


def search_requests(
    spark: SparkSession, out: str, requests: DataFrame, k: int = 10, **options
) -> DataFrame:
    """The k best profiles for every row (query_id, q) of `requests`."""
    return search(read_index(spark, f"{out}/index"), requests, WEIGHTS, k, **options)
