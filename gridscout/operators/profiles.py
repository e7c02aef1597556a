"""Profile table: attributes of crawled pages as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.functions import extract as X
from gridscout.functions.text import strip_tags
from gridscout.functions.typed import is_bad, to_double, to_int
from gridscout.schemas import (
    DOUBLE_COLUMNS,
    ENRICHED_COLUMNS,
    INT_COLUMNS,
    PROFILE_COLUMNS,
)


def page_attributes(pages: DataFrame, content: str = "content") -> DataFrame:
    """`pages` with the attributes found in the HTML as added text columns, "" where not found."""
    page = F.col(content)
    cut = pages.withColumn("_section", X.section_from(page, X.SECTION_HEADING))
    section = F.col("_section")
    found = {
        "name": X.capture(page, X.NAME_PATTERN),
        "series": X.capture(page, X.SERIES_PATTERN),
        "driverdb_score": X.capture(page, X.SCORE_PATTERN),
    }
    found |= {label: X.labelled_value(page, label) for label in X.VALUE_LABELS}
    found |= {c: X.section_count(section, label) for c, label in X.COUNT_LABELS.items()}
    found |= {c: X.section_percentage(section, label) for c, label in X.PERCENTAGE_LABELS.items()}
    order = [c for c in PROFILE_COLUMNS if c in found]
    return cut.withColumns({c: found[c] for c in order}).drop("_section")


def with_json(pages: DataFrame, content: str = "content") -> DataFrame:
    """`pages` with `_json`, the embedded object as a map. The text is cut out in a step of its own,
    so that it is looked for once."""
    cut = pages.withColumn("_text", X.embedded_text(F.col(content)))
    return cut.withColumn("_json", X.json_object(F.col("_text"))).drop("_text")


def override_from_json(
    pages: DataFrame, content: str = "content", literal_missing: bool = False
) -> DataFrame:
    """Attributes replaced by those of the page's embedded JSON object, where it has one."""
    parsed = with_json(pages, content)
    return parsed.withColumns(
        {
            c: X.json_or(F.col("_json"), key, F.col(c), literal_missing)
            for c, key in X.JSON_KEYS.items()
        }
    ).drop("_json")


def extract_profiles(
    pages: DataFrame, path_contains: str | None = X.PATH_MARK, literal_missing: bool = False
) -> DataFrame:
    """(filename, content) pages to the 16-column profile table."""
    if path_contains is not None:
        pages = pages.where(F.col("filename").contains(path_contains))
    full = override_from_json(page_attributes(pages), literal_missing=literal_missing)
    return full.select(*PROFILE_COLUMNS)


def typed_profiles(enriched: DataFrame) -> DataFrame:
    """Number columns as numbers, 0 for none, and `bad_columns`: those that held other text."""
    kinds = {c: "int" for c in INT_COLUMNS} | {c: "double" for c in DOUBLE_COLUMNS}
    kinds = {c: k for c, k in kinds.items() if c in enriched.columns}
    bad = F.filter(
        F.array(*[F.when(is_bad(F.col(c), k), F.lit(c)) for c, k in kinds.items()]),
        lambda c: c.isNotNull(),
    )
    flagged = enriched.withColumn("bad_columns", bad)
    return flagged.withColumns(
        {c: (to_int if k == "int" else to_double)(F.col(c)) for c, k in kinds.items()}
    )


def profile_values(enriched: DataFrame) -> DataFrame:
    """Typed enriched rows without null texts."""
    texts = [c for c in ENRICHED_COLUMNS if c not in INT_COLUMNS + DOUBLE_COLUMNS and c != "filename"]
    return typed_profiles(enriched.fillna("", subset=texts))


def page_texts(pages: DataFrame) -> DataFrame:
    """(filename, content): the tag-free text of each page."""
    return pages.select("filename", strip_tags(F.col("content")).alias("content"))


def profile_documents(enriched: DataFrame, pages: DataFrame) -> DataFrame:
    """Search documents: typed enriched rows with `content`, the tag-free text of their page."""
    return profile_values(enriched).join(page_texts(pages), "filename", "left")
