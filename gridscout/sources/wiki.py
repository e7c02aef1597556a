"""Wiki dumps: XML pages as nested rows, and as flat page rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridscout.schemas import WIKI_SCHEMA

START, END = "<page>", "</page>"
RECORD = rf"{START}[\s\S]*?{END}"


def read_wiki_xml(spark: SparkSession, path: str, schema: StructType = WIKI_SCHEMA) -> DataFrame:
    """Dump file(s) as nested rows.

    The XML source reads a file with records over several lines in one task. So the file is read as
    text "lines" that end where the next page starts: the text source splits a file among tasks and
    still gives each line whole. A page that is not closed before the next one, or before the end
    of the file, is left out.
    """
    chunks = spark.read.option("lineSep", START).text(path)
    closed = chunks.where(F.instr("value", F.lit(END)) > 0)
    record = F.concat(F.lit(START), F.substring_index("value", END, 1), F.lit(END))
    return closed.select(F.from_xml(record, schema).alias("page")).select("page.*")


def pages_from_xml_column(df: DataFrame, column: str, schema: StructType = WIKI_SCHEMA, keep=()) -> DataFrame:
    """Nested rows of all `<page>` records inside a text column, with the columns of `keep`."""
    records = df.select(
        *keep, F.explode(F.regexp_extract_all(column, F.lit(RECORD), F.lit(0))).alias("_record")
    )
    parsed = records.select(*keep, F.from_xml("_record", schema).alias("page"))
    return parsed.select(*keep, "page.*")


def first_text(revision: str = "revision") -> Column:
    """Text of the first revision; null where there is none."""
    return F.get(F.col(f"{revision}.text._VALUE"), F.lit(0))


def wiki_pages(nested: DataFrame) -> DataFrame:
    """(id, title, is_redirect, target, text); records without a title are left out."""
    return nested.where(F.col("title").isNotNull()).select(
        "id",
        "title",
        F.col("redirect").isNotNull().alias("is_redirect"),
        F.col("redirect._title").alias("target"),
        first_text().alias("text"),
    )


def malformed_count(nested: DataFrame) -> DataFrame:
    """One row: how many records have no title."""
    return nested.agg(F.count_if(F.col("title").isNull()).alias("n_malformed"))
