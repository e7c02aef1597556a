"""Column expressions for cleaning and showing text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_SPECIFIED = "Not specified"  # fixed value
DATE_FORMAT = "dd.MM.yyyy"  # fixed value


def strip_tags(html: Column) -> Column:
    """Script blocks, then tags, each become one space. A tag must not span lines."""
    no_scripts = F.regexp_replace(html, r"<script[^>]*>[\s\S]*?</script[^>]*>", " ")
    return F.regexp_replace(no_scripts, r"(?d)<.*?>", " ")


def clean_wiki(text: Column) -> Column:
    """Without square brackets and bold marks."""
    return F.regexp_replace(F.regexp_replace(text, r"[\[\]]", ""), "'''", "")


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def path_of_uri(uri: Column) -> Column:
    """Second ':'-separated part: the path of a file URI."""
    return F.split_part(uri, F.lit(":"), F.lit(2))


def display(df: DataFrame, name: str) -> Column:
    """Column `name` as shown to a reader: dates by day, lists joined, markup and null replaced."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.ArrayType):
        shown = clean_wiki(F.when(value.isNotNull(), F.concat_ws(", ", value)))
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        shown = F.date_format(value, DATE_FORMAT)
    elif isinstance(kind, T.StringType):
        shown = clean_wiki(value)
    else:
        shown = value.cast("string")
    return F.coalesce(shown, F.lit(NOT_SPECIFIED))
