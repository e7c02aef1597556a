"""Search requests: free text with @field=value, ^field=min and $field=max, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridscout.functions.text import strip

# The three marked parts of a request. (?U): \w takes letters of any language.
MUST = r"(?U)@(\w+)=(\w+)"
MAX = r"(?U)\$(\w+)=(\w+)"
MIN = r"(?U)\^(\w+)=(\w+)"
# Bounds may also be negative or have decimals.
NUMBER_MAX = r"(?U)\$(\w+)=(-?\w+(?:\.\d+)?)"
NUMBER_MIN = r"(?U)\^(\w+)=(-?\w+(?:\.\d+)?)"


def _pairs(request: Column, pattern: str, value_name: str, value) -> Column:
    names = F.regexp_extract_all(request, F.lit(pattern), F.lit(1))
    values = F.regexp_extract_all(request, F.lit(pattern), F.lit(2))
    return F.zip_with(
        names, values, lambda n, v: F.struct(n.alias("field"), value(v).alias(value_name))
    )


def parse_requests(requests: DataFrame, request: str = "q", word_bounds: bool = False) -> DataFrame:
    """`requests` with text, must array<field, value>, mins and maxs array<field, bound>.

    Underscores in a must value stand for spaces. A bound that is no number is null.
    `word_bounds` reads a bound as one run of word characters only, so 12.5 as 12.
    """
    q = F.col(request)
    max_pattern, min_pattern = (MAX, MIN) if word_bounds else (NUMBER_MAX, NUMBER_MIN)
    text = q
    for pattern in [MUST, max_pattern, min_pattern]:
        text = strip(F.regexp_replace(text, pattern, ""))

    def number(v: Column) -> Column:
        return v.try_cast("double")

    return requests.withColumns(
        {
            "text": text,
            "must": _pairs(q, MUST, "value", lambda v: F.replace(v, F.lit("_"), F.lit(" "))),
            "mins": _pairs(q, min_pattern, "bound", number),
            "maxs": _pairs(q, max_pattern, "bound", number),
        }
    )
