"""Text to lower-case terms and their counts, inside the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_TERM = 255  # fixed value: longer runs are cut into pieces of this length

# Runs of letters, digits and underscores.
TOKEN_SIMPLE = rf"[\p{{L}}\p{{N}}_]{{1,{MAX_TERM}}}"

# Nearer to Unicode word breaks: keeps don't, 1,234, 3.14 and u.s.a whole, splits e-mail, and
# takes Han and Hiragana characters one by one.
_SINGLE = r"\p{IsHan}\p{IsHiragana}"
_RUN = rf"[\p{{L}}\p{{M}}\p{{N}}_&&[^{_SINGLE}]]{{1,{MAX_TERM}}}+"
TOKEN_WORDBREAK = (
    rf"[{_SINGLE}]\p{{M}}*|{_RUN}"
    rf"(?:(?:(?<=[\p{{L}}\p{{M}}])['’.:·](?=\p{{L}})|(?<=\p{{N}})[.,;'’](?=\p{{N}})){_RUN})*+"  # possessive: no recursion
)


def tokens(text: Column, pattern: str = TOKEN_SIMPLE) -> Column:
    """The terms of a text in order; what is longer than MAX_TERM is cut into pieces."""
    found = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    if pattern == TOKEN_SIMPLE:  # gives no longer ones
        return found
    too_long = lambda t: F.length(t) > MAX_TERM
    cut = lambda t: F.when(too_long(t), F.regexp_extract_all(t, F.lit(f"(?s).{{1,{MAX_TERM}}}"), F.lit(0))).otherwise(F.array(t))
    return F.flatten(
        F.transform(F.array(found), lambda s: F.when(F.exists(s, too_long), F.flatten(F.transform(s, cut))).otherwise(s))
    )


def term_counts(terms: Column) -> Column:
    """array<struct<term, tf>> of an array of terms, in term order.

    Sorts the array and reads off the lengths of the runs, so that counting the terms of a row
    needs no shuffle. The one-element arrays bind a value once for use inside a lambda.
    """

    def runs(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))
        )
        return F.flatten(F.transform(F.array(starts), lambda st: counted(s, st, n)))

    def counted(s: Column, starts: Column, n: Column) -> Column:
        return F.transform(
            starts,
            lambda start, j: F.struct(
                F.get(s, start).alias("term"),
                (F.coalesce(F.get(starts, j + 1), n) - start).alias("tf"),
            ),
        )

    return F.when(
        F.size(terms) > 0, F.flatten(F.transform(F.array(F.sort_array(terms)), runs))
    )
