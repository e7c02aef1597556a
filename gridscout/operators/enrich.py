"""Profiles joined to what wiki articles say about their series, person and team."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridscout.functions import extract as X
from gridscout.operators.joins import HOT_ROWS, join_unique
from gridscout.operators.redirects import article_texts
from gridscout.schemas import ENRICHED_COLUMNS
from gridscout.sources.tables import stage


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The values of `key` that are neither null nor ""."""
    return df.select(key).where(F.col(key) != "").distinct()


def article_info(
    titles: DataFrame,
    pages: DataFrame,
    keys: DataFrame,
    extracts: dict[str, Column],
    predicate: Column | None = None,
    one_per_title: bool = True,
    distinct_rows: bool = False,
    hot_rows: int = HOT_ROWS,
    n_titles: int | None = None,
) -> DataFrame:
    """(title, *extracts) of the articles whose title is in the one-column table `keys`.

    `extracts` and `predicate` are expressions over the article's `text`. Titles are cut down to
    the wanted ones before any text is fetched. With several pages of one title the lowest page id
    that meets the predicate wins, unless `one_per_title` is off; `distinct_rows` then drops
    equal (title, text) rows.
    """
    names = keys.toDF("title")
    wanted = join_unique(titles, names, ["title"], ["id"], "left_semi", hot_rows, n_titles)
    found = article_texts(wanted, pages, "inner", hot_rows, n_titles)
    if predicate is not None:
        found = found.where(predicate)
    values = [e.alias(name) for name, e in extracts.items()]
    if not one_per_title:
        if distinct_rows:
            found = found.dropDuplicates(["title", "text"])
        return found.select("title", *values)
    first = found.select("title", F.struct("id", *values).alias("v")).groupBy("title").agg(F.min("v").alias("v"))
    return first.select("title", *[F.col("v")[name].alias(name) for name in extracts])


def add_info(
    profiles: DataFrame,
    info: DataFrame,
    key: str,
    spread_by: list[str],
    hot_rows: int = HOT_ROWS,
    n_profiles: int | None = None,
) -> DataFrame:
    """`profiles`, at most `n_profiles` where that is known, left-joined to `info` on key = title;
    text not found reads ""."""
    info_by_key = info.withColumnRenamed("title", key)
    joined = join_unique(profiles, info_by_key, [key], spread_by, "left", hot_rows, n_profiles)
    added = [c for c in info.columns if c != "title"]
    return joined.select(*profiles.columns, *added).fillna("", subset=added)


def person_extracts() -> dict[str, Column]:
    text = F.col("text")
    return {
        "current_team": X.infobox_value(text, X.CURRENT_TEAM_KEY, "link"),
        "all_teams": X.infobox_value(text, X.ALL_TEAMS_KEY, "line"),
        "car_number": X.infobox_value(text, X.CAR_NUMBER_KEY, "int"),
        "championships": X.infobox_value(text, X.CHAMPIONSHIPS_KEY, "int"),
        "bio": X.lead_line(text),
    }


def enrich_profiles(
    profiles: DataFrame,
    titles: DataFrame,
    pages: DataFrame,
    one_per_title: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The 16-column profile table to the 23-column enriched table.

    `titles` is `title_map(pages)`. All three inputs are read several times, so they should be
    written tables. The result of the person step is staged, as the team step reads it twice.
    """
    profiles = profiles.fillna("")
    n_profiles = profiles.count() if one_per_title else None
    options = {"one_per_title": one_per_title, "hot_rows": hot_rows, "n_titles": titles.count()}

    def info(keys: DataFrame, extracts: dict[str, Column], **more) -> DataFrame:
        return article_info(titles, pages, keys, extracts, **options, **more)

    series = info(
        distinct_keys(profiles, "series"), {"series_description": X.lead_line(F.col("text"))}
    )
    persons = info(
        distinct_keys(profiles, "name"),
        person_extracts(),
        predicate=F.col("text").rlike(X.PERSON_MARK),
        distinct_rows=True,
    )
    with_series = add_info(profiles, series, "series", ["filename"], hot_rows, n_profiles)
    with_person = stage(
        add_info(with_series, persons, "name", ["filename"], hot_rows, n_profiles)
    )
    teams = info(
        distinct_keys(with_person, "current_team"),
        {"team_description": X.lead_line(F.col("text"))},
    )
    full = add_info(with_person, teams, "current_team", ["filename"], hot_rows, n_profiles)
    return full.select(*ENRICHED_COLUMNS)
