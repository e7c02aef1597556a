"""Joins with hot keys, redirects and enrichment."""

import random

import pytest
from pyspark.sql import functions as F

from gridscout.operators import enrich as E
from gridscout.operators import redirects as R
from gridscout.operators.joins import hot_keys, join_unique
from gridscout.schemas import ENRICHED_COLUMNS, PROFILE_COLUMNS

PAGE = "id long, title string, is_redirect boolean, target string, text string"


def pages_of(spark, articles, edges):
    rows = [(i, t, False, None, text) for i, t, text in articles]
    rows += [(i, s, True, t, "#REDIRECT") for i, s, t in edges]
    return spark.createDataFrame(rows, PAGE)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_unique_equals_a_plain_join(spark, how):
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 6 + ["", None, "a", "b", "c"])) for i in range(900)]
    left = spark.createDataFrame(rows, "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("a", 2), ("z", 3), ("", 4)], "k string, v int")
    plain = sorted(map(tuple, left.join(right, "k", how).collect()), key=str)
    for hot_rows in (1, 10, 100, 10**6):
        split = join_unique(left, right, ["k"], ["i"], how, hot_rows)
        assert sorted(map(tuple, split.select("k", "i", "v").collect()), key=str) == plain


def test_all_hot_keys_are_spread(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") < 400, F.lit("x")).otherwise(F.col("id").cast("string")).alias("k"))
    assert [tuple(r) for r in hot_keys(left, ["k"], 100).collect()] == [("x", 4)]
    assert hot_keys(left, ["k"], 1).count() == 601
    many = spark.range(20_000).select("id", (F.col("id") % 2000).cast("string").alias("k"))  # every key is hot
    split = join_unique(many, many.select("k").distinct().withColumn("v", F.lit(1)), ["k"], ["id"], "left", 5)
    assert hot_keys(many, ["k"], 5).count() == 2000 and split.where("v = 1").count() == 20_000
    right = spark.createDataFrame([("x", 1)], "k string, v int")
    plan = join_unique(left, right, ["k"], ["id"], "left", 100)
    assert plan.where("v = 1").count() == 400


def walk(edges, articles, title):
    """(end of the chain, is it a cycle)"""
    seen, at = set(), title
    while at in edges:
        if at in seen:
            return None, True
        seen.add(at)
        at = edges[at]
    return at, False


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_title_map_against_a_walk(spark, hot_rows):
    rng = random.Random(5)
    articles = [(i, f"a{i}", f"text {i}") for i in range(30)]
    edges = {}
    for i in range(25):  # one long chain
        edges[f"c{i}"] = f"c{i + 1}" if i < 24 else "a0"
    for i in range(60):  # a third of all go to one title
        edges[f"h{i}"] = "a7"
    for i in range(80):
        edges[f"r{i}"] = rng.choice([f"r{rng.randrange(80)}", f"a{rng.randrange(30)}", f"c{rng.randrange(25)}", "gone"])
    edges |= {"self": "self", "p": "q", "q": "p", "into": "p"}
    rows = [(1000 + n, s, t) for n, (s, t) in enumerate(edges.items())]
    rows.append((5000, "h1", "a9"))  # a second page of one title: the lower id counts
    titles = R.title_map(pages_of(spark, articles, rows), hot_rows)
    got = {r.title: r for r in titles.where("id >= 1000").collect()}
    assert set(got) == set(edges)
    ids = {t: i for i, t, _ in articles}
    for source in edges:
        end, cycle = walk(edges, ids, source)
        assert got[source].is_cycle == cycle, source
        assert got[source].article_id == ids.get(end), source
        if not cycle:
            assert got[source].article_title == end
    assert titles.where("id < 1000").where("article_id = id and title = article_title").count() == 30


def test_title_map_without_redirects_and_with_equal_titles(spark):
    pages = pages_of(spark, [(1, "a", "x"), (2, "a", "y")], [])
    assert sorted(r.article_id for r in R.title_map(pages).collect()) == [1, 2]
    pages = pages_of(spark, [(2, "a", "y"), (1, "a", "x")], [(3, "r", "a")])
    assert R.title_map(pages).where("title = 'r'").first().article_id == 1


def test_resolving_twice_changes_nothing(spark):
    pages = pages_of(spark, [(1, "a", "x")], [(2, "b", "a"), (3, "c", "b"), (4, "d", "c")])
    first = R.follow_edges(R.unique_edges(R.redirect_edges(pages)))
    again = R.follow_edges(first.select("id", "source", "target"))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_one_pass_keeps_the_source_for_plain_redirects(spark):
    pages = pages_of(spark, [(1, "A", "ta"), (2, "Z", "tz")], [(3, "B", "A"), (4, "X", "Y"), (5, "Y", "Z")])
    got = {(r.title, r.article_title, r.text) for r in R.one_pass_titles(pages).collect()}
    assert got == {("A", "A", "ta"), ("Z", "Z", "tz"), ("B", "B", None), ("X", "Z", "tz"), ("Y", "Y", None)}
    itself = pages_of(spark, [(1, "A", "ta")], [(2, "S", "S")])
    assert {r.article_title for r in R.one_pass_titles(itself).collect()} == {"A", "S"}


def test_unchanged_count_has_bag_semantics(spark):
    a = spark.createDataFrame([("x", "y")] * 3 + [("p", "q")], "source string, target string")
    b = spark.createDataFrame([("x", "y")] * 2, "source string, target string")
    assert tuple(R.unchanged_count(a, b).first()) == (6, 4)


def profiles_of(spark, rows):
    full = [
        tuple({"filename": f"f{i}", "name": n, "series": s}.get(c, "") for c in PROFILE_COLUMNS)
        for i, (n, s) in enumerate(rows)
    ]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in PROFILE_COLUMNS))


ARTICLES = [
    (1, "F3", "'''F3''' is fast.\nmore"),
    (2, "F3", "'''F3''' twice.\nmore"),
    (3, "Ann", "a baker '''Ann'''\n"),
    (4, "Ann", "team = [[Red]]\nteams = Red, Blue\ncar_number = 5\n'''Ann''' is a RACING driver.\n"),
    (5, "Ann", "team = Blue\n'''Ann''' racing driver\n"),
    (6, "Red Racing", "'''Red''' races.\nx"),
    (7, "Bob", "'''Bob''' is a baker.\n"),
    (8, "Cy", None),
    (11, "Eve", "team = Green\n'''Eve''' racing driver\n"),
]
EDGES = [(9, "Red", "Red Racing"), (10, "Dee", "Eve")]


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_enrichment(spark, hot_rows):
    profiles = profiles_of(spark, [("Ann", "F3"), ("Bob", "F3"), ("Cy", ""), ("", "F9"), ("Dee", "F3"), ("Ann", None)])
    pages = pages_of(spark, ARTICLES, EDGES)
    rows = E.enrich_profiles(profiles, R.title_map(pages), pages, hot_rows=hot_rows).orderBy("filename").collect()
    assert rows[0].asDict().keys() == dict.fromkeys(ENRICHED_COLUMNS).keys()
    assert [r.series_description for r in rows] == ["'''F3''' is fast."] * 2 + ["", "", "'''F3''' is fast.", ""]
    ann = rows[0]
    assert (ann.current_team, ann.all_teams, ann.car_number, ann.championships) == ("Red", "Red, Blue", "5", "")
    assert (ann.bio, ann.team_description) == ("'''Ann''' is a RACING driver.", "'''Red''' races.")
    assert [r.current_team for r in rows] == ["Red", "", "", "", "Green", "Red"]
    assert rows[1].bio == "" and rows[2].bio == ""


def test_enrichment_with_bag_semantics(spark):
    profiles = profiles_of(spark, [("Ann", "F3")])
    pages = pages_of(spark, ARTICLES, [])
    rows = E.enrich_profiles(profiles, R.title_map(pages), pages, one_per_title=False).collect()
    assert sorted((r.series_description, r.current_team) for r in rows) == [
        ("'''F3''' is fast.", "Blue"),
        ("'''F3''' is fast.", "Red"),
        ("'''F3''' twice.", "Blue"),
        ("'''F3''' twice.", "Red"),
    ]


def test_recursive_query_resolves_the_same_titles(spark):
    rows = [(i, f"t{i}", True, f"t{i + 1}", None) for i in range(20)] + [(20, "t20", False, None, "end")]
    rows += [(30, "a", True, "b", None), (31, "b", True, "c", None), (32, "c", True, "b", None), (33, "self", True, "self", None), (34, "x", True, "nowhere", None)]
    pages = spark.createDataFrame(rows, "id long, title string, is_redirect boolean, target string, text string")

    def plain(titles):
        return {(r.id, r.title, None if r.is_cycle else r.article_title, r.article_id, r.is_cycle) for r in titles.collect()}

    found = plain(R.title_map(pages, follow=R.follow_edges_recursive))
    assert found == plain(R.title_map(pages)) and len(found) == len(rows)
    assert plain(R.title_map(pages.where("false"), follow=R.follow_edges_recursive)) == set()
