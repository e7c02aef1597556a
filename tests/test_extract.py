"""Edge rows of page extraction, text cleaning, numbers and term counting."""

import datetime
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridscout.functions import extract as X
from gridscout.functions.text import clean_wiki, display, path_of_uri, strip, strip_tags
from gridscout.functions.tokens import TOKEN_SIMPLE, TOKEN_WORDBREAK, term_counts, tokens
from gridscout.functions.typed import is_bad, to_double, to_int
from gridscout.operators import profiles as P
from gridscout.schemas import PROFILE_COLUMNS


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def page(body="", **labels):
    rows = "".join(f"<div>{k.replace('_', ' ')}</div>\n  <div>{v}</div>\n" for k, v in labels.items())
    return f"<title>Driver: Ann Lee | Driver Database</title>\n{rows}{body}"


def profile(spark, content, **options):
    df = spark.createDataFrame([("file:/x/com_drivers_1.html", content)], "filename string, content string")
    return P.extract_profiles(df, **options).first()


def test_profile_columns_and_section(spark):
    section = (
        '<h2>Driver Stats</h2><div>races started</div>\n <div>12</div><div>wins</div><div>3</div>'
        "<div>race win percentage</div>\n<div>25.5<!-- -->%</div>"
    )
    row = profile(spark, page("<div>wins</div><div>99</div>" + section, nationality="Finnish", age=31))
    assert list(row.asDict()) == PROFILE_COLUMNS
    assert (row.name, row.nationality, row.age, row.hometown) == ("Ann Lee", "Finnish", "31", "")
    assert (row.races_started, row.wins, row.race_win_percentage, row.podiums) == ("12", "3", "25.5", "")


def test_section_cut_equals_one_whole_page_pattern(spark):
    pages = [
        page("<h2>Driver Stats</h2><div>wins</div><div>1</div>"),
        page("<div>wins</div><div>7</div>"),
        page("<h2>Driver Stats</h2> none <h2>Driver Stats</h2><div>wins</div>\n\t<div>5</div>"),
        page("<h2>Driver Stats</h2><div>wins</div>\n\n<div>5</div><div>wins</div><div></div>"),
        None,
    ]
    whole = r">Driver Stats</h2>[\s\S]*?wins</div>\n?[ \t]*<div>([0-9]*)</div>"
    cut = values(spark, pages, lambda t: X.section_count(X.section_from(t, X.SECTION_HEADING), "wins"))
    assert cut == values(spark, pages, lambda t: F.regexp_extract(t, whole, 1))


def test_path_filter(spark):
    df = spark.createDataFrame([("file:/a/com_teams_1.html", "x")], "filename string, content string")
    assert P.extract_profiles(df).count() == 0
    assert P.extract_profiles(df, path_contains=None).count() == 1


STATS = '<script>{"stats":%s,"careerOverview":1}</script>'


@pytest.mark.parametrize(
    "json, wins, literal",
    [
        ('{"wins":3}', "3", "3"),
        ('{"wins":null}', "", "None"),
        ('{"races":1}', "", "N/A"),
        ('{"wins":12.50}', "12.5", "12.5"),
        ('{"wins":1e3}', "1000.0", "1000.0"),
        ('{"wins":"x y"}', "x y", "x y"),
        ("[1]", "", ""),
        ("null", "", ""),
        ("{bad", "", ""),
        ("{'wins':3}", "", ""),
        ('{"wins":3} rest', "", ""),
    ],
)
def test_json_overrides(spark, json, wins, literal):
    assert profile(spark, page(STATS % json)).wins == wins
    assert profile(spark, page(STATS % json), literal_missing=True).wins == literal


def test_json_is_skipped_where_the_page_has_the_section(spark):
    assert profile(spark, page(STATS % '{"wins":3}' + " Driver Stats ")).wins == ""
    assert profile(spark, page(STATS % '{"wins"\n:3}')).wins == ""


def test_series_pattern_is_ascii(spark):
    block = '<div><b>x</b></div>\n</div>\n<div class="a b">%s</div>\n</div>'
    assert values(spark, [block % "Formula-3 x", block % "Fórmula"], lambda t: X.capture(t, X.SERIES_PATTERN)) == [
        "Formula-3 x",
        "",
    ]


def test_lead_line(spark):
    texts = ["'''A''' is.\nMore", "'''A''' is.", "x '''A'''\n'''B'''\n", "none\n", "'''A\rB\n", None]
    assert values(spark, texts, X.lead_line) == ["'''A''' is.", "", "'''A'''", "", "", None]
    assert values(spark, texts[:2], lambda t: X.lead_line(t, allow_eof=True)) == ["'''A''' is."] * 2


def test_infobox(spark):
    text = "| team = [[Red|R]]\n| team(s) = A, B\n| car_number = 44\n| Championships = 7\n"
    kinds = [
        (X.CURRENT_TEAM_KEY, "link", "Red"),
        (X.ALL_TEAMS_KEY, "line", "A, B"),
        (X.CAR_NUMBER_KEY, "int", "44"),
        (X.CHAMPIONSHIPS_KEY, "int", "7"),
    ]
    for key, kind, wanted in kinds:
        assert values(spark, [text], lambda t: X.infobox_value(t, key, kind)) == [wanted]


def test_strip_tags_follows_the_two_substitutions(spark):
    pages = [
        "a<script>var x='<b>';\n</script >b<i>c</i>",
        "<SCRIPT>x</SCRIPT>",
        "<a\nhref>x</a>",
        "<!-- a > b -->",
        "<p\r>x</p>",
        "<script>open",
        None,
    ]

    def wanted(html):
        html = re.sub(r"<script[^>]*>[\s\S]*?</script[^>]*>", " ", html)
        return re.sub(r"<.*?>", " ", html)

    assert values(spark, pages, strip_tags) == [p if p is None else wanted(p) for p in pages]


def test_small_text_functions(spark):
    assert values(spark, ["[[A|b]] '''c'''"], clean_wiki) == ["A|b c"]
    assert values(spark, ["\t a b\n"], strip) == ["a b"]
    assert values(spark, ["file:/a/b.html", "x"], path_of_uri) == ["/a/b.html", ""]


def test_numbers(spark):
    texts = ["", "None", "N/A", "1,234", " 5 ", "5.0", "-7", None]
    assert values(spark, texts, to_int) == [0, 0, 0, 0, 5, 0, -7, 0]
    assert values(spark, texts, lambda t: is_bad(t, "int")) == [False, False, True, True, False, True, False, False]
    assert values(spark, ["12.5", "x", "0.0"], to_double) == [12.5, 0.0, 0.0]


def test_display(spark):
    df = spark.createDataFrame(
        [("[a] '''b'''", 3, 1.5, datetime.datetime(2024, 3, 9), ["x", "[y]"]), (None,) * 5],
        "s string, n int, d double, t timestamp, l array<string>",
    )
    rows = [tuple(r) for r in df.select(*[display(df, c).alias(c) for c in df.columns]).collect()]
    assert ("a b", "3", "1.5", "09.03.2024", "x, y") in rows
    assert ("Not specified",) * 5 in rows


def test_tokens(spark):
    text = "Don't e-mail 1,234 3.14 u.s.a foo_bar Éa"
    assert values(spark, [text], lambda t: tokens(t, TOKEN_WORDBREAK)) == [
        ["don't", "e", "mail", "1,234", "3.14", "u.s.a", "foo_bar", "éa"]
    ]
    assert values(spark, ["漢字 ab"], lambda t: tokens(t, TOKEN_WORDBREAK)) == [["漢", "字", "ab"]]
    assert values(spark, ["a" * 600], lambda t: F.transform(tokens(t, TOKEN_SIMPLE), F.length)) == [[255, 255, 90]]


def test_term_counts_match_a_counter(spark):
    texts = ["b a b c a b", "x", "", None, "z " * 5000 + "y"]
    got = values(spark, texts, lambda t: term_counts(tokens(t)))
    for text, counted in zip(texts, got):
        if not text:
            assert counted is None
        else:
            assert [(c.term, c.tf) for c in counted] == sorted(Counter(text.split()).items())


def test_joined_tokens_neither_overflow_nor_grow(spark):
    many = 100_000
    texts = ["1," * many, "a." * many, "a.1," * many, "x" * 1000, "1,234 3.14 don't u.s.a. a.b'c"]
    got = values(spark, texts, lambda t: tokens(t, TOKEN_WORDBREAK))
    assert "".join(got[0]) == "1," * (many - 1) + "1" and max(map(len, got[0])) == 255
    assert "".join(got[1]) == "a." * (many - 1) + "a" and max(map(len, got[1])) == 255
    assert len(got[2]) == 2 * many and set(got[2]) == {"a", "1"}
    assert [len(t) for t in got[3]] == [255, 255, 255, 235]
    assert got[4] == ["1,234", "3.14", "don't", "u.s.a", "a.b'c"]


def test_patterns_do_not_backtrack_over_line_ends(spark):
    import time

    lines = "\n" * 60_000
    pages = [f"<div>age</div>{lines}<div>5</div>", f"<div>age</div>{lines}x", f"</div>{lines}</div>{lines}x", "<div>a.e</div><div>6</div>"]
    start = time.time()
    assert values(spark, pages, lambda t: X.labelled_value(t, "age")) == ["5", "", "", ""]
    assert values(spark, pages, lambda t: X.capture(t, X.SERIES_PATTERN)) == [""] * 4
    assert values(spark, pages, lambda t: X.labelled_value(t, "a.e")) == ["", "", "", "6"]
    assert time.time() - start < 6
