"""Column expressions that cut values out of HTML pages and wiki markup."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where the attributes of a profile page stand. Group 1 is the value.
PATH_MARK = "com_drivers"
NAME_PATTERN = r"<title>Driver: (.*) \| Driver Database</title>"
SERIES_PATTERN = r"</div>\s*</div>\s*<div class=\"[\w ]*?\">([\w -]+)</div>\s*</div>"
SCORE_PATTERN = r"driverdb score</div>\n?[ \t]*<div>([0-9,]*)"
SECTION_HEADING = ">Driver Stats</h2>"
JSON_PATTERN = r'"stats":(.*?),"careerOverview"'
JSON_SKIP_MARK = "Driver Stats"
VALUE_LABELS = ["nationality", "age", "birthday", "hometown"]
COUNT_LABELS = {
    "races_started": "races started",
    "races_entered": "races entered",
    "wins": "wins",
    "podiums": "podiums",
    "pole_positions": "pole positions",
    "fastest_laps": "fastest laps",
}
PERCENTAGE_LABELS = {
    "race_win_percentage": "race win percentage",
    "podium_percentage": "podium percentage",
}
JSON_KEYS = {
    "races_started": "races",
    "races_entered": "racesEntered",
    "wins": "wins",
    "podiums": "podiums",
    "pole_positions": "polePositions",
    "fastest_laps": "fastestLaps",
    "race_win_percentage": "racewinpercentage",
    "podium_percentage": "podiumpercentage",
    "driverdb_score": "score",
}
# Infobox keys and the lead line of an article.
CURRENT_TEAM_KEY = r"(?:t|T)eam"
ALL_TEAMS_KEY = r"(?:t|T)eam\(*s\)*"
CAR_NUMBER_KEY = r"car(?:_| )number"
CHAMPIONSHIPS_KEY = r"(?:c|C)hampionships"
INFOBOX_VALUE = {
    "link": r"\s*=\s*\[{0,2}(.*?)(?:\n|<|]]|\|)",
    "line": r"\s*=\ *(.*)\n",
    "int": r"\s*=\s*(\d+)",
}
LEAD_LINE = r"('''.*?)\n"
PERSON_MARK = r"(?i)racing driver"


def capture(text: Column, pattern: str) -> Column:
    """Group 1 of the first match; "" without a match, null for null text."""
    return F.regexp_extract(text, pattern, 1)


def quoted(label: str) -> str:
    """A pattern for the label itself."""
    return re.escape(label).replace(r"\ ", " ")


# The patterns around a label below are fixed values too.


def labelled_value(page: Column, label: str) -> Column:
    return capture(page, rf"<div>{quoted(label)}</div>\s*<div>([^<]*)</div>")


def section_from(page: Column, heading: str) -> Column:
    """The page from the first `heading` on, "" where there is none.

    Cutting once lets every number of the section be found by a short pattern instead of one
    lazy scan of the whole page per number.
    """
    at = F.instr(page, F.lit(heading))
    return F.when(at > 0, F.substr(page, at)).when(at == 0, F.lit(""))


def section_count(section: Column, label: str) -> Column:
    return capture(section, rf"{quoted(label)}</div>\n?[ \t]*<div>([0-9]*)</div>")


def section_percentage(section: Column, label: str) -> Column:
    return capture(section, rf"{quoted(label)}</div>\n?[ \t]*<div>([0-9.]*)(?:<!-- -->)*%")


def embedded_text(page: Column, pattern: str = JSON_PATTERN, skip_mark: str = JSON_SKIP_MARK) -> Column:
    """The embedded JSON text, "" where there is none, null where the page holds `skip_mark`."""
    text = F.trim(capture(page, "(?d)" + pattern))  # (?d): only \n ends a line
    return F.when(~page.contains(skip_mark), text)


def json_object(text: Column) -> Column:
    """A JSON object as map<string,string>; null for anything else, also for text after it."""
    parsed = F.from_json(text, "map<string,string>", {"allowSingleQuotes": "false"})
    return F.when(text.startswith("{") & text.endswith("}"), parsed)


def json_or(parsed: Column, key: str, other: Column, literal_missing: bool = False) -> Column:
    """Value of `key`, else `other`.

    With `literal_missing` a JSON null reads "None" and an absent key "N/A" instead, wherever
    there was an object at all.
    """
    if not literal_missing:
        return F.coalesce(F.try_element_at(parsed, F.lit(key)), other)
    return (
        F.when(parsed.isNull(), other)
        .when(~F.map_contains_key(parsed, key), F.lit("N/A"))
        .otherwise(F.coalesce(F.try_element_at(parsed, F.lit(key)), F.lit("None")))
    )


def infobox_value(text: Column, key: str, kind: str) -> Column:
    """Value after `key =`: a link target ("link"), the rest of the line ("line") or an "int"."""
    return capture(text, key + INFOBOX_VALUE[kind])


def lead_line(text: Column, allow_eof: bool = False) -> Column:
    """From the first ''' to the end of its line; the line must end in a newline by default."""
    return capture(text, r"('''.*?)(?:\n|\z)" if allow_eof else LEAD_LINE)
