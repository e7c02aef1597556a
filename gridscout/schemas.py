"""Column lists, schemas and field weights of the profile data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Only the parts of a dump page that any job reads. "_title" and "_VALUE" are the names
# Spark's XML reader gives to an attribute and to the text of an element with attributes.
WIKI_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("redirect", T.StructType([T.StructField("_title", T.StringType())])),
        T.StructField(
            "revision",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "text",
                            T.StructType(
                                [
                                    T.StructField("_VALUE", T.StringType()),
                                    T.StructField("_bytes", T.LongType()),
                                ]
                            ),
                        )
                    ]
                )
            ),
        ),
    ]
)

# The columns of the profile table and of the enriched table, in file order.
PROFILE_COLUMNS = [
    "filename",
    "name",
    "nationality",
    "series",
    "age",
    "birthday",
    "hometown",
    "races_started",
    "races_entered",
    "wins",
    "podiums",
    "pole_positions",
    "fastest_laps",
    "race_win_percentage",
    "podium_percentage",
    "driverdb_score",
]
ENRICHED_COLUMNS = PROFILE_COLUMNS + [
    "series_description",
    "current_team",
    "all_teams",
    "car_number",
    "championships",
    "bio",
    "team_description",
]

# Columns that are searched as numbers.
INT_COLUMNS = [
    "age",
    "races_started",
    "races_entered",
    "wins",
    "podiums",
    "pole_positions",
    "fastest_laps",
    "championships",
]
DOUBLE_COLUMNS = ["race_win_percentage", "podium_percentage"]

# Searched text field -> (source column, weight in free-text search).
TEXT_FIELDS = {
    "content": ("content", 1.0),
    "driver_name": ("name", 3.0),
    "nationality": ("nationality", 3.0),
    "series": ("series", 3.0),
    "birthday": ("birthday", 3.0),
    "hometown": ("hometown", 3.0),
    "driverdb_score": ("driverdb_score", 2.0),
    "current_team": ("current_team", 3.0),
    "all_teams": ("all_teams", 2.0),
    "car_number": ("car_number", 1.0),
    "driver_bio": ("bio", 2.0),
    "series_description": ("series_description", 2.0),
    "team_description": ("team_description", 2.0),
}
WEIGHTS = {field: weight for field, (_, weight) in TEXT_FIELDS.items()}

PROFILE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in PROFILE_COLUMNS])
ENRICHED_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ENRICHED_COLUMNS])
