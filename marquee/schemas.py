"""The seven declared schemas of the title / people / ratings catalog.

Schema inference is never used: every read passes one of these. All fields
are nullable. Ratings stay FLOAT at rest on purpose: widening them to DOUBLE
lets a group of equal ratings exceed its own mean.
"""

from __future__ import annotations

from pyspark.sql.types import FloatType, IntegerType, StringType, StructField, StructType


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, I, F = StringType(), IntegerType(), FloatType()

NAME_BASICS = _schema(
    ("nconst", S),
    ("primaryName", S),
    ("birthYear", I),
    ("deathYear", I),
    ("primaryProfession", S),
    ("knownForTitles", S),
)

TITLE_AKAS = _schema(
    ("titleId", S),
    ("ordering", I),
    ("title", S),
    ("region", S),
    ("language", S),
    ("types", S),
    ("attributes", S),
    ("isOriginalTitle", I),
)

TITLE_BASICS = _schema(
    ("tconst", S),
    ("titleType", S),
    ("primaryTitle", S),
    ("originalTitle", S),
    ("isAdult", I),
    ("startYear", I),
    ("endYear", I),
    ("runtimeMinutes", I),
    ("genres", S),
)

TITLE_CREW = _schema(("tconst", S), ("directors", S), ("writers", S))

TITLE_EPISODE = _schema(
    ("tconst", S),
    ("parentTconst", S),
    ("seasonNumber", I),
    ("episodeNumber", I),
)

TITLE_PRINCIPALS = _schema(
    ("tconst", S),
    ("ordering", I),
    ("nconst", S),
    ("category", S),
    ("job", S),
    ("characters", S),
)

TITLE_RATINGS = _schema(("tconst", S), ("averageRating", F), ("numVotes", I))

# Catalog table name -> schema, in the order the loader lists them.
SCHEMAS: dict[str, StructType] = {
    "name_basics": NAME_BASICS,
    "title_akas": TITLE_AKAS,
    "title_basics": TITLE_BASICS,
    "title_crew": TITLE_CREW,
    "title_episode": TITLE_EPISODE,
    "title_principals": TITLE_PRINCIPALS,
    "title_ratings": TITLE_RATINGS,
}

# The public dump file name of each table.
FILE_NAMES: dict[str, str] = {
    "name_basics": "name.basics.tsv",
    "title_akas": "title.akas.tsv",
    "title_basics": "title.basics.tsv",
    "title_crew": "title.crew.tsv",
    "title_episode": "title.episode.tsv",
    "title_principals": "title.principals.tsv",
    "title_ratings": "title.ratings.tsv",
}
