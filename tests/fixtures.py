"""Semantic fixture rows for the seven-table catalog (NULLs, lists, ties, namesakes).

Columns follow the declared schemas; None is NULL.
"""

from __future__ import annotations

N = None

TITLE_BASICS = [
    # tconst, titleType, primaryTitle, originalTitle, isAdult, startYear, endYear, runtimeMinutes, genres
    ("tt01", "movie", "Alpha", "Alpha", 0, 2024, N, 100, "Drama"),
    ("tt02", "movie", "Beta", "Beta", 0, 2024, N, 120, "Drama,Comedy"),
    ("tt03", "movie", "Gamma", "Gamma", 0, 2011, N, N, N),
    ("tt04", "tvSeries", "Delta", "Delta", 0, 2000, N, 45, "Drama"),
    ("tt05", "tvEpisode", "Ep1", "Ep1", 0, 2000, N, 45, "Drama"),
    ("tt06", "tvEpisode", "Ep2", "Ep2", 0, 2001, N, N, "Comedy"),
    ("tt07", "movie", "Eta", "Eta", 0, N, N, 90, "Comedy"),
    ("tt08", "movie", "Theta", "Theta", 0, 2024, N, 80, "Drama"),
    ("tt09", "movie", "Iota", "Iota", 0, 2024, N, 95, "Comedy"),
]

TITLE_RATINGS = [
    ("tt01", 8.0, 20000),
    ("tt02", 9.0, 15000),
    ("tt03", 10.0, 500),
    ("tt05", 8.1, 1000),
    ("tt06", 9.4, 999),
    ("tt07", 1.0, 12000),
    ("tt08", 7.0, 10000),
    ("tt09", 9.0, 30000),
]

TITLE_CREW = [
    ("tt01", "nm1", "nm1"),
    ("tt02", "nm1,nm2", "nm2"),
    ("tt03", N, N),
    ("tt04", "nm3", "nm4"),
    ("tt05", "nm2", "nm2"),
    ("tt06", "nm1,nm2", "nm1,nm2"),
    ("tt07", "nm9", "nm3"),
    ("tt08", "nm5", "nm5"),
    ("tt09", "nm2", "nm1"),
]

NAME_BASICS = [
    # nconst, primaryName, birthYear, deathYear, primaryProfession, knownForTitles
    ("nm1", "Ann Lee", 1974, 2024, "director,actor", N),
    ("nm2", "Benedict Roe", 1930, N, "actor,music_department", N),
    ("nm3", "Ann Lee", 1990, N, "actress", N),  # namesake of nm1
    ("nm4", "Cy Poe", N, N, "music_department", N),
    ("nm5", "Dee Fox", 2010, N, "actress,director", N),
    ("nm6", "Eli Orr", 1750, 1800, "writer", N),
]

TITLE_PRINCIPALS = [
    ("tt01", 1, "nm1", "actor", N, N),
    ("tt01", 2, "nm1", "actor", N, N),  # same person twice
    ("tt02", 1, "nm3", "actress", N, N),
    ("tt02", 2, "nm2", "actor", N, N),
    ("tt04", 1, "nm2", "actor", N, N),
    ("tt07", 1, "nm9", "actor", N, N),
]

TITLE_AKAS = [
    # titleId, ordering, title, region, language, types, attributes, isOriginalTitle
    ("tt01", 1, "Alfa", "DE", "de", N, N, N),
    ("tt01", 2, "Alfa2", "DE", N, N, N, N),
    ("tt02", 1, "Beta2", "DE", "de", N, N, N),
    ("tt03", 1, "Gama", N, "fr", N, N, N),
    ("tt03", 2, "Gamma3", "DE", "de", N, N, N),
    ("tt05", 1, "Folge", "DE", "de", N, N, N),
    ("tt06", 1, "Ep", "FR", "fr", N, N, N),
]

TITLE_EPISODE = [
    ("tt05", "tt04", 1, 3),
    ("tt06", "tt04", 2, N),
]

ROWS = {
    "title_basics": TITLE_BASICS,
    "title_ratings": TITLE_RATINGS,
    "title_crew": TITLE_CREW,
    "name_basics": NAME_BASICS,
    "title_principals": TITLE_PRINCIPALS,
    "title_akas": TITLE_AKAS,
    "title_episode": TITLE_EPISODE,
}
