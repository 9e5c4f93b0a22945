"""The business questions and dataset statistics on the seven-table catalog.

Each question is a pure function of a ``MovieCatalog`` (plus parameters whose
defaults are the original literals) returning a lazy DataFrame. Query IDs
follow SURVEY §2.0. Where the original left something arbitrary or
single-task, the rewrite is deterministic and distributed:

* ties in every ranking are broken by the title / person id;
* window-aggregate-then-distinct becomes a grouped aggregate;
* "above the group mean" deals the rows once by (group, part) and joins merged
  partial sums back, not a window;
* global numbering uses ``number_rows`` (no single-partition window);
* lists are one row per value with its position;
* joins on a person with very many titles split that person (``hot_key_join``);
* FLOAT ratings are compared with FLOAT literals (8.1 keeps 8.1).

Output column names are the original ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import bin_label, contains_any, float_literal, single_valued
from marquee.operators import (
    above_group_mean,
    count_by,
    count_through,
    exists_in,
    explode_list,
    first_per_group,
    group_list,
    hot_key_join,
    late_lookup,
    max_by_group,
    mean_by,
    number_rows,
    preview,
    row_count,
    table_counts,
    top_n_per_group,
    with_names,
    year_span,
)
from marquee.sources.catalog import MovieCatalog
from marquee.sources.sinks import Published, export_csv

# The original questions' literals, in question order. They are
# the parameter defaults below; every one can be overridden per call.
REGION = "DE"
LANGUAGE = "de"
BORDER_YEAR = 2010
BORDER_RATING = 8.1
MIN_VOTES = 1000
MOVIE = "movie"
EPISODE = "tvEpisode"
ACTOR_WORDS = ("actor", "actress")
MAX_AGE = 18
MIN_EPISODES = 100
CURRENT_YEAR = 2025
MIN_LIVING_AGE = 90
DRAMA = "Drama"
TOP_DRAMAS = 3
NAME_PART = "Benedict"
LIFESPAN = 50
PROFESSION_PART = "music_dep"
POPULAR_YEAR = 2024
POPULAR_VOTES = 10000
ACTOR_CATEGORY = "actor"
SERIES_MIN_AVG_VOTES = 1000
TOP_PER_GENRE = 5
MIN_STAT_YEAR = 1800


def _genres(titles: DataFrame, keep: list[str]) -> DataFrame:
    return explode_list(titles.filter(F.col("genres").isNotNull()), "genres", "genre", keep=keep)


def _movies(cat: MovieCatalog) -> DataFrame:
    return cat.title_basics.filter(F.col("titleType") == MOVIE)


# ----------------------------------------------------------------- A1..A7


def a1_german_region_genres(cat: MovieCatalog, region: str = REGION) -> DataFrame:
    """(aka row in ``region`` x genre of its title) pairs per genre."""
    akas = cat.title_akas.filter(F.col("region") == region).select("titleId")
    titles = cat.title_basics.select("tconst", "genres")
    return count_through(akas, "titleId", titles, "tconst", ["genre"], name="count", explode=("genres", "genre", ","))


def a2_german_movies_from_year(
    cat: MovieCatalog, border_year: int = BORDER_YEAR, language: str = LANGUAGE, region: str = REGION
) -> DataFrame:
    movies = _movies(cat).filter(F.col("startYear") >= border_year)
    akas = cat.title_akas.filter((F.col("language") == language) & (F.col("region") == region))
    out = movies.join(akas, movies["tconst"] == akas["titleId"])
    return out.select(
        movies["tconst"], akas["title"], akas["region"], akas["language"],
        movies["startYear"].alias("year"), movies["genres"],
    ).orderBy("year", "tconst", "title")


def _crew_people(cat: MovieCatalog, column: str, explode: bool) -> DataFrame:
    """(tconst, person id) from a crew list column: the whole string as one id
    (only single-person lists can match a person), or every listed id."""
    crew = cat.title_crew.select("tconst", column)
    if explode:
        return explode_list(crew, column, "__person", keep=["tconst"])
    return crew.select("tconst", F.col(column).alias("__person"))


def a3_writers_with_avg_rating_from(
    cat: MovieCatalog,
    border_rating: float = BORDER_RATING,
    min_votes: int = MIN_VOTES,
    explode: bool = False,
    by_id: bool = False,
) -> DataFrame:
    """Writers with mean rating >= border.

    Defaults follow the original: namesakes merge (grouped by name) and only
    single-writer titles match. ``explode=True`` credits every listed writer;
    ``by_id=True`` keeps namesakes apart (adds ``nconst``).
    """
    rated = exists_in(
        cat.title_ratings.filter(F.col("numVotes") >= min_votes).select("tconst", "averageRating"),
        cat.title_basics, "tconst",
    )
    writers = hot_key_join(
        _crew_people(cat, "writers", explode), cat.name_basics, "__person", "nconst",
        columns=["primaryName"], rename={"primaryName": "writer"},
    )
    joined = rated.join(writers.select("tconst", "writer", F.col("__person").alias("nconst")), "tconst")
    keys = ["nconst", "writer"] if by_id else ["writer"]
    means = mean_by(
        joined, keys, {"avgWriterRating": "averageRating"}, having=F.col("avgWriterRating") >= border_rating
    )
    return means.orderBy("avgWriterRating", *keys)


def a4_countries_longest_series(cat: MovieCatalog) -> DataFrame:
    """Largest episode number per aka region over episodes, descending."""
    episodes = exists_in(
        cat.title_episode.select("tconst", "episodeNumber"),
        cat.title_basics.filter(F.col("titleType") == EPISODE), "tconst",
    )
    akas = cat.title_akas.filter(F.col("region").isNotNull()).select("titleId", "region")
    joined = episodes.join(akas, episodes["tconst"] == akas["titleId"])
    return max_by_group(joined, ["region"], "episodeNumber", "maxEpisodeNumber").orderBy(
        F.col("maxEpisodeNumber").desc(), "region"
    )


def a5_episodes_with_rating_from(
    cat: MovieCatalog, border_rating: float = BORDER_RATING, min_votes: int = MIN_VOTES
) -> DataFrame:
    episodes = cat.title_basics.filter(F.col("titleType") == EPISODE)
    ratings = cat.title_ratings.filter(
        (F.col("numVotes") >= min_votes) & (F.col("averageRating") >= float_literal(border_rating))
    )
    out = episodes.join(ratings, "tconst").orderBy("averageRating", "tconst")
    return out.select(
        F.col("primaryTitle").alias("episodeTitle"), F.col("startYear").alias("releaseYear"),
        "genres", "averageRating", "numVotes",
    )


def a6_titles_with_same_director_writer(cat: MovieCatalog) -> DataFrame:
    """Titles whose director list equals the writer list; one-person lists find a name."""
    crew = cat.title_crew.filter(F.col("writers").isNotNull() & (F.col("directors") == F.col("writers")))
    authors = hot_key_join(crew, cat.name_basics, "writers", "nconst", columns=["primaryName"],
                         rename={"primaryName": "authorName"})
    out = cat.title_basics.join(authors, "tconst").orderBy("startYear", "tconst")
    return out.select(
        "tconst", F.col("primaryTitle").alias("title"), F.col("startYear").alias("releaseYear"),
        "genres", "directors", "writers", "authorName",
    )


def a7_avg_title_type_runtime(cat: MovieCatalog) -> DataFrame:
    titles = cat.title_basics.filter(F.col("runtimeMinutes").isNotNull())
    return mean_by(titles, ["titleType"], {"averageRuntime": "runtimeMinutes"})


# ----------------------------------------------------------------- I1..I7


def _actors(cat: MovieCatalog) -> DataFrame:
    return cat.name_basics.filter(contains_any("primaryProfession", *ACTOR_WORDS))


def i1_actor_film_counts(cat: MovieCatalog, by_id: bool = False) -> DataFrame:
    """Actor/actress principal rows per person name, descending.

    Namesakes merge as in the original; ``by_id=True`` keeps them apart (adds ``nconst``).
    """
    roles = cat.title_principals.filter(F.col("category").isin(*ACTOR_WORDS))
    per_person = count_by(roles, ["nconst"], name="n", nonnull="tconst")
    named = per_person.join(_actors(cat).select("nconst", "primaryName"), "nconst")
    keys = ["nconst", "primaryName"] if by_id else ["primaryName"]
    return named.groupBy(*keys).agg(F.sum("n").alias("film_count")).orderBy(
        F.col("film_count").desc(), *keys
    )


def i2_minor_actor_directors(cat: MovieCatalog, max_age: int = MAX_AGE, explode: bool = False) -> DataFrame:
    """Titles whose sole director (every listed director with ``explode=True``)
    is an actor/actress aged [0, max_age) at the start year."""
    crew = _crew_people(cat, "directors", explode).join(
        cat.title_basics.select("tconst", "primaryTitle", "startYear"), "tconst"
    )
    out = year_span(
        hot_key_join(crew, _actors(cat), "__person", "nconst", columns=["primaryName", "birthYear", "primaryProfession"]),
        "birthYear", "startYear", "actor_age_on_shooting", lo=0, hi=max_age,
    )
    return out.orderBy(F.col("actor_age_on_shooting").asc(), "tconst").select(
        "primaryName", "primaryTitle", "startYear", "actor_age_on_shooting", "primaryProfession"
    )


def i3_long_series(cat: MovieCatalog, min_episodes: int = MIN_EPISODES) -> DataFrame:
    episodes = exists_in(
        cat.title_episode.select("tconst", "parentTconst"),
        cat.title_basics.filter(F.col("titleType") == EPISODE), "tconst",
    )
    counts = count_by(episodes, ["parentTconst"], name="episode_count").filter(F.col("episode_count") > min_episodes)
    out = with_names(counts, cat.title_basics, "parentTconst", "tconst", how="left", columns=["primaryTitle"])
    return out.orderBy(F.col("episode_count").desc(), "parentTconst").select("primaryTitle", "episode_count")


def i4_old_living_actors(cat: MovieCatalog, current_year: int = CURRENT_YEAR, min_age: int = MIN_LIVING_AGE) -> DataFrame:
    # current_year - birthYear > min_age  <=>  birthYear < current_year - min_age (pushed to the scan)
    people = _actors(cat).filter(
        F.col("deathYear").isNull() & F.col("birthYear").isNotNull()
        & (F.col("birthYear") < current_year - min_age)
    )
    return people.withColumn("age", (F.lit(current_year) - F.col("birthYear")).cast("int")).orderBy(
        F.col("age").desc(), "nconst"
    ).select("primaryName", "age", "primaryProfession")


def i5_best_title_per_director(cat: MovieCatalog) -> DataFrame:
    """Best-rated title of each sole director (ties: title id), by director name."""
    crew = cat.title_crew.filter(single_valued("directors")).select(
        "tconst", F.col("directors").alias("nconst")
    )
    joined = crew.join(cat.title_basics.select("tconst", "primaryTitle"), "tconst").join(
        cat.title_ratings.select("tconst", "averageRating"), "tconst"
    )
    top = first_per_group(joined, ["nconst"], [F.col("averageRating").desc(), F.col("tconst").asc()])
    out = top.join(cat.name_basics.select("nconst", "primaryName"), "nconst")
    return out.orderBy("primaryName", "nconst").select("primaryName", "primaryTitle")


def _rated_movies(cat: MovieCatalog, genre: str | None = None) -> DataFrame:
    movies = _movies(cat).filter(F.col("primaryTitle").isNotNull() & F.col("startYear").isNotNull())
    if genre:
        movies = movies.filter(F.col("genres").contains(genre))
    ratings = cat.title_ratings.filter(F.col("averageRating").isNotNull())
    return movies.select("tconst", "primaryTitle", "startYear").join(ratings.select("tconst", "averageRating"), "tconst")


def i6_top_dramas_per_year(cat: MovieCatalog, genre: str = DRAMA, n: int = TOP_DRAMAS) -> DataFrame:
    above = above_group_mean(_rated_movies(cat, genre), ["startYear"], "averageRating")
    top = top_n_per_group(above, ["startYear"], [F.col("averageRating").desc(), F.col("tconst").asc()], n)
    return top.orderBy(F.col("startYear").desc(), F.col("averageRating").desc(), "tconst").select(
        "primaryTitle", "startYear", "averageRating"
    )


def i7_movies_above_year_mean(cat: MovieCatalog) -> DataFrame:
    above = above_group_mean(_rated_movies(cat), ["startYear"], "averageRating", mean_name="avg_year_rating")
    return above.orderBy(F.col("averageRating").desc(), "tconst").select(
        "primaryTitle", "startYear", "averageRating", "avg_year_rating"
    )


# ----------------------------------------------------------------- M1..M6


def _renamed(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"primaryTitle": "filmName", "directors": "director_ids", "primaryName": "Names"})


def m1_titles_with_single_director(cat: MovieCatalog) -> DataFrame:
    crew = cat.title_crew.filter(single_valued("directors"))
    titles = cat.title_basics.filter(F.col("tconst").isNotNull()).join(crew, "tconst")
    out = with_names(titles.select("tconst", "primaryTitle", "directors"), cat.name_basics, "directors", "nconst",
                     how="left", columns=["primaryName"])
    return _renamed(out.select("primaryTitle", "directors", "primaryName"))


def m2_one_title_per_named_director(cat: MovieCatalog, name_part: str = NAME_PART, explode: bool = False) -> DataFrame:
    """One title per director whose name contains ``name_part`` (first by title id).

    As in the original only single-director titles match; ``explode=True``
    also credits directors listed with others.
    """
    crew = _crew_people(cat, "directors", explode).filter(F.col("__person").isNotNull())
    crew = crew.select("tconst", F.col("__person").alias("directors"))
    people = cat.name_basics.filter(F.col("primaryName").contains(name_part))
    joined = hot_key_join(crew, people, "directors", "nconst", columns=["primaryName"]).join(
        cat.title_basics.select("tconst", "primaryTitle"), "tconst"
    )
    first = first_per_group(joined, ["directors"], [F.col("tconst").asc()])
    return _renamed(first.select("primaryTitle", "directors", "primaryName"))


def m3_lived_exactly(cat: MovieCatalog, years: int = LIFESPAN) -> DataFrame:
    people = cat.name_basics.filter(F.col("birthYear").isNotNull() & F.col("deathYear").isNotNull())
    people = year_span(people, "birthYear", "deathYear", "ageAtDeath", lo=years, hi=years + 1)
    numbered = number_rows(
        people.select("nconst", "primaryName", "birthYear", "deathYear", "ageAtDeath"),
        ["deathYear", "nconst"], keys=["ageAtDeath"], name="death_rank",
    )
    return numbered.select(
        F.col("primaryName").alias("name"), F.col("birthYear").alias("birth"), F.col("deathYear").alias("Death"),
        "ageAtDeath", "death_rank",
    )


def m4_music_department_groups(cat: MovieCatalog, profession_part: str = PROFESSION_PART) -> DataFrame:
    """Names per full profession string containing ``profession_part`` (in order, one row each)."""
    people = cat.name_basics.filter(F.col("primaryProfession").contains(profession_part)).select(
        "primaryProfession", "primaryName", "nconst"
    )
    lists = group_list(people, ["primaryProfession"], "primaryName", "fullName", order=["primaryName", "nconst"])
    return lists.withColumnRenamed("primaryProfession", "containsMusic_Department")


def m5_akas_per_language(cat: MovieCatalog) -> DataFrame:
    akas = cat.title_akas.filter(
        F.col("title").isNotNull() & F.col("region").isNotNull() & F.col("language").isNotNull()
    )
    return count_by(akas, ["language"], name="original_title_count").orderBy(
        F.col("original_title_count").desc(), "language"
    )


def m6_popular_titles_of_year(
    cat: MovieCatalog, year: int = POPULAR_YEAR, min_votes: int = POPULAR_VOTES, top: int | None = None
) -> DataFrame:
    """Titles of ``year`` with more than ``min_votes`` votes, numbered by votes.

    All rows are kept, as in the original (whose column is nevertheless named
    ``top-20``); ``top=N`` keeps only the first N, computed as a top-N.
    """
    titles = cat.title_basics.filter(F.col("startYear") == year).select("tconst", "primaryTitle", "startYear")
    rated = titles.join(cat.title_ratings.filter(F.col("numVotes") > min_votes).select("tconst", "numVotes"), "tconst")
    numbered = number_rows(rated, [F.col("numVotes").desc(), F.col("tconst").asc()], name="top-20", limit=top)
    return numbered.select("primaryTitle", "startYear", "numVotes", "`top-20`")


# ----------------------------------------------------------------- S1..S6


def s1_most_active_actors(cat: MovieCatalog, category: str = ACTOR_CATEGORY) -> DataFrame:
    roles = exists_in(cat.title_principals.filter(F.col("category") == category), _movies(cat), "tconst")
    counts = count_by(roles, ["nconst"], name="film_count", distinct="tconst")
    out = counts.join(cat.name_basics.select("nconst", "primaryName"), "nconst", "left")
    return out.orderBy(F.col("film_count").desc(), "nconst").select("primaryName", "film_count")


def s2_genre_years(cat: MovieCatalog) -> DataFrame:
    genres = explode_list(_movies(cat).select("startYear", "genres"), "genres", "genre", keep=["startYear"])
    return count_by(genres, ["startYear", "genre"]).orderBy(
        F.col("startYear").desc(), F.col("count").desc(), "genre"
    )


def s3_top_regions(cat: MovieCatalog) -> DataFrame:
    akas = cat.title_akas.filter(F.col("region").isNotNull())
    return count_by(akas, ["region"], name="unique_titles", distinct="titleId").orderBy(
        F.col("unique_titles").desc(), "region"
    )


def s4_top_series(cat: MovieCatalog, min_avg_votes: float = SERIES_MIN_AVG_VOTES) -> DataFrame:
    rated = cat.title_episode.select("tconst", "parentTconst").join(cat.title_ratings, "tconst")
    stats = mean_by(
        rated, ["parentTconst"], {"avg_rating": "averageRating", "avg_votes": "numVotes"},
        count_name="episode_count", having=F.col("avg_votes") > min_avg_votes,
    )
    out = stats.join(cat.title_basics.select("tconst", "primaryTitle"), stats["parentTconst"] == F.col("tconst"))
    return out.orderBy(F.col("avg_rating").desc(), "parentTconst").select(
        "primaryTitle", "avg_rating", "avg_votes", "episode_count"
    )


def s5_top5_per_genre(cat: MovieCatalog, min_votes: int = POPULAR_VOTES, n: int = TOP_PER_GENRE) -> DataFrame:
    # join first, explode after: the join ships one row per title, not per genre
    titles = cat.title_basics.select("tconst", "primaryTitle", "startYear", "genres")
    rated = titles.join(cat.title_ratings.filter(F.col("numVotes") > min_votes), "tconst")
    genres = _genres(rated, ["tconst", "primaryTitle", "startYear", "averageRating", "numVotes"])
    top = top_n_per_group(genres, ["genre"], [F.col("averageRating").desc(), F.col("tconst").asc()], n)
    return top.select("genre", "primaryTitle", "averageRating", "numVotes", "startYear")


def s6_earliest_per_genre(cat: MovieCatalog) -> DataFrame:
    """Earliest title per genre (ties: title id) with its directors' names, one row each.

    A genre whose earliest title has no directors drops out, as in the original.
    """
    genres = _genres(
        cat.title_basics.filter(F.col("startYear").isNotNull() & (F.col("startYear") > 0)).select(
            "tconst", "primaryTitle", "startYear", "runtimeMinutes", "genres"
        ),
        ["tconst", "primaryTitle", "startYear", "runtimeMinutes"],
    )
    first = first_per_group(genres, ["genre"], [F.col("startYear").asc(), F.col("tconst").asc()])
    # one title per genre is left: its id, then its directors' ids, filter the scans before any shuffle
    crew = late_lookup(first, cat.title_crew, "tconst", "tconst", columns=["directors"])
    directors = explode_list(crew, "directors", "director")
    named = late_lookup(directors, cat.name_basics, "director", "nconst", how="left", columns=["primaryName"])
    keys = ["genre", "primaryTitle", "startYear", "runtimeMinutes"]
    lists = group_list(named.select(*keys, "primaryName", "director"), keys, "primaryName", "director",
                       order=["primaryName", "director"])
    return lists.select("genre", "primaryTitle", "startYear", "position", "director").orderBy("genre", "position")


# ------------------------------------------------------------- ST1..ST6


def st1_table_counts(cat: MovieCatalog) -> DataFrame:
    return table_counts(cat.tables())


def st2_birth_years(cat: MovieCatalog, min_year: int = MIN_STAT_YEAR) -> DataFrame:
    people = cat.name_basics.filter(F.col("birthYear").isNotNull() & (F.col("birthYear") >= min_year))
    return count_by(people, ["birthYear"]).orderBy("birthYear")


def st3_release_years(cat: MovieCatalog, min_year: int = MIN_STAT_YEAR) -> DataFrame:
    titles = cat.title_basics.filter(F.col("startYear").isNotNull() & (F.col("startYear") >= min_year))
    return count_by(titles, ["startYear"]).orderBy("startYear")


def st4_movie_count(cat: MovieCatalog) -> DataFrame:
    return row_count(_movies(cat))


def st5_movies_per_genre(cat: MovieCatalog) -> DataFrame:
    genres = explode_list(_movies(cat).select("tconst", "genres"), "genres", "genre", keep=["tconst"])
    return count_by(genres, ["genre"])


# Rating bin edges 1..10; the last bin (9-10) is closed on both ends.
RATING_EDGES = tuple(range(1, 11))


def st6_movies_per_rating_bin(cat: MovieCatalog) -> DataFrame:
    rated = exists_in(cat.title_ratings.select("tconst", "averageRating"), _movies(cat), "tconst")
    binned = rated.select(bin_label("averageRating", RATING_EDGES).alias("RatingRange"))
    return count_by(binned, ["RatingRange"]).orderBy("RatingRange")


# ----------------------------------------------------------------- P1, X1

# Preview order per table (its id columns).
PREVIEW_KEYS: dict[str, list[str]] = {
    "name_basics": ["nconst"],
    "title_akas": ["titleId", "ordering"],
    "title_basics": ["tconst"],
    "title_crew": ["tconst"],
    "title_episode": ["tconst"],
    "title_principals": ["tconst", "ordering"],
    "title_ratings": ["tconst"],
}


def p1_previews(cat: MovieCatalog, n: int = 5) -> dict[str, DataFrame]:
    return {name: preview(df, n, PREVIEW_KEYS[name]) for name, df in cat.tables().items()}


def s_results(cat: MovieCatalog) -> dict[str, DataFrame]:
    """The six S results under their export names."""
    return {
        "most_active_actors": s1_most_active_actors(cat),
        "genre_years": s2_genre_years(cat),
        "top_regions": s3_top_regions(cat),
        "top_series": s4_top_series(cat),
        "top5_per_genre": s5_top5_per_genre(cat),
        "earliest_per_genre": s6_earliest_per_genre(cat),
    }


def x1_export(cat: MovieCatalog, out_dir: str) -> dict[str, Published]:
    """Publish the six S results as headered CSV directories under ``out_dir``:
    all of them or, if any fails, none. Each path carries its ``rows``."""
    return export_csv(s_results(cat), out_dir)


QUESTIONS = {
    "A1": a1_german_region_genres,
    "A2": a2_german_movies_from_year,
    "A3": a3_writers_with_avg_rating_from,
    "A4": a4_countries_longest_series,
    "A5": a5_episodes_with_rating_from,
    "A6": a6_titles_with_same_director_writer,
    "A7": a7_avg_title_type_runtime,
    "I1": i1_actor_film_counts,
    "I2": i2_minor_actor_directors,
    "I3": i3_long_series,
    "I4": i4_old_living_actors,
    "I5": i5_best_title_per_director,
    "I6": i6_top_dramas_per_year,
    "I7": i7_movies_above_year_mean,
    "M1": m1_titles_with_single_director,
    "M2": m2_one_title_per_named_director,
    "M3": m3_lived_exactly,
    "M4": m4_music_department_groups,
    "M5": m5_akas_per_language,
    "M6": m6_popular_titles_of_year,
    "S1": s1_most_active_actors,
    "S2": s2_genre_years,
    "S3": s3_top_regions,
    "S4": s4_top_series,
    "S5": s5_top5_per_genre,
    "S6": s6_earliest_per_genre,
    "ST1": st1_table_counts,
    "ST2": st2_birth_years,
    "ST3": st3_release_years,
    "ST4": st4_movie_count,
    "ST5": st5_movies_per_genre,
    "ST6": st6_movies_per_rating_bin,
}
