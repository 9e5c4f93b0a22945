"""The questions on the seven-table catalog against hand-derived fixture answers."""

from __future__ import annotations

import pytest

from marquee.plans import movies as q


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]


def as_set(df, *cols):
    return sorted(rows(df, *cols), key=repr)


def test_a1(catalog):
    assert as_set(q.a1_german_region_genres(catalog)) == [("Comedy", 1), ("Drama", 4)]


def test_a2(catalog):
    got = rows(q.a2_german_movies_from_year(catalog, 2010), "tconst", "title", "year")
    assert got[0] == ("tt03", "Gamma3", 2011)
    assert sorted(got[1:]) == [("tt01", "Alfa", 2024), ("tt02", "Beta2", 2024)]


def test_a3_namesakes_merge(catalog):
    got = rows(q.a3_writers_with_avg_rating_from(catalog, 8.1))
    assert [w for w, _ in got] == ["Benedict Roe"]
    assert got[0][1] == pytest.approx(8.55, abs=1e-5)
    # below the border, namesake "Ann Lee" is one writer with mean 6.0
    low = dict(rows(q.a3_writers_with_avg_rating_from(catalog, 5.0)))
    assert low["Ann Lee"] == pytest.approx(6.0, abs=1e-6)


def test_a4(catalog):
    assert rows(q.a4_countries_longest_series(catalog)) == [("DE", 3), ("FR", None)]


def test_a5_float_threshold_keeps_equal_rating(catalog):
    assert rows(q.a5_episodes_with_rating_from(catalog, 8.1), "episodeTitle") == [("Ep1",)]


def test_a6(catalog):
    assert as_set(q.a6_titles_with_same_director_writer(catalog), "tconst", "authorName") == [
        ("tt01", "Ann Lee"), ("tt05", "Benedict Roe"), ("tt08", "Dee Fox"),
    ]


def test_a7(catalog):
    assert as_set(q.a7_avg_title_type_runtime(catalog)) == [
        ("movie", 97.0), ("tvEpisode", 45.0), ("tvSeries", 45.0),
    ]


def test_i1(catalog):
    assert rows(q.i1_actor_film_counts(catalog)) == [("Ann Lee", 3), ("Benedict Roe", 2)]


def test_i2(catalog):
    assert rows(q.i2_minor_actor_directors(catalog), "primaryName", "primaryTitle", "actor_age_on_shooting") == [
        ("Ann Lee", "Delta", 10), ("Dee Fox", "Theta", 14),
    ]


def test_i3(catalog):
    assert rows(q.i3_long_series(catalog, 1)) == [("Delta", 2)]
    assert rows(q.i3_long_series(catalog)) == []


def test_i4(catalog):
    assert rows(q.i4_old_living_actors(catalog, 2025), "primaryName", "age") == [("Benedict Roe", 95)]


def test_i5(catalog):
    assert rows(q.i5_best_title_per_director(catalog)) == [
        ("Ann Lee", "Alpha"), ("Benedict Roe", "Iota"), ("Dee Fox", "Theta"),
    ]


def test_i6(catalog):
    assert rows(q.i6_top_dramas_per_year(catalog), "primaryTitle", "startYear") == [("Beta", 2024)]


def test_i7(catalog):
    got = as_set(q.i7_movies_above_year_mean(catalog))
    assert [(t, y) for t, y, _, _ in got] == [("Beta", 2024), ("Iota", 2024)]
    assert all(m == pytest.approx(8.25) for *_, m in got)


def test_m1(catalog):
    got = as_set(q.m1_titles_with_single_director(catalog))
    assert [t for t, _, _ in got] == ["Alpha", "Delta", "Ep1", "Eta", "Iota", "Theta"]
    assert ("Eta", "nm9", None) in got


def test_m2_deterministic_survivor(catalog):
    assert rows(q.m2_one_title_per_named_director(catalog)) == [("Ep1", "nm2", "Benedict Roe")]


def test_m3(catalog):
    assert sorted(rows(q.m3_lived_exactly(catalog, 50), "death_rank", "name")) == [(1, "Eli Orr"), (2, "Ann Lee")]


def test_m4(catalog):
    got = as_set(q.m4_music_department_groups(catalog), "containsMusic_Department", "position", "fullName")
    assert got == [("actor,music_department", 1, "Benedict Roe"), ("music_department", 1, "Cy Poe")]


def test_m5(catalog):
    assert rows(q.m5_akas_per_language(catalog)) == [("de", 4), ("fr", 1)]


def test_m6(catalog):
    got = sorted(rows(q.m6_popular_titles_of_year(catalog, 2024), "top-20", "primaryTitle", "numVotes"))
    assert got == [(1, "Iota", 30000), (2, "Alpha", 20000), (3, "Beta", 15000)]


def test_s1(catalog):
    assert as_set(q.s1_most_active_actors(catalog)) == sorted(
        [("Ann Lee", 1), ("Benedict Roe", 1), (None, 1)], key=repr
    )


def test_s2(catalog):
    assert rows(q.s2_genre_years(catalog)) == [(2024, "Drama", 3), (2024, "Comedy", 2), (None, "Comedy", 1)]


def test_s3(catalog):
    assert rows(q.s3_top_regions(catalog)) == [("DE", 4), ("FR", 1)]


def test_s4(catalog):
    got = rows(q.s4_top_series(catalog, 900))
    assert got == [("Delta", pytest.approx(8.75), pytest.approx(999.5), 2)]
    assert rows(q.s4_top_series(catalog)) == []


def test_s5_ties_by_id(catalog):
    got = q.s5_top5_per_genre(catalog)
    by_genre = {}
    for g, t, r in rows(got, "genre", "primaryTitle", "averageRating"):
        by_genre.setdefault(g, []).append((r, t))
    ordered = {g: [t for _, t in sorted(v, key=lambda x: -x[0])] for g, v in by_genre.items()}
    assert ordered["Comedy"] == ["Beta", "Iota", "Eta"]
    assert ordered["Drama"] == ["Beta", "Alpha"]


def test_s6(catalog):
    assert rows(q.s6_earliest_per_genre(catalog), "genre", "primaryTitle", "startYear", "position", "director") == [
        ("Comedy", "Ep2", 2001, 1, "Ann Lee"),
        ("Comedy", "Ep2", 2001, 2, "Benedict Roe"),
        ("Drama", "Delta", 2000, 1, "Ann Lee"),
    ]


def test_st1(catalog):
    assert dict(rows(q.st1_table_counts(catalog))) == {
        "title_basics": 9, "title_ratings": 8, "title_crew": 9, "name_basics": 6,
        "title_principals": 6, "title_akas": 7, "title_episode": 2,
    }


def test_st2(catalog):
    assert rows(q.st2_birth_years(catalog)) == [(1930, 1), (1974, 1), (1990, 1), (2010, 1)]


def test_st3(catalog):
    assert rows(q.st3_release_years(catalog)) == [(2000, 2), (2001, 1), (2011, 1), (2024, 4)]


def test_st4(catalog):
    assert rows(q.st4_movie_count(catalog)) == [(6,)]


def test_st5(catalog):
    assert as_set(q.st5_movies_per_genre(catalog)) == [("Comedy", 3), ("Drama", 3)]


def test_st6_closed_last_bin(catalog):
    assert rows(q.st6_movies_per_rating_bin(catalog)) == [("1-2", 1), ("7-8", 1), ("8-9", 1), ("9-10", 3)]


def test_p1(catalog):
    previews = q.p1_previews(catalog, 2)
    assert set(previews) == set(catalog.tables())
    assert rows(previews["title_basics"], "tconst") == [("tt01",), ("tt02",)]


def test_every_question_registered(catalog):
    assert sorted(q.QUESTIONS) == sorted(
        [f"A{i}" for i in range(1, 8)] + [f"I{i}" for i in range(1, 8)] + [f"M{i}" for i in range(1, 7)]
        + [f"S{i}" for i in range(1, 7)] + [f"ST{i}" for i in range(1, 7)]
    )
    for fn in q.QUESTIONS.values():
        fn(catalog).schema  # every plan analyzes


def test_options_keep_namesakes_apart(catalog):
    got = rows(q.a3_writers_with_avg_rating_from(catalog, 8.1, by_id=True), "nconst", "writer")
    assert sorted(got) == [("nm1", "Ann Lee"), ("nm2", "Benedict Roe")]  # nm1 alone averages 8.5
    counts = sorted(rows(q.i1_actor_film_counts(catalog, by_id=True)))
    assert counts == [("nm1", "Ann Lee", 2), ("nm2", "Benedict Roe", 2), ("nm3", "Ann Lee", 1)]


def test_options_explode_crew_lists(catalog):
    # with every listed director credited, Beta (tt02, "nm1,nm2") is Benedict's first title
    assert rows(q.m2_one_title_per_named_director(catalog, explode=True)) == [("Beta", "nm2", "Benedict Roe")]
    assert rows(q.i2_minor_actor_directors(catalog, explode=True), "primaryName", "primaryTitle") == [
        ("Ann Lee", "Delta"), ("Dee Fox", "Theta"),
    ]


def test_m6_top_n(catalog):
    got = sorted(rows(q.m6_popular_titles_of_year(catalog, 2024, top=2), "top-20", "primaryTitle"))
    assert got == [(1, "Iota"), (2, "Alpha")]
