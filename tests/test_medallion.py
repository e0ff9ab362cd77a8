"""Raw files in their native formats, through bronze, silver, spine and gold, to queries on the star."""

import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reelspark.operators.quality import split_quarantine
from reelspark.plans import bronze, finance, genres, gold, movies, people, silver, spine, temporal
from reelspark.plans import star as star_jobs
from reelspark.sources import readers, writers

DAY = "2024-03-09"

MOVIELENS = {
    "movies": "movieId,title,genres\n"
    "1,Toy Story (1995),Adventure|Animation|Children|Comedy|Fantasy\n"
    "2,No Year,(no genres listed)\n"
    "3,Dune (1984),Sci-Fi\n"
    '4,"Big, The (2001)",Drama\n',
    "links": "movieId,imdbId,tmdbId\n1,114709,862\n2,,\n3,10872600,\n4,0000009,777\n",
    "ratings": "userId,movieId,rating,timestamp\n1,1,3.5,10\n2,1,4.0,11\n1,3,5.0,12\n",
    "tags": 'userId,movieId,tag,timestamp\n1,1,"  ",5\n1,3," noir ",6\n',
}
IMDB = {
    "title.basics": [
        "tconst titleType primaryTitle originalTitle isAdult startYear endYear runtimeMinutes genres",
        r"tt0114709 movie Toy_Story Toy_Story 0 1995 \N 81 Adventure,Animation,Comedy,Family,Fantasy",
        r'tt0000005 movie "Open_only Otra 0 1991 \N \N \N',
        r"tt0000006 tvSeries Show Show 0 2000 2005 30 Drama",
        r"tt10872600 movie Dune Dune 0 \N \N 137 Sci-Fi",
    ],
    "title.ratings": ["tconst averageRating numVotes", "tt0114709 8.3 1000000", "tt10872600 6.3 bad"],
    "name.basics": [
        "nconst primaryName birthYear deathYear primaryProfession knownForTitles",
        r"nm1 Tom_Hanks 1956 \N actor,producer tt0114709,tt0000005",
        r"nm2 No_Birth \N \N \N \N",
    ],
    "title.principals": [
        "tconst ordering nconst category job characters",
        r'tt0114709 1 nm1 actor \N ["Woody"]',
        r"tt0114709 7 nm1 producer executive \N",
        r"tt0114709 2 nm2 actor \N \N",
        r"tt0000006 1 nm1 actor \N \N",
    ],
    "title.crew": ["tconst directors writers", r"tt0114709 nm5,nm6 \N"],
    "title.akas": ["titleId ordering title region language types attributes isOriginalTitle", r"tt0114709 1 x US \N \N \N 1"],
    "title.episode": ["tconst parentTconst seasonNumber episodeNumber", r"tt9 tt0000006 1 \N"],
}
TMDB = [
    {"id": 862, "title": "Toy Story", "original_title": "Toy Story", "overview": "toys", "poster_path": "/p.jpg", "release_date": "1995-11-22", "popularity": 9.5, "vote_average": 7.9, "vote_count": 10, "genre_ids": [16, 99999], "original_language": "en", "adult": False, "video": False, "budget": 30000000, "revenue": 2923706026},
    {"id": 11224, "title": "Cinderella", "original_title": "Cinderella", "release_date": "", "genre_ids": [10751, 14], "poster_path": None, "vote_average": 7.045},
    {"id": 11224, "title": "Cinderella", "original_title": "Cinderella", "release_date": "", "genre_ids": [10751, 14], "poster_path": None, "vote_average": 7.045},
]
RT = [
    {"rt_id": "dune", "slug": "dune_1984", "title": "Dune!", "tomatometer_score": 40, "audience_score": 65, "mpaa_rating": "PG-13", "box_office": "$30.9M", "release_year": 1985, "director": "David Lynch", "genre": "Sci-Fi, Kids & Family"},
    {"rt_id": "dune", "slug": "dune_2021", "title": "Dune", "tomatometer_score": 83, "release_year": 2021, "director": "A B, C D"},
    {"rt_id": "toy_story", "slug": "toy_story", "title": "TOY STORY", "tomatometer_score": 100, "audience_score": 92, "box_office": "n/a", "release_year": 1995, "genre": ""},
]


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for source in ("movielens", "imdb", "tmdb", "rotten_tomatoes"):
        (root / source / DAY).mkdir(parents=True)
        (root / source / "2023-01-01").mkdir()
        (root / source / "_tmp").mkdir()
    for name, text in MOVIELENS.items():
        (root / "movielens" / DAY / f"{name}.csv").write_text(text)
    for name, lines in IMDB.items():
        text = "\n".join("\t".join(f.replace("_", " ") for f in line.split(" ")) for line in lines) + "\n"
        (root / "imdb" / DAY / f"{name}.tsv").write_text(text)
    for i, part in enumerate([TMDB[:2], TMDB[2:]], 1):
        (root / "tmdb" / DAY / f"movies_{i:04d}.ndjson").write_text("\n".join(json.dumps(r) for r in part))
    (root / "rotten_tomatoes" / DAY / "movies_0001.ndjson").write_text("\n".join(json.dumps(r) for r in RT))
    return str(root)


@pytest.fixture(scope="module")
def lake(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    bronze.ingest_all(spark, raw, root)
    return root


@pytest.fixture(scope="module")
def tables(spark, lake):
    silver.refine_all(spark, lake, DAY)
    spine.resolve_all(spark, lake, DAY)
    names = {
        "ml": "movielens/movies",
        "ml_ratings": "movielens/ratings_agg",
        "ml_tags": "movielens/tags",
        "imdb": "imdb/title_basics",
        "imdb_names": "imdb/name_basics",
        "imdb_crew": "imdb/title_crew",
        "tmdb": "tmdb/movies",
        "rt": "rotten_tomatoes/movies",
        "spine": "entity_spine",
    }
    return {short: readers.read_table(spark, f"{lake}/silver/{name}") for short, name in names.items()}


@pytest.fixture(scope="module")
def star(spark, lake, tables):
    gold.publish_all(spark, lake, DAY)
    return star_jobs.read_star(spark, f"{lake}/gold")


def test_newest_delivery_is_read(spark, raw):
    assert readers.input_folder(spark, f"{raw}/imdb").endswith(f"/imdb/{DAY}")
    assert readers.input_folder(spark, f"{raw}/imdb", "2023-01-01").endswith("/imdb/2023-01-01")
    with pytest.raises(FileNotFoundError):
        readers.input_folder(spark, f"{raw}/nothing")


def test_days_are_kept_and_replaced_one_by_one(spark, raw, tmp_path):
    import shutil

    old = str(tmp_path / "raw")
    shutil.copytree(raw, old)
    for source in ("movielens", "imdb", "tmdb", "rotten_tomatoes"):
        shutil.copytree(f"{raw}/{source}/{DAY}", f"{old}/{source}/2023-01-01", dirs_exist_ok=True)
    lake, path = str(tmp_path / "lake"), f"{tmp_path}/lake/bronze/tmdb/movies"
    bronze.ingest_all(spark, old, lake, "2023-01-01")
    bronze.ingest_all(spark, old, lake, DAY)
    per_day = lambda: {str(r.ingest_date): r.n for r in readers.read_table(spark, path).groupBy("ingest_date").agg(F.count("*").alias("n")).collect()}
    assert per_day() == {"2023-01-01": 2, DAY: 2}
    with open(f"{old}/tmdb/2023-01-01/movies_0009.ndjson", "w") as f:
        f.write(json.dumps({"id": 77, "title": "Late"}))
    kept = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "lake/bronze/tmdb/movies" / f"ingest_date={DAY}").glob("*.parquet")}
    bronze.ingest_all(spark, old, lake, "2023-01-01")
    assert per_day() == {"2023-01-01": 3, DAY: 2}
    assert kept == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "lake/bronze/tmdb/movies" / f"ingest_date={DAY}").glob("*.parquet")}
    newest, given = readers.read_day(spark, path, "ingest_date"), readers.read_day(spark, path, "ingest_date", "2023-01-01")
    assert newest.count() == 2 and given.count() == 3 and given.where("id = 77").count() == 1
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    silver.refine_all(spark, lake, DAY)
    assert readers.read_table(spark, f"{lake}/silver/tmdb/movies").count() == 2


def test_bronze(spark, lake):
    def read(name):
        return readers.read_table(spark, f"{lake}/bronze/{name}")

    assert read("tmdb/movies").count() == 2
    assert read("rotten_tomatoes/movies").count() == 3
    assert {r.revenue for r in read("tmdb/movies").collect()} == {2923706026, None}
    basics = {r.tconst: r for r in read("imdb/title_basics").collect()}
    assert basics["tt0000005"].primaryTitle == '"Open only' and basics["tt0000005"].startYear == "1991"
    assert basics["tt0000005"].genres is None and "ingest_date" in read("imdb/title_akas").columns
    assert read("imdb/title_episode").first().episodeNumber is None


def test_rt_key_choice(spark, raw):
    by_id = bronze.read_rotten_tomatoes(spark, f"{raw}/rotten_tomatoes/{DAY}", DAY, key="rt_id")
    assert by_id.count() == 2


def test_optional_sources(spark, lake):
    found = readers.read_present(spark, [f"{lake}/bronze/tmdb/movies", f"{lake}/bronze/missing"])
    assert len(found) == 1
    with pytest.raises(FileNotFoundError):
        readers.read_present(spark, [f"{lake}/bronze/missing"])


def test_silver(tables):
    ml = {r.ml_id: r for r in tables["ml"].collect()}
    assert (ml[1].title, ml[1].year, len(ml[1].genres_array)) == ("Toy Story", 1995, 5)
    assert (ml[2].title, ml[2].year, ml[2].genres_array) == ("No Year", None, None)
    assert ml[4].title == "Big, The"
    assert {(r.ml_id, r.ml_avg_rating, r.ml_rating_count) for r in tables["ml_ratings"].collect()} == {(1, 3.75, 2), (3, 5.0, 1)}
    assert [r.tag for r in tables["ml_tags"].collect()] == ["noir"]
    imdb = {r.imdb_id: r for r in tables["imdb"].collect()}
    assert set(imdb) == {"tt0114709", "tt0000005", "tt10872600"}
    assert (imdb["tt0114709"].year, imdb["tt0114709"].runtime_minutes) == (1995, 81)
    assert imdb["tt10872600"].year is None and imdb["tt0000005"].genres_array is None
    names = {r.person_id: r for r in tables["imdb_names"].collect()}
    assert names["nm1"].primary_profession == "actor" and names["nm1"].known_for_titles == ["tt0114709", "tt0000005"]
    assert names["nm2"].birth_year is None
    crew = tables["imdb_crew"].first()
    assert crew.directors == ["nm5", "nm6"] and crew.writers is None
    tmdb = {r.tmdb_id: r for r in tables["tmdb"].collect()}
    assert tmdb[862].poster_url == "https://image.tmdb.org/t/p/w500/p.jpg" and tmdb[862].year == 1995
    assert tmdb[862].genres_array == ["Animation", "Unknown(99999)"]
    assert tmdb[11224].year is None and tmdb[11224].poster_url is None
    rt = {r.rt_slug: r for r in tables["rt"].collect()}
    assert rt["dune_1984"].divisive_score == 25 and rt["dune_1984"].box_office_revenue == 30_900_000
    assert rt["dune_2021"].divisive_score is None and rt["dune_2021"].directors == ["A B", "C D"]
    assert rt["toy_story"].genres_array is None and rt["toy_story"].box_office_revenue is None


def test_spine(tables):
    rows = tables["spine"].orderBy("movie_id").collect()
    assert [r.movie_id for r in rows] == list(range(1, len(rows) + 1))
    by_ml = {r.ml_id: r for r in rows if r.ml_id}
    assert (by_ml[1].imdb_id, by_ml[1].tmdb_id, by_ml[1].rt_slug, by_ml[1].rt_match_method) == ("tt0114709", 862, "toy_story", "title_year_exact")
    # 1984 against 1985: only the fuzzy pass may match, and not the remake of 2021.
    assert (by_ml[3].imdb_id, by_ml[3].rt_slug, by_ml[3].rt_match_method) == ("tt10872600", "dune_1984", "title_year_fuzzy")
    assert (by_ml[2].imdb_id, by_ml[2].tmdb_id, by_ml[2].rt_match_method) == (None, None, None)
    assert {r.rt_slug for r in rows if r.rt_match_method == "unmatched"} == {"dune_2021"}
    assert {r.imdb_id for r in rows if r.ml_id is None and r.imdb_id} == {"tt0000005"}
    assert {r.tmdb_id for r in rows if r.ml_id is None and r.tmdb_id} == {11224}
    order = [0 if r.imdb_id else 1 if r.tmdb_id else 2 if r.ml_id else 3 for r in rows]
    assert order == sorted(order)


def test_doubled_quotes_and_commas_inside_quotes(spark, tmp_path):
    (tmp_path / "movies.csv").write_text('movieId,title,genres\n1,"""Great Performances"" Cats, The (1998)",Musical\n2,Plain (1999),Drama|War\n')
    rows = readers.read_csv(spark, f"{tmp_path}/movies.csv", "movieId int, title string, genres string").orderBy("movieId").collect()
    assert [tuple(r) for r in rows] == [(1, '"Great Performances" Cats, The (1998)', "Musical"), (2, "Plain (1999)", "Drama|War")]


def test_repeated_source_rows_give_one_film(spark):
    spine_rows = spark.createDataFrame([(1, 10, "tt1", 20, "s")], "movie_id bigint, ml_id int, imdb_id string, tmdb_id int, rt_slug string")
    imdb = spark.createDataFrame([("tt1", t, t, 1999, 90, 0) for t in ("B", "A")], "imdb_id string, primary_title string, original_title string, year int, runtime_minutes int, is_adult int")
    ml = spark.createDataFrame([(10, "M", 1999), (10, "N", 1999)], "ml_id int, title string, year int")
    tmdb = spark.createDataFrame([], "tmdb_id int, title string, year int, plot_summary string, poster_url string, backdrop_url string, popularity double")
    rt = spark.createDataFrame([], "rt_slug string, title string, release_year int, mpaa_rating string")
    assert [r.title for r in gold.build_dim_movie(spine_rows, imdb, ml, tmdb, rt).collect()] == ["A"]
    films = spark.createDataFrame([(1, "x"), (None, "y")], "id int, title string")
    details = spark.createDataFrame([(1, 5, None), (1, 6, 7), (None, 1, 1)], "id int, budget bigint, revenue bigint")
    got = {r.title: (r.budget, r.revenue) for r in bronze.enrich_box_office(films, details).collect()}
    assert got == {"x": (5, 0), "y": (None, None)}


def test_a_film_with_many_rows_spans_files(spark, tmp_path):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("movie_id"), F.col("id").cast("string").alias("person_id"), F.lit(1).alias("ordering"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_table(rows.repartition(8), f"{tmp_path}/t", sort_by=star_jobs.layout_keys("bridge_movie_cast"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/t").groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_gold(spark, star, tables):
    films = {r.title: r for r in star.dim_movie.collect()}
    assert (films["Toy Story"].runtime, films["Toy Story"].popularity, films["Toy Story"].is_adult) == (81, 9.5, 0)
    assert films["Dune"].mpaa_rating == "PG-13" or films["Dune"].rt_slug == "dune_2021"
    facts = {r.movie_id: r for r in star.fact_movie_metrics.collect()}
    toy = facts[films["Toy Story"].movie_id]
    assert (toy.ml_avg_rating, toy.imdb_rating, toy.revenue, toy.divisive_score, toy.time_id) == (3.75, 8.3, 2923706026, 8, 20240309)
    fixed = spark.createDataFrame([(1, "20240115")], "m bigint, d string").select(gold.metric_id(F.col("m"), F.col("d")))
    assert fixed.first()[0] == 5426770723622455472
    cast = star.bridge_movie_cast.orderBy("ordering").collect()
    assert [(c.person_id, c.ordering, c.category) for c in cast] == [("nm1", 1, "actor"), ("nm1", 7, "producer")]
    assert cast[0].characters == '["Woody"]'
    genre_names = [r.genre_name for r in star.dim_genre.orderBy("genre_id").collect()]
    assert genre_names == sorted(genre_names) and "Science Fiction" in genre_names and "Unknown(99999)" in genre_names
    assert [r.genre_id for r in star.dim_genre.orderBy("genre_id").collect()] == list(range(1, len(genre_names) + 1))
    assert star.dim_time.count() == 29_585
    sunday = star.dim_time.where("time_id = 20240310").first()
    assert (sunday.day_of_week, sunday.week_of_year, sunday.quarter) == (1, 10, 1)


def test_star_queries_on_text_ids(star):
    assert finance.top_revenue(star).first().title == "Toy Story"
    assert people.top_prolific(star).first().person_id == "nm1"
    history = people.person_detail(star, "nm1").collect()
    assert len(history) == 2 and {h.category for h in history} == {"actor", "producer"}
    toy = star.dim_movie.where("title = 'Toy Story'").first().movie_id
    detail = movies.movie_detail(star, toy).first()
    assert [p.ordering for p in detail["cast"]] == [1, 7] and len(detail.genres) >= 5
    columns = movies.movie_detail(star).columns
    assert len(columns) == len(set(columns))
    page = movies.movie_page(star, 1, 2, sort_by="title", sort_order="asc").first()
    assert page.total == star.dim_movie.count() and len(page.data) == 2
    assert [m.title for m in page.data] == sorted(m.title for m in page.data)
    # Toy Story (Children, Family), Cinderella (10751) and the first Dune (Kids & Family).
    assert genres.genre_list(star).where("genre_name = 'Family'").first().movie_count == 3
    assert temporal.quality_by_month(star).first().month == 3


@pytest.mark.parametrize("sort_by,sort_order", [("rating", "desc"), ("rating", "asc"), ("year", "desc"), ("title", "asc")])
def test_pages_in_a_row_equal_pages_by_offset(star, sort_by, sort_order):
    column = movies.SORT_COLUMNS[sort_by]
    want = [r.movie_id for r in movies.movie_list(star, 1, 1000, sort_by=sort_by, sort_order=sort_order).collect()]
    got, last = [], None
    while rows := movies.movies_after(star, last, 2, sort_by=sort_by, sort_order=sort_order).collect():
        got += [r.movie_id for r in rows]
        last = (rows[-1][column], rows[-1].movie_id)
    assert got == want and len(want) == star.dim_movie.count()


def test_titles_by_index(spark, tmp_path):
    rng = random.Random(6)
    titles = ["".join(rng.choices("abAB% _É", k=rng.randint(0, 9))) for _ in range(400)] + [None, "", "ab", "100% Wolf", "100 Wolf", "a_b", "axb", "ÉTÉ"]
    films = spark.createDataFrame(list(enumerate(titles)), "movie_id int, title string").withColumn("year", F.lit(1))
    star = SimpleNamespace(dim_movie=films)
    writers.write_table(movies.title_index(star), str(tmp_path), sort_by=["gram", "movie_id"])
    index = spark.read.parquet(str(tmp_path))
    for part in ("ab", "aba", "AB%", "0% w", "a_b", "été", "zzz", "", "ab abab", "\\\\"):
        want = sorted(i for i, t in enumerate(titles) if t is not None and part.lower() in t.lower())
        assert sorted(r.movie_id for r in movies.movies_titled(star, part, index).collect()) == want, part
    plan = movies.movies_titled(star, "wolf", index)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram, [olf,wol])" in plan


def test_views_are_sql_tables(spark, star):
    star_jobs.register_views(star)
    row = spark.sql("select genres from v_movie_genres where title = 'Toy Story'").first()
    assert row.genres.startswith("Adventure, Animation")
    assert spark.sql("select count(*) c from v_movie_cast").first().c == 2
    assert spark.sql("select count(*) c from v_movie_full").first().c == star.dim_movie.count()


def test_checks_on_a_sound_star(star):
    report = {(r.table_name, r.check_name): r.violations for r in star_jobs.constraint_report(star).collect()}
    assert set(report.values()) == {0} and len(report) == 18
    counts = {r.table_name: r.row_count for r in star_jobs.validate_load(star).collect()}
    assert counts["_orphan_facts"] == 0 and counts["dim_time"] == 29_585


def test_checks_are_fused_and_equal_the_single_ones(spark, star, tmp_path):
    for name, df in star.tables().items():
        extra = df.limit(1)
        if name == "fact_movie_metrics":
            extra = extra.withColumns({"budget": F.lit(-5).cast(df.schema["budget"].dataType), "movie_id": F.lit(None).cast("bigint")})
        if name == "bridge_movie_cast":
            extra = extra.withColumn("person_id", F.lit("nobody"))
        if name == "dim_movie":
            extra = extra.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in star_jobs.SOURCE_IDS})
        df.unionByName(extra).write.parquet(f"{tmp_path}/{name}")
    bad = star_jobs.read_star(spark, str(tmp_path))
    report = star_jobs.constraint_report(bad)
    single = [star_jobs.dq_uniqueness(bad), star_jobs.dq_referential(bad), star_jobs.dq_range(bad), star_jobs.dq_has_id(bad)]
    want = {(r.table_name, r.check_name): r.violations for df in single for r in df.collect()}
    assert {(r.table_name, r.check_name): r.violations for r in report.collect()} == want
    assert sum(n > 0 for n in want.values()) >= 9
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 7


def test_export(spark, star, tmp_path):
    outcome = star_jobs.export_star(star, str(tmp_path), ["dim_person", "no_such_table", "dim_genre"])
    assert outcome == {"dim_genre": "ok", "dim_person": "ok"}
    person = spark.read.parquet(str(tmp_path / "dim_person")).first()
    assert person.known_for_titles == "tt0114709,tt0000005"
    # Appending the same rows loads no key twice.
    n = star.dim_genre.count()
    assert star_jobs.export_star(star, str(tmp_path), ["dim_genre"], mode="append") == {"dim_genre": f"ok, {n} rejected"}
    assert spark.read.parquet(str(tmp_path / "dim_genre")).count() == n
    again = spark.read.parquet(str(tmp_path / "_rejected/dim_genre"))
    assert {r.reason for r in again.collect()} == {"already_loaded"} and again.count() == n
    people = star.dim_person
    broken = people.withColumn("birth_year", F.lit(3_000_000_000)).unionByName(people.withColumn("birth_year", F.col("birth_year").cast("bigint"))).unionByName(
        people.withColumns({"person_id": F.lit(None).cast("string"), "birth_year": F.lit(1).cast("bigint")})
    )
    rows, rejected = star_jobs.loadable(SimpleNamespace(dim_person=broken), "dim_person")
    assert rows.schema["birth_year"].dataType.typeName() == "integer" and rows.count() == people.count()
    assert {r.reason: r.n for r in rejected.groupBy("reason").agg(F.sum("copies").alias("n")).collect()} == {
        "does_not_fit": people.count(), "null_key": people.count(),
    }
    failed = star_jobs.export_star(star, "nosuchscheme://x", ["dim_genre"])
    assert failed["dim_genre"].startswith("failed")


def test_references_have_to_name_loaded_rows(spark, star, tmp_path):
    films = star.dim_movie.limit(2).withColumn("year", F.when(F.col("movie_id") % 2 == 0, F.lit(3_000_000_000)).otherwise(F.col("year").cast("bigint")))
    films = films.withColumn("movie_id", F.row_number().over(Window.orderBy("movie_id")).cast("bigint"))
    films = films.withColumn("year", F.when(F.col("movie_id") == 1, F.lit(3_000_000_000)).otherwise(F.lit(1999)))
    facts = star.fact_movie_metrics.limit(2).withColumn("movie_id", F.row_number().over(Window.orderBy("metric_id")).cast("bigint"))
    bad = star.replace(dim_movie=films, fact_movie_metrics=facts)
    outcome = star_jobs.export_star(bad, str(tmp_path), ["dim_time", "dim_movie", "fact_movie_metrics"])
    assert outcome == {"dim_time": "ok", "dim_movie": "ok, 1 rejected", "fact_movie_metrics": "ok, 1 rejected"}
    assert [r.movie_id for r in spark.read.parquet(f"{tmp_path}/fact_movie_metrics").collect()] == [2]
    assert [(r.movie_id, r.reason) for r in spark.read.parquet(f"{tmp_path}/_rejected/fact_movie_metrics").collect()] == [(1, "orphan")]
    assert [r.movie_id for r in star_jobs.loadable(bad, "fact_movie_metrics")[0].collect()] == [2]


def test_the_load_runs_its_source_once(spark, star, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            read.add(1)
            yield row

    genres_read = spark.createDataFrame(star.dim_genre.rdd.mapPartitions(counted), star.dim_genre.schema)
    assert star_jobs.export_star(star.replace(dim_genre=genres_read), str(tmp_path), ["dim_genre"]) == {"dim_genre": "ok"}
    assert read.value == star.dim_genre.count()


def test_projection_for_the_warehouse(spark):
    df = spark.createDataFrame(
        [(float("nan"), 3e9, [1, 2], "d"), (float("inf"), 7.0, None, "d")], "a double, b double, c array<int>, created_date string"
    )
    out = star_jobs.warehouse_projection(df, {"b": "bigint"}).collect()
    assert [tuple(r) for r in out] == [(None, 3_000_000_000, "1,2"), (None, 7, None)]


def test_ndjson_chunks_and_partitions(spark, tmp_path):
    df = spark.range(2500).coalesce(1).withColumn("y", F.col("id") % 2)
    writers.write_ndjson_chunks(df, str(tmp_path / "chunks"))
    files = sorted((tmp_path / "chunks").glob("*.json"))
    assert [sum(1 for _ in f.open()) for f in files] == [1000, 1000, 500]
    writers.write_table(df, str(tmp_path / "t"), ["y"])
    assert sorted(p.name for p in (tmp_path / "t").glob("y=*")) == ["y=0", "y=1"]
    assert readers.read_ndjson(spark, str(tmp_path / "chunks"), "id bigint").count() == 2500
    manifest = star_jobs.manifest_of_chunks(spark, str(tmp_path / "chunks"), "id bigint, y bigint", "y").first()
    assert (manifest.total_movies, manifest.total_chunks, manifest.fields) == (2500, 3, "id,y")
    assert bronze.read_tmdb(spark, str(tmp_path / "chunks")).select("id").distinct().count() == 2500


def test_money_of_failed_lookups(spark):
    films = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, t string")
    details = spark.createDataFrame([(1, 5, 6), (2, None, 9)], "id int, budget bigint, revenue bigint")
    got = {r.id: (r.budget, r.revenue) for r in bronze.enrich_box_office(films, details).collect()}
    assert got == {1: (5, 6), 2: (0, 9), 3: (None, None)}


def test_quarantine_of_the_bridge(star):
    loaded, rejected = split_quarantine(star.bridge_movie_cast, ["movie_id", "person_id"], [("person_id", star.dim_person, "person_id")])
    assert loaded.count() == 1 and rejected.first().reason == "duplicate_key"
