"""The star schema as a bundle of DataFrames, its reading views, and its load into a warehouse."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.operators.joins import union_all
from reelspark.operators.quality import LOADED, check_row, duplicate_keys, judge_rows, orphans, range_violations, without_any
from reelspark.sources import readers, writers


# Parents come before children: this is also the load order.
TABLES = [
    "dim_time",
    "dim_genre",
    "dim_person",
    "dim_movie",
    "fact_movie_metrics",
    "bridge_movie_cast",
    "bridge_movie_genres",
]

AUDIT_COLUMNS = ["created_date", "cleaned_date", "ingest_date", "aggregated_date"]


class Star:
    """The seven tables, each given as a DataFrame or as a function that opens it on first use.

    Opening late means that a query touches the file listings of the tables it reads and of no others.
    """

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]):
        unknown = set(tables) - set(TABLES)
        if unknown:
            raise ValueError(f"not a star table: {sorted(unknown)}")
        self._tables = dict(tables)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._tables:
            raise AttributeError(name)
        df = self._tables[name]
        if not isinstance(df, DataFrame):
            df = self._tables[name] = df()
        return df

    def replace(self, **tables: DataFrame) -> Star:
        """The same star with some tables exchanged."""
        return Star(**{**self._tables, **tables})

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES if name in self._tables}

    def films(self, how: str = "inner") -> DataFrame:
        """Films with their metrics."""
        metrics = self.fact_movie_metrics.drop("time_id", "metric_id", *AUDIT_COLUMNS)
        return self.dim_movie.join(metrics, "movie_id", how)


def read_star(spark: SparkSession, gold_root: str) -> Star:
    return Star(**{name: partial(readers.read_table, spark, f"{gold_root}/{name}") for name in TABLES})


def register_views(star: Star) -> None:
    """Tables and views for SQL users."""
    views = {"v_movie_full": v_movie_full, "v_movie_genres": v_movie_genres, "v_movie_cast": v_movie_cast}
    for name, df in star.tables().items():
        df.createOrReplaceTempView(name)
    for name, view in views.items():
        view(star).createOrReplaceTempView(name)


def v_movie_full(star: Star) -> DataFrame:
    return star.films("left").select(
        "movie_id",
        "title",
        "original_title",
        "year",
        "runtime",
        "mpaa_rating",
        "plot_summary",
        "poster_url",
        "ml_avg_rating",
        "ml_rating_count",
        "imdb_rating",
        "imdb_votes",
        "tmdb_rating",
        "tmdb_votes",
        "tomatometer_score",
        "audience_score",
        "divisive_score",
        "budget",
        "revenue",
    )


def genre_names_per_movie(star: Star) -> DataFrame:
    """Sorted genre names per film. A film has at most as many entries as there are genres."""
    named = star.bridge_movie_genres.join(star.dim_genre, "genre_id")
    return named.groupBy("movie_id").agg(F.array_sort(F.collect_list("genre_name")).alias("genre_names"))


def v_movie_genres(star: Star) -> DataFrame:
    return (
        star.dim_movie.select("movie_id", "title", "year")
        .join(genre_names_per_movie(star), "movie_id", "left")
        .select("movie_id", "title", "year", F.array_join("genre_names", ", ").alias("genres"))
    )


def v_movie_cast(star: Star) -> DataFrame:
    return (
        star.bridge_movie_cast.join(star.dim_movie.select("movie_id", "title"), "movie_id")
        .join(star.dim_person.select("person_id", F.col("name").alias("person_name")), "person_id")
        .select("movie_id", "title", "category", "ordering", "person_id", "person_name", "characters")
    )


# The key that readers look a table up by; files are laid out along it.
LOOKUP_KEYS = {
    "dim_time": "time_id",
    "dim_genre": "genre_id",
    "dim_person": "person_id",
    "dim_movie": "movie_id",
    "fact_movie_metrics": "movie_id",
    "bridge_movie_cast": "movie_id",
    "bridge_movie_genres": "movie_id",
}

# Columns of the warehouse schema whose types the rows have to be brought to (fixed values).
WAREHOUSE_TYPES = {
    "dim_time": {"int": "time_id year quarter month day day_of_week day_of_year week_of_year"},
    "dim_genre": {"int": "genre_id"},
    "dim_person": {"int": "birth_year death_year"},
    "dim_movie": {"bigint": "movie_id", "int": "tmdb_id ml_id year runtime is_adult", "double": "popularity"},
    "fact_movie_metrics": {
        "bigint": "metric_id movie_id budget revenue",
        "int": "time_id ml_rating_count imdb_votes tmdb_votes tomatometer_score audience_score divisive_score",
        "double": "ml_avg_rating imdb_rating tmdb_rating tmdb_popularity",
    },
    "bridge_movie_cast": {"bigint": "movie_id", "int": "ordering"},
    "bridge_movie_genres": {"bigint": "movie_id", "int": "genre_id"},
}

# --- Warehouse load -------------------------------------------------------------------------------------------

def warehouse_projection(df: DataFrame, target: dict[str, str] | None = None) -> DataFrame:
    """Rows as a relational table takes them: no audit date, arrays as comma text, NaN and infinity as NULL, and
    columns cast to the target types; a value the target type cannot hold becomes NULL."""
    target = target or {}
    out = []
    for field in df.schema.fields:
        if field.name in AUDIT_COLUMNS:
            continue
        c = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
        if field.name in target:
            c = c.try_cast(target[field.name])
        out.append(c.alias(field.name))
    return df.select(*out)


def _judged(star: Star, name: str, parents: dict[str, DataFrame], stored: DataFrame | None = None) -> DataFrame:
    """Rows of a table, typed as the warehouse takes them where they fit, with reason and copies. parents: the rows that references may name."""
    rows = warehouse_projection(getattr(star, name))
    types = {c: t for t, columns in WAREHOUSE_TYPES[name].items() for c in columns.split() if c in rows.columns}
    fits = reduce(lambda a, b: a & b, [F.col(c).isNull() | F.col(c).try_cast(t).isNotNull() for c, t in types.items()])
    keys = [(key, parents[parent].select(key), key) for child, key, parent in FOREIGN_KEYS if child == name]
    return judge_rows(rows, PRIMARY_KEYS[name], keys, stored, fits)


def _typed(judged: DataFrame, name: str) -> DataFrame:
    """The loadable rows alone, in the warehouse's types."""
    types = {c: t for t, columns in WAREHOUSE_TYPES[name].items() for c in columns.split() if c in judged.columns}
    return judged.where(F.col("reason") == LOADED).drop("reason", "copies").withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def _parents_of(name: str) -> list[str]:
    return list(dict.fromkeys(parent for child, _, parent in FOREIGN_KEYS if child == name))


def loadable(star: Star, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a table as the warehouse takes them, and the rejected ones with reason and copies. A reference has to name a loadable
    row of its parent."""
    judged = _judged(star, name, {p: loadable(star, p)[0] for p in _parents_of(name)})
    return _typed(judged, name), judged.where(F.col("reason") != LOADED)


def _stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return next(iter(readers.read_present(spark, [path]).values()))
    except FileNotFoundError:
        return None


def _outcome(counts: dict[str, int | None]) -> str:
    bad = counts.get("rejected") or 0
    return f"ok, {bad} rejected" if bad else "ok"


def _counted(judged: DataFrame, counter: Observation) -> DataFrame:
    rejected = F.col("reason") != LOADED
    return judged.observe(counter, F.count_if(~rejected).alias("loaded"), F.sum(F.when(rejected, F.col("copies"))).alias("rejected"))


def export_star(star: Star, root: str, tables: list[str] | None = None, mode: str = "overwrite") -> dict[str, str]:
    """Write the tables in load order as Parquet, typed as the warehouse has them, and rejected rows beside them in
    ``_rejected``; a table that fails does not stop the others, unknown names are skipped. Returns the outcome per table.

    One job judges a table and writes its rows to ``_staged``, parted by outcome, while an observation counts them; the two parts are published from
    there. References have to name rows that are stored under ``root``. Appending loads no key a second time: such rows are rejected as
    ``already_loaded``, so an append that is run twice leaves the table as it was.
    """
    outcome = {}
    for name in [t for t in TABLES if tables is None or t in tables]:
        try:
            spark = getattr(star, name).sparkSession
            stored = _stored_table(spark, f"{root}/{name}") if mode == "append" else None
            there = {p: _stored_table(spark, f"{root}/{p}") for p in _parents_of(name)}
            parents = {p: getattr(star, p).limit(0) if df is None else df for p, df in there.items()}
            counter = Observation(f"load of {name}")
            judged = _counted(_judged(star, name, parents, stored), counter)
            parted = judged.withColumn("outcome", F.when(F.col("reason") == LOADED, LOADED).otherwise("rejected"))
            writers.write_table(parted, f"{root}/_staged/{name}", ["outcome"])
            staged = spark.read.schema(parted.schema).parquet(f"{root}/_staged/{name}")
            writers.write_table(_typed(staged.where(F.col("outcome") == LOADED).drop("outcome"), name), f"{root}/{name}", mode=mode, sort_by=layout_keys(name))
            writers.write_table(staged.where(F.col("outcome") != LOADED).drop("outcome"), f"{root}/_rejected/{name}", mode=mode)
            outcome[name] = _outcome(counter.get)
        except Exception as e:  # noqa: BLE001 - reported per table
            outcome[name] = f"failed: {e}"
    return outcome


def export_star_jdbc(
    star: Star, url: str, tables: list[str] | None = None, properties: dict | None = None, mode: str = "overwrite"
) -> dict[str, str]:
    """As ``export_star``, into a database: rejected rows are left out and counted in the same job (``loadable`` lists them). Appending reads
    the keys that the database holds."""
    outcome = {}
    for name in [t for t in TABLES if tables is None or t in tables]:
        try:
            spark = getattr(star, name).sparkSession
            stored = spark.read.jdbc(url, name, properties=properties or {}) if mode == "append" else None
            counter = Observation(f"load of {name}")
            judged = _judged(star, name, {p: loadable(star, p)[0] for p in _parents_of(name)}, stored)
            writers.write_jdbc(_typed(_counted(judged, counter), name), url, name, properties, mode)
            outcome[name] = _outcome(counter.get)
        except Exception as e:  # noqa: BLE001 - reported per table
            outcome[name] = f"failed: {e}"
    return outcome


def load_manifest(
    df: DataFrame, year: str, records_per_chunk: int = 1000, completed_at: str | None = None, file: str | None = None
) -> DataFrame:
    """One line about a delivery: records, chunk files, year span, fields, time of completion. Chunks are those to be
    written, or the distinct values of column `file`, which is no field."""
    chunks = F.ceil(F.count("*") / records_per_chunk) if file is None else F.count_distinct(file)
    fields = [c for c in df.columns if c != file]
    done = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") if completed_at is None else F.lit(completed_at)
    return df.agg(
        F.count("*").alias("total_movies"),
        chunks.cast("bigint").alias("total_chunks"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
    ).select("*", F.lit(",".join(fields)).alias("fields"), done.alias("completed_at"))


def manifest_of_chunks(spark: SparkSession, path: str, schema: str, year: str, completed_at: str | None = None) -> DataFrame:
    """As ``load_manifest``, about the chunk files that were really written to ``path``."""
    written = readers.read_ndjson(spark, path, schema)
    return load_manifest(written.withColumn("_file", F.input_file_name()), year, completed_at=completed_at, file="_file")


# --- Checks on the loaded star --------------------------------------------------------------------------------


def orphan_facts(star: Star) -> DataFrame:
    """Metric rows whose film is missing."""
    return orphans(star.fact_movie_metrics, star.dim_movie, "movie_id")


def validate_load(star: Star) -> DataFrame:
    """Rows per table, and the number of orphan facts (a load is good when that is 0)."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in star.tables().items()
    ]
    lost = orphan_facts(star).agg(F.count("*").alias("row_count")).select(F.lit("_orphan_facts").alias("table_name"), "row_count")
    return union_all([*counts, lost])


PRIMARY_KEYS = {
    "dim_time": ["time_id"],
    "dim_genre": ["genre_id"],
    "dim_person": ["person_id"],
    "dim_movie": ["movie_id"],
    "fact_movie_metrics": ["metric_id"],
    "bridge_movie_cast": ["movie_id", "person_id", "ordering"],
    "bridge_movie_genres": ["movie_id", "genre_id"],
}


def layout_keys(name: str) -> list[str]:
    """Sort order of a stored table: its lookup key, then the rest of its primary key, so that a film with very many rows
    spans files."""
    return list(dict.fromkeys([LOOKUP_KEYS[name], *PRIMARY_KEYS[name]]))


FOREIGN_KEYS = [
    ("fact_movie_metrics", "movie_id", "dim_movie"),
    ("fact_movie_metrics", "time_id", "dim_time"),
    ("bridge_movie_cast", "movie_id", "dim_movie"),
    ("bridge_movie_cast", "person_id", "dim_person"),
    ("bridge_movie_genres", "movie_id", "dim_movie"),
    ("bridge_movie_genres", "genre_id", "dim_genre"),
]


def dq_uniqueness(star: Star, tables: dict[str, list[str]] | None = None) -> DataFrame:
    """Keys that occur more than once, counted per table."""
    keys = tables or PRIMARY_KEYS
    return union_all([check_row(t, "unique_key", duplicate_keys(star.tables()[t], k)) for t, k in keys.items()])


def dq_referential(star: Star, keys: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Child rows without a parent, counted per foreign key."""
    tables = star.tables()
    return union_all(
        [
            check_row(child, f"{column} in {parent}", orphans(tables[child].select(column), tables[parent], column))
            for child, column, parent in keys or FOREIGN_KEYS
        ]
    )


def _range_rules() -> dict[str, Column]:
    rules = {f"{c} 0..100": F.col(c).between(0, 100) for c in ["tomatometer_score", "audience_score"]}
    return rules | {f"{c} >= 0": F.col(c) >= 0 for c in ["budget", "revenue"]}


def dq_range(star: Star) -> DataFrame:
    """Scores outside 0..100 and negative money, all from one pass over the fact."""
    found = range_violations(star.fact_movie_metrics, _range_rules())
    return found.select(F.lit("fact_movie_metrics").alias("table_name"), F.col("rule").alias("check_name"), "violations")


SOURCE_IDS = ["imdb_id", "tmdb_id", "ml_id", "rt_slug"]


def dq_has_id(star: Star) -> DataFrame:
    """Films without any source id."""
    return check_row("dim_movie", "has_source_id", without_any(star.dim_movie, SOURCE_IDS))


def _notes(name: str) -> list[Column]:
    """What the row of a table says to the checks: (table_name, check_name, key, note), NULL where it says nothing.

    A row has a primary key, is the parent or the child of a reference, or breaks a rule by itself."""

    def note(table: str, check: str, what: str, key: Column | None = None) -> Column:
        named = {"table_name": F.lit(table), "check_name": F.lit(check), "key": F.lit(None).cast("string") if key is None else key, "note": F.lit(what)}
        return F.struct(*(c.alias(k) for k, c in named.items()))

    said = [note(name, "unique_key", "key", F.to_json(F.struct(*PRIMARY_KEYS[name])))]
    for child, column, parent in FOREIGN_KEYS:
        value, check = F.col(column).cast("string"), f"{column} in {parent}"
        if name == child:
            said.append(F.when(value.isNull(), note(child, check, "broken")).otherwise(note(child, check, "child", value)))
        if name == parent:
            said.append(F.when(value.isNotNull(), note(child, check, "parent", value)))
    rules = _range_rules() if name == "fact_movie_metrics" else {}
    rules |= {"has_source_id": F.coalesce(*(F.col(c).cast("string") for c in SOURCE_IDS)).isNotNull()} if name == "dim_movie" else {}
    return [*said, *(F.when(~rule, note(name, check, "broken")) for check, rule in rules.items())]


def constraint_report(star: Star) -> DataFrame:
    """All checks as one table (table_name, check_name, violations), from one scan of each table and one shuffle.

    Every row notes its key, its references and the rules it breaks. Notes are counted by check and key, before and after they are shuffled:
    a key noted twice is a duplicate, and the children of a key without a parent are orphans."""
    tables = star.tables()
    notes = union_all([df.select(F.explode(F.filter(F.array(*_notes(name)), lambda n: n.isNotNull())).alias("n")).select("n.*") for name, df in tables.items()])
    times = {n: F.count_if(F.col("note") == n).alias(f"_{n}") for n in ("key", "child", "parent", "broken")}
    counts = notes.groupBy("table_name", "check_name", "key").agg(*times.values())
    violations = (F.col("_key") > 1).cast("bigint") + F.when(F.col("_parent") == 0, F.col("_child")).otherwise(0) + F.col("_broken")
    named = [(name, "unique_key") for name in tables] + [(c, f"{k} in {p}") for c, k, p in FOREIGN_KEYS]
    named += [("fact_movie_metrics", r) for r in _range_rules()] + [("dim_movie", "has_source_id")]
    lines = F.array(*(F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("check_name"), F.lit(0).cast("bigint").alias("violations")) for t, c in named))
    none = counts.sparkSession.range(1).select(F.inline(lines))
    found = counts.select("table_name", "check_name", violations.alias("violations")).union(none)
    return found.groupBy("table_name", "check_name").agg(F.sum("violations").alias("violations"))
