"""Every operator and report as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance import bindings as B
from conformance.scratch import scratch_path
from ratingloom.defaults import BAND_EDGES, BAND_LABELS
from ratingloom.functions import measures as M
from ratingloom.functions import text as X
from ratingloom.operators import checks, ranking, sketches
from ratingloom.operators.cleaning import (
    clean_catalog,
    coerce_types,
    fill_blank_strings,
    first_per_key,
    identified,
)
from ratingloom.operators.reshape import (
    explode_labels,
    join_measures,
    rated_votes,
    tag_totals,
    unpivot_votes,
    wide_vote_totals,
)
from ratingloom.plans import full_run, incremental, sql_reports
from ratingloom.plans import presentation as P
from ratingloom.plans import reports as R
from ratingloom.plans import summary as S
from ratingloom.sources import readers, views, writers

Query = Callable[[SparkSession, str], DataFrame]
T = B.THRESHOLDS
QUERIES: dict[str, Query] = {}

CLEAN_COLUMNS = [
    "appid", "name", "release_date", "developer", "publisher", "platforms", "categories",
    "genres", "community_tags", "positive_ratings", "negative_ratings", "owners", "price",
    "total_reviews", "rating_pct", "wilson_score", "release_year", "price_band",
    "owner_lower", "owner_upper", "owner_midpoint", "has_missing_core",
]

# A band beyond every price, so that completing the bands has something to add.
WIDE_EDGES = (*BAND_EDGES, (100, "40-100"))
WIDE_LABELS = (*BAND_LABELS[:-1], "40-100", "100+")


def query(name: str):
    """Register a query under a name."""

    def add(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return add


def over_games(name: str):
    """Register a query that needs nothing but the cleaned catalogue."""

    def add(build: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(B.games(spark, sf_dir))
        return build

    return add


def catalog_file(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "catalog-csv")
    writers.write_catalog_csv(B.raw_catalog(spark, sf_dir).drop("ver"), path)
    return path


def votes_file(spark: SparkSession, sf_dir: str, votes=B.wide_votes) -> str:
    path = scratch_path(spark, "votes-csv")
    writers.write_catalog_csv(votes(spark, sf_dir), path)
    return path


def registered(spark: SparkSession, sf_dir: str) -> None:
    games = B.games(spark, sf_dir)
    views.register_views(games, rated_votes(B.wide_votes(spark, sf_dir), games))


# -- sources and sinks ------------------------------------------------------


@query("land_raw")
def land_raw(spark, sf_dir):
    source = catalog_file(spark, sf_dir)
    landed = readers.land_raw(
        spark, {"catalog": source, "votes": None}, scratch_path(spark, "raw-zone")
    )
    return spark.read.parquet(landed["catalog"]).drop("source_file")


@query("read_catalog_csv")
def read_catalog_csv(spark, sf_dir):
    return readers.read_catalog(spark, catalog_file(spark, sf_dir))


@query("read_wide_votes")
def read_wide_votes(spark, sf_dir):
    return readers.read_wide_votes(spark, votes_file(spark, sf_dir))


@query("read_catalog_reordered")
def read_catalog_reordered(spark, sf_dir):
    path = scratch_path(spark, "catalog-turned")
    raw = B.raw_catalog(spark, sf_dir).withColumnRenamed("community_tags", "file_tags")
    writers.write_catalog_csv(raw.select(*reversed(raw.columns)), path)
    return readers.read_catalog(spark, path, names={"community_tags": "file_tags"})


@query("read_votes_folder")
def read_votes_folder(spark, sf_dir):
    path = scratch_path(spark, "votes-folder")
    votes = B.wide_votes(spark, sf_dir)
    writers.write_catalog_csv(votes.where("appid % 40 = 0").coalesce(1), f"{path}/first")
    writers.write_catalog_csv(votes.where("appid % 40 != 0").coalesce(1), f"{path}/second")
    return readers.read_wide_votes(spark, [f"{path}/first", f"{path}/second"])


@query("read_votes_by_header")
def read_votes_by_header(spark, sf_dir):
    """Two files that share a tag and name others."""
    path = scratch_path(spark, "votes-headers")
    votes = B.wide_votes(spark, sf_dir)
    first = votes.where("appid % 40 = 0").select("appid", "click", "error", "view")
    second = votes.where("appid % 40 != 0").select("purchase", "view", "appid", "signup")
    writers.write_catalog_csv(first.coalesce(1), f"{path}/first")
    writers.write_catalog_csv(second.coalesce(1), f"{path}/second")
    return readers.read_votes_by_header(spark, [f"{path}/first", f"{path}/second"])


@query("curated_roundtrip")
def curated_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "curated")
    writers.write_curated(B.games(spark, sf_dir), path)
    return readers.read_curated(spark, path).select(*CLEAN_COLUMNS)


@query("curated_increment")
def curated_increment(spark, sf_dir):
    """A table of some rows, to which the others come: new keys, and copies that win over held ones."""
    path = scratch_path(spark, "curated")
    raw = B.raw_catalog(spark, sf_dir)
    first = "ver = 2 OR (appid % 3 != 0 AND appid % 20 != 0)"
    writers.write_curated(clean_catalog(raw.where(first), order=["ver"]), path)
    incremental.add_raw(spark, raw.where(f"NOT ({first})"), path, ["ver"])
    return readers.read_curated(spark, path).select(*CLEAN_COLUMNS)


@query("tag_votes_bucketed")
def tag_votes_bucketed(spark, sf_dir):
    """Votes and ratings from a table that is laid out by item."""
    path = scratch_path(spark, "ratings")
    writers.write_bucketed(B.games(spark, sf_dir).select("appid", "rating_pct"), path, buckets=8)
    return rated_votes(B.wide_votes(spark, sf_dir), readers.read_bucketed(spark, path))


@query("result_csv_roundtrip")
def result_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "result")
    writers.write_result(R.yearly_report(B.games(spark, sf_dir), T), path, ["release_year"])
    schema = "release_year INT, games BIGINT, total_reviews BIGINT, mean_rating_pct DOUBLE"
    return readers.read_result(spark, path, schema)


@query("summary_json_roundtrip")
def summary_json_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "summary")
    writers.write_summary(run_summary(spark, sf_dir), path)
    return readers.read_summary(spark, path, S.SUMMARY_SCHEMA)


# -- cleaning and measures --------------------------------------------------


@over_games("clean_catalog")
def clean_catalog_rows(games):
    return games.select(*CLEAN_COLUMNS)



@query("dedupe_catalog")
def dedupe_catalog(spark, sf_dir):
    raw = B.raw_catalog(spark, sf_dir)
    return first_per_key(identified(raw), order=["ver"]).select("appid", "ver", "positive_ratings")


@query("dedupe_by_content")
def dedupe_by_content(spark, sf_dir):
    raw = identified(B.raw_catalog(spark, sf_dir)).drop("ver")
    return first_per_key(raw).select("appid", "name", "positive_ratings")


@query("coerce_types")
def coerce_cells(spark, sf_dir):
    cells = B.untyped_cells(spark, sf_dir)
    return coerce_types(cells, ["price", "negative_ratings"], ["release_date"])



@over_games("wilson_scores")
def wilson_scores(games):
    return games.select("appid", "positive_ratings", "total_reviews", "rating_pct", "wilson_score")


@query("wilson_null_at_zero")
def wilson_null_at_zero(spark, sf_dir):
    raw = B.raw_catalog(spark, sf_dir)
    cleaned = clean_catalog(raw, order=["ver"], zero_positive="null")
    return cleaned.select("appid", "wilson_score")


@over_games("price_bands")
def price_bands(games):
    return games.select("appid", "price", "price_band", M.band_position("price_band").alias("place"))


@over_games("owner_bounds")
def owner_bounds(games):
    return games.select("appid", "owner_lower", "owner_upper", "owner_midpoint")


@over_games("missing_core")
def missing_core(games):
    return games.select("appid", "has_missing_core")


@query("fill_blank_strings")
def fill_blank_text(spark, sf_dir):
    return fill_blank_strings(B.games(spark, sf_dir)).select("appid", "publisher", "community_tags")



# -- presentation -----------------------------------------------------------


@query("display_names")
def display_names(spark, sf_dir):
    documents = B.table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id",
        X.display_label("text").alias("chart_label"),
        X.display_label("text", "Non-Latin title").alias("table_label"),
    )


@query("pretty_tags")
def pretty_tags(spark, sf_dir):
    tags = B.priority_tags(spark, sf_dir)
    return tags.select("tag", X.title_words("tag").alias("label"), "orders")


@query("formatted_kpis")
def formatted_kpis(spark, sf_dir):
    return P.headline_figures(run_summary(spark, sf_dir))


@over_games("formatted_price_bands")
def formatted_price_bands(games):
    return P.price_band_text(R.price_band_report(games, exact=True))


@over_games("formatted_ranking")
def formatted_ranking(games):
    return P.ranking_text(R.top_reliable_numbered(games, T))


@query("formatted_tags")
def formatted_tags(spark, sf_dir):
    return P.tag_text(top_tags(spark, sf_dir), 3)


@over_games("largest_genres")
def largest_genres(games):
    return R.largest_genres(R.genre_report(R.game_genres(games), T), 8)


@over_games("genre_bubble")
def genre_bubble(games):
    return R.genre_bubbles(R.genre_report(R.game_genres(games), T), 12)


@over_games("uncertainty_sample")
def uncertainty_sample(games):
    return R.uncertainty_sample(games)


# -- labels and votes -------------------------------------------------------


@over_games("explode_genres")
def explode_genres(games):
    return explode_labels(games, "genres", "genre")


@over_games("explode_platforms")
def explode_platforms(games):
    return explode_labels(games, "platforms", "platform")


@over_games("game_genres")
def game_genres(games):
    return R.game_genres(games)


@over_games("game_platforms")
def game_platforms(games):
    return R.game_platforms(games)


@over_games("joined_platforms")
def joined_platforms(games):
    return join_measures(explode_labels(games, "platforms", "platform"), games, ["rating_pct"])


@query("unpivot_votes")
def unpivot_vote_matrix(spark, sf_dir):
    return unpivot_votes(B.wide_votes(spark, sf_dir))



@query("tag_votes")
def tag_votes(spark, sf_dir):
    return rated_votes(B.wide_votes(spark, sf_dir), B.games(spark, sf_dir))


# -- aggregate reports ------------------------------------------------------


@over_games("quality_report")
def quality_report(games):
    return S.quality_report(games)


@query("missing_before")
def missing_before(spark, sf_dir):
    return S.missing_before(B.raw_catalog(spark, sf_dir))


@query("run_summary")
def run_summary(spark, sf_dir):
    return S.run_summary(B.raw_catalog(spark, sf_dir), B.games(spark, sf_dir))


@over_games("yearly_report")
def yearly_report(games):
    return R.yearly_report(games, T)


@over_games("yearly_slice")
def yearly_slice(games):
    return R.year_slice(R.yearly_report(games, T), 1997, 1999)


@over_games("peak_year")
def peak_year(games):
    return R.peak_year(R.yearly_report(games, T))


@over_games("genre_report")
def genre_report(games):
    return R.genre_report(R.game_genres(games), T)


@over_games("genre_min_games")
def genre_min_games(games):
    return R.at_least(R.genre_report(R.game_genres(games), T), "games", 250)


@over_games("platform_report")
def platform_report(games):
    return R.platform_report(R.game_platforms(games))


@over_games("price_band_report")
def price_band_report(games):
    return R.price_band_report(games)


@over_games("price_band_exact")
def price_band_exact(games):
    return R.price_band_report(games, exact=True)


@over_games("price_band_ordered")
def price_band_ordered(games):
    ordered = R.in_band_order(R.price_band_report(games))
    return ranking.numbered(ordered, [M.band_position("price_band")], at_most=len(BAND_LABELS)).select(
        "position", "price_band", "games", "median_reviews"
    )


@query("price_bands_complete")
def price_bands_complete(spark, sf_dir):
    raw = B.raw_catalog(spark, sf_dir)
    games = clean_catalog(raw, order=["ver"], edges=WIDE_EDGES, top_label="100+", null_band=None)
    banded = games.filter(F.col("price_band").isNotNull())
    return R.complete_bands(R.price_band_report(banded, exact=True), WIDE_LABELS)


@over_games("best_price_band")
def best_price_band(games):
    return R.best_price_band(R.price_band_report(games))


@over_games("publisher_report")
def publisher_report(games):
    return R.publisher_report(games, T)


@query("shared_reports")
def shared_reports(spark, sf_dir):
    """The yearly, band and publisher reports from one scan of the catalogue."""
    path = scratch_path(spark, "totals")
    R.shared_totals(B.games(spark, sf_dir)).write.parquet(path)
    totals = spark.read.parquet(path)
    none = F.lit(None).cast("double")
    yearly = R.yearly_of(totals, T).select(
        F.lit("yearly").alias("report"), F.col("release_year").cast("string").alias("key"), "games", "mean_rating_pct",
        none.alias("other"),
    )
    bands = R.bands_of(totals).select(F.lit("band"), "price_band", "games", "mean_rating_pct", "mean_price")
    publishers = R.publishers_of(totals, T).select(F.lit("publisher"), "publisher", "games", none, "mean_wilson_pct")
    return yearly.union(bands).union(publishers)


@query("top_tags")
def top_tags(spark, sf_dir):
    totals = tag_totals(B.wide_votes(spark, sf_dir), B.games(spark, sf_dir), unique_key=False)
    return R.top_tags_from_totals(totals, T)


@query("top_tags_left")
def top_tags_left(spark, sf_dir):
    totals = tag_totals(B.wide_votes(spark, sf_dir), B.games(spark, sf_dir), how="left")
    return R.top_tags_from_totals(totals, T)


@query("top_tags_repeated")
def top_tags_repeated(spark, sf_dir):
    """Items with one and with several matrix rows, told apart by the operator."""
    totals = tag_totals(B.repeated_votes(spark, sf_dir), B.games(spark, sf_dir), least_rows=4)
    return R.top_tags_from_totals(totals, T)


@query("tag_votes_repeated")
def tag_votes_repeated(spark, sf_dir):
    """Heavy items are dealt over tasks; every vote stays."""
    return rated_votes(B.repeated_votes(spark, sf_dir), B.games(spark, sf_dir), least_rows=4)


@query("top_tags_unique")
def top_tags_unique(spark, sf_dir):
    totals = tag_totals(B.wide_votes(spark, sf_dir), B.games(spark, sf_dir), unique_key=True)
    return R.top_tags_from_totals(totals, T)


@query("top_tags_left_unique")
def top_tags_left_unique(spark, sf_dir):
    votes, games = B.wide_votes(spark, sf_dir), B.games(spark, sf_dir)
    return R.top_tags_from_totals(tag_totals(votes, games, how="left", unique_key=True), T)


@query("top_tags_many_columns")
def top_tags_many_columns(spark, sf_dir):
    votes, games = B.type_votes(spark, sf_dir), B.games(spark, sf_dir)
    return tag_totals(votes, games, how="left", unique_key=True).withColumn(
        "mean_rating", F.round("mean_rating", 6)
    )


@query("top_tags_long")
def top_tags_long(spark, sf_dir):
    return R.top_tags(tag_votes(spark, sf_dir), T)


@query("top_tags_wide")
def top_tags_wide(spark, sf_dir):
    ratings = B.games(spark, sf_dir).select("appid", "rating_pct")
    rated = B.wide_votes(spark, sf_dir).join(ratings, "appid", "left")
    return R.top_tags_from_totals(wide_vote_totals(rated, columns=B.VOTE_TAGS), T)


def _written_states(spark, df, by, **options) -> DataFrame:
    path = scratch_path(spark, "states")
    sketches.group_states(df, by, **options).write.partitionBy("release_year").parquet(path)
    return spark.read.parquet(path).where("release_year BETWEEN 1996 AND 1998")


@query("sketched_medians")
def sketched_medians(spark, sf_dir):
    """Medians per band over three years, from states per year and band, and whether their exact
    rank is within the documented error."""
    games = B.games(spark, sf_dir)
    states = _written_states(spark, games, ["release_year", "price_band"], quantiles=["rating_pct"])
    medians = sketches.merged_states(states, ["price_band"], quantiles={"rating_pct": 0.5})
    medians = medians.withColumnsRenamed({"rating_pct": "median"})
    within = games.where("release_year BETWEEN 1996 AND 1998").join(medians, "price_band")
    ranked = within.withColumn("below", (F.col("rating_pct") < F.col("median")).cast("int")).withColumn(
        "upto", (F.col("rating_pct") <= F.col("median")).cast("int")
    )
    return ranked.groupBy("price_band", F.col("rows").alias("games")).agg(
        ((F.avg("below") <= 0.51) & (F.avg("upto") >= 0.49)).alias("within")
    )


@query("sketched_items_by_genre")
def sketched_items_by_genre(spark, sf_dir):
    """Distinct items and publishers per genre over three years, from states per year and genre;
    whether the estimates are within four standard errors of the exact counts."""
    games = B.games(spark, sf_dir)
    genres = explode_labels(games, "genres", "genre", keep=("publisher", "release_year"))
    states = _written_states(spark, genres, ["release_year", "genre"], distinct=["appid", "publisher"])
    found = sketches.merged_states(states, ["genre"], distinct=["appid", "publisher"])
    exact = (
        genres.where("release_year BETWEEN 1996 AND 1998")
        .groupBy("genre")
        .agg(F.count_distinct("appid").alias("items"), F.count_distinct("publisher").alias("publishers"))
    )
    near = lambda name, n: F.abs(F.col(name) - F.col(n)) <= F.greatest(F.lit(0.5), 0.065 * F.col(n))
    return found.join(exact, "genre").select(
        "genre",
        F.col("rows").alias("games"),
        "items",
        "publishers",
        (near("distinct_appid", "items") & near("distinct_publisher", "publishers")).alias("within"),
    )


# -- rankings ---------------------------------------------------------------


@over_games("top_reliable")
def top_reliable(games):
    return R.top_reliable(games, T)


@over_games("top_reliable_numbered")
def top_reliable_numbered(games):
    return R.top_reliable_numbered(games, T)


@query("top_n_of_result")
def top_n_of_result(spark, sf_dir):
    path = scratch_path(spark, "top-reliable")
    writers.write_result(R.top_reliable(B.games(spark, sf_dir), T), path)
    schema = "appid BIGINT, name STRING, total_reviews BIGINT, rating_pct DOUBLE, wilson_pct DOUBLE, price DOUBLE"
    return ranking.top_n(readers.read_result(spark, path, schema), 8, "wilson_pct", tie=["appid"])


@over_games("era_champions")
def era_champions(games):
    return R.era_champions(games, T)


# -- SQL surface ------------------------------------------------------------


def _sql_report(name: str) -> Query:
    def run(spark, sf_dir):
        registered(spark, sf_dir)
        return sql_reports.run(spark, name, T)

    return run


for _name in sql_reports.SQL_REPORTS:
    QUERIES[f"sql_{_name}"] = _sql_report(_name)


@query("sql_wilson_function")
def sql_wilson_function(spark, sf_dir):
    registered(spark, sf_dir)
    views.register_wilson(spark)
    return spark.sql(
        "SELECT appid, wilson_lower_bound(positive_ratings, total_reviews) AS wilson_score FROM games"
    )


# -- checks -----------------------------------------------------------------


@over_games("check_unique_key")
def check_unique_key(games):
    return checks.unique_key(games)


@over_games("check_totals")
def check_totals(games):
    return checks.consistent_totals(games)


@over_games("check_ranking_order")
def check_ranking_order(games):
    order = [F.desc_nulls_last("wilson_score"), "appid"]
    return checks.ranking_order(R.evidenced(games, T), "wilson_score", order, at_most=T.top_items)


@over_games("check_eligible")
def check_eligible(games):
    return checks.meets_threshold(R.top_reliable(games, T), "total_reviews", T.min_reviews)


@over_games("check_wilson_bound")
def check_wilson_bound(games):
    return checks.lower_bound_holds(games, F.col("wilson_score") * 100)


@over_games("check_band_total")
def check_band_total(games):
    return checks.group_total(R.price_band_report(games), "games", games)


@over_games("check_band_domain")
def check_band_domain(games):
    return checks.label_domain(R.price_band_report(games))


@over_games("check_band_order")
def check_band_order(games):
    ordered = R.in_band_order(R.price_band_report(games))
    return checks.label_order(
        ranking.numbered(ordered, [M.band_position("price_band")], at_most=len(BAND_LABELS))
    )


# The same checks on rows that break them, with as many violations as SQL counts.


@query("check_unique_key_broken")
def check_unique_key_broken(spark, sf_dir):
    return checks.unique_key(B.raw_catalog(spark, sf_dir))


@over_games("check_totals_broken")
def check_totals_broken(games):
    shifted = games.withColumn("total_reviews", F.col("total_reviews") + 1)
    return checks.consistent_totals(shifted)


@over_games("check_ranking_order_broken")
def check_ranking_order_broken(games):
    return checks.ranking_order(
        R.evidenced(games, T), "wilson_score", ["wilson_score", "appid"], at_most=T.top_items
    )


@over_games("check_eligible_broken")
def check_eligible_broken(games):
    return checks.meets_threshold(games, "total_reviews", T.min_reviews)


@over_games("check_wilson_bound_broken")
def check_wilson_bound_broken(games):
    swapped = games.select((F.col("wilson_score") * 100).alias("rate"), F.col("rating_pct").alias("lower"))
    return checks.lower_bound_holds(swapped, "lower", "rate")


@over_games("check_band_total_broken")
def check_band_total_broken(games):
    banded = R.price_band_report(games).where("price_band != 'Free'")
    return checks.group_total(banded, "games", games)


@over_games("check_band_domain_broken")
def check_band_domain_broken(games):
    renamed = F.when(F.col("price_band") == "40+", "Dear").otherwise(F.col("price_band"))
    return checks.label_domain(R.price_band_report(games).withColumn("price_band", renamed))


@over_games("check_band_order_broken")
def check_band_order_broken(games):
    turned = ranking.numbered(
        R.price_band_report(games), [F.desc(M.band_position("price_band"))], at_most=len(BAND_LABELS)
    )
    return checks.label_order(turned)


# -- whole run --------------------------------------------------------------


def _run(spark: SparkSession, sf_dir: str):
    """A run over files of the test tables, as a function that can be repeated."""
    catalog, votes = catalog_file(spark, sf_dir), votes_file(spark, sf_dir)
    curated, output = scratch_path(spark, "curated"), scratch_path(spark, "results")

    def run():
        return full_run.run_all(
            spark, catalog, curated, output, tags_path=votes, thresholds=T
        )

    return run


@query("full_run_reports")
def full_run_reports(spark, sf_dir):
    written = _run(spark, sf_dir)()
    return full_run.result_fingerprints(spark, written).select("report", "rows")


@query("full_run_contents")
def full_run_contents(spark, sf_dir):
    """Every cell that a run has written, read back as text: report, key, column, value."""
    written = _run(spark, sf_dir)()
    tables = []
    for name, path in written.items():
        read = readers.read_summary if name == "summary" else readers.read_text_table
        rows = read(spark, path)
        keys = RUN_KEYS[name]
        key = F.concat_ws("/", *[F.col(c).cast("string") for c in keys]) if keys else F.lit("")
        cells = F.array(
            *[
                F.struct(F.lit(c).alias("column"), _plain_text(F.col(c), c).alias("value"))
                for c in rows.columns
                if c not in keys
            ]
        )
        tables.append(
            rows.select(F.lit(name).alias("report"), key.alias("key"), F.explode(cells).alias("cell"))
            .select("report", "key", "cell.column", "cell.value")
        )
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table)
    return stacked


# Key columns of the results of a run.
RUN_KEYS = {
    "data_quality": [],
    "yearly": ["release_year"],
    "genre": ["genre"],
    "platform": ["platform"],
    "price_band": ["price_band"],
    "top_reliable": ["appid"],
    "publishers": ["publisher"],
    "era_champions": ["release_year", "era_rank", "appid"],
    "top_tags": ["tag"],
    "summary": [],
}


def _plain_text(cell, name: str):
    """Names as they are; numbers to six digits, so that both engines write them alike."""
    if name == "name":
        return cell.cast("string")
    return F.format_string("%.6f", cell.cast("double"))


@query("run_checks")
def run_checks(spark, sf_dir):
    catalog, votes = catalog_file(spark, sf_dir), votes_file(spark, sf_dir)
    curated, output = scratch_path(spark, "curated"), scratch_path(spark, "results")
    written = full_run.run_all(spark, catalog, curated, output, tags_path=votes, thresholds=T)
    return full_run.check_run(spark, written, curated, T)


@query("full_run_repeated_votes")
def full_run_repeated_votes(spark, sf_dir):
    """The tag report of a run whose vote file has items on several rows."""
    votes = votes_file(spark, sf_dir, B.repeated_votes)
    curated, output = scratch_path(spark, "curated"), scratch_path(spark, "results")
    written = full_run.run_all(spark, catalog_file(spark, sf_dir), curated, output, tags_path=votes, thresholds=T)
    return readers.read_result(
        spark, written["top_tags"], "tag STRING, tagged_games BIGINT, total_tag_votes BIGINT, mean_rating_pct DOUBLE"
    )


def untyped_file(spark: SparkSession, sf_dir: str) -> str:
    """The catalogue with cells that are no number or date."""
    path = scratch_path(spark, "untyped-csv")
    raw = B.raw_catalog(spark, sf_dir)
    cells = raw.selectExpr(
        *[f"{B.UNTYPED_COLUMNS[c]} as {c}" if c in B.UNTYPED_COLUMNS else c for c in raw.columns if c != "ver"]
    )
    writers.write_catalog_csv(cells, path)
    return path


@query("rejected_cells")
def rejected_cells(spark, sf_dir):
    """Cells that have text and no value, with their raw line."""
    audited = readers.read_audited(spark, untyped_file(spark, sf_dir))
    cells = readers.rejected_cells(audited)
    return cells.select(F.regexp_extract("line", "^([0-9]+)", 1).cast("int").alias("appid"), "column", "text")


@query("full_run_audit")
def full_run_audit(spark, sf_dir):
    """The bad cells that a run counts by column, and those that it lists."""
    curated, output = scratch_path(spark, "curated"), scratch_path(spark, "results")
    written = full_run.run_all(spark, untyped_file(spark, sf_dir), curated, output, thresholds=T, audit=True)
    counts = readers.read_result(spark, written["bad_cells"], "column STRING, cells BIGINT")
    listed = spark.read.parquet(written["rejects"]).groupBy("column").agg(F.count("*").alias("listed"))
    return counts.join(listed, "column", "left")


@query("run_manifest")
def run_manifest(spark, sf_dir):
    catalog, votes = catalog_file(spark, sf_dir), votes_file(spark, sf_dir)
    curated, output = scratch_path(spark, "curated"), scratch_path(spark, "results")
    full_run.run_all(spark, catalog, curated, output, tags_path=votes, thresholds=T)
    return full_run.run_manifest(spark, curated, output)


@query("rerun_idempotent")
def rerun_idempotent(spark, sf_dir):
    run = _run(spark, sf_dir)
    first = scratch_path(spark, "fingerprints")
    full_run.result_fingerprints(spark, run()).write.parquet(first)
    again = full_run.result_fingerprints(spark, run())
    before = spark.read.parquet(first).withColumnsRenamed({"rows": "rows_before", "content": "content_before"})
    same = (F.col("rows") == F.col("rows_before")) & (F.col("content") == F.col("content_before"))
    return again.join(before, "report", "left").select(
        "report", "rows", F.coalesce(same, F.lit(False)).alias("unchanged")
    )
