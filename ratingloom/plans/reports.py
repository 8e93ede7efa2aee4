"""Grouped and ranked reports over the curated fact.

Every grouped report is one partial and one final hash aggregation: a label, year
or publisher that holds a third of the rows reaches the shuffle as one row per
map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.defaults import BAND_LABELS, Thresholds
from ratingloom.functions import measures as M
from ratingloom.operators import ranking
from ratingloom.operators.cleaning import band_dimension
from ratingloom.operators.quantiles import exact_quantiles
from ratingloom.operators.reshape import explode_labels

DEFAULTS = Thresholds()


def items() -> Column:
    return F.count("*").alias("games")


def reviews() -> Column:
    return F.sum("total_reviews").alias("total_reviews")


def mean_of(column: str, alias: str, factor: int = 1, digits: int = 2) -> Column:
    mean = F.avg(column) if factor == 1 else F.avg(column) * factor
    return F.round(mean, digits).alias(alias)


def mean_rating() -> Column:
    return mean_of("rating_pct", "mean_rating_pct")


def mean_wilson() -> Column:
    return mean_of("wilson_score", "mean_wilson_pct", 100)


def _ordered(report: DataFrame, rounded: str, exact: str, key: str, sort_unrounded: bool) -> list:
    return [F.col(exact if sort_unrounded else rounded).desc_nulls_last(), F.col(key)]


# -- time -------------------------------------------------------------------


def yearly_report(games: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Items, outcomes and mean rate per year of a closed range of years."""
    in_range = games.filter(F.col("release_year").between(t.first_year, t.last_year))
    return in_range.groupBy("release_year").agg(items(), reviews(), mean_rating()).orderBy("release_year")


def year_slice(yearly: DataFrame, first: int, last: int) -> DataFrame:
    """A chosen range of years of the yearly report."""
    return yearly.filter(F.col("release_year").between(first, last)).orderBy("release_year")


def peak_year(yearly: DataFrame) -> DataFrame:
    """The year with most items, the earliest one among equals."""
    return ranking.row_of_max(
        yearly, "games", first_by="release_year", columns=["release_year", "games"]
    )


# -- labels -----------------------------------------------------------------


def game_genres(games: DataFrame) -> DataFrame:
    """Genre labels with the measures of their item."""
    return explode_labels(
        games, "genres", "genre", keep=("total_reviews", "rating_pct", "wilson_score")
    )


def game_platforms(games: DataFrame) -> DataFrame:
    """Platform labels with the rate of their item."""
    return explode_labels(games, "platforms", "platform", keep=("rating_pct",))


def genre_report(
    genres: DataFrame, t: Thresholds = DEFAULTS, *, sort_unrounded: bool = False
) -> DataFrame:
    """Reach and quality per genre that has enough items."""
    grouped = genres.groupBy("genre").agg(
        items(), reviews(), mean_rating(), mean_wilson(), F.avg("wilson_score").alias("_exact")
    )
    large = at_least(grouped, "games", t.min_label_items)
    order = _ordered(large, "mean_wilson_pct", "_exact", "genre", sort_unrounded)
    return large.orderBy(*order).drop("_exact")


def platform_report(platforms: DataFrame) -> DataFrame:
    """Coverage and mean rate per platform."""
    grouped = platforms.groupBy("platform").agg(items(), mean_rating())
    return grouped.orderBy(F.desc("games"), "platform")


def at_least(report: DataFrame, column: str, minimum: int) -> DataFrame:
    """Rows of a report that reach a minimum."""
    return report.filter(F.col(column) >= minimum)


def largest_genres(genre: DataFrame, n: int = 12) -> DataFrame:
    """The most reviewed genres in ascending order of quality."""
    return ranking.top_then_resort(
        genre, n, take_by="total_reviews", show_by="mean_wilson_pct", tie=["genre"]
    )


def genre_bubbles(genre: DataFrame, n: int = 12) -> DataFrame:
    """The most reviewed genres in ascending order of quality, with a marker size."""
    largest = ranking.top_n(genre, n, "total_reviews", tie=["genre"])
    peak = F.max("total_reviews").over(Window.partitionBy())  # over the n listed rows
    sized = largest.withColumn("marker_size", M.relative_size("total_reviews", peak))
    return sized.orderBy(F.col("mean_wilson_pct").asc_nulls_last(), "genre")


# -- price ------------------------------------------------------------------


def price_band_report(games: DataFrame, *, exact: bool = False, accuracy: int = 10000) -> DataFrame:
    """Items, mean price, mean rate and median outcomes per price band.

    The median is approximate, with bounded memory, or exact: interpolated and
    then cut to a whole number.
    """
    measured = [items(), mean_of("price", "mean_price"), mean_rating()]
    grouped = games.groupBy("price_band")
    if not exact:
        median = F.percentile_approx("total_reviews", 0.5, accuracy).cast("long")
        return grouped.agg(*measured, median.alias("median_reviews"))
    medians = exact_quantiles(
        games, ["total_reviews"], 0.5, by=["price_band"], bounded_groups=True
    ).select(
        F.col("price_band").alias("_band"), F.col("quantile").cast("long").alias("median_reviews")
    )
    same_band = F.col("price_band").eqNullSafe(F.col("_band"))
    return grouped.agg(*measured).join(medians, same_band, "left").drop("_band")


def in_band_order(report: DataFrame, labels: Sequence[str] = BAND_LABELS) -> DataFrame:
    """A band report in the declared order of the bands."""
    return report.orderBy(M.band_position("price_band", labels), "price_band")


def complete_bands(report: DataFrame, labels: Sequence[str] = BAND_LABELS) -> DataFrame:
    """One row per declared band: absent bands get null measures and median zero."""
    dimension = band_dimension(report.sparkSession, labels)
    filled = dimension.join(report, "price_band", "left").withColumn(
        "median_reviews", F.coalesce("median_reviews", F.lit(0).cast("long"))
    )
    return filled.orderBy("band_order").select(*report.columns)


def best_price_band(report: DataFrame, labels: Sequence[str] = BAND_LABELS) -> DataFrame:
    """The band with the highest mean rate, the first one among equals."""
    placed = report.withColumn("_place", M.band_position("price_band", labels))
    return ranking.row_of_max(
        placed, "mean_rating_pct", first_by="_place", columns=["price_band", "mean_rating_pct"]
    )


# -- several reports from one scan ------------------------------------------

SHARED = ("release_year", "price_band", "publisher")


def shared_totals(games: DataFrame, *, accuracy: int = 10000) -> DataFrame:
    """The totals per year, per band and per publisher, by grouping sets over one scan.

    ``grouped_by`` names the column that a row is grouped by; the others are null. Sums
    and counts are kept beside the means, so that rows can be ordered by the unrounded mean. Write the
    table (or let one report use it) before deriving several reports: each reads it again.
    """
    keys = [F.col(c) for c in SHARED]
    which = F.grouping_id(*SHARED)
    names = {3: "release_year", 5: "price_band", 6: "publisher"}
    named = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    totals = games.select(*SHARED, "total_reviews", "rating_pct", "wilson_score", "price").groupingSets(
        [[key] for key in keys], *keys
    )
    return totals.agg(
        which.cast("int").alias("_which"),
        items(),
        reviews(),
        mean_rating(),
        mean_wilson(),
        F.avg("wilson_score").alias("exact_wilson"),
        mean_of("price", "mean_price"),
        F.percentile_approx("total_reviews", 0.5, accuracy).cast("long").alias("median_reviews"),
    ).select(F.element_at(named, F.col("_which")).alias("grouped_by"), *SHARED, *[
        "games", "total_reviews", "mean_rating_pct", "mean_wilson_pct", "exact_wilson", "mean_price", "median_reviews",
    ])


def yearly_of(totals: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """The yearly report from shared totals."""
    rows = totals.where(F.col("grouped_by") == "release_year")
    in_range = rows.filter(F.col("release_year").between(t.first_year, t.last_year))
    return in_range.select("release_year", "games", "total_reviews", "mean_rating_pct").orderBy("release_year")


def bands_of(totals: DataFrame) -> DataFrame:
    """The price band report, with the approximate median, from shared totals."""
    rows = totals.where(F.col("grouped_by") == "price_band")
    return rows.select("price_band", "games", "mean_price", "mean_rating_pct", "median_reviews")


def publishers_of(totals: DataFrame, t: Thresholds = DEFAULTS, *, sort_unrounded: bool = False) -> DataFrame:
    """The publisher report from shared totals."""
    rows = totals.where((F.col("grouped_by") == "publisher") & F.col("publisher").isNotNull() & (F.col("publisher") != ""))
    scale = at_least(rows, "games", t.min_publisher_items)
    scale = at_least(scale, "total_reviews", t.min_publisher_reviews)
    order = _ordered(scale, "mean_wilson_pct", "exact_wilson", "publisher", sort_unrounded)
    return scale.orderBy(*order).limit(t.top_publishers).select("publisher", "games", "total_reviews", "mean_wilson_pct")


# -- rankings ---------------------------------------------------------------


def evidenced(games: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    return at_least(games, "total_reviews", t.min_reviews)


def shown_ranking(best: DataFrame, *first: str) -> DataFrame:
    return best.select(
        *first,
        "appid",
        "name",
        "total_reviews",
        F.round("rating_pct", 2).alias("rating_pct"),
        F.round(F.col("wilson_score") * 100, 2).alias("wilson_pct"),
        "price",
    )


def top_reliable(games: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Best items by the unrounded lower bound among those with enough outcomes."""
    best = ranking.top_n(evidenced(games, t), t.top_items, "wilson_score", tie=["appid"])
    return shown_ranking(best)


def top_reliable_numbered(games: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """The ranking of the best items with position numbers."""
    order = [F.col("wilson_score").desc_nulls_last(), "appid"]
    best = ranking.numbered(evidenced(games, t), order, at_most=t.top_items)
    return shown_ranking(best, "position")


def publisher_report(
    games: DataFrame, t: Thresholds = DEFAULTS, *, sort_unrounded: bool = False
) -> DataFrame:
    """Publishers with scale, by mean lower bound."""
    named = games.filter(F.col("publisher").isNotNull() & (F.col("publisher") != ""))
    grouped = named.groupBy("publisher").agg(
        items(), reviews(), mean_wilson(), F.avg("wilson_score").alias("_exact")
    )
    scale = at_least(grouped, "games", t.min_publisher_items)
    scale = at_least(scale, "total_reviews", t.min_publisher_reviews)
    order = _ordered(scale, "mean_wilson_pct", "_exact", "publisher", sort_unrounded)
    return scale.orderBy(*order).limit(t.top_publishers).drop("_exact")


def top_tags(votes: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Most voted tags from long votes: distinct items, votes, mean rate."""
    grouped = votes.groupBy("tag").agg(
        F.count_distinct("appid").alias("tagged_games"),
        F.sum("votes").alias("total_tag_votes"),
        mean_rating(),
    )
    return ranking.top_n(grouped, t.top_tags, "total_tag_votes", tie=["tag"])


def top_tags_from_totals(totals: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Most voted tags from totals per tag."""
    rounded = totals.select(
        "tag", "tagged_games", "total_tag_votes", F.round("mean_rating", 2).alias("mean_rating_pct")
    )
    return ranking.top_n(rounded, t.top_tags, "total_tag_votes", tie=["tag"])


def era_champions(games: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """Best items of each release year; tied items share a rank and are all listed."""
    eligible = evidenced(games, t).filter(F.col("release_year").isNotNull())
    # A date has four-digit years, so there are at most some ten thousand groups.
    best = ranking.dense_rank_within(
        eligible, "release_year", "wilson_score", keep=t.era_ranks, bounded_groups=True
    )
    listed = ["release_year", "era_rank", "appid", "name", "total_reviews", "rating_pct", "wilson_score"]
    return best.select(*listed).orderBy("release_year", "era_rank", "appid")


# -- samples -----------------------------------------


def uncertainty_sample(games: DataFrame, q: float = 0.995) -> DataFrame:
    """Items with outcomes, without the most reviewed ones, on a log scale."""
    limit = exact_quantiles(games, ["total_reviews"], q).select("quantile").scalar()
    volume = F.col("total_reviews")
    trimmed = games.filter((volume > 0) & (volume <= limit))
    return trimmed.select("appid", F.log10(volume).alias("log_reviews"), "rating_pct")
