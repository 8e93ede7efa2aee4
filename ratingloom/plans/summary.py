"""One-row summaries: data quality, missing values, the run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.defaults import ddl_names
from ratingloom.operators.quantiles import exact_quantiles, quantile_row

# The metrics of a run, in order.
SUMMARY_SCHEMA = """
    raw_rows BIGINT, clean_rows BIGINT, distinct_appids BIGINT,
    duplicate_appids_removed BIGINT, missing_release_date_before BIGINT,
    missing_release_date_after BIGINT, missing_price_after BIGINT,
    zero_review_games BIGINT, total_positive_ratings BIGINT,
    total_negative_ratings BIGINT, overall_weighted_positive_pct DOUBLE,
    median_game_rating_pct DOUBLE, median_reviews_per_game BIGINT
"""


def quality_report(games: DataFrame, key: str = "appid", *, approximate: bool = False) -> DataFrame:
    """Rows, distinct keys, missing dates and prices, items without outcomes.

    The exact distinct count shuffles every key; ``approximate`` shuffles sketches.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return games.agg(
        F.count("*").alias("clean_rows"),
        distinct(key).alias("distinct_appids"),
        F.count_if(F.col("release_date").isNull()).alias("missing_release_date"),
        F.count_if(F.col("price").isNull()).alias("missing_price"),
        F.count_if(F.col("total_reviews") == 0).alias("zero_review_games"),
    )


def missing_before(
    raw: DataFrame, columns: Sequence[str] = ("release_date", "price", "genres", "publisher")
) -> DataFrame:
    """Missing values per column before cleaning."""
    return raw.agg(*[F.count_if(F.col(name).isNull()).alias(f"missing_{name}") for name in columns])


def run_summary(raw: DataFrame, games: DataFrame, key: str = "appid") -> DataFrame:
    """The metrics of a run, from the raw rows and the curated fact.

    Each part is a one-row aggregate; the parts are stacked and folded into one
    row, each metric being set in exactly one of them.
    """
    from_raw = raw.agg(
        F.count("*").alias("raw_rows"),
        # Rows without a key count as copies of one another.
        (F.count("*") - F.count_distinct(key) - F.coalesce(F.max(F.col(key).isNull().cast("long")), F.lit(0)))
        .alias("duplicate_appids_removed"),
        F.count_if(F.col("release_date").isNull()).alias("missing_release_date_before"),
    )
    positive, total = F.sum("positive_ratings"), F.sum("total_reviews")
    from_clean = games.agg(
        F.count("*").alias("clean_rows"),
        # Cleaning leaves one row per key; the unique-key check of a run proves it.
        F.count(key).alias("distinct_appids"),
        F.count_if(F.col("release_date").isNull()).alias("missing_release_date_after"),
        F.count_if(F.col("price").isNull()).alias("missing_price_after"),
        F.count_if(F.col("total_reviews") == 0).alias("zero_review_games"),
        positive.alias("total_positive_ratings"),
        F.sum("negative_ratings").alias("total_negative_ratings"),
        # Totals may be near the bigint limit, so the factor is not an integer.
        F.round(F.try_divide(100.0 * positive, total), 2).alias("overall_weighted_positive_pct"),
    )
    return _folded([from_raw, from_clean, _medians(games)])


def observed_summary(observed: dict[str, int], games: DataFrame) -> DataFrame:
    """The metrics of a run from what its curated pass observed; only the medians read the curated fact."""
    total, positive = observed["total_reviews"], observed["positive_ratings"]
    row = {
        "raw_rows": observed["raw_rows"],
        "clean_rows": observed["clean_rows"],
        # Cleaning leaves one row per key; the unique-key check of a run proves it.
        "distinct_appids": observed["clean_rows"],
        "duplicate_appids_removed": observed["duplicate_appids_removed"],
        "missing_release_date_before": observed["missing_release_date"],
        "missing_release_date_after": observed["missing_release_date_after"],
        "missing_price_after": observed["missing_price_after"],
        "zero_review_games": observed["zero_review_games"],
        "total_positive_ratings": positive,
        "total_negative_ratings": observed["negative_ratings"],
    }
    schema = ", ".join(f"{name} BIGINT" for name in row)
    counted = games.sparkSession.createDataFrame([tuple(row.values())], schema)
    share = F.try_divide(F.lit(100.0) * F.lit(positive).cast("long"), F.lit(total).cast("long"))
    counted = counted.withColumn("overall_weighted_positive_pct", F.round(share, 2))
    return _folded([counted, _medians(games)])


def _medians(games: DataFrame) -> DataFrame:
    measures = ["rating_pct", "total_reviews"]
    return quantile_row(exact_quantiles(games, measures, 0.5), measures).select(
        F.round("rating_pct", 2).alias("median_game_rating_pct"),
        F.col("total_reviews").cast("long").alias("median_reviews_per_game"),
    )


def _folded(parts: Sequence[DataFrame]) -> DataFrame:
    """Stacked one-row tables as one row, each metric being set in exactly one of them."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, True)
    return stacked.agg(*[F.max(name).alias(name) for name in ddl_names(SUMMARY_SCHEMA)])
