"""Reports as display text: numbers formatted, labels made readable.

Input is a finished report of known small size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions import text as X
from ratingloom.operators import ranking


def headline_figures(summary: DataFrame) -> DataFrame:
    """The summary's key figures as numbers and as display text."""
    outcomes = F.col("total_positive_ratings") + F.col("total_negative_ratings")
    gap = F.round(F.col("overall_weighted_positive_pct") - F.col("median_game_rating_pct"), 2)
    return summary.select(
        outcomes.alias("review_outcomes"),
        gap.alias("weighted_minus_median"),
        X.thousands("clean_rows").alias("games_text"),
        X.thousands(outcomes).alias("review_outcomes_text"),
        X.affixed("overall_weighted_positive_pct", suffix="%").alias("weighted_positive_text"),
        X.affixed("median_game_rating_pct", suffix="%").alias("median_rating_text"),
        X.affixed(gap, suffix="-point").alias("gap_text"),
        X.thousands("median_reviews_per_game").alias("median_reviews_text"),
    )


def price_band_text(report: DataFrame, currency: str = "GBP") -> DataFrame:
    """A band report as display text, prices with their currency."""
    return report.select(
        "price_band",
        X.thousands("games").alias("games_text"),
        X.affixed("mean_price", prefix=f"{currency} ").alias("mean_price_text"),
        X.affixed("mean_rating_pct").alias("mean_rating_text"),
        X.thousands("median_reviews").alias("median_reviews_text"),
    )


def ranking_text(numbered_top: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of a numbered item ranking with chart-safe names."""
    return ranking.top_n(numbered_top, n, "position", tie=["appid"], ascending=True).select(
        "position",
        X.display_label("name", "Non-Latin title").alias("display_name"),
        X.thousands("total_reviews").alias("reviews_text"),
        X.affixed("rating_pct").alias("rating_text"),
        X.affixed("wilson_pct").alias("wilson_text"),
    )


def tag_text(top: DataFrame, n: int = 8) -> DataFrame:
    """The first rows of a tag ranking with readable tags."""
    return ranking.top_n(top, n, "total_tag_votes", tie=["tag"]).select(
        X.title_words("tag").alias("label"),
        X.thousands("tagged_games").alias("games_text"),
        X.thousands("total_tag_votes").alias("votes_text"),
        X.affixed("mean_rating_pct").alias("mean_rating_text"),
    )
