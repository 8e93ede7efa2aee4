"""The report catalogue as Spark SQL over the registered views.

The texts use SQL's pipe form and named parameters; ``run`` binds the thresholds.
They need the views of ``ratingloom.sources.views``.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.defaults import BAND_LABELS, Thresholds

SQL_REPORTS = {
    "yearly": """
        FROM games
        |> WHERE release_year BETWEEN :first_year AND :last_year
        |> AGGREGATE count(*) AS games, sum(total_reviews) AS total_reviews,
                     round(avg(rating_pct), 2) AS mean_rating_pct
           GROUP BY release_year
        |> ORDER BY release_year
    """,
    "genre": """
        FROM game_genres
        |> AGGREGATE count(*) AS games, sum(total_reviews) AS total_reviews,
                     round(avg(rating_pct), 2) AS mean_rating_pct,
                     round(avg(wilson_score) * 100, 2) AS mean_wilson_pct
           GROUP BY genre
        |> WHERE games >= :min_label_items
        |> ORDER BY mean_wilson_pct DESC NULLS LAST, genre
    """,
    "price_band": """
        FROM games
        |> AGGREGATE count(*) AS games, round(avg(price), 2) AS mean_price,
                     round(avg(rating_pct), 2) AS mean_rating_pct,
                     cast(percentile_approx(total_reviews, 0.5) AS BIGINT) AS median_reviews
           GROUP BY price_band
        |> ORDER BY array_position(:band_labels, price_band), price_band
    """,
    "top_reliable": """
        FROM games
        |> WHERE total_reviews >= :min_reviews
        |> ORDER BY wilson_score DESC NULLS LAST, appid
        |> LIMIT :top_items
        |> SELECT appid, name, total_reviews, round(rating_pct, 2) AS rating_pct,
                  round(wilson_score * 100, 2) AS wilson_pct, price
    """,
    "platform": """
        FROM game_platforms
        |> AGGREGATE count(*) AS games, round(avg(rating_pct), 2) AS mean_rating_pct
           GROUP BY platform
        |> ORDER BY games DESC, platform
    """,
    "publishers": """
        FROM games
        |> WHERE publisher <> ''
        |> AGGREGATE count(*) AS games, sum(total_reviews) AS total_reviews,
                     round(avg(wilson_score) * 100, 2) AS mean_wilson_pct
           GROUP BY publisher
        |> WHERE games >= :min_publisher_items AND total_reviews >= :min_publisher_reviews
        |> ORDER BY mean_wilson_pct DESC NULLS LAST, publisher
        |> LIMIT :top_publishers
    """,
    "top_tags": """
        FROM tag_votes
        |> AGGREGATE count(DISTINCT appid) AS tagged_games, sum(votes) AS total_tag_votes,
                     round(avg(rating_pct), 2) AS mean_rating_pct
           GROUP BY tag
        |> ORDER BY total_tag_votes DESC, tag
        |> LIMIT :top_tags
    """,
}


def run(spark: SparkSession, name: str, t: Thresholds | None = None) -> DataFrame:
    """One report of the catalogue, with its thresholds bound as parameters."""
    args = asdict(t or Thresholds()) | {"band_labels": F.array(*map(F.lit, BAND_LABELS))}
    text = SQL_REPORTS[name]
    return spark.sql(text, args={key: value for key, value in args.items() if f":{key}" in text})
