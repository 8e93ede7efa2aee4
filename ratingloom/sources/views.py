"""Named views for SQL callers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ratingloom.defaults import Z_95
from ratingloom.operators.reshape import explode_labels


def register_views(games: DataFrame, votes: DataFrame | None = None) -> None:
    """``games``, ``game_genres``, ``game_platforms`` and, given votes, ``tag_votes``."""
    views = {
        "games": games,
        "game_genres": explode_labels(
            games, "genres", "genre", keep=("total_reviews", "rating_pct", "wilson_score")
        ),
        "game_platforms": explode_labels(games, "platforms", "platform", keep=("rating_pct",)),
        "tag_votes": votes,
    }
    for name, table in views.items():
        if table is not None:
            table.createOrReplaceTempView(name)


def register_wilson(spark, name: str = "wilson_lower_bound", z: float = Z_95) -> None:
    """The Wilson lower bound as a SQL function; Spark inlines its body in the plan.

    The body is the same arithmetic as the column builder, over a divisor that is
    null without outcomes.
    """
    square = repr(z * z) + "D"
    n = "nullif(greatest(total, 0L), 0L)"
    spread = f"sqrt(((positive / {n}) * (1 - positive / {n}) + {square} / (4 * {n})) / {n})"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(positive BIGINT, total BIGINT)
        RETURNS DOUBLE
        RETURN (positive / {n} + {square} / (2 * {n}) - {z!r}D * {spread}) / (1 + {square} / {n})
        """
    )
