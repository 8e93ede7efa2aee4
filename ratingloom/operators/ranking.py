"""Top-k, rank within a group, position numbers, row of the maximum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, by: str | Column, *, tie: Sequence[str], ascending: bool = False) -> DataFrame:
    """First ``n`` rows by one measure; ``tie`` must make the order unique."""
    measure = F.col(by) if isinstance(by, str) else by
    first = measure.asc_nulls_last() if ascending else measure.desc_nulls_last()
    return df.orderBy(first, *tie).limit(n)


def top_then_resort(
    df: DataFrame, n: int, *, take_by: str, show_by: str, tie: Sequence[str]
) -> DataFrame:
    """The ``n`` largest by one measure, shown in ascending order of another."""
    return top_n(df, n, take_by, tie=tie).orderBy(F.col(show_by).asc_nulls_last(), *tie)


BROADCAST_RANKS = 100  # ranks of a bounded group that are few enough for a forced broadcast


def numbered(
    df: DataFrame, order: Sequence[Column | str], alias: str = "position", *, at_most: int
) -> DataFrame:
    """Number the first ``at_most`` rows of a ranking; only these meet in one task."""
    top = df.orderBy(*order).limit(at_most)
    return top.withColumn(alias, F.row_number().over(Window.orderBy(*order)))


def dense_rank_within(
    df: DataFrame,
    group: str,
    score: str,
    *,
    keep: int,
    alias: str = "era_rank",
    bounded_groups: bool = False,
) -> DataFrame:
    """Rows whose score is among the ``keep`` best distinct scores of their group.

    Ties share a rank, and one group or one tied score may hold any number of
    rows. So only distinct (group, score) pairs are ranked, each map task sending
    its own best few, and the few cut-off scores are joined back to the rows: no
    task ever receives a whole group, and the rows are not shuffled when the
    cut-offs are small enough for Spark to broadcast. Missing scores rank last.
    """
    best_first = Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last())
    cutoffs = (
        df.select(group, score)
        .distinct()
        .withColumn(alias, F.dense_rank().over(best_first))
        .filter(F.col(alias) <= keep)
        .select(F.col(group).alias("_group"), F.col(score).alias("_score"), alias)
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(score).eqNullSafe(F.col("_score"))
    cutoffs = F.broadcast(cutoffs) if bounded_groups and keep <= BROADCAST_RANKS else cutoffs
    return df.join(cutoffs, same).drop("_group", "_score")


def row_of_max(df: DataFrame, by: str, *, first_by: str, columns: Sequence[str]) -> DataFrame:
    """The row with the largest ``by``; among equals the lowest ``first_by`` (numeric)."""
    best = F.max_by(
        F.struct(*columns),
        F.when(F.col(by).isNotNull(), F.struct(F.col(by), -F.col(first_by))),
    )
    return df.agg(best.alias("best")).filter(F.col("best").isNotNull()).select("best.*")
