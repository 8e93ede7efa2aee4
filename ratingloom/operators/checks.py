"""Data-quality checks; each returns one row ``(check, violations, passed)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.defaults import BAND_LABELS
from ratingloom.operators.cleaning import band_dimension


def _verdict(df: DataFrame, check: str, violations: Column) -> DataFrame:
    counted = df.agg(F.coalesce(violations.cast("long"), F.lit(0).cast("long")).alias("violations"))
    return counted.select(F.lit(check).alias("check"), "violations", (F.col("violations") == 0).alias("passed"))


def unique_key(df: DataFrame, key: str = "appid") -> DataFrame:
    """Keys that occur more than once."""
    copies = df.groupBy(key).agg(F.count("*").alias("copies"))
    return _verdict(copies, "unique_key", F.count_if(F.col("copies") > 1))


def _unlike_totals(p: Column, n: Column, t: Column) -> Column:
    """How many of the two rules on sums of outcomes are broken: they add up, at a rate in (0, 100]."""
    rate = F.try_divide(100.0 * p, t)
    wrong_total = F.when((p + n).eqNullSafe(t), 0).otherwise(1)
    wrong_rate = F.when((rate > 0) & (rate <= 100), 0).otherwise(1)
    return wrong_total + wrong_rate


def consistent_totals(
    df: DataFrame,
    positive: str = "positive_ratings",
    negative: str = "negative_ratings",
    total: str = "total_reviews",
) -> DataFrame:
    """Outcome totals that disagree, plus a weighted rate outside (0, 100]."""
    return _verdict(df, "consistent_totals", _unlike_totals(F.sum(positive), F.sum(negative), F.sum(total)))


def run_battery(
    games: DataFrame, top: DataFrame, bands: DataFrame, *, min_reviews: int, tolerance: float, key: str = "appid"
) -> DataFrame:
    """unique_key, consistent_totals, group_total, meets_threshold and lower_bound_holds in one pass.

    The fact is read once, for its key and three counts, and summed by key, map side
    first; the other tables are results of a few rows. The parts are one-row aggregates, stacked
    and folded.
    """
    outcomes = ("positive_ratings", "negative_ratings", "total_reviews")
    by_key = games.groupBy(key).agg(F.count("*").alias("copies"), *[F.sum(c).alias(c) for c in outcomes])
    no = F.lit(0).cast("long")
    from_fact = by_key.agg(
        F.count_if(F.col("copies") > 1).alias("unique_key"),
        _unlike_totals(*[F.sum(c) for c in outcomes]).cast("long").alias("consistent_totals"),
        F.coalesce(F.sum("copies"), no).alias("_rows"),
    )
    from_top = top.agg(
        F.count_if(F.col("total_reviews") < min_reviews).alias("meets_threshold"),
        F.count_if(F.col("wilson_pct") > F.col("rating_pct") + tolerance).alias("lower_bound_holds"),
    )
    from_bands = bands.agg(F.coalesce(F.sum("games"), no).alias("_listed"))
    stacked = from_fact.unionByName(from_top, True).unionByName(from_bands, True)
    names = ["unique_key", "consistent_totals", "meets_threshold", "lower_bound_holds"]
    folded = stacked.agg(
        *[F.max(name).alias(name) for name in names], F.abs(F.max("_listed") - F.max("_rows")).alias("group_total")
    )
    listed = F.array(
        *[F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in [*names, "group_total"]]
    )
    rows = folded.select(F.explode(listed).alias("one")).select("one.*")
    return rows.withColumn("passed", F.col("violations") == 0)


def ranking_order(
    top: DataFrame, score: str, order: Sequence[Column | str], *, at_most: int
) -> DataFrame:
    """Rows of a ranking whose score exceeds the one before, over its first ``at_most`` rows.

    The limit is applied here: the rows are compared in one task.
    """
    previous = F.lag(score).over(Window.orderBy(*order))
    stepped = top.orderBy(*order).limit(at_most).withColumn("_rises", F.col(score) > previous)
    return _verdict(stepped, "ranking_order", F.count_if("_rises"))


def meets_threshold(df: DataFrame, column: str, minimum: int) -> DataFrame:
    """Rows below the evidence threshold."""
    return _verdict(df, "meets_threshold", F.count_if(F.col(column) < minimum))


def lower_bound_holds(
    df: DataFrame, lower_pct: str | Column, rate_pct: str = "rating_pct", tolerance: float = 1e-9
) -> DataFrame:
    """Rows whose lower bound lies above the raw rate."""
    lower = F.col(lower_pct) if isinstance(lower_pct, str) else lower_pct
    return _verdict(df, "lower_bound_holds", F.count_if(lower > F.col(rate_pct) + tolerance))


def group_total(report: DataFrame, count: str, facts: DataFrame) -> DataFrame:
    """Difference between the counts of a grouped report and the rows of its facts."""
    parts = report.select(F.col(count).alias("rows")).unionByName(facts.agg((-F.count("*")).alias("rows")))
    return _verdict(parts, "group_total", F.abs(F.sum("rows")))


def label_domain(
    report: DataFrame, label: str = "price_band", labels: Sequence[str] = BAND_LABELS
) -> DataFrame:
    """Labels that are missing from the report or unknown to the declared list."""
    declared = band_dimension(report.sparkSession, labels, label)
    both = declared.select(label, F.lit(True).alias("_declared")).join(
        report.select(label, F.lit(True).alias("_reported")), label, "full"
    )
    alone = F.col("_declared").isNull() | F.col("_reported").isNull()
    return _verdict(both, "label_domain", F.count_if(alone))


def label_order(report: DataFrame, label: str = "price_band", labels: Sequence[str] = BAND_LABELS,
                position: str = "position") -> DataFrame:
    """Labels of a numbered report that are not at their declared place."""
    declared = band_dimension(report.sparkSession, labels, label)
    placed = report.join(declared, label, "left")
    moved = ~F.col("band_order").eqNullSafe(F.col(position) - 1)
    return _verdict(placed, "label_order", F.count_if(moved))
