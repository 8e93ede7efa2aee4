"""Multi-label strings and wide vote matrices to long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.defaults import LABEL_SEPARATOR
from ratingloom.functions.text import split_labels
from ratingloom.operators.skew import HEAVY_ROWS, dealt_join, heavy_keys


def quoted(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def value_columns(df: DataFrame, key: str | Sequence[str] = "appid") -> list[str]:
    """Every column but the key."""
    keys = {key} if isinstance(key, str) else set(key)
    return [name for name in df.columns if name not in keys]


def explode_labels(
    df: DataFrame,
    source: str,
    label: str,
    *,
    key: str = "appid",
    keep: Sequence[str] = (),
    separator: str = LABEL_SEPARATOR,
    unique_key: bool = True,
) -> DataFrame:
    """One row per (key, distinct label), carrying the ``keep`` columns along.

    Labels are made distinct inside the row and the measures ride with them, so
    there is neither a shuffle nor a join back to the fact. Where the key may
    repeat, ``unique_key=False`` keeps one row per (key, label) over all rows.
    """
    long = df.select(key, *keep, F.explode(split_labels(source, separator)).alias(label))
    return long if unique_key else long.dropDuplicates([key, label])


def join_measures(
    labels: DataFrame, facts: DataFrame, measures: Sequence[str], key: str = "appid"
) -> DataFrame:
    """Labels that arrive in their own table, with the measures of their item."""
    return labels.join(facts.select(key, *measures), key)


def unpivot_votes(
    wide: DataFrame,
    *,
    key: str = "appid",
    columns: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    label: str = "tag",
    value: str = "votes",
) -> DataFrame:
    """Sparse long form of a vote matrix: one row per positive cell.

    The cells travel as a plain number array and a position; the name of the
    column is looked up only for the cells that stay.
    """
    columns = list(columns) if columns else value_columns(wide, (key, *keep))
    cells = _cells(wide, columns, [key, *keep], value).filter(F.col(value) > 0)
    return cells.select(key, *keep, _name_at(columns, label), value)


def _cells(wide: DataFrame, columns: Sequence[str], keep: Sequence[str], value: str) -> DataFrame:
    numbers = F.array(*[quoted(name).cast("long") for name in columns])
    return wide.select(*keep, F.posexplode(numbers).alias("_position", value))


def _compact(wide: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Each row as its key and the positive cells by position."""
    numbers = F.array(*[quoted(name).cast("long") for name in columns])
    cells = F.filter(
        F.transform(numbers, lambda votes, at: F.struct(at.alias("position"), votes.alias("votes"))),
        lambda cell: cell["votes"] > 0,
    )
    return wide.select(key, cells.alias("_cells")).filter(F.size("_cells") > 0)


def _name_at(columns: Sequence[str], label: str) -> Column:
    names = F.array(*[F.lit(name) for name in columns])
    return F.element_at(names, F.col("_position") + 1).alias(label)


def _unnested(rows: DataFrame, *kept: str) -> DataFrame:
    """One row per cell of ``_compact`` rows."""
    cells = rows.select(*kept, F.explode("_cells").alias("_cell"))
    return cells.select(*kept, F.col("_cell.position").alias("_position"), F.col("_cell.votes").alias("votes"))


def rated_votes(
    wide: DataFrame,
    facts: DataFrame,
    *,
    key: str = "appid",
    measures: Sequence[str] = ("rating_pct",),
    columns: Sequence[str] | None = None,
    how: str = "inner",
    least_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Long votes with the measures of their item.

    A matrix row joins once, as an array of its positive cells, and is unnested after the
    join: a sparse row of hundreds of columns travels as a few numbers. Items with more
    than ``least_rows`` matrix rows are measured and dealt over several tasks.
    ``how="left"`` keeps votes whose item is unknown.
    """
    columns = list(columns) if columns else value_columns(wide, key)
    counts = wide.groupBy(key).agg(F.count("*").alias("rows"))
    heavy = heavy_keys(counts, key, least_rows=least_rows)
    rows, rated = _compact(wide, columns, key), facts.select(key, *measures)
    rated = dealt_join(rows, rated, key, how=how, heavy=heavy, least_rows=least_rows)
    return _unnested(rated, key, *measures).select(key, _name_at(columns, "tag"), "votes", *measures)


def wide_vote_totals(
    wide: DataFrame,
    *,
    columns: Sequence[str],
    measure: str = "rating_pct",
    label: str = "tag",
) -> DataFrame:
    """Per column: positive cells, sum of cells, mean measure of the positive cells.

    Unlike the long form this also lists columns nobody voted for, and a repeated
    item counts once per row. The cells are folded by position as they come out of
    the row, so a map task sends one row per column to the shuffle; hundreds of
    columns as separate aggregates would be too many for code generation.
    """
    positive = F.col("votes") > 0
    totals = (
        _cells(wide, columns, [measure], "votes")
        .groupBy("_position")
        .agg(
            F.count_if(positive).alias("tagged_games"),
            F.coalesce(F.sum("votes"), F.lit(0).cast("long")).alias("total_tag_votes"),
            F.avg(F.when(positive, F.col(measure))).alias("mean_rating"),
        )
    )
    return totals.select(_name_at(columns, label), "tagged_games", "total_tag_votes", "mean_rating")


def _single_totals(rows: DataFrame, facts: DataFrame, key: str, measure: str, how: str) -> DataFrame:
    """Partial totals of items with one matrix row: joined as arrays, cells are never shuffled."""
    rated = rows.join(facts, key, how)
    return (
        _unnested(rated, key, measure)
        .groupBy("_position")
        .agg(
            F.count(key).alias("items"),
            F.sum("votes").alias("votes"),
            F.sum(measure).alias("weighted"),
            F.count(measure).alias("weight"),
        )
    )


def _repeated_totals(rows: DataFrame, facts: DataFrame, key: str, measure: str, how: str) -> DataFrame:
    """Partial totals of items with several rows: an item's cells are combined, map side first, then joined."""
    combined = (
        _unnested(rows, key)
        .groupBy(key, "_position")
        .agg(F.sum("votes").alias("votes"), F.count("*").alias("cells"))
    )
    rated = combined.join(facts, key, how)
    return rated.groupBy("_position").agg(
        F.count(key).alias("items"),
        F.sum("votes").alias("votes"),
        F.sum(F.col(measure) * F.col("cells")).alias("weighted"),
        F.coalesce(F.sum(F.when(F.col(measure).isNotNull(), F.col("cells"))), F.lit(0)).alias("weight"),
    )


def tag_totals(
    wide: DataFrame,
    facts: DataFrame,
    *,
    key: str = "appid",
    measure: str = "rating_pct",
    columns: Sequence[str] | None = None,
    how: str = "inner",
    unique_key: bool | None = None,
    least_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Per tag: distinct items, votes, mean measure over the voted cells.

    The keys of the matrix are counted first, map side first and without its cells. Where
    none repeats, each row joins the ratings once, as an array of its positive cells, and
    is unnested after the join into the partial aggregate. Where some repeat, only their
    rows take the other way: their cells are combined by item and tag before the join, so
    that an item counts once per tag. Keys with very many rows are dealt over tasks while
    they are told apart. Tags travel as positions and get their name at the end.

    ``unique_key=True`` trusts that no key repeats and ``False`` combines all rows; either
    saves the count. A null key joins nothing and counts as no item.
    """
    columns = list(columns) if columns else value_columns(wide, key)
    facts = facts.select(key, measure)
    rows = _compact(wide, columns, key)
    parts = []
    if unique_key is None:
        counts = wide.groupBy(key).agg(F.count("*").alias("rows"))
        heaviest = heavy_keys(counts, key, least_rows=1)
        unique_key = not heaviest
        if not unique_key:
            mark = counts.where("rows > 1").select(key, F.lit(True).alias("_repeated"))
            rows = dealt_join(rows, mark, key, how="left", heavy=heaviest, least_rows=least_rows)
            parts = [
                _single_totals(rows.where("_repeated IS NULL").drop("_repeated"), facts, key, measure, how),
                _repeated_totals(rows.where("_repeated"), facts, key, measure, how),
            ]
    if not parts:
        totals = _single_totals if unique_key else _repeated_totals
        parts = [totals(rows, facts, key, measure, how)]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    totals = stacked.groupBy("_position").agg(
        F.sum("items").alias("tagged_games"),
        F.sum("votes").alias("total_tag_votes"),
        F.try_divide(F.sum("weighted"), F.sum("weight")).alias("mean_rating"),
    )
    return totals.select(_name_at(columns, "tag"), "tagged_games", "total_tag_votes", "mean_rating")
