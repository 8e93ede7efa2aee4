"""Joins whose heavy keys are measured and dealt over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_HEAVY = 1000  # keys that are dealt at once; any other holds less than one row in a thousand
HEAVY_ROWS = 10_000  # fewer rows of a key are no burden to a task


def heavy_keys(counts: DataFrame, key: str, *, least_rows: int = HEAVY_ROWS) -> dict[object, int]:
    """The keys with more than ``least_rows`` rows and their counts, at most MOST_HEAVY of them.

    ``counts`` has one line per key, with its ``rows``. The list on the driver is bounded
    whatever the data. A null key is listed like any other.
    """
    found = counts.where(F.col("rows") > least_rows).orderBy(F.desc("rows")).limit(MOST_HEAVY)
    return {r[0]: r[1] for r in found.select(key, "rows").collect()}


def dealt_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    *,
    how: str = "inner",
    heavy: dict[object, int] | None = None,
    least_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Join a large side to one line per key; the rows of a heavy key go to several tasks.

    A key is heavy if its measured rows exceed ``least_rows``; it is dealt into parts of
    that many rows, and only its line of the small side is repeated, once per part. So
    no task gets more rows of a key than that, without help from adaptive execution. Where
    no key is heavy, this is the plain join. ``heavy``: the measured keys with their rows,
    where the caller has them. ``how``: inner, left, left_semi or left_anti; rows with a null
    key match nothing and are dealt as well.
    """
    if heavy is None:
        heavy = heavy_keys(big.groupBy(key).agg(F.count("*").alias("rows")), key, least_rows=least_rows)
    parts = {value: -(-rows // least_rows) for value, rows in heavy.items() if rows > least_rows}
    if not parts:
        return big.join(small, key, how)
    nulls = parts.pop(None, 1)
    schema = T.StructType([T.StructField(key, big.schema[key].dataType), T.StructField("_parts", T.LongType())])
    # MOST_HEAVY lines at most.
    dealt = F.broadcast(big.sparkSession.createDataFrame(list(parts.items()), schema))
    # Numbered by place, not by content: equal rows are dealt, too.
    of_row = F.when(F.col(key).isNull(), F.lit(nulls)).otherwise(F.coalesce("_parts", F.lit(1)))
    part = F.pmod(F.monotonically_increasing_id(), of_row.cast("long"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1))
    left = big.join(dealt, key, "left").withColumn("_part", part).drop("_parts")
    right = small.join(dealt, key, "left").withColumn("_part", every).drop("_parts")
    return left.join(right, [key, "_part"], how).drop("_part")
