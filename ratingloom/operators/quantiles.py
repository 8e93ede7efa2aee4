"""Exact quantiles without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], *, broadcast: bool) -> DataFrame:
    """Inner join on keys that may be null."""
    right = right.withColumnsRenamed({name: f"_{name}" for name in keys})
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys])
    right = F.broadcast(right) if broadcast else right
    return left.join(right, same).drop(*[f"_{name}" for name in keys])


def _with_bucket(df: DataFrame, value: str, cuts: str, buckets: int) -> DataFrame:
    """How many of the sorted cuts lie below the value, by one small step per power of two.

    Each step is a projection of its own, so that none grows too large to be compiled.
    """
    step = 1 << max(0, (buckets - 1).bit_length() - 1)
    df = df.withColumn("bucket", F.lit(0))
    while step:
        beyond = f"bucket + {step} < {buckets} AND {value} > element_at({cuts}, bucket + {step})"
        df = df.withColumn("bucket", F.expr(f"bucket + if({beyond}, {step}, 0)"))
        step //= 2
    return df


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    q: float = 0.5,
    *,
    by: Sequence[str] = (),
    buckets: int = 512,
    rounds: int = 1,
    bounded_groups: bool | None = None,
) -> DataFrame:
    """Linearly interpolated quantile ``q`` of each column, per group.

    Returns ``(*by, measure, quantile)`` with one row per group and column.

    Spark's own ``percentile`` merges all distinct values of a group in one task.
    Here the values are first counted (equal values meet in the map-side combine),
    then approximate quantiles of the distinct values cut each group into
    ``buckets``; the bucket counts tell which bucket holds the wanted rank, and that one
    is sorted: about one in ``buckets`` of a group's distinct values meet in a task.
    With ``rounds=2`` it is cut again before, for groups of a hundred million distinct
    values and more; each round reads the counts once more. The cuts only balance the
    work: any cuts give the exact result. In one round the counts are shuffled once.

    ``bounded_groups`` states that ``by`` takes few values by nature (bands,
    years), which makes the per-group tables a few kilobytes and safe to broadcast.
    Without that statement they are broadcast only if there is no ``by``; otherwise
    Spark picks the join by size.
    """
    bounded_groups = not by if bounded_groups is None else bounded_groups
    group = [*by, "measure"]
    measured = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in columns])
    # Exploding structs, unlike unpivot, leaves the group columns as they are: all
    # readers of the counts then ask for the same exchange and share it.
    counted = (
        df.select(*by, F.explode(measured).alias("cell"))
        .select(*by, F.col("cell.measure").alias("measure"), F.col("cell.value").alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy(*group, "value")
        .agg(F.count("*").alias("copies"))
    )
    cut_points = [i / buckets for i in range(1, buckets)]
    inside = counted.withColumn("before", F.lit(0).cast("long"))
    wanted = None
    for _ in range(rounds):
        cuts = inside.groupBy(*group).agg(
            F.percentile_approx("value", cut_points, 8 * buckets).alias("cuts"),
            F.max("before").alias("base"),
            F.sum("copies").alias("total"),
        )
        if wanted is None:
            position = (F.col("total") - 1) * F.lit(float(q))
            ranks = [F.floor(position).alias("low"), F.ceil(position).alias("high"), (position - F.floor(position)).alias("fraction")]
            cuts = cuts.select(*group, "cuts", "base", *ranks)
        else:
            ranks = wanted.select(*group, "low", "high", "fraction")
            cuts = _join_on(cuts.drop("total"), ranks, group, broadcast=bounded_groups)
        placed = _with_bucket(_join_on(inside, cuts, group, broadcast=bounded_groups), "value", "cuts", buckets)
        # At most ``buckets`` rows per group from here on.
        by_bucket = Window.partitionBy(*group).orderBy("bucket")
        wanted = (
            placed.groupBy(*group, "bucket")
            .agg(
                F.sum("copies").alias("inside"),
                F.min("value").alias("least"),
                F.max("value").alias("most"),
                *[F.max(name).alias(name) for name in ("base", "low", "high", "fraction")],
            )
            .withColumn("before", F.col("base") + F.sum("inside").over(by_bucket) - F.col("inside"))
            .filter((F.col("before") <= F.col("high")) & (F.col("before") + F.col("inside") > F.col("low")))
            .groupBy(*group)
            .agg(
                F.min("before").alias("before"),
                F.min("least").alias("least"),
                F.max("most").alias("most"),
                F.max("low").alias("low"),
                F.max("high").alias("high"),
                F.max("fraction").alias("fraction"),
            )
        )
        bounds = wanted.select(*group, "before", "least", "most")
        inside = _join_on(counted, bounds, group, broadcast=bounded_groups).filter(
            F.col("value").between(F.col("least"), F.col("most"))
        )
    by_value = Window.partitionBy(*group).orderBy("value")
    ranked = (
        _join_on(counted, wanted, group, broadcast=bounded_groups)
        .filter(F.col("value").between(F.col("least"), F.col("most")))
        .withColumn("end", F.col("before") + F.sum("copies").over(by_value))
        .withColumn("start", F.col("end") - F.col("copies"))
    )

    def value_at(rank: str):
        covers = (F.col("start") <= F.col(rank)) & (F.col(rank) < F.col("end"))
        return F.max(F.when(covers, F.col("value")))

    low, high, fraction = value_at("low"), value_at("high"), F.max("fraction")
    return ranked.groupBy(*group).agg((low + (high - low) * fraction).alias("quantile"))


def quantile_row(quantiles: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ungrouped quantiles as one row with a column per measure."""
    return quantiles.agg(
        *[F.max(F.when(F.col("measure") == name, F.col("quantile"))).alias(name) for name in columns]
    )
