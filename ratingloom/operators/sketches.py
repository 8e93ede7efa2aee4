"""Mergeable states of quantiles and distinct counts, kept per group and merged on demand.

A state is written once per finest group (a year and a band, say). Any slice, as a range of
years or all bands together, is then answered from the states alone: Spark merges them, map
side first, and no item is read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A quantile sketch of this size has a rank error of about 0.35 % (0.0132 at size 200,
#: falling with the power 0.9 of the size) at 99 % confidence, merged or not.
QUANTILE_SIZE = 800
#: A distinct sketch with 2^12 registers has a relative standard error of 1.6 % at most.
DISTINCT_BITS = 12


def group_states(
    df: DataFrame,
    by: Sequence[str],
    *,
    quantiles: Sequence[str] = (),
    distinct: Sequence[str] = (),
    size: int = QUANTILE_SIZE,
    bits: int = DISTINCT_BITS,
) -> DataFrame:
    """Per group: ``rows``, a quantile state per measure (q_...) and a distinct state per column (d_...).

    Nulls enter no state. One partial aggregate: a task sends one state per group.
    """
    states = [F.count("*").alias("rows")]
    states += [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(f"q_{c}") for c in quantiles]
    states += [F.hll_sketch_agg(c, F.lit(bits)).alias(f"d_{c}") for c in distinct]
    return df.groupBy(*by).agg(*states)


def merged_states(
    states: DataFrame,
    by: Sequence[str] = (),
    *,
    quantiles: Mapping[str, float] | None = None,
    distinct: Sequence[str] = (),
) -> DataFrame:
    """Per coarser group: ``rows`` (exact), the wanted quantile of each measure, and distinct counts.

    Filter the states before, by year or any other column they are grouped by. A group
    without a value has null quantiles and distinct counts of 0.
    """
    quantiles = quantiles or {}
    merged = [F.sum("rows").alias("rows")]
    merged += [F.kll_merge_agg_double(f"q_{c}").alias(f"q_{c}") for c in quantiles]
    merged += [F.hll_union_agg(f"d_{c}").alias(f"d_{c}") for c in distinct]
    found = states.groupBy(*by).agg(*merged)
    return found.select(
        *by,
        "rows",
        *[_quantile(f"q_{c}", p).alias(c) for c, p in quantiles.items()],
        *[F.coalesce(F.hll_sketch_estimate(f"d_{c}"), F.lit(0)).alias(f"distinct_{c}") for c in distinct],
    )


def _quantile(state: str, p: float) -> Column:
    held = F.kll_sketch_get_n_double(state)
    return F.when(held > 0, F.kll_sketch_get_quantile_double(state, F.lit(float(p))))
