"""Merged states against exact answers."""

import pytest
from pyspark.sql import functions as F

from ratingloom.operators.sketches import group_states, merged_states


@pytest.fixture(scope="module")
def items(spark):
    return spark.range(0, 60_000, 1, 8).select(
        (F.col("id") % 7 + 1990).cast("int").alias("year"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("band"),
        F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("double").alias("value"),
        (F.col("id") % 9000).alias("item"),
    )


def rank_error(values, found, p):
    below, upto = sum(v < found for v in values) / len(values), sum(v <= found for v in values) / len(values)
    return max(0, below - p, p - upto)


@pytest.mark.parametrize("by", [[], ["band"]])
def test_merged_answers_are_within_their_error(spark, items, by):
    states = group_states(items, ["year", "band"], quantiles=["value"], distinct=["item"])
    assert states.count() == 14
    for years in ((1990, 1996), (1992, 1993)):
        inside = F.col("year").between(*years)
        for p in (0.01, 0.5, 0.9):
            found = merged_states(states.where(inside), by, quantiles={"value": p}, distinct=["item"]).collect()
            assert len(found) == (2 if by else 1)
            for row in found:
                rows = items.where(inside).where(F.col("band") == row["band"] if by else F.lit(True))
                held = rows.select("value", "item").collect()
                assert row["rows"] == len(held)
                assert rank_error([r.value for r in held], row["value"], p) < 0.0045
                exact = len({r.item for r in held})
                assert abs(row["distinct_item"] - exact) < 0.065 * exact


def test_a_slice_reads_states_only(spark, items, tmp_path):
    path = str(tmp_path / "states")
    group_states(items, ["year", "band"], quantiles=["value"], distinct=["item"]).write.partitionBy("year").parquet(path)
    sliced = merged_states(spark.read.parquet(path).where("year = 1991"), ["band"], quantiles={"value": 0.5})
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "d_item" not in plan and "Range" not in plan


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, None, None), (1, None, None), (2, 5.0, 7)], "g int, v double, k int")
    states = group_states(rows, ["g"], quantiles=["v"], distinct=["k"])
    found = {r.g: (r.rows, r.v, r.distinct_k) for r in merged_states(states, ["g"], quantiles={"v": 0.5}, distinct=["k"]).collect()}
    assert found == {1: (2, None, 0), 2: (1, 5.0, 1)}
    assert merged_states(states.limit(0), ["g"], quantiles={"v": 0.5}).collect() == []
