import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators.quantiles import exact_quantiles, quantile_row


def grouped(spark, seed, groups=4, rows=900):
    rng = random.Random(seed)
    data = []
    for _ in range(rows):
        group = rng.choice([None, "hot", "hot", "hot", *[f"g{i}" for i in range(groups)]])
        value = rng.choice([None, 0.0, 5.0, rng.gauss(0, 100), float(rng.randint(-50, 50))])
        data.append((group, value))
    return data, spark.createDataFrame(data, "g string, v double")


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.995, 1.0])
@pytest.mark.parametrize("buckets", [2, 7, 128])
def test_global_quantile(spark, q, buckets):
    data, df = grouped(spark, 1)
    expected = np.quantile([v for _, v in data if v is not None], q)
    (row,) = exact_quantiles(df, ["v"], q, buckets=buckets).collect()
    assert row["measure"] == "v" and row["quantile"] == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize("seed", [2, 3, 4])
@pytest.mark.parametrize("bounded", [True, False])
def test_grouped_quantiles(spark, seed, bounded):
    data, df = grouped(spark, seed)
    names = {g for g, v in data if g is not None}
    found = exact_quantiles(df, ["v"], 0.5, by=["g"], bounded_groups=bounded).filter("g is not null")
    result = {r["g"]: r["quantile"] for r in found.collect()}
    assert set(result) == names
    for name in names:
        values = [v for g, v in data if g == name and v is not None]
        assert result[name] == pytest.approx(np.median(values), abs=1e-9)


def test_missing_group_is_a_group(spark):
    data, df = grouped(spark, 5)
    found = exact_quantiles(df, ["v"], 0.5, by=["g"]).filter("g is null").collect()
    values = [v for g, v in data if g is None and v is not None]
    assert [r["quantile"] for r in found] == [pytest.approx(np.median(values), abs=1e-9)]


def test_several_columns_in_one_pass(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None), (10, 40.0)], "a bigint, b double")
    row = quantile_row(exact_quantiles(df, ["a", "b"], 0.5), ["a", "b"]).first()
    assert tuple(row) == (2.5, 20.0)


def test_small_and_empty_inputs(spark):
    one = spark.createDataFrame([(7.0,)], "v double")
    assert exact_quantiles(one, ["v"], 0.5).first()["quantile"] == 7.0
    none = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(none, ["v"], 0.5).collect() == []
    assert quantile_row(exact_quantiles(none, ["v"], 0.5), ["v"]).collect() == [(None,)]


def test_one_value_in_a_third_of_the_rows(spark):
    ids = spark.range(0, 30000, 1, 8)
    df = ids.select(F.when(F.col("id") % 3 == 0, F.lit(12345.0)).otherwise(F.col("id")).alias("v"))
    values = [12345.0 if i % 3 == 0 else float(i) for i in range(30000)]
    for q in (0.3, 0.5, 0.9):
        assert exact_quantiles(df, ["v"], q).first()["quantile"] == pytest.approx(np.quantile(values, q))


def test_counts_are_shuffled_once(spark, executed_plan, tmp_path):
    path = str(tmp_path / "values")
    spark.range(1000).select(F.col("id").cast("double").alias("v")).write.parquet(path)
    plan = executed_plan(exact_quantiles(spark.read.parquet(path), ["v"], 0.5))
    assert plan.count("ReusedExchange") >= 2
    assert "percentile(" not in plan and "CartesianProduct" not in plan


def test_grouped_counts_are_shuffled_once(spark, executed_plan, tmp_path):
    path = str(tmp_path / "values")
    spark.range(1000).selectExpr("id % 3 AS g", "cast(id AS double) AS v").write.parquet(path)
    found = exact_quantiles(spark.read.parquet(path), ["v"], 0.5, by=["g"], bounded_groups=True)
    plan = executed_plan(found)
    assert plan.count("ReusedExchange") >= 2
    assert plan.count("FileScan parquet") == 1


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_oversized_buckets_are_cut_again(spark, rounds):
    df = spark.range(5000).selectExpr("id % 2 AS g", "cast(id AS double) AS v")
    found = exact_quantiles(df, ["v"], 0.37, by=["g"], buckets=2, rounds=rounds).collect()
    for row in found:
        assert row["quantile"] == pytest.approx(np.quantile(np.arange(row["g"], 5000, 2.0), 0.37))
