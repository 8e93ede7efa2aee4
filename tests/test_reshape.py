import pytest
from pyspark.sql import functions as F

from ratingloom.operators.reshape import (
    explode_labels,
    join_measures,
    rated_votes,
    tag_totals,
    unpivot_votes,
    value_columns,
    wide_vote_totals,
)


@pytest.fixture
def wide(spark):
    rows = [(1, 5, 0, 2), (2, None, 3, -1), (3, 1, 1, 0), (9, 0, 8, 0)]
    return spark.createDataFrame(rows, "appid int, `a.b` bigint, `c d` int, `e``f` bigint")


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(1, 50.0), (2, None), (3, 80.0)], "appid int, rating_pct double")


def test_labels_once_per_item(spark):
    df = spark.createDataFrame([(1, "x; y;x;;", 10), (2, None, 20), (3, " ; ", 30)], "appid int, g string, n int")
    long = explode_labels(df, "g", "label", keep=["n"])
    assert sorted(map(tuple, long.collect())) == [(1, 10, "x"), (1, 10, "y")]
    again = explode_labels(df.union(df), "g", "label")
    assert again.count() == 4
    once = explode_labels(df.union(df), "g", "label", unique_key=False)
    assert sorted(map(tuple, once.collect())) == [(1, "x"), (1, "y")]


def test_labels_in_their_own_table(spark, facts):
    labels = spark.createDataFrame([(1, "x"), (3, "y"), (7, "z")], "appid int, label string")
    joined = join_measures(labels, facts, ["rating_pct"])
    assert sorted(map(tuple, joined.collect())) == [(1, "x", 50.0), (3, "y", 80.0)]


def test_unpivot_keeps_positive_cells(wide):
    assert value_columns(wide) == ["a.b", "c d", "e`f"]
    long = unpivot_votes(wide)
    assert dict(long.dtypes) == {"appid": "int", "tag": "string", "votes": "bigint"}
    assert sorted(map(tuple, long.collect())) == [
        (1, "a.b", 5), (1, "e`f", 2), (2, "c d", 3), (3, "a.b", 1), (3, "c d", 1), (9, "c d", 8),
    ]


def test_rated_votes(wide, facts):
    inner = rated_votes(wide, facts)
    assert inner.columns == ["appid", "tag", "votes", "rating_pct"]
    assert 9 not in [r["appid"] for r in inner.collect()]
    left = rated_votes(wide, facts, how="left")
    assert (9, "c d", 8, None) in [tuple(r) for r in left.collect()]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_tag_totals_equal_the_long_form(wide, facts, how):
    repeated = wide.union(wide.filter("appid = 1"))
    votes = rated_votes(repeated, facts, how=how)
    expected = votes.groupBy("tag").agg(
        F.count_distinct("appid"), F.sum("votes"), F.round(F.avg("rating_pct"), 9)
    )
    totals = tag_totals(repeated, facts, how=how)
    rounded = totals.withColumn("mean_rating", F.round("mean_rating", 9))
    assert sorted(map(tuple, rounded.collect())) == sorted(map(tuple, expected.collect()))


def test_wide_totals_list_every_column(wide, facts):
    rated = wide.join(facts, "appid", "left")
    totals = {r["tag"]: tuple(r)[1:] for r in wide_vote_totals(rated, columns=value_columns(wide)).collect()}
    assert totals == {"a.b": (2, 6, 65.0), "c d": (3, 12, 80.0), "e`f": (1, 1, 50.0)}
    silent = rated.withColumn("quiet", F.lit(None).cast("long"))
    assert wide_vote_totals(silent, columns=["quiet"]).collect() == [("quiet", 0, 0, None)]


def test_many_columns(spark, facts):
    names = [f"t{i}" for i in range(380)]
    cells = [F.when(F.col("id") % 380 == i, F.lit(i + 1)).otherwise(0).alias(n) for i, n in enumerate(names)]
    wide = spark.range(0, 760).select(F.col("id").cast("int").alias("appid"), *cells)
    votes = unpivot_votes(wide).groupBy("tag").agg(F.sum("votes").alias("v"), F.count("*").alias("n"))
    found = {r["tag"]: (r["v"], r["n"]) for r in votes.collect()}
    assert found == {f"t{i}": (2 * (i + 1), 2) for i in range(380)}


def test_item_with_a_third_of_the_matrix(spark, executed_plan):
    """Its cells are combined before the join, so the join key is not hot."""
    n = 30000
    wide = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("appid"),
        F.lit(2).alias("x"),
        (F.col("id") % 2).alias("y"),
    )
    facts = wide.select("appid").distinct().select("appid", F.lit(60.0).alias("rating_pct"))
    totals = tag_totals(wide, facts)
    plan = executed_plan(totals)
    assert "partial_count" in plan and "Join" in plan
    items = n - n // 3
    assert sorted(map(tuple, totals.collect())) == [
        ("x", items + 1, 2 * n, 60.0),
        ("y", items // 2 + 1, n // 2, 60.0),
    ]
    joined = rated_votes(wide, facts).groupBy("tag").agg(F.count("*"), F.count_distinct("appid"))
    assert sorted(map(tuple, joined.collect())) == [("x", n, items + 1), ("y", n // 2, items // 2 + 1)]
