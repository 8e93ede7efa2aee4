import random

from pyspark.sql import functions as F

from ratingloom.operators import ranking


def brute_dense_rank(rows, keep):
    """(group, score, id) rows within the best ``keep`` distinct scores of their group."""
    kept = []
    for group in {g for g, _, _ in rows}:
        mine = [r for r in rows if r[0] == group]
        scores = sorted({s for _, s, _ in mine if s is not None}, reverse=True)
        if any(s is None for _, s, _ in mine):
            scores.append(None)
        kept += [(g, scores.index(s) + 1, i) for g, s, i in mine if scores.index(s) < keep]
    return sorted(kept, key=repr)


def test_dense_rank_within(spark):
    rng = random.Random(11)
    rows = [
        (rng.choice([2001, 2002, 2003, None]), rng.choice([None, 0.5, 0.25, 0.125, -1.0, 3.0]), i)
        for i in range(400)
    ] + [(2010, None, 900), (2010, 1.0, 901)]
    df = spark.createDataFrame(rows, "g int, s double, id int")
    for bounded in (True, False):
        best = ranking.dense_rank_within(df, "g", "s", keep=3, bounded_groups=bounded)
        found = sorted((tuple(r) for r in best.select("g", "era_rank", "id").collect()), key=repr)
        assert found == brute_dense_rank(rows, 3)


def test_hot_group_and_hot_tie(spark, executed_plan):
    """A third of all rows tie for first place in one year: all are listed, none is shuffled."""
    n = 60000
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 < 2, F.lit(2018)).otherwise(2000 + F.col("id") % 18).cast("int").alias("y"),
        F.when(F.col("id") % 3 == 0, F.lit(9.0)).otherwise((F.col("id") % 1000) / 1000).alias("s"),
        "id",
    )
    best = ranking.dense_rank_within(df, "y", "s", keep=3, bounded_groups=True)
    plan = executed_plan(best)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    hot = best.filter("y = 2018")
    assert hot.filter("era_rank = 1").count() == n // 3
    assert [r[0] for r in hot.select("era_rank").distinct().orderBy("era_rank").collect()] == [1, 2, 3]


def test_top_n_breaks_ties(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 2.0), (4, None)], "id int, s double")
    assert [r["id"] for r in ranking.top_n(df, 3, "s", tie=["id"]).collect()] == [2, 1, 3]
    assert [r["id"] for r in ranking.top_n(df, 9, "s", tie=["id"], ascending=True).collect()] == [1, 3, 2, 4]


def test_top_n_is_a_partial_sort(spark, executed_plan):
    assert "TakeOrderedAndProject" in executed_plan(ranking.top_n(spark.range(100), 3, "id", tie=["id"]))


def test_top_then_resort(spark):
    df = spark.createDataFrame([("a", 5, 1.0), ("b", 9, 3.0), ("c", 7, 2.0)], "k string, n int, s double")
    shown = ranking.top_then_resort(df, 2, take_by="n", show_by="s", tie=["k"])
    assert [r["k"] for r in shown.collect()] == ["c", "b"]


def test_numbered(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9)], "k string, n int")
    rows = ranking.numbered(df, [F.desc("n")], at_most=100).orderBy("position").collect()
    assert [(r["position"], r["k"]) for r in rows] == [(1, "b"), (2, "a")]


def test_row_of_max_takes_the_first_among_equals(spark):
    df = spark.createDataFrame([(2003, 7), (2001, 7), (2002, 3), (2004, None)], "y int, n int")
    best = ranking.row_of_max(df, "n", first_by="y", columns=["y", "n"])
    assert best.collect() == [(2001, 7)]
    nothing = ranking.row_of_max(df.filter("n is null"), "n", first_by="y", columns=["y", "n"])
    assert nothing.collect() == []
