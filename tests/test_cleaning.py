from datetime import date

from pyspark.sql import functions as F

from ratingloom.operators.cleaning import (
    clean_catalog,
    fill_blank_strings,
    first_per_key,
    identified,
)

SCHEMA = (
    "appid int, name string, release_date date, publisher string, owners string, "
    "positive_ratings bigint, negative_ratings bigint, price double"
)


def catalog(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_clean_rows(spark):
    raw = catalog(
        spark,
        [
            (1, " One ", date(2001, 5, 1), " P ", " 10-20 ", 3, 1, 4.5),
            (2, "Two", None, None, None, None, -4, -1.0),
            (3, None, date(2001, 5, 1), "P", "1-2", 1, 1, 1.0),
            (None, "No key", date(2001, 5, 1), "P", "1-2", 1, 1, 1.0),
        ],
    )
    rows = {r["appid"]: r for r in clean_catalog(raw).collect()}
    assert set(rows) == {1, 2}
    one, two = rows[1], rows[2]
    assert (one["name"], one["publisher"], one["owners"]) == ("One", "P", "10-20")
    assert (one["total_reviews"], one["rating_pct"], one["release_year"]) == (4, 75.0, 2001)
    assert (one["price_band"], one["owner_midpoint"], one["has_missing_core"]) == ("Under 5", 15.0, False)
    assert (two["positive_ratings"], two["negative_ratings"], two["total_reviews"]) == (0, 0, 0)
    assert two["rating_pct"] is None and two["wilson_score"] is None
    assert two["price"] is None and two["price_band"] == "40+" and two["has_missing_core"]
    assert two["publisher"] is None and two["release_year"] is None


def test_nameless_copy_does_not_win(spark):
    raw = catalog(
        spark,
        [
            (1, None, date(2000, 1, 1), "A", "1-2", 0, 0, 0.0),
            (1, "Kept", date(2001, 1, 1), "B", "1-2", 5, 5, 1.0),
        ],
    )
    (row,) = clean_catalog(raw).collect()
    assert row["name"] == "Kept"


def test_survivor_follows_the_order(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "c", 9), (2, "d", None)], "k int, v string, o int")
    first = first_per_key(df, ["k"], [F.col("o").asc_nulls_last()])
    assert sorted(map(tuple, first.collect())) == [(1, "b", 1), (2, "c", 9)]
    last = first_per_key(df, ["k"], [F.col("o").desc_nulls_last()])
    assert sorted(map(tuple, last.collect())) == [(1, "a", 2), (2, "c", 9)]


def test_survivor_by_content_ignores_row_order(spark):
    rows = [(1, "b", None), (1, "a", 2.0), (1, "a", 1.0), (1, "a", None)]
    for arranged in (rows, rows[::-1]):
        df = spark.createDataFrame(arranged, "k int, v string, o double")
        assert [tuple(r) for r in first_per_key(df, ["k"]).collect()] == [(1, "a", 1.0)]


def test_hot_key_sends_one_row_per_task(spark, executed_plan):
    hot = spark.range(0, 90000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("appid"),
        F.concat(F.lit("n"), "id").alias("name"),
    )
    once = first_per_key(identified(hot), order=["name"])
    plan = executed_plan(once)
    assert "WindowGroupLimit" in plan and "row_number(), 1, Partial" in plan
    assert once.count() == hot.select("appid").distinct().count()
    assert once.filter("appid = 7").first()["name"] == hot.filter("appid = 7").agg(F.min("name")).first()[0]


def test_options(spark):
    raw = catalog(spark, [(1, "\tOne", date(2001, 5, 1), None, None, 0, 5, None)])
    plain = clean_catalog(raw).first()
    assert plain["name"] == "\tOne" and abs(plain["wilson_score"]) < 1e-12
    other = clean_catalog(
        raw, whitespace=True, fill_blank=True, zero_positive="null", null_band="Unknown"
    ).first()
    assert other["name"] == "One" and other["wilson_score"] is None
    assert other["publisher"] == "" and other["owners"] == "" and other["price_band"] == "Unknown"


def test_fill_blank_strings(spark):
    df = spark.createDataFrame([(None, None, 1), ("a", None, None)], "x string, y string, n int")
    assert [tuple(r) for r in fill_blank_strings(df, ["x"]).collect()] == [("", None, 1), ("a", None, None)]
    assert [tuple(r) for r in fill_blank_strings(df).collect()] == [("", "", 1), ("a", "", None)]
