from datetime import date

import pytest
from pyspark.sql import functions as F

from ratingloom.defaults import BAND_LABELS, Thresholds
from ratingloom.operators import checks
from ratingloom.operators.cleaning import clean_catalog
from ratingloom.plans import presentation as P
from ratingloom.plans import reports as R
from ratingloom.plans import summary as S

SMALL = Thresholds(
    first_year=2000, last_year=2001, min_reviews=10, min_label_items=2, min_publisher_items=2,
    min_publisher_reviews=20, top_items=2, top_publishers=2, top_tags=2, era_ranks=1,
)


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (1, "A", date(2000, 1, 1), "P", "win;mac", "Action;Indie", 9, 1, 0.0),
        (2, "B", date(2000, 2, 1), "P", "win", "Action", 18, 2, 4.0),
        (3, "C", date(2001, 3, 1), "Q", "win;;win", "Indie;Action", 5, 5, 7.0),
        (4, "D", None, "", "linux", "RPG", 100, 0, None),
        (5, "E", date(1999, 1, 1), None, None, None, 0, 0, 50.0),
        (6, "F", date(2001, 6, 1), "Q", "win", "RPG", 10, 0, 15.0),
        (6, "F copy", date(2001, 6, 1), "Q", "win", "RPG", 10, 0, 15.0),
        (None, "no key", None, "Q", "win", "RPG", 10, 0, 15.0),
        (None, "no key", None, "Q", "win", "RPG", 10, 0, 15.0),
    ]
    schema = (
        "appid int, name string, release_date date, publisher string, platforms string, genres string, "
        "positive_ratings bigint, negative_ratings bigint, price double"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def games(raw):
    return clean_catalog(raw, order=["name"])


def test_yearly(games):
    yearly = R.yearly_report(games, SMALL)
    assert yearly.collect() == [(2000, 2, 30, 90.0), (2001, 2, 20, 75.0)]
    assert R.year_slice(yearly, 2001, 2030).collect() == [(2001, 2, 20, 75.0)]
    assert R.peak_year(yearly).collect() == [(2000, 2)]


def test_labels(games):
    genre = R.genre_report(R.game_genres(games), SMALL).collect()
    assert {r["genre"]: (r["games"], r["total_reviews"]) for r in genre} == {
        "Action": (3, 40), "Indie": (2, 20), "RPG": (2, 110),
    }
    assert [r["mean_wilson_pct"] for r in genre] == sorted([r["mean_wilson_pct"] for r in genre], reverse=True)
    exact = R.genre_report(R.game_genres(games), SMALL, sort_unrounded=True)
    assert exact.columns == ["genre", "games", "total_reviews", "mean_rating_pct", "mean_wilson_pct"]
    assert [r["genre"] for r in exact.collect()] == [r["genre"] for r in genre]
    platform = R.platform_report(R.game_platforms(games)).collect()
    assert [(r["platform"], r["games"]) for r in platform] == [("win", 4), ("linux", 1), ("mac", 1)]


def test_labels_need_neither_join_nor_shuffle(spark, executed_plan, tmp_path, games):
    games.write.parquet(str(tmp_path / "g"))
    stored = spark.read.parquet(str(tmp_path / "g"))
    plan = executed_plan(R.game_genres(stored))
    assert "Join" not in plan and "Exchange" not in plan
    plan = executed_plan(R.genre_report(R.game_genres(stored), SMALL))
    assert plan.count("hashpartitioning") == 1


def test_price_bands(games):
    report = R.price_band_report(games)
    bands = {r["price_band"]: tuple(r)[1:] for r in report.collect()}
    assert bands["Free"] == (1, 0.0, 90.0, 10)
    assert bands["40+"] == (2, 50.0, 100.0, 0)
    exact = {r["price_band"]: r["median_reviews"] for r in R.price_band_report(games, exact=True).collect()}
    assert exact["40+"] == 50 and set(exact) == set(bands)
    ordered = [r["price_band"] for r in R.in_band_order(report).collect()]
    assert ordered == [b for b in BAND_LABELS if b in bands]
    complete = R.complete_bands(report).collect()
    assert [r["price_band"] for r in complete] == list(BAND_LABELS)
    assert tuple(complete[4]) == ("20-40", None, None, None, 0)
    assert R.best_price_band(report).collect() == [("10-20", 100.0)]


def test_rankings(games):
    top = R.top_reliable(games, SMALL)
    assert [r["appid"] for r in top.collect()] == [4, 6]
    assert top.columns == ["appid", "name", "total_reviews", "rating_pct", "wilson_pct", "price"]
    publishers = R.publisher_report(games, SMALL).collect()
    assert [(r["publisher"], r["games"], r["total_reviews"]) for r in publishers] == [("P", 2, 30), ("Q", 2, 20)]
    era = R.era_champions(games, SMALL).collect()
    assert [(r["release_year"], r["era_rank"], r["appid"]) for r in era] == [(2000, 1, 2), (2001, 1, 6)]


def test_uncertainty_sample(games):
    sample = {r["appid"]: r["log_reviews"] for r in R.uncertainty_sample(games, 0.9).collect()}
    assert set(sample) == {1, 2, 3, 6} and sample[1] == 1.0


def test_genre_bubbles(games):
    bubbles = R.genre_bubbles(R.genre_report(R.game_genres(games), SMALL), 2).collect()
    assert {r["genre"] for r in bubbles} == {"RPG", "Action"}
    assert max(r["marker_size"] for r in bubbles) == 600.0


def test_display_tables(spark, games):
    shown = P.ranking_text(R.top_reliable_numbered(games, SMALL), 1).collect()
    assert [tuple(r)[:3] for r in shown] == [(1, "D", "100")]
    genres = R.largest_genres(R.genre_report(R.game_genres(games), SMALL), 2).collect()
    assert [r["mean_wilson_pct"] for r in genres] == sorted(r["mean_wilson_pct"] for r in genres)
    tags = spark.createDataFrame(
        [("free_to_play", 5, 9000, 70.5), ("2d", 4, 100, None), ("rts", 4, 50, 1.0)],
        "tag string, tagged_games bigint, total_tag_votes bigint, mean_rating_pct double",
    )
    rows = P.tag_text(tags, 2).collect()
    assert rows[0] == ("Free To Play", "5", "9,000", "70.50") and rows[1]["label"] == "2D"
    assert rows[1]["mean_rating_text"] is None


def test_summary(raw, games):
    summary = S.run_summary(raw, games).first()
    assert summary.asDict() == {
        "raw_rows": 9,
        "clean_rows": 6,
        "distinct_appids": 6,
        "duplicate_appids_removed": 2,
        "missing_release_date_before": 3,
        "missing_release_date_after": 1,
        "missing_price_after": 1,
        "zero_review_games": 1,
        "total_positive_ratings": 142,
        "total_negative_ratings": 8,
        "overall_weighted_positive_pct": 94.67,
        "median_game_rating_pct": 90.0,
        "median_reviews_per_game": 10,
    }
    for approximate in (False, True):
        assert tuple(S.quality_report(games, approximate=approximate).first()) == (6, 6, 1, 1, 1)
    assert tuple(S.missing_before(raw).first()) == (3, 1, 1, 1)
    shown = P.headline_figures(S.run_summary(raw, games)).first()
    assert (shown["review_outcomes"], shown["weighted_minus_median"]) == (150, 4.67)
    assert (shown["weighted_positive_text"], shown["gap_text"]) == ("94.67%", "4.67-point")


def test_huge_totals(raw):
    large = raw.filter("appid < 4").withColumn("positive_ratings", F.lit(5 * 10**16))
    games = clean_catalog(large)
    row = S.run_summary(large, games).first()
    assert row["total_positive_ratings"] == 15 * 10**16
    assert row["overall_weighted_positive_pct"] == 100.0
    assert checks.consistent_totals(games).first()["passed"]


def test_checks_pass_and_fail(spark, games):
    def verdict(df):
        return tuple(df.first())

    report = R.price_band_report(games)
    assert verdict(checks.unique_key(games)) == ("unique_key", 0, True)
    assert verdict(checks.unique_key(games.union(games))) == ("unique_key", 6, False)
    assert verdict(checks.consistent_totals(games)) == ("consistent_totals", 0, True)
    broken = games.withColumn("total_reviews", F.col("total_reviews") + 1)
    assert verdict(checks.consistent_totals(broken)) == ("consistent_totals", 1, False)
    nothing = games.filter("false")
    assert verdict(checks.consistent_totals(nothing)) == ("consistent_totals", 1, False)
    top = R.top_reliable(games, SMALL)
    order = [F.desc("wilson_pct"), "appid"]
    assert verdict(checks.ranking_order(top, "wilson_pct", order, at_most=20)) == ("ranking_order", 0, True)
    assert verdict(checks.ranking_order(top, "wilson_pct", ["wilson_pct"], at_most=20))[1:] == (1, False)
    assert verdict(checks.meets_threshold(top, "total_reviews", 10))[1:] == (0, True)
    assert verdict(checks.meets_threshold(top, "total_reviews", 50))[1:] == (1, False)
    assert verdict(checks.lower_bound_holds(games, F.col("wilson_score") * 100))[1:] == (0, True)
    assert verdict(checks.lower_bound_holds(games, F.lit(95.0)))[1:] == (3, False)
    assert verdict(checks.group_total(report, "games", games))[1:] == (0, True)
    assert verdict(checks.group_total(report, "games", games.union(games)))[1:] == (6, False)
    assert verdict(checks.label_domain(R.complete_bands(report)))[1:] == (0, True)
    assert verdict(checks.label_domain(report.withColumn("price_band", F.lit("odd"))))[1] > 6
    placed = spark.createDataFrame([(1, "Free"), (2, "5-10")], "position int, price_band string")
    assert verdict(checks.label_order(placed))[1:] == (1, False)


def test_shared_totals_equal_the_single_reports(spark, sf_dir):
    """One scan for three reports; a null year, band or publisher is a group like any other."""
    from conformance import bindings as B

    games = B.games(spark, sf_dir)
    games = games.withColumn("price_band", F.when(F.col("appid") % 17 != 0, F.col("price_band")))
    totals = R.shared_totals(games)
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand [") == 1 and plan.count("part.parquet") == R.yearly_report(games)._jdf.queryExecution().executedPlan().toString().count("part.parquet")
    t = B.THRESHOLDS
    assert R.yearly_of(totals, t).collect() == R.yearly_report(games, t).collect()
    assert R.publishers_of(totals, t).collect() == R.publisher_report(games, t).collect()
    assert R.publishers_of(totals, t, sort_unrounded=True).collect() == R.publisher_report(games, t, sort_unrounded=True).collect()
    bands = R.bands_of(totals)
    assert sorted(bands.collect(), key=str) == sorted(R.price_band_report(games).collect(), key=str)
    missing = totals.where("grouped_by = 'release_year' AND release_year IS NULL").first()
    assert missing.games == games.where("release_year IS NULL").count()
