"""The battery of a run against the single checks."""

import pytest
from pyspark.sql import functions as F

from conformance import bindings as B
from ratingloom.operators import checks
from ratingloom.plans import full_run
from ratingloom.plans import reports as R
from ratingloom.sources import writers

T = B.THRESHOLDS


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    """A curated table and the two results that are checked."""
    root = tmp_path_factory.mktemp("run")
    games = B.games(spark, sf_dir)
    writers.write_curated(games, f"{root}/curated")
    written = {"top_reliable": f"{root}/top", "price_band": f"{root}/bands"}
    writers.write_result(R.top_reliable(games, T), written["top_reliable"])
    writers.write_result(R.in_band_order(R.price_band_report(games)), written["price_band"], at_most=7)
    return spark.read.parquet(f"{root}/curated"), written, f"{root}/curated"


def single(games, top, bands):
    found = [
        checks.unique_key(games), checks.consistent_totals(games), checks.meets_threshold(top, "total_reviews", 30),
        checks.lower_bound_holds(top, "wilson_pct", "rating_pct", 0.01), checks.group_total(bands, "games", games),
    ]
    return {r["check"]: (r["violations"], r["passed"]) for df in found for r in df.collect()}


@pytest.mark.parametrize("broken", [False, True])
def test_battery_equals_the_single_checks(spark, run, broken):
    games, _, _ = run
    top, bands = R.top_reliable(games, T), R.price_band_report(games)
    if broken:
        games = games.unionByName(games.where("appid < 90")).withColumn("total_reviews", F.col("total_reviews") + 1)
        top = top.withColumns({"total_reviews": F.lit(3), "wilson_pct": F.col("rating_pct") + 1})
    rows = checks.run_battery(games, top, bands, min_reviews=30, tolerance=0.01).collect()
    found = {r["check"]: (r["violations"], r["passed"]) for r in rows}
    assert found == single(games, top, bands)
    assert all(passed is not broken for _, passed in found.values())


def test_battery_of_nothing(run):
    games = run[0].limit(0)
    top, bands = R.top_reliable(games, T), R.price_band_report(games)
    rows = checks.run_battery(games, top, bands, min_reviews=30, tolerance=0.01).collect()
    assert {r["check"]: (r["violations"], r["passed"]) for r in rows} == single(games, top, bands)


def test_checks_read_the_curated_table_once(spark, run):
    _, written, curated = run
    found = full_run.check_run(spark, written, curated, T)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "ReadSchema: struct<appid:int,positive_ratings:bigint,negative_ratings:bigint,total_reviews:bigint>" in plan.replace(
        "appid:bigint", "appid:int"
    )
    assert all(r["passed"] for r in found.collect())
