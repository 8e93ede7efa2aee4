"""Increments against full rebuilds, and the layout by item."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conformance import bindings as B
from ratingloom.operators.cleaning import clean_catalog
from ratingloom.operators.reshape import rated_votes
from ratingloom.plans import incremental
from ratingloom.sources import publish, readers, writers

SCHEMA = """appid INT, name STRING, release_date DATE, positive_ratings BIGINT, negative_ratings BIGINT,
    price DOUBLE, owners STRING, loaded INT"""


def row(key, year, loaded, name="N", positive=5):
    return (key, name, None if year is None else date(year, 3, 1), positive, 1, 2.0, "1-2", loaded)


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def parts(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in Path(folder).rglob("part-*")}


OLD = [row(1, 1999, 3), row(2, 1999, 3), row(3, 2000, 3), row(4, 2001, 3), row(5, None, 3), row(6, 2002, None)]
NEW = [
    row(7, 1999, 9), row(3, 2000, 1, positive=50), row(3, 2000, 2), row(4, 1998, 1), row(2, 1999, 3, positive=9),
    row(1, 2005, 4), row(6, 2002, 8, positive=70), row(8, None, 1), row(None, 1990, 1), row(9, 1991, 1, name=None),
]


@pytest.fixture
def curated(spark, tmp_path):
    path = str(tmp_path / "curated")
    writers.write_curated(clean_catalog(spark.createDataFrame(OLD, SCHEMA), order=["loaded"]), path)
    return path


def rebuilt(spark, rows):
    return clean_catalog(spark.createDataFrame(rows, SCHEMA), order=[F.col("loaded").asc_nulls_last()])


def test_increment_equals_a_rebuild(spark, curated):
    before = parts(curated)
    done = incremental.add_raw(spark, spark.createDataFrame(NEW, SCHEMA), curated, ["loaded"])
    # 7 and 8 are new; 3, 4 and 6 win; 2 ties and 1 loses.
    assert (done.added, done.replaced) == (2, 3)
    null = "release_year=__HIVE_DEFAULT_PARTITION__"
    assert done.partitions == tuple(sorted([*(f"release_year={y}" for y in (1998, 1999, 2000, 2001, 2002)), null]))
    assert rows_of(readers.read_curated(spark, curated)) == rows_of(rebuilt(spark, OLD + NEW))
    assert not Path(curated, "release_year=2001").exists()
    assert publish.damaged_files(spark, curated) == []
    assert publish.read_manifest(spark, curated)["tables"]["."]["rows"] == 8
    assert before and sorted(p.name for p in Path(curated).parent.iterdir()) == ["curated"]


def test_untouched_years_keep_their_files(spark, curated):
    before = parts(curated)
    done = incremental.add_raw(spark, spark.createDataFrame([row(20, 1999, 1)], SCHEMA), curated, ["loaded"])
    after = parts(curated)
    kept = {k: v for k, v in before.items() if "1999" not in k}
    assert done.partitions == ("release_year=1999",) and {k: after[k] for k in kept} == kept
    assert incremental.add_raw(spark, spark.createDataFrame([row(20, 1999, 1)], SCHEMA), curated, ["loaded"]).partitions == ()
    assert parts(curated) == after
    nothing = spark.createDataFrame([], SCHEMA)
    assert incremental.add_raw(spark, nothing, curated, ["loaded"]) == incremental.Increment(0, 0, ())


def test_order_has_to_be_held(spark, curated):
    with pytest.raises(ValueError, match="ver"):
        incremental.add_raw(spark, spark.createDataFrame(NEW, SCHEMA), curated, ["ver"])


def test_ended_increment_is_completed(spark, curated, monkeypatch):
    rename, seen = publish.Files.rename, []

    def ending(self, source, target):
        if "release_year" in target:
            seen.append(target)
            if len(seen) == 4:
                raise KeyboardInterrupt
        rename(self, source, target)

    monkeypatch.setattr(publish.Files, "rename", ending)
    with pytest.raises(KeyboardInterrupt):
        incremental.add_raw(spark, spark.createDataFrame(NEW, SCHEMA), curated, ["loaded"])
    monkeypatch.setattr(publish.Files, "rename", rename)
    done = incremental.add_raw(spark, spark.createDataFrame(NEW, SCHEMA), curated, ["loaded"])
    assert done.partitions == ()
    assert rows_of(readers.read_curated(spark, curated)) == rows_of(rebuilt(spark, OLD + NEW))
    assert publish.damaged_files(spark, curated) == []


def test_ratings_by_item_join_without_a_shuffle_of_the_fact(spark, sf_dir, tmp_path):
    path = str(tmp_path / "ratings")
    games = B.games(spark, sf_dir).select("appid", "rating_pct")
    writers.write_bucketed(games, path, buckets=8)
    facts = readers.read_bucketed(spark, path)
    assert rows_of(facts) == rows_of(games)
    votes = B.wide_votes(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = rated_votes(votes, facts)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Between the join and the scan of the ratings there is a sort, but no exchange.
    above = plan[: plan.index("Bucketed: true")].rsplit("Sort [", 1)[1]
    assert "SortMergeJoin" in plan and "Exchange" not in above
    assert rows_of(joined) == rows_of(rated_votes(votes, games))
    writers.write_bucketed(games.where("appid < 100"), path, buckets=4)
    assert readers.read_bucketed(spark, path).count() == games.where("appid < 100").count()
