"""Runs that fail, rerun, retry or meet heavy keys."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conformance import bindings as B
from ratingloom.operators.reshape import rated_votes, tag_totals
from ratingloom.operators.skew import dealt_join, heavy_keys
from ratingloom.plans import full_run, observed, summary
from ratingloom.sources import publish, readers, writers

T = B.THRESHOLDS


@pytest.fixture(scope="module")
def raw_file(spark, sf_dir, tmp_path_factory):
    """The catalogue with copies, nameless rows (one of them the only row of its key) and rows without a key."""
    raw = B.raw_catalog(spark, sf_dir).drop("ver")
    nameless = raw.where("appid % 100 = 0").withColumn("name", F.lit(None).cast("string"))
    alone = raw.where("appid = 7").withColumns({"appid": F.lit(-7), "name": F.lit(None).cast("string")})
    keyless = raw.where("appid < 4").withColumn("appid", F.lit(None).cast("int"))
    path = str(tmp_path_factory.mktemp("raw") / "catalog")
    writers.write_catalog_csv(raw.unionAll(nameless).unionAll(alone).unionAll(keyless), path)
    return path


def content(spark, folder):
    return {p.name: sorted(x.read_bytes() for x in p.glob("part-*")) for p in Path(folder).iterdir() if p.is_dir()}


# --- metrics of the pass that writes


def csv_scans(spark, path):
    """Executed queries that scan CSV files below a path."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    plans = spark._jsparkSession.sharedState().statusStore().executionsList()
    texts = [plans.apply(i).physicalPlanDescription() or "" for i in range(plans.size())]
    return sum("Scan csv" in text and str(Path(path).parent) in text for text in texts)


@pytest.mark.parametrize("once", [True, False])
def test_summary_comes_from_the_pass_that_writes(spark, raw_file, tmp_path, monkeypatch, once):
    monkeypatch.setattr(observed.Attempts, "single", lambda self: once)
    before = csv_scans(spark, raw_file)
    written = full_run.run_all(spark, raw_file, str(tmp_path / "curated"), str(tmp_path / "out"), thresholds=T)
    assert csv_scans(spark, raw_file) - before == (1 if once else 2)
    games = readers.read_curated(spark, str(tmp_path / "curated"))
    wanted = summary.run_summary(readers.read_catalog(spark, raw_file), games).first().asDict()
    found = readers.read_summary(spark, written["summary"]).first().asDict()
    assert found == wanted
    assert wanted["duplicate_appids_removed"] > 100 and wanted["distinct_appids"] == wanted["clean_rows"]


def test_all_raw_metrics_are_observed(spark, raw_file, tmp_path):
    raw = readers.read_catalog(spark, raw_file)
    curating = observed.CuratedPass(raw)
    with observed.attempts(spark) as attempts:
        observe = (curating.clean, observed.clean_metrics())
        writers.write_curated(curating.rows, str(tmp_path / "c"), observe=observe)
        assert attempts.single()
        found = curating.metrics(attempts.single())
    assert found == curating.metrics(exact=False)
    for name, value in summary.missing_before(raw).first().asDict().items():
        assert found[name] == value
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_pass_keeps_the_rows_that_cleaning_keeps(spark, raw_file):
    raw = readers.read_catalog(spark, raw_file)
    from ratingloom.operators.cleaning import clean_catalog

    direct, by_pass = clean_catalog(raw), observed.CuratedPass(raw).rows
    assert direct.exceptAll(by_pass).isEmpty() and by_pass.exceptAll(direct).isEmpty()


# --- replacing results


def test_failed_run_leaves_the_old_tables(spark, raw_file, tmp_path, monkeypatch):
    curated, out = str(tmp_path / "curated"), str(tmp_path / "out")
    full_run.run_all(spark, raw_file, curated, out, thresholds=T)
    run, before = publish.read_manifest(spark, out)["run"], content(spark, out)

    def broken(*_, **__):
        raise RuntimeError("disk gone")

    monkeypatch.setattr(writers, "write_summary", broken)
    with pytest.raises(RuntimeError, match="disk gone"):
        full_run.run_all(spark, raw_file, curated, out, thresholds=T)
    assert content(spark, out) == before
    assert full_run.run_manifest(spark, curated, out).where("NOT whole").isEmpty()
    assert publish.read_manifest(spark, curated)["run"] == run
    assert readers.read_curated(spark, curated).count() == publish.read_manifest(spark, curated)["tables"]["."]["rows"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["curated", "out"]


@pytest.mark.parametrize("ended_at", range(1, 5))
def test_ended_publication_is_completed(spark, raw_file, tmp_path, monkeypatch, ended_at):
    """The driver is lost at each rename after the journal; the next start finishes the swap."""
    curated, out = str(tmp_path / "curated"), str(tmp_path / "out")
    folders = [tmp_path / "curated", tmp_path / "out"]
    for folder in folders:
        folder.mkdir()
        (folder / "part-old").write_text("old")
    rename, seen = publish.Files.rename, []

    def ending(self, source, target):
        if not target.endswith(("json", "journal")):
            seen.append(target)
            if len(seen) == ended_at:
                raise KeyboardInterrupt
        rename(self, source, target)

    monkeypatch.setattr(publish.Files, "rename", ending)
    with pytest.raises(KeyboardInterrupt):
        with publish.Publication(spark, [curated, out]) as publication:
            for path in publication.staged.values():
                spark.range(3).write.parquet(path)
            publication.publish({out: {".": 3}})
    monkeypatch.setattr(publish.Files, "rename", rename)
    publish.recover(publish.Files(spark), [curated, out])
    for folder in folders:
        assert spark.read.parquet(str(folder)).count() == 3 and not (folder / "part-old").exists()
        assert publish.read_manifest(spark, str(folder))["run"] == publication.run
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["curated", "out"]


def test_leftovers_of_a_lost_driver_go(spark, tmp_path):
    (tmp_path / "_out.abc.staged").mkdir()
    (tmp_path / "_other.abc.staged").mkdir()
    publish.recover(publish.Files(spark), [str(tmp_path / "out")])
    assert [p.name for p in tmp_path.iterdir()] == ["_other.abc.staged"]


def test_damage_is_found(spark, raw_file, tmp_path):
    curated, out = str(tmp_path / "curated"), str(tmp_path / "out")
    full_run.run_all(spark, raw_file, curated, out, thresholds=T)
    assert publish.damaged_files(spark, out) == []
    part = next(Path(out, "yearly").glob("part-*"))
    part.write_text(part.read_text() + "1900,1,1,1\n")
    assert publish.damaged_files(spark, out) == [f"yearly/{part.name}"]
    assert not full_run.run_manifest(spark, curated, out).where("NOT whole").isEmpty()
    manifest = json.loads(Path(out, publish.MANIFEST).read_text())
    assert manifest["tables"]["yearly"]["rows"] == 5 and manifest["tables"]["summary"]["rows"] == 1


# --- heavy keys


@pytest.fixture
def hot_matrix(spark):
    """A third of the rows on one item."""
    return spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 30_000).alias("appid"),
        F.lit(2).alias("x"),
        (F.col("id") % 2).alias("y"),
    )


@pytest.fixture
def no_help(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_task_holds_a_heavy_item(spark, hot_matrix, no_help):
    facts = hot_matrix.select("appid").distinct().select("appid", F.lit(60.0).alias("rating_pct"))
    votes = rated_votes(hot_matrix, facts, least_rows=500)
    by_task = [r["count"] for r in votes.groupBy(F.spark_partition_id()).count().collect()]
    assert max(by_task) <= 2 * sorted(by_task)[len(by_task) // 2]
    assert votes.count() == 60_000 + 30_000
    plain = rated_votes(hot_matrix, facts)
    assert votes.exceptAll(plain).isEmpty() and plain.exceptAll(votes).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_dealt_join_equals_the_plain_join(spark, hot_matrix, how):
    nulls = spark.range(3000).select(F.lit(None).cast("long").alias("appid"), F.lit(1).alias("x"), F.lit(0).cast("long").alias("y"))
    big = hot_matrix.unionAll(nulls)
    small = spark.range(-5, 15_000).select(F.col("id").alias("appid"), (F.col("id") * 2).alias("m"))
    dealt, plain = dealt_join(big, small, "appid", how=how, least_rows=1000), big.join(small, "appid", how)
    assert dealt.columns == plain.columns
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()


def test_heavy_keys_are_bounded(spark, hot_matrix, monkeypatch):
    counts = hot_matrix.groupBy("appid").agg(F.count("*").alias("rows"))
    assert heavy_keys(counts, "appid") == {-1: 20_000}
    monkeypatch.setattr("ratingloom.operators.skew.MOST_HEAVY", 5)
    assert len(heavy_keys(counts, "appid", least_rows=1)) == 5


@pytest.mark.parametrize("how", ["inner", "left"])
def test_tag_totals_tell_repeated_items_apart(spark, hot_matrix, how):
    facts = spark.range(-1, 20_000).select(
        F.col("id").alias("appid"), F.when(F.col("id") % 7 != 0, F.col("id") % 100).cast("double").alias("rating_pct")
    )
    long = rated_votes(hot_matrix, facts, how=how)
    wanted = long.groupBy("tag").agg(
        F.count_distinct("appid"), F.sum("votes"), F.round(F.avg("rating_pct"), 9).alias("mean")
    )
    for options in ({}, {"least_rows": 500}, {"unique_key": False}):
        totals = tag_totals(hot_matrix, facts, how=how, **options)
        rounded = totals.withColumn("mean_rating", F.round("mean_rating", 9))
        assert sorted(map(tuple, rounded.collect())) == sorted(map(tuple, wanted.collect()))


def test_cells_of_single_items_are_not_shuffled(spark, no_help):
    wide = spark.range(1000).select(F.col("id").alias("appid"), F.lit(1).alias("x"), F.lit(2).alias("y"))
    facts = wide.select("appid", F.lit(1.0).alias("rating_pct"))
    plan = tag_totals(wide, facts)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("appid" in line and "_position" in line for line in exchanges)
