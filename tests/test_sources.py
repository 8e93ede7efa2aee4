import getpass
import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratingloom.defaults import CATALOG_SCHEMA, Thresholds, ddl_names
from ratingloom.operators.cleaning import clean_catalog
from ratingloom.plans import full_run
from ratingloom.plans import summary as S
from conformance import scratch
from ratingloom.sources import readers, views, workspace, writers

HEADER = ",".join(ddl_names(CATALOG_SCHEMA))


def line(appid="1", name="N", day="2001-02-03", developer="D", publisher="P", genres="Action;Indie",
         positive="3", negative="1", owners="10-20", price="4.5"):
    return (
        f"{appid},{name},{day},1,{developer},{publisher},windows;mac,0,c1;c2,{genres},t1;t2,5,"
        f"{positive},{negative},1.5,2.5,{owners},{price}"
    )


@pytest.fixture
def catalog_csv(tmp_path):
    """Quoted separators, doubled quotes, a trailing backslash, bad and missing cells."""
    rows = [
        line("1", name='"a;b, c ""q"" d, e"'),
        line("2", name="back\\"),
        line("3", day="03/02/2001"),
        line("4", price="free"),
        line("", name="no key"),
        line("6", name=""),
        line("7", positive="-3", negative=""),
        line("7", positive="-3", negative=""),
        line("8", price="-2"),
        line("9", name="東方 ～"),
    ]
    path = tmp_path / "catalog.csv"
    path.write_text("\n".join([HEADER, *rows]) + "\n", encoding="utf-8")
    return str(path)


def test_typed_reader(spark, catalog_csv):
    df = readers.read_catalog(spark, catalog_csv)
    assert dict(df.dtypes)["appid"] == "int" and dict(df.dtypes)["release_date"] == "date"
    rows = df.collect()
    assert len(rows) == 10
    by_key = {r["appid"]: r for r in rows}
    assert by_key[1]["name"] == 'a;b, c "q" d, e' and by_key[1]["price"] == 4.5
    assert by_key[2]["name"] == "back\\" and by_key[2]["release_date"] == date(2001, 2, 3)
    assert by_key[3]["release_date"] is None and by_key[3]["price"] == 4.5
    assert by_key[4]["price"] is None and by_key[4]["genres"] == "Action;Indie"
    assert by_key[None]["name"] == "no key"
    assert by_key[6]["name"] is None
    assert by_key[7]["positive_ratings"] == -3 and by_key[7]["negative_ratings"] is None
    assert by_key[9]["name"] == "東方 ～"


def test_cleaned_file(spark, catalog_csv):
    games = {r["appid"]: r for r in clean_catalog(readers.read_catalog(spark, catalog_csv)).collect()}
    assert set(games) == {1, 2, 3, 4, 7, 8, 9}
    assert games[7]["total_reviews"] == 0 and games[7]["wilson_score"] is None
    assert games[8]["price"] is None and games[8]["has_missing_core"]


def test_vote_files_of_different_headers(spark, tmp_path):
    folder = tmp_path / "votes"
    folder.mkdir()
    (folder / "a.csv").write_text("appid,x,a.b\n1,5,\n")
    (folder / "b.csv").write_text('a.b,appid,"new ""tag"""\n7,2,8\n')
    (folder / "c.csv").write_text("appid,x,a.b\n3,1,2\n")
    (folder / "empty.csv").write_text("")
    df = readers.read_votes_by_header(spark, str(folder))
    assert df.columns == ["appid", "x", "a.b", 'new "tag"']
    assert sorted(map(tuple, df.collect())) == [(1, 5, None, 0), (2, 0, 7, 8), (3, 1, 2, 0)]
    one = readers.read_votes_by_header(spark, str(folder / "a.csv"))
    assert one.collect() == readers.read_wide_votes(spark, str(folder / "a.csv")).collect()
    (folder / "d.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="d.csv has no column appid"):
        readers.read_votes_by_header(spark, str(folder))


def test_line_break_inside_quotes(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text("\n".join([HEADER, line("1", name='"two\nlines"'), line("2")]) + "\n")
    rows = readers.read_catalog(spark, str(path), multi_line=True).collect()
    assert {r["appid"]: r["name"] for r in rows} == {1: "two\nlines", 2: "N"}


def test_wide_votes_schema_comes_from_the_header(spark, tmp_path):
    path = tmp_path / "votes.csv"
    path.write_text("appid,free_to_play,1980s,a.b\n5,1,0,7\n6,x,,2\n")
    df = readers.read_wide_votes(spark, str(path))
    assert df.dtypes == [("appid", "int"), ("free_to_play", "bigint"), ("1980s", "bigint"), ("a.b", "bigint")]
    assert sorted(map(tuple, df.collect())) == [(5, 1, 0, 7), (6, None, None, 2)]


def test_land_raw_keeps_text_and_origin(spark, catalog_csv, tmp_path):
    target = str(tmp_path / "zone")
    before = Path(catalog_csv).read_bytes()
    for _ in range(2):
        landed = readers.land_raw(spark, {"catalog": catalog_csv, "votes": None}, target)
    assert landed == {"catalog": f"{target}/catalog"}
    df = spark.read.parquet(landed["catalog"])
    assert {t for _, t in df.dtypes} == {"string"} and df.count() == 10
    assert [r["price"] for r in df.filter("appid = '4'").collect()] == ["free"]
    assert df.select("source_file").distinct().first()[0].endswith("catalog.csv")
    assert Path(catalog_csv).read_bytes() == before


def test_curated_partitions_prune_and_push_down(spark, catalog_csv, tmp_path, executed_plan):
    path = str(tmp_path / "curated")
    writers.write_curated(clean_catalog(readers.read_catalog(spark, catalog_csv)), path)
    folders = {p.name for p in Path(path).iterdir() if p.is_dir()}
    assert folders == {"release_year=2001", "release_year=__HIVE_DEFAULT_PARTITION__"}
    curated = readers.read_curated(spark, path)
    assert curated.columns[-1] == "release_year" and dict(curated.dtypes)["release_year"] == "int"
    plan = executed_plan(
        curated.filter(F.col("release_year").between(2000, 2002) & (F.col("total_reviews") >= 4)).select("name")
    )
    assert "PartitionFilters: [isnotnull(release_year" in plan
    assert "GreaterThanOrEqual(total_reviews,4)" in plan
    assert "ReadSchema: struct<name:string,total_reviews:bigint>" in plan


def test_hot_year_is_written_by_several_tasks(spark, tmp_path):
    """Adaptive execution splits the hot year by size; the row limit is not reached."""
    path = str(tmp_path / "curated")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    df = spark.range(0, 400000, 1, 16).select(
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 > 0, F.lit(2018)).otherwise(2000 + F.col("id") % 5).alias("release_year"),
    )
    spark.conf.set(size, "4m")
    try:
        writers.write_curated(df, path)
    finally:
        spark.conf.set(size, before)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in Path(path).iterdir() if p.is_dir()}
    assert files["release_year=2018"] >= 3 and files["release_year=2001"] <= 2
    assert spark.read.parquet(path).count() == 400000


def test_row_limit_per_file(spark, tmp_path):
    path = str(tmp_path / "curated")
    df = spark.range(1000).withColumn("release_year", F.lit(2018))
    writers.write_curated(df, path, records_per_file=300)
    assert len(list(Path(path, "release_year=2018").glob("*.parquet"))) == 4


def test_results(spark, tmp_path):
    df = spark.createDataFrame([(2, 'q"x, y', 1.5), (1, None, None)], "k int, t string, v double")
    single, many = str(tmp_path / "single"), str(tmp_path / "many")
    for _ in range(2):
        writers.write_result(df.repartition(4), single, ["k"], at_most=2)
        writers.write_result(df.repartition(4), many, [F.desc("k")])
    files = list(Path(single).glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text() == 'k,t,v\n1,,\n2,"q""x, y",1.5\n'
    for path in (single, many):
        rows = readers.read_result(spark, path, "k int, t string, v double").collect()
        assert sorted(map(tuple, rows)) == [(1, None, None), (2, 'q"x, y', 1.5)]
    assert dict(readers.read_result(spark, single).dtypes) == {"k": "int", "t": "string", "v": "double"}


def test_summary_file(spark, tmp_path):
    path = str(tmp_path / "summary")
    row = spark.range(1).select(F.lit(3).alias("rows"), F.lit(None).cast("double").alias("rate"))
    writers.write_summary(row, path)
    (part,) = Path(path).glob("*.json")
    assert json.loads(part.read_text()) == {"rows": 3, "rate": None}
    pretty = tmp_path / "pretty.json"
    pretty.write_text(json.dumps({"raw_rows": 7, "median_game_rating_pct": 76.03}, indent=2))
    read = readers.read_summary(spark, str(pretty), S.SUMMARY_SCHEMA).first()
    assert (read["raw_rows"], read["median_game_rating_pct"], read["clean_rows"]) == (7, 76.03, None)


def test_result_beyond_its_bound_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="more than 5 rows"):
        writers.write_result(spark.range(6), str(tmp_path / "r"), at_most=5)


def test_large_result_keeps_its_tasks(spark, tmp_path):
    path = str(tmp_path / "r")
    writers.write_result(spark.range(0, 1000, 1, 6), path)
    assert len(list(Path(path).glob("part-*.csv"))) == 6


def test_catalogue_is_read_by_name(spark, catalog_csv, tmp_path):
    lines = Path(catalog_csv).read_text().splitlines()
    head = lines[0].split(",")
    i, j = head.index("positive_ratings"), head.index("negative_ratings")
    spark.read.option("header", True).option("escape", '"').csv(catalog_csv).select(
        *[head[j] if k == i else head[i] if k == j else c for k, c in enumerate(head)]
    ).coalesce(1).write.options(header=True, escape='"').csv(str(tmp_path / "turned"))
    as_is, turned = (readers.read_catalog(spark, p) for p in (catalog_csv, str(tmp_path / "turned")))
    assert turned.columns == as_is.columns
    assert sorted(map(repr, turned.collect())) == sorted(map(repr, as_is.collect()))
    with pytest.raises(Exception, match="header"):
        readers.read_catalog(spark, [catalog_csv, str(tmp_path / "turned")]).collect()
    short = tmp_path / "short.csv"
    short.write_text("appid,name\n1,a\n")
    with pytest.raises(ValueError, match="no column release_date"):
        readers.read_catalog(spark, str(short))


def test_votes_of_differing_headers_raise(spark, tmp_path):
    for name, text in (("a", "appid,action,indie\n1,2,3\n"), ("b", "appid,indie,action\n4,5,6\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    assert readers.read_wide_votes(spark, str(tmp_path / "b.csv")).first().asDict() == {
        "appid": 4, "indie": 5, "action": 6,
    }
    with pytest.raises(Exception, match="header"):
        readers.read_wide_votes(spark, str(tmp_path)).collect()


def test_votes_with_line_breaks(spark, tmp_path):
    (tmp_path / "v.csv").write_text('appid,"act\nion"\n1,2\n')
    read = readers.read_wide_votes(spark, str(tmp_path / "v.csv"), multi_line=True)
    assert tuple(read.first()) == (1, 2) and len(read.columns) == 2


def test_views_and_function(spark, catalog_csv):
    games = clean_catalog(readers.read_catalog(spark, catalog_csv))
    views.register_views(games)
    assert spark.sql("SELECT count(*) FROM game_platforms").first()[0] == 14
    views.register_wilson(spark)
    rows = spark.sql(
        "SELECT wilson_lower_bound(positive_ratings, total_reviews) AS f, wilson_score AS w FROM games"
    )
    assert all(r["f"] == r["w"] for r in rows.collect())
    edge = spark.sql("SELECT wilson_lower_bound(NULL, 3L), wilson_lower_bound(0L, 0L), wilson_lower_bound(1L, -2L)")
    assert tuple(edge.first()) == (None, None, None)
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


def test_scratch_paths_are_fresh_and_shared(spark):
    a, b = (scratch.scratch_path(spark, "x") for _ in range(2))
    assert a != b and a.startswith(scratch.shared_root(spark))


def test_outputs_must_not_touch_inputs():
    workspace.require_disjoint(["/raw/a.csv", "hdfs://n/raw"], ["/curated", "/results"])
    for inputs, outputs in [
        (["/data/raw"], ["/data/raw"]),
        (["/data/raw/a.csv"], ["/data"]),
        (["/data"], ["/data/results"]),
        (["/raw"], ["/out", "/out/results"]),
        (["/data/raw"], ["file:/data/raw/"]),
        (["hdfs://n/data/raw"], ["hdfs://n/data/raw/x"]),
    ]:
        with pytest.raises(ValueError):
            workspace.require_disjoint(inputs, outputs)


@pytest.mark.parametrize(
    ("given", "output"),
    [
        ("/data/raw", "hdfs://nn:8020/data/raw"),
        ("hdfs://nn/data/raw", "hdfs://nn:8020/data/raw"),
        ("/data/raw/a.csv", "/data/cur/../raw"),
        ("/data/raw/*.csv", "/data/raw/out"),
        ("/user/{me}/raw/a.csv", "raw"),
        ("HDFS:/data/raw".lower(), "/data"),
    ],
)
def test_paths_are_qualified(given, output):
    given = given.format(me=getpass.getuser())
    with pytest.raises(ValueError):
        workspace.require_disjoint([given], [output], "hdfs://nn:8020")


def test_other_file_systems_are_apart(tmp_path, monkeypatch):
    workspace.require_disjoint(["/data/raw"], ["file:///data/raw"], "hdfs://nn:8020")
    workspace.require_disjoint(["hdfs://a/data/raw"], ["hdfs://b/data/raw"], "hdfs://nn:8020")
    workspace.require_disjoint(["/data/raw*/x"], ["/results"], "file:///")
    monkeypatch.chdir(tmp_path)
    with pytest.raises(ValueError):
        workspace.require_disjoint(["raw/a.csv"], [str(tmp_path / "raw")])


def test_landing_refuses_to_replace_its_source(spark, catalog_csv):
    with pytest.raises(ValueError):
        readers.land_raw(spark, {"c": catalog_csv}, str(Path(catalog_csv).parent))


def test_whole_run(spark, catalog_csv, tmp_path):
    votes = tmp_path / "votes.csv"
    votes.write_text("appid,action,indie\n1,5,0\n2,1,2\n77,9,9\n")
    raw = Path(catalog_csv).read_bytes()
    t = Thresholds(min_reviews=4, min_label_items=2, min_publisher_items=2, min_publisher_reviews=4)
    curated, out = str(tmp_path / "curated"), str(tmp_path / "out")
    before = None
    for _ in range(2):
        written = full_run.run_all(spark, catalog_csv, curated, out, tags_path=str(votes), thresholds=t)
        prints = sorted(map(tuple, full_run.result_fingerprints(spark, written).collect()))
        assert before in (None, prints)
        before = prints
    assert Path(catalog_csv).read_bytes() == raw
    counts = {name: rows for name, rows, _ in before}
    assert set(counts) == {
        "data_quality", "yearly", "genre", "platform", "price_band", "top_reliable", "publishers",
        "era_champions", "top_tags", "summary",
    }
    tags = readers.read_result(spark, written["top_tags"]).collect()
    assert [tuple(r)[:3] for r in tags] == [("action", 2, 6), ("indie", 1, 2)]
    without = full_run.run_all(spark, catalog_csv, curated, out + "2", thresholds=t)
    assert "top_tags" not in without
    with pytest.raises(ValueError):
        full_run.run_all(spark, catalog_csv, curated, str(tmp_path))


def test_command_line(spark, catalog_csv, tmp_path):
    import run

    out = str(tmp_path / "o")
    args = ["--input", catalog_csv, "--curated", str(tmp_path / "c"), "--output", out, "--check"]
    assert run.main([*args, "--min-reviews", "4"]) == 0
    assert not Path(out, "top_tags").exists()
    assert readers.read_result(spark, f"{out}/data_quality").first()["clean_rows"] == 7
    assert len(readers.read_result(spark, f"{out}/price_band").collect()) == 6
    # Without an eligible item there is nothing wrong; without completion bands are missing.
    assert run.main([*args, "--only-found-bands", "--exact-median"]) == 1
