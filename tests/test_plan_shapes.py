"""Plans that have to hold at a thousand times the data."""

import pytest

from conformance.registry import QUERIES

WRITES = {
    "land_raw", "read_catalog_csv", "read_wide_votes", "curated_roundtrip", "result_csv_roundtrip",
    "summary_json_roundtrip", "top_n_of_result", "full_run_reports", "rerun_idempotent",
    "read_catalog_reordered", "read_votes_folder", "full_run_contents", "run_checks",
    "full_run_repeated_votes", "run_manifest", "curated_increment", "tag_votes_bucketed",
    "rejected_cells", "full_run_audit", "shared_reports", "read_votes_by_header", "sketched_medians", "sketched_items_by_genre",
}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_python_and_no_products(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list"):
        assert operator not in plan


def test_raw_scans_read_only_what_they_use(spark, sf_dir):
    plan = physical(QUERIES["yearly_report"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_returnflag:string>" in plan
    assert "p_retailprice" not in plan and "p_size" not in plan


def test_line_items_are_counted_before_the_join(spark, sf_dir):
    plan = physical(QUERIES["yearly_report"](spark, sf_dir))
    scan = plan.index("ReadSchema: struct<l_orderkey")
    assert "partial_count" in plan[:scan].rsplit("Join", 1)[1]


def test_reports_aggregate_before_they_shuffle(spark, sf_dir):
    for name in ("yearly_report", "genre_report", "publisher_report", "platform_report", "price_band_report"):
        assert "partial_" in physical(QUERIES[name](spark, sf_dir))


def test_tags_are_combined_per_item_before_the_join(spark, sf_dir):
    plan = physical(QUERIES["top_tags"](spark, sf_dir))
    assert "keys=[appid" in plan and "partial_sum(votes" in plan
    assert "TakeOrderedAndProject" in plan


def test_unique_items_join_without_shuffled_cells(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(QUERIES["top_tags_unique"](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("appid" in line and "_position" in line for line in exchanges)
    assert "partial_count" in plan[: plan.index("Generate explode")]


def test_publisher_predicate_is_pushed(spark, sf_dir, tmp_path, executed_plan):
    from conformance import bindings as B
    from ratingloom.plans import sql_reports
    from ratingloom.sources import readers, views, writers

    path = str(tmp_path / "curated")
    writers.write_curated(B.games(spark, sf_dir), path)
    views.register_views(readers.read_curated(spark, path))
    plan = executed_plan(sql_reports.run(spark, "publishers", B.THRESHOLDS))
    assert "Not(EqualTo(publisher,))" in plan
