"""Every registered query against its SQL twin, over whole tables."""

import pytest

import __spark_entry__ as contract
from conformance import compare
from conformance.oracles import ORACLES
from conformance.registry import QUERIES
from ratingloom.defaults import BAND_LABELS


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = compare.connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, engine, sf_dir, name):
    assert compare.compare(spark, engine, name, sf_dir) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert flagship.columns == ["release_year", "games", "total_reviews", "mean_rating_pct"]
    assert flagship.count() == 5


@pytest.mark.parametrize(
    "report",
    ["yearly", "genre", "price_band", "top_reliable", "platform", "publishers", "top_tags"],
)
def test_sql_text_equals_dataframe_form(spark, sf_dir, report):
    """Same rows in the same order."""
    dataframe_form = {
        "yearly": "yearly_report",
        "genre": "genre_report",
        "price_band": "price_band_report",
        "top_reliable": "top_reliable",
        "platform": "platform_report",
        "publishers": "publisher_report",
        "top_tags": "top_tags_long",
    }[report]
    by_text = QUERIES[f"sql_{report}"](spark, sf_dir)
    by_calls = QUERIES[dataframe_form](spark, sf_dir)
    assert by_text.columns == by_calls.columns
    rows = by_calls.collect()
    if report == "price_band":
        assert [r["price_band"] for r in by_text.collect()] == list(BAND_LABELS)
        assert sorted(by_text.collect()) == sorted(rows)
    else:
        assert by_text.collect() == rows
