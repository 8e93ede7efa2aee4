"""No cell of a raw file becomes null in silence."""

import pytest

from ratingloom.plans import full_run
from ratingloom.sources import readers
from tests.test_sources import HEADER, line


@pytest.fixture
def messy(tmp_path):
    rows = [
        line("1", name='"a;b, ""q"""'), line("2", price="free"), line("3", day="03/02/2001", price="1e"),
        line("x4"), line("5", positive=""), line("6") + ",one,more", line("7").rsplit(",", 3)[0], line("8", negative="2.5"),
    ]
    path = tmp_path / "catalog.csv"
    path.write_text("\n".join([HEADER, *rows]) + "\n")
    return str(path)


def test_bad_cells_keep_their_text_and_line(spark, messy):
    audited = readers.read_audited(spark, messy)
    plain = readers.read_catalog(spark, messy)
    assert audited.drop("_file", "_line", "_bad").collect() == plain.collect()
    found = {(r.column, r.text) for r in readers.rejected_cells(audited).collect() if r.column != "*"}
    assert found == {
        ("price", "free"), ("release_date", "03/02/2001"), ("price", "1e"), ("appid", "x4"), ("negative_ratings", "2.5"),
    }
    whole = [r for r in readers.rejected_cells(audited).collect() if r.column == "*"]
    assert len(whole) == 2 and all(r.text == r.line and r.file.endswith("catalog.csv") for r in whole)
    rows = audited.collect()
    assert all((r["_line"] is None) == (r["_file"] is None) == (r["_bad"] is None) for r in rows)


def test_run_counts_bad_cells(spark, messy, tmp_path):
    written = full_run.run_all(spark, messy, str(tmp_path / "c"), str(tmp_path / "o"), audit=True)
    counts = {r.column: r.cells for r in readers.read_result(spark, written["bad_cells"]).collect()}
    assert counts == {"price": 2, "release_date": 1, "appid": 1, "negative_ratings": 1, "*": 2}
    assert spark.read.parquet(written["rejects"]).count() == 7
    assert full_run.run_manifest(spark, str(tmp_path / "c"), str(tmp_path / "o")).where("NOT whole").isEmpty()
    clean = tmp_path / "clean.csv"
    clean.write_text("\n".join([HEADER, line("1")]) + "\n")
    written = full_run.run_all(spark, str(clean), str(tmp_path / "c"), str(tmp_path / "o"), audit=True)
    assert "rejects" not in written and readers.read_result(spark, written["bad_cells"], "column STRING, cells LONG").isEmpty()
