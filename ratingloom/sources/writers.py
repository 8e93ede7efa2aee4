"""Curated Parquet, result CSV and summary JSON; every write replaces its target."""

from __future__ import annotations

import json
from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ratingloom.sources.publish import Files

RECORDS_PER_FILE = 5_000_000
LAYOUT = "_layout.json"


def bucketed_name(path: str) -> str:
    """The name of a bucketed table in the session's catalogue."""
    return f"ratingloom_{md5(path.rstrip('/').encode()).hexdigest()}"


def _counted(df: DataFrame, rows: Observation | None) -> DataFrame:
    """The rows as they are written, counted by the way."""
    return df.observe(rows, F.count("*").alias("rows")) if rows else df


def write_curated(
    df: DataFrame,
    path: str,
    *,
    partition: str = "release_year",
    records_per_file: int = RECORDS_PER_FILE,
    observe: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    """Parquet with a folder per partition value.

    The rebalance hint gathers a value's rows into few tasks, one file per task and
    value, and lets adaptive execution split a value that holds most of the rows. Tasks
    take about ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` of shuffled rows; set
    it to some 256m where curated files are large. ``observe`` takes metrics of the rows
    that are written, in the tasks that write them.
    """
    dealt = df.hint("rebalance", partition)
    if observe:
        dealt = dealt.observe(observe[0], *observe[1])
    (
        dealt.write.mode("overwrite")
        .option("maxRecordsPerFile", records_per_file)
        .partitionBy(partition)
        .parquet(path)
    )


def write_result(
    df: DataFrame,
    path: str,
    order: Sequence[str | Column] = (),
    *,
    at_most: int | None = None,
    rows: Observation | None = None,
) -> None:
    """Result CSV with header, in part files; with an ``order`` these follow one another.

    ``at_most`` states how many rows the result can have by its nature (a top-k, years,
    bands). Such a result becomes one file: only its finished rows move to one task. A
    result with more rows is refused, not cut. Its order is made, or made again, after
    that check, so it does not hang on what the check does with the rows. ``rows`` counts
    what is written.
    """
    if at_most is None:
        df = df.orderBy(*order) if order else df
    else:
        listed = df.columns
        df = df.limit(at_most + 1).withColumn("_place", F.monotonically_increasing_id())
        df = df.withColumn("_rows", F.count("*").over(Window.partitionBy()))
        fits = F.assert_true(F.col("_rows") <= at_most, F.lit(f"more than {at_most} rows"))
        df = df.where(fits.isNull()).orderBy(*(order or ["_place"]))
        df = df.select(*[F.col(f"`{c}`") for c in listed])
    _counted(df, rows).write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_summary(df: DataFrame, path: str, *, rows: Observation | None = None) -> None:
    """A one-row table as one JSON object; null metrics stay in the object."""
    _counted(df.repartition(1), rows).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_catalog_csv(df: DataFrame, path: str) -> None:
    """Catalogue-shaped CSV that the typed reader gives back unchanged."""
    df.write.mode("overwrite").options(
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_bucketed(df: DataFrame, path: str, *, key: str = "appid", buckets: int = 64) -> None:
    """Parquet with the rows of a key in one of ``buckets`` files, in the order of the key.

    Joins and groupings on the key read such a table without a shuffle of it; the other
    side is shuffled to the same buckets. Size buckets so that one fits a task, some 256 MB.
    The layout is written with the files, as a path alone does not tell it; read the table
    with ``readers.read_bucketed``.
    """
    files = Files(df.sparkSession)
    name = bucketed_name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    layout = {"key": key, "buckets": buckets, "schema": df.schema.json()}
    files.write(f"{path}/{LAYOUT}", json.dumps(layout))
