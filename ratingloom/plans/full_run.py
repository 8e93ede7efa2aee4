"""Raw files to curated Parquet to every report, as one repeatable run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ratingloom.defaults import BAND_LABELS, Thresholds
from ratingloom.functions.measures import band_position
from ratingloom.operators import checks
from ratingloom.operators.reshape import tag_totals
from ratingloom.plans import observed as O
from ratingloom.plans import reports as R
from ratingloom.plans import summary as S
from ratingloom.sources import readers, writers
from ratingloom.sources.publish import Publication, damaged_files, read_manifest
from ratingloom.sources.workspace import default_file_system, require_disjoint


@dataclass(frozen=True)
class Report:
    """How one report is built and written; a top-k report is in order already.

    ``at_most``: the rows that it can have by its nature, for one file; None for many.
    """

    build: Callable[[DataFrame], DataFrame]
    order: tuple[str | Column, ...] = ()
    at_most: int | None = None


def catalog_reports(
    t: Thresholds, *, all_bands: bool = True, exact_median: bool = False, sort_unrounded: bool = False
) -> dict[str, Report]:
    """The reports over the curated fact.

    ``all_bands`` lists the declared price bands that have no item, too.
    """

    def bands(games: DataFrame) -> DataFrame:
        report = R.price_band_report(games, exact=exact_median)
        return R.complete_bands(report) if all_bands else report

    years = max(0, t.last_year - t.first_year + 1)
    return {
        "data_quality": Report(S.quality_report, at_most=1),
        "yearly": Report(lambda g: R.yearly_report(g, t), ("release_year",), years),
        "genre": Report(
            lambda g: R.genre_report(R.game_genres(g), t, sort_unrounded=sort_unrounded),
            (F.desc("mean_wilson_pct"), "genre"),
        ),
        "platform": Report(lambda g: R.platform_report(R.game_platforms(g)), (F.desc("games"), "platform")),
        # A report without completion may have a row without a band.
        "price_band": Report(bands, (band_position("price_band"),), len(BAND_LABELS) + 1),
        "top_reliable": Report(lambda g: R.top_reliable(g, t), at_most=t.top_items),
        "publishers": Report(
            lambda g: R.publisher_report(g, t, sort_unrounded=sort_unrounded), at_most=t.top_publishers
        ),
        "era_champions": Report(lambda g: R.era_champions(g, t), ("release_year", "era_rank", "appid")),
    }


def run_all(
    spark: SparkSession,
    catalog_path: str,
    curated_path: str,
    output_path: str,
    *,
    tags_path: str | None = None,
    thresholds: Thresholds | None = None,
    order: Sequence[Column | str] | None = None,
    multi_line: bool = False,
    names: Mapping[str, str] | None = None,
    zero_positive: str = "score",
    all_bands: bool = True,
    exact_median: bool = False,
    sort_unrounded: bool = False,
    unique_votes: bool | None = None,
    at_once: int = 4,
    audit: bool = False,
) -> dict[str, str]:
    """Clean, curate and report; returns the path of each written result.

    The raw catalogue is read once: its metrics and those of the curated rows are observed
    in the pass that writes. The curated table and the results are written beside their
    targets and replace them together at the end, with a manifest of files and rows in
    each; a run that fails leaves the old ones as they were (see ``sources.publish``). Raw
    files are never written near. Each report reads the curated Parquet by itself, so that its column
    list, its filters and the year partitions prune the scan; a shared cache would
    read everything. ``at_once`` reports run side by side. Without a tag file the tag
    report is left out. ``unique_votes``: whether items have one row in the vote matrix
    each; None finds out. ``audit`` adds two results: ``bad_cells``, the cells that have text but
    no value, counted by column in the same pass, and ``rejects``, a table of them with file
    and raw line, for which the raw file is read again only if there are any.
    """
    inputs = [path for path in (catalog_path, tags_path) if path]
    require_disjoint(inputs, [curated_path, output_path], default_file_system(spark))
    t = thresholds or Thresholds()
    with Publication(spark, [curated_path, output_path]) as publication:
        curated, output = publication.staged.values()
        read = readers.read_audited if audit else readers.read_catalog
        raw = read(spark, catalog_path, names=names, multi_line=multi_line)
        curating = O.CuratedPass(raw, order=order, zero_positive=zero_positive)
        with O.attempts(spark) as attempts:
            writers.write_curated(curating.rows, curated, observe=(curating.clean, O.clean_metrics()))
            metrics = curating.metrics(attempts.single())
        games = readers.read_curated(spark, curated)

        planned = catalog_reports(
            t, all_bands=all_bands, exact_median=exact_median, sort_unrounded=sort_unrounded
        )
        if tags_path:
            votes = readers.read_wide_votes(spark, tags_path, multi_line=multi_line)
            planned["top_tags"] = Report(
                lambda g: R.top_tags_from_totals(tag_totals(votes, g, unique_key=unique_votes), t),
                at_most=t.top_tags,
            )
        if audit:
            listed = sorted(curating.bad_cells.items())
            bad = spark.createDataFrame(listed, "column string, cells long")
            planned["bad_cells"] = Report(lambda g: bad, ("column",), len(listed))
        counted = {name: Observation() for name in [*planned, "summary"]}

        def write(name: str) -> None:
            if name == "summary":
                writers.write_summary(S.observed_summary(metrics, games), f"{output}/{name}", rows=counted[name])
                return
            report = planned[name]
            writers.write_result(
                report.build(games), f"{output}/{name}", report.order, at_most=report.at_most, rows=counted[name]
            )

        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(inheritable_thread_target(spark)(write), counted))
        rows = {name: found.get["rows"] for name, found in counted.items()}
        if audit and curating.bad_cells:
            counted["rejects"] = Observation()
            rejects = readers.rejected_cells(raw).observe(counted["rejects"], F.count("*").alias("rows"))
            rejects.write.parquet(f"{output}/rejects")
            rows["rejects"] = counted["rejects"].get["rows"]
        publication.publish(
            {publication.targets[0]: {".": metrics["clean_rows"]}, publication.targets[1]: rows}
        )
    return {name: f"{output_path}/{name}" for name in counted}


def run_manifest(spark: SparkSession, curated_path: str, output_path: str) -> DataFrame:
    """What the manifests of a run say, one row per table: report, rows, and whether files and runs agree."""
    curated, output = (read_manifest(spark, path) for path in (curated_path, output_path))
    damaged = damaged_files(spark, curated_path) + damaged_files(spark, output_path)
    whole = not damaged and curated["run"] == output["run"]
    tables = {"curated": curated["tables"]["."]} | output["tables"]
    rows = [(name, table["rows"], whole) for name, table in tables.items()]
    return spark.createDataFrame(rows, "report string, rows long, whole boolean")


def check_run(
    spark: SparkSession, written: Mapping[str, str], curated_path: str, t: Thresholds | None = None
) -> DataFrame:
    """One row per check over the files of a run: (check, violations, passed). The curated table is read once."""
    t = t or Thresholds()
    games = readers.read_curated(spark, curated_path)
    top = readers.read_result(
        spark,
        written["top_reliable"],
        "appid BIGINT, name STRING, total_reviews BIGINT, rating_pct DOUBLE, wilson_pct DOUBLE, price DOUBLE",
    )
    bands = readers.read_result(
        spark,
        written["price_band"],
        "price_band STRING, games BIGINT, mean_price DOUBLE, mean_rating_pct DOUBLE, median_reviews BIGINT",
    )
    # One small file each, so the row number of the file is the place in the ranking.
    place = F.monotonically_increasing_id()
    numbered = bands.withColumn("position", (place + 1).cast("int"))
    found = [
        # Both rounded figures of the ranking have two digits.
        checks.run_battery(games, top, bands, min_reviews=t.min_reviews, tolerance=0.01),
        checks.ranking_order(top.withColumn("place", place), "wilson_pct", ["place"], at_most=t.top_items),
        checks.label_domain(bands),
        checks.label_order(numbered),
    ]
    stacked = found[0]
    for one in found[1:]:
        stacked = stacked.unionByName(one)
    return stacked


def result_fingerprints(spark: SparkSession, written: dict[str, str]) -> DataFrame:
    """Row count and content hash of each result of a run, one row per report."""
    tables = []
    for name, path in written.items():
        reader = readers.read_summary if name == "summary" else readers.read_text_table
        table = reader(spark, path)
        # Summed as decimals: the sum neither depends on row order nor overflows.
        content = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in table.columns]).cast("decimal(20,0)"))
        tables.append(
            table.agg(F.count("*").alias("rows"), F.coalesce(content, F.lit(0)).alias("content"))
            .select(F.lit(name).alias("report"), "rows", "content")
        )
    stacked = tables[0]
    for table in tables[1:]:
        stacked = stacked.unionByName(table)
    return stacked
