"""Cleaning: identification, deduplication, null rules and derived measures."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.defaults import BAND_EDGES, BAND_LABELS, FREE_LABEL, TEXT_COLUMNS, TOP_BAND, Z_95
from ratingloom.functions import measures as M
from ratingloom.functions import text as X


def identified(df: DataFrame, required: Sequence[str] = ("appid", "name")) -> DataFrame:
    """Rows whose identifying columns are all present."""
    for name in required:
        df = df.filter(F.col(name).isNotNull())
    return df


def content_order(df: DataFrame, skip: Iterable[str] = ()) -> list[Column]:
    """An order over everything a row holds, for a survivor that is always the same."""
    skip = set(skip)
    return [F.col(f"`{name}`").asc_nulls_last() for name in df.columns if name not in skip]


def first_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("appid",),
    order: Sequence[Column | str] | None = None,
) -> DataFrame:
    """One row per key: the first under ``order``, else the first by content.

    The ``= 1`` filter sits on the row number, so each map task keeps at most one
    row per key before the shuffle; a key that holds a third of all rows arrives
    as one row per map task. Give ``order`` where there is one: without it the
    order needs every column and nothing can be pruned.
    """
    order = list(order) if order else content_order(df, keys)
    place = "_place"
    ranked = df.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(place) == 1).drop(place)


def coerce_types(
    df: DataFrame,
    numbers: Sequence[str] = (),
    dates: Sequence[str] = (),
) -> DataFrame:
    """Text columns to numbers and dates; what does not parse becomes null."""
    return df.withColumns(
        {name: X.to_number(name) for name in numbers} | {name: X.to_date(name) for name in dates}
    )


def fill_blank_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Missing text becomes the empty string."""
    return df.fillna("", subset=list(columns) if columns is not None else None)


def trim_text(
    df: DataFrame, columns: Iterable[str] = TEXT_COLUMNS, whitespace: bool = False
) -> DataFrame:
    """Trim the listed text columns that the table has."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: X.trimmed(name, whitespace) for name in present})


def add_measures(
    df: DataFrame,
    *,
    z: float = Z_95,
    zero_positive: str = "score",
    edges: Sequence[tuple[float, str]] = BAND_EDGES,
    free_label: str = FREE_LABEL,
    top_label: str = TOP_BAND,
    null_band: str | None = TOP_BAND,
) -> DataFrame:
    """Every measure derived from cleaned counts, price, date and owner range.

    Measures whose input the table lacks are left out.
    """
    have = set(df.columns)
    if {"positive_ratings", "negative_ratings"} <= have:
        df = df.withColumn("total_reviews", F.col("positive_ratings") + F.col("negative_ratings"))
    derived: dict[str, Column] = {}
    if "total_reviews" in df.columns:
        derived["rating_pct"] = M.rating_pct("positive_ratings", "total_reviews")
        derived["wilson_score"] = M.wilson_lower_bound(
            "positive_ratings", "total_reviews", z, zero_positive
        )
    if "release_date" in have:
        derived["release_year"] = F.year("release_date")
    if "price" in have:
        derived["price_band"] = M.price_band("price", edges, free_label, top_label, null_band)
    if "owners" in have:
        derived["owner_lower"] = M.owner_lower("owners")
        derived["owner_upper"] = M.owner_upper("owners")
        derived["owner_midpoint"] = M.midpoint(derived["owner_lower"], derived["owner_upper"])
    if {"release_date", "price"} <= have:
        derived["has_missing_core"] = M.missing_any("release_date", "price")
    return df.withColumns(derived)


def clean_catalog(
    raw: DataFrame,
    *,
    key: str = "appid",
    name: str = "name",
    order: Sequence[Column | str] | None = None,
    **options,
) -> DataFrame:
    """The curated fact: one identified row per key, null rules applied, measures added.

    Rows without key or name go first, so that they neither form a hot group in
    the shuffle nor win over a complete copy. ``options`` are those of ``clean_rows``.
    """
    return clean_rows(first_per_key(identified(raw, (key, name)), (key,), order), **options)


def clean_rows(
    df: DataFrame,
    *,
    text_columns: Iterable[str] = TEXT_COLUMNS,
    whitespace: bool = False,
    fill_blank: bool = False,
    **measure_options,
) -> DataFrame:
    """Null rules and measures on rows that are identified and unique."""
    present = [column for column in text_columns if column in df.columns]
    df = trim_text(df, present, whitespace)
    if fill_blank:
        df = fill_blank_strings(df, present)
    rules = {
        "positive_ratings": M.non_negative,
        "negative_ratings": M.non_negative,
        "price": M.valid_price,
    }
    df = df.withColumns({c: rule(c) for c, rule in rules.items() if c in df.columns})
    return add_measures(df, **measure_options)


def band_dimension(spark, labels: Sequence[str] = BAND_LABELS, column: str = "price_band") -> DataFrame:
    """The declared bands with their position, one row each."""
    listed = F.array(*[F.lit(label) for label in labels])
    return spark.range(1).select(F.posexplode(listed).alias("band_order", column))
