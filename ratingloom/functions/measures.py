"""Derived measures as native column expressions (all inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratingloom.defaults import BAND_EDGES, BAND_LABELS, FREE_LABEL, TOP_BAND, Z_95

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def non_negative(count: ColumnOrName) -> Column:
    """Missing and negative counts become zero."""
    zero = F.lit(0).cast("long")
    return F.greatest(F.coalesce(as_column(count).cast("long"), zero), zero)


def valid_price(price: ColumnOrName) -> Column:
    """Negative prices become null; zero is a real price."""
    price = as_column(price)
    return F.when(price >= 0, price)


def rating_pct(positive: ColumnOrName, total: ColumnOrName) -> Column:
    """Share of positive outcomes in percent, null without outcomes."""
    total = as_column(total)
    return 100 * as_column(positive) / F.when(total > 0, total)


def wilson_lower_bound(
    positive: ColumnOrName,
    total: ColumnOrName,
    z: float = Z_95,
    zero_positive: str = "score",
) -> Column:
    """Lower end of the Wilson score interval for ``positive`` out of ``total``.

    Null when there are no outcomes. ``zero_positive="null"`` also returns null
    when no outcome is positive; the default keeps the formula's value, zero.
    The divisor is null rather than zero, so ANSI mode never raises.
    """
    if zero_positive not in ("score", "null"):
        raise ValueError("zero_positive must be 'score' or 'null'")
    positive, total = as_column(positive), as_column(total)
    usable = total > 0
    if zero_positive == "null":
        usable = usable & (positive > 0)
    n = F.when(usable, total)
    share = positive / n
    z_squared = F.lit(z * z)
    spread = F.sqrt((share * (1 - share) + z_squared / (4 * n)) / n)
    return (share + z_squared / (2 * n) - F.lit(z) * spread) / (1 + z_squared / n)


def price_band(
    price: ColumnOrName,
    edges: Iterable[tuple[float, str]] = BAND_EDGES,
    free_label: str = FREE_LABEL,
    top_label: str = TOP_BAND,
    null_band: str | None = TOP_BAND,
) -> Column:
    """Label of the half-open price band; ``null_band`` labels a missing price.

    The default puts missing prices in the top band, so that the bands always
    cover every row; ``null_band=None`` leaves them without a band.
    """
    price = as_column(price)
    start = F.when(price.isNull(), F.lit(null_band)).when(price == 0, free_label)
    chain = reduce(lambda branch, edge: branch.when(price < edge[0], edge[1]), edges, start)
    return chain.otherwise(top_label)


def band_position(band: ColumnOrName, labels: Iterable[str] = BAND_LABELS) -> Column:
    """Place of a band in the declared order; unknown labels sort last."""
    labels = list(labels)
    place = F.array_position(F.array(*[F.lit(label) for label in labels]), as_column(band))
    return F.when(place > 0, place - 1).otherwise(len(labels)).cast("int")


def _digits(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("long")


def owner_lower(owners: ColumnOrName) -> Column:
    """Leading number of a ``low-high`` range, null when there is none."""
    return _digits(as_column(owners), r"^(\d+)")


def owner_upper(owners: ColumnOrName) -> Column:
    """Trailing number of a ``low-high`` range, null when there is none."""
    return _digits(as_column(owners), r"(\d+)$")


def midpoint(lower: ColumnOrName, upper: ColumnOrName) -> Column:
    return (as_column(lower) + as_column(upper)) / 2


def missing_any(*columns: ColumnOrName) -> Column:
    """True when at least one of the columns is null."""
    return reduce(lambda a, b: a | b, [as_column(c).isNull() for c in columns])


# Smallest marker and what the largest one adds to it.
MARKER_BASE, MARKER_SPAN = 80, 520


def relative_size(
    value: ColumnOrName,
    largest: ColumnOrName,
    base: float = MARKER_BASE,
    span: float = MARKER_SPAN,
) -> Column:
    """Marker size that grows with the square root of the share of the largest value."""
    return base + span * F.sqrt(as_column(value) / as_column(largest))
