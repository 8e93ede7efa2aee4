"""Declared schema, thresholds and fixed labels."""

from __future__ import annotations

from dataclasses import dataclass

# Column order and types of the catalogue file.
CATALOG_SCHEMA = """
    appid INT, name STRING, release_date DATE, english INT, developer STRING,
    publisher STRING, platforms STRING, required_age INT, categories STRING,
    genres STRING, community_tags STRING, achievements INT,
    positive_ratings BIGINT, negative_ratings BIGINT,
    average_playtime DOUBLE, median_playtime DOUBLE, owners STRING, price DOUBLE
"""



def ddl_names(ddl: str) -> list[str]:
    """Column names of a flat DDL schema."""
    return [field.split()[0] for field in ddl.split(",")]


# Text columns that cleaning trims.
TEXT_COLUMNS = (
    "name",
    "developer",
    "publisher",
    "platforms",
    "categories",
    "genres",
    "community_tags",
    "owners",
)

# Price bands. A zero price has its own label; every other band is
# half open, [previous edge, edge), and the last one has no upper edge.
FREE_LABEL = "Free"
BAND_EDGES = ((5, "Under 5"), (10, "5-10"), (20, "10-20"), (40, "20-40"))
TOP_BAND = "40+"
BAND_LABELS = (FREE_LABEL, *(label for _, label in BAND_EDGES), TOP_BAND)

# Fixed value: two-sided 95 % normal quantile.
Z_95 = 1.959963984540054

LABEL_SEPARATOR = ";"
DATE_FORMAT = "yyyy-MM-dd"


@dataclass(frozen=True)
class Thresholds:
    """Evidence thresholds and report sizes (fixed values)."""

    first_year: int = 1997
    last_year: int = 2019
    min_reviews: int = 1000
    min_label_items: int = 100
    min_publisher_items: int = 10
    min_publisher_reviews: int = 10000
    top_items: int = 20
    top_publishers: int = 20
    top_tags: int = 30
    era_ranks: int = 3
