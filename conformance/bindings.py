"""The test tables in the shapes the library expects.

A catalogue is derived from ``part``, ``lineitem`` and ``orders``: parts are items,
their line items are review outcomes. A vote matrix is derived from ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.defaults import Thresholds
from ratingloom.operators.cleaning import clean_catalog

# An item has some 30 outcomes at every scale factor, so thresholds are lower here.
THRESHOLDS = Thresholds(
    first_year=1996,
    last_year=2000,
    min_reviews=30,
    min_label_items=100,
    min_publisher_items=10,
    min_publisher_reviews=1000,
)

# The event types, each a tag column of the vote matrix.
VOTE_TAGS = ("click", "error", "purchase", "signup", "view")
VOTE_OFFSET = 2  # taken off every cell, so that zero and negative cells occur


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome counts per part and the date of its latest order.

    Line items are counted before anything is joined, so the order dates join one
    row per part instead of one per line item (every line item has its order).
    """
    returned = F.col("l_returnflag") == "R"
    per_part = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.count_if(F.coalesce(~returned, F.lit(False))).alias("kept"),
            F.count_if(returned).alias("returned"),
            F.max("l_orderkey").alias("last_order"),
        )
    )
    dates = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return per_part.join(dates, F.col("last_order") == F.col("o_orderkey"), "left")


# Columns of the raw catalogue over part, its outcome counts and its latest order
# date, in SQL that reads the same in both engines. A rule on the key puts blanks,
# gaps and bad values in; every row stays.
RAW_COLUMNS = {
    "appid": "p_partkey",
    "name": "' ' || p_name || ' '",
    "release_date": "case when p_partkey % 40 <> 0 then cast(o_orderdate as date) end",
    "english": "1",
    "developer": "'Studio \"' || p_type || '\", Ltd; '",
    "publisher": "case when p_partkey % 25 = 0 then '  ' else p_brand end",
    "platforms": """case when p_partkey % 3 = 0 then 'windows;mac;linux'
        when p_partkey % 7 = 0 then 'windows; mac ;windows;' else 'windows' end""",
    "required_age": "p_size",
    "categories": "p_type || ' ; ' || p_brand",
    "genres": """case when p_partkey % 7 = 0
        then replace(p_name, ' ', ' ;; ') || '; ' || replace(p_name, ' ', ';')
        else replace(p_name, ' ', ';') end""",
    "community_tags": "case when p_partkey % 9 <> 0 then lower(p_type) end",
    "achievements": "p_size * 2",
    "positive_ratings": """case when p_partkey % 11 = 0 then null
        when p_partkey % 33 = 1 then cast(0 as bigint) else kept end""",
    "negative_ratings": """case when p_partkey % 13 = 0 then cast(-5 as bigint)
        when p_partkey % 33 = 1 then cast(0 as bigint) else returned end""",
    "average_playtime": "p_retailprice",
    "median_playtime": "p_retailprice / 2",
    "owners": """case when p_partkey % 60 = 0 then 'n/a'
        else cast(p_size * 1000 as varchar(20)) || '-' || cast(p_size * 2000 as varchar(20)) end""",
    "price": """case when p_partkey % 50 = 0 then cast(-1 as double)
        else cast(p_size - 1 as double) end""",
}

# Text cells, some of which are no number or date.
UNTYPED_COLUMNS = {
    "price": """case when appid % 50 = 0 then 'free' when appid % 33 = 0 then '12f'
        else cast(price as varchar(30)) end""",
    "negative_ratings": """case when appid % 11 = 0 then ''
        else cast(negative_ratings as varchar(30)) end""",
    "release_date": """case when appid % 40 = 0 then '2001-02-30'
        else cast(release_date as varchar(30)) end""",
}


def aliased(columns: dict[str, str]) -> list[str]:
    return [f"{text} as {name}" for name, text in columns.items()]


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw catalogue rows, untrimmed; every twentieth key comes twice.

    ``ver`` tells the copies apart; the second one has one more positive outcome.
    """
    facts = table(spark, sf_dir, "part").join(
        outcomes(spark, sf_dir), F.col("p_partkey") == F.col("l_partkey"), "left"
    )
    copies = "explode(case when p_partkey % 20 = 0 then array(1, 2) else array(1) end) as ver"
    rows = facts.selectExpr(*aliased(RAW_COLUMNS), copies)
    return rows.withColumn("positive_ratings", F.expr("positive_ratings + (ver - 1)"))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned catalogue."""
    return clean_catalog(raw_catalog(spark, sf_dir), order=["ver"])


def wide_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user, one column per event type: its events less a fixed offset.

    Keys reach beyond the catalogue; some cells are zero or negative.
    """
    return (
        table(spark, sf_dir, "events")
        .groupBy((F.col("user_id") * 20).alias("appid"))
        .agg(*[(F.count_if(F.col("event_type") == tag) - VOTE_OFFSET).alias(tag) for tag in VOTE_TAGS])
    )


def repeated_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vote matrix with every second item twice and every fifth one six times."""
    times = "case when appid % 100 = 0 then 6 when appid % 40 = 0 then 2 else 1 end"
    return wide_votes(spark, sf_dir).selectExpr("*", f"explode(sequence(1, {times})) as copy").drop("copy")


def type_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A matrix of 150 columns: the sizes of the parts of each type, twenty parts to an item."""
    return (
        table(spark, sf_dir, "part")
        .groupBy((F.floor(F.col("p_partkey") / 20) * 20).alias("appid"))
        .pivot("p_type")
        .agg(F.sum("p_size"))
        .na.fill(0)
    )


def untyped_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue cells as text."""
    return raw_catalog(spark, sf_dir).selectExpr("appid", "ver", *aliased(UNTYPED_COLUMNS))


def priority_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities in the spelling of tag columns, with their number of orders."""
    tag = F.replace(F.lower("o_orderpriority"), F.lit(" "), F.lit("_")).alias("tag")
    return table(spark, sf_dir, "orders").groupBy(tag).agg(F.count("*").alias("orders"))
