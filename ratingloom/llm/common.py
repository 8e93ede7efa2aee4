"""Scratch tables in the shared folder, free column names, joins with hot keys."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
HOT_KEYS = 200  # keys of a join that are dealt over several tasks, at most
HOT_ROWS = 1000  # rows from which a key is one of them


@cache
def _own_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"ratingloom-llm-{application_id}-")


def shared_root(spark: SparkSession) -> str:
    """The folder that the session names; one of our own only in a local session without it."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return _own_root(spark.sparkContext.applicationId)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends, a lost executor costs nothing.

    The table stays until the owner of the folder removes it, as results read it lazily.
    """
    path = f"{shared_root(df.sparkSession)}/{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of the frame has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def without(df: DataFrame, *names: str) -> list[str]:
    """The frame's columns but those that an operator is about to give anew."""
    dropped = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in dropped]


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """The frame with its columns of these names renamed, and the columns that bring them back."""
    clashing = [c for c in df.columns if c.lower() in {n.lower() for n in names}]
    renamed = dict(zip(clashing, free_names(df, *[f"own_{c}" for c in clashing])))
    back = [quoted(renamed.get(c, c)).alias(c) for c in df.columns]
    return df.withColumnsRenamed(renamed), back


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered(text: Column) -> Column:
    """A-Z to lower case and nothing else; the quicker function where the text is all ASCII."""
    slow = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def hot_keys(keys: DataFrame, key: str, rows: str) -> list:
    """The HOT_KEYS keys with most rows, if they have more than HOT_ROWS.

    ``keys`` has one line per key and its number of rows. Any other key holds less than
    one row in HOT_KEYS, or few rows, so the list on the driver is short whatever the data.
    """
    found = keys.where((F.col(rows) > HOT_ROWS) & F.col(key).isNotNull())
    return [r[0] for r in found.orderBy(F.desc(rows)).limit(HOT_KEYS).select(key).collect()]


def salted(key: Column, hot: list, spread: Column, salts: int) -> Column:
    """Of each row of the large side: 0, or for a hot key one of ``salts`` numbers."""
    if not hot:
        return F.lit(0)
    return F.when(key.isin(hot), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(0)


def all_salts(key: Column, hot: list, salts: int) -> Column:
    """Of each row of the small side: the numbers that the large side may carry for its key."""
    one = F.array(F.lit(0))
    if not hot:
        return one
    return F.when(key.isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(one)


def lookup_join(
    big: DataFrame, small: DataFrame, key: str, spread: str, *, how: str = "left", salts: int = 32
) -> DataFrame:
    """Join a large side to one line per key, both sides with the key under one name.

    Hot keys of the large side are found by an exact count and dealt over ``salts``
    tasks by the ``spread`` column; only their lines of the small side are repeated.
    """
    counts = big.groupBy(key).agg(F.count("*").alias("key_rows"))
    hot = hot_keys(counts, key, "key_rows")
    (salt,) = free_names(big, "lookup_salt")
    left = big.withColumn(salt, salted(quoted(key), hot, quoted(spread), salts))
    right = small.withColumn(salt, F.explode(all_salts(quoted(key), hot, salts)))
    return left.join(right, [key, salt], how).drop(salt)
