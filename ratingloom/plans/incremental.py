"""New raw rows into a curated table, without a rebuild of the years that they leave alone."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.operators.cleaning import clean_rows, first_per_key, identified
from ratingloom.sources import readers
from ratingloom.sources.publish import MANIFEST, Files, manifest_text, recover, swap


@dataclass(frozen=True)
class Increment:
    """What an increment did: rows added for new keys, rows replaced, and the partitions written anew."""

    added: int
    replaced: int
    partitions: tuple[str, ...]


def _order(order: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in order]


def challengers(
    new: DataFrame, held: DataFrame, order: Sequence[str], *, key: str, partition: str
) -> DataFrame:
    """The new rows that enter the table: key unknown, or before the row held under ``order``.

    ``_held`` tells whether a row is displaced and ``_from`` its partition. Ties stay with
    the table. Only the key, the order and the partition of the table are read.
    """
    known = held.select(
        F.col(key).alias("_key"), F.struct(*order).alias("_place"), F.col(partition).alias("_from")
    )
    both = new.join(known, F.col(key) == F.col("_key"), "left")
    earlier = F.lit(False)
    for name in reversed(order):
        own, other = F.col(name), F.col(f"_place.{name}")
        # Nulls last, as in the order of a full run.
        before = (own < other) | (own.isNotNull() & other.isNull())
        earlier = F.coalesce(before, F.lit(False)) | (own.eqNullSafe(other) & earlier)
    return (
        both.where(F.col("_key").isNull() | earlier)
        .withColumn("_held", F.col("_key").isNotNull())
        .drop("_key", "_place")
    )


def add_raw(
    spark: SparkSession,
    new_raw: DataFrame,
    curated_path: str,
    order: Sequence[str],
    *,
    key: str = "appid",
    name: str = "name",
    partition: str = "release_year",
    **options,
) -> Increment:
    """Merge new raw rows into a curated table; the result is that of a run over all raw rows.

    ``order`` names the columns by which a run picks the row of a key (first under it,
    nulls last). They have to be in the curated table and must come through cleaning
    unchanged: a version, a load date. Of the table only the partitions that gain or lose
    a row are read whole and written, beside the table, and swapped in together with the
    manifest; the files of all others stay. Every other partition costs its key, order and
    year columns. A partition that loses its last row goes. Rows that change nothing leave
    all files as they are.
    """
    curated_path = curated_path.rstrip("/")
    files = Files(spark)
    recover(files, [curated_path])
    held = readers.read_curated(spark, curated_path)
    missing = [c for c in order if c not in held.columns]
    if not order or missing:
        raise ValueError(f"the curated table has no column {', '.join(missing) or 'to order by'}")
    run = uuid.uuid4().hex
    staged = posixpath.join(posixpath.dirname(curated_path), f"_{posixpath.basename(curated_path)}.{run}.staged")
    try:
        firsts = first_per_key(identified(new_raw, (key, name)), (key,), _order(order))
        entering = challengers(clean_rows(firsts, **options), held, order, key=key, partition=partition)
        # Written once: the rows decide the partitions, are counted and are merged.
        entering.write.parquet(f"{staged}/entering")
        entering = spark.read.parquet(f"{staged}/entering")
        added, replaced = entering.agg(F.count_if(~F.col("_held")), F.count_if("_held")).first()
        if not added + replaced:
            return Increment(0, 0, ())
        gains = entering.select(F.col(partition).alias("p"))
        losses = entering.where("_held").select(F.col("_from").alias("p"))
        touched = [r["p"] for r in gains.union(losses).distinct().collect()]  # years: few by their nature

        years = [p for p in touched if p is not None]
        inside = F.col(partition).isin(years) | (F.col(partition).isNull() if None in touched else F.lit(False))
        gone = entering.where("_held").select(key)
        stay = held.where(inside).join(gone, key, "left_anti")
        merged = stay.unionByName(entering.select(*held.columns))
        merged.hint("rebalance", partition).write.partitionBy(partition).parquet(f"{staged}/merged")

        folder = {p: f"{partition}={'__HIVE_DEFAULT_PARTITION__' if p is None else p}" for p in touched}
        present = set(files.names(f"{staged}/merged"))
        moves = {
            f"{curated_path}/{f}": f"{staged}/merged/{f}" if f in present else None for f in folder.values()
        }
        kept = {n: size for n, size in files.listing(curated_path).items() if n.split("/")[0] not in folder.values()}
        written = files.listing(f"{staged}/merged")
        rows = spark.read.parquet(f"{staged}/merged").count() + held.where(~F.coalesce(inside, F.lit(False))).count()
        text = manifest_text(run, {".": rows}, kept | written)
        swap(files, curated_path, moves, {f"{curated_path}/{MANIFEST}": text})
        return Increment(added, replaced, tuple(sorted(folder.values())))
    finally:
        if not files.exists(posixpath.join(posixpath.dirname(curated_path), f"_{posixpath.basename(curated_path)}.journal")):
            files.delete(staged)
