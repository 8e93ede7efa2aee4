"""Sharding by histogram sort: shards of near equal bytes, rows in one global order.

The digests are written once, and each row gets a number with them. The order is by a
63-bit key: the CRC-32 of the text, then 31 bits of the hashed row number. So equal texts
stand together, and a text that holds a third of all rows, or one row that repeats as
often, can still be cut between its rows. Each round counts, exactly and over all
partitions, the bytes and rows
below candidate boundaries and keeps for each wanted boundary the two candidates around
it; the next candidates lie between them. When every boundary is near enough, or no row
lies between its two candidates, the rows are exchanged once.

A shard is cut into pieces of about ``piece_bytes``, so that no task holds a whole
shard; the counts of the pieces give each one its first slot.

Results: a null text has size 8 and CRC-32 0. Rows that are equal in id and text are
interchangeable and get places of their own. Fewer rows than shards leave shards empty; an
empty table has no rows. Columns named size, text_crc32, shard or slot are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.llm.common import free_names, quoted, without, written

KEY_END = 2**63 - 1
ROW_BYTES = 8
FIRST_PROBES = 4096
ROUND_PROBES = 65_536


def count_below(digests: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each probe; at most one line per probe comes back."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.zeros(len(probes) + 1, dtype=np.int64)
        rows = np.zeros(len(probes) + 1, dtype=np.int64)
        for batch in batches:
            at = np.searchsorted(probes, batch.column(0).to_numpy(), side="right")
            rows += np.bincount(at, minlength=len(rows))
            np.add.at(size, at, batch.column(1).to_numpy())
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full), pa.array(size[full]), pa.array(rows[full])], ["at", "size", "rows"]
        )

    counts = (
        digests.select("key", "size")
        .mapInArrow(partial, "at long, size long, rows long")
        .groupBy("at")
        .agg(F.sum("size").alias("size"), F.sum("rows").alias("rows"))
        .toPandas()
    )
    size = np.zeros(len(probes) + 1, dtype=np.int64)
    rows = np.zeros(len(probes) + 1, dtype=np.int64)
    size[counts["at"]] = counts["size"]
    rows[counts["at"]] = counts["rows"]
    return np.cumsum(size), np.cumsum(rows)


def find_splitters(digests: DataFrame, targets: np.ndarray, tolerances: np.ndarray) -> np.ndarray:
    """For each target a key with as many bytes below it, but for the tolerance or one key."""
    n = len(targets)
    low, high = np.zeros(n, dtype=np.int64), np.full(n, KEY_END, dtype=np.int64)
    low_size, high_size = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    open_ = np.arange(n)
    probes = np.arange(1, FIRST_PROBES + 1, dtype=np.int64) * (KEY_END // FIRST_PROBES)
    probes[-1] = KEY_END
    while True:
        size, rows = count_below(digests, probes)
        keys = np.concatenate([[0], probes])
        size, rows = np.concatenate([[0], size[:-1]]), np.concatenate([[0], rows[:-1]])
        first, last = np.searchsorted(keys, low[open_]), np.searchsorted(keys, high[open_])
        at = np.searchsorted(size, targets[open_], side="right") - 1
        at = np.clip(at, first, last - 1)
        low[open_], high[open_] = keys[at], keys[at + 1]
        low_size[open_], high_size[open_] = size[at], size[at + 1]
        off = np.minimum(targets[open_] - size[at], size[at + 1] - targets[open_])
        apart = (rows[at + 1] - rows[at] > 1) & (keys[at + 1] - keys[at] > 1)
        open_ = open_[(off > tolerances[open_]) & apart]
        if not len(open_):
            return np.sort(np.where(targets - low_size <= high_size - targets, low, high))
        each = max(2, min(64, ROUND_PROBES // len(open_)))
        found = {
            int(a) + (int(b) - int(a)) * k // (each + 1)
            for a, b in zip(low[open_], high[open_])
            for k in range(each + 2)
        }
        probes = np.array(sorted(found - {0}), dtype=np.int64)


def shard(
    docs: DataFrame,
    shards: int,
    *,
    text: str = "text",
    carry: Sequence[str] | None = None,
    tolerance: float = 0.0005,
    piece_bytes: int = 1 << 26,
) -> DataFrame:
    """The documents with size, text_crc32, shard and slot (gapless in each shard, from 0).

    ``carry``: the columns that the result has besides, all by default; they are written
    with the row numbers. ``tolerance``: share of a shard's bytes by which a boundary may be
    off. The driver holds one boundary per piece and at most ROUND_PROBES counts; no row.
    """
    kept = without(docs, "size", "text_crc32", "shard", "slot") if carry is None else list(carry)
    row, key, at = free_names(docs.select(*map(quoted, kept)), "shard_row", "shard_key", "shard_place")
    crc = F.coalesce(F.crc32(quoted(text)), F.lit(0).cast("long"))
    size = F.coalesce(F.octet_length(quoted(text)), F.lit(0)).cast("long") + ROW_BYTES
    fixed = written(
        docs.select(
            *map(quoted, kept),
            size.alias("size"),
            crc.alias("text_crc32"),
            F.monotonically_increasing_id().alias(row),
        ),
        "shard-rows",
    )
    order = F.shiftleft("text_crc32", 31).bitwiseOR(F.shiftrightunsigned(F.xxhash64(row), 33))
    digests = fixed.select(order.alias("key"), "size")
    total = digests.agg(F.sum("size")).first()[0] or 0
    pieces = max(1, -(-total // (shards * piece_bytes)))
    n = shards * pieces
    targets = np.array([total * i // n for i in range(1, n)], dtype=np.int64)
    edge = np.arange(1, n) % pieces == 0
    allowed = np.where(edge, tolerance * total / shards, 0.05 * total / n)
    if total and len(targets):
        splitters = find_splitters(digests, targets, allowed)
        _, rows = count_below(digests, splitters)
    else:
        splitters, rows = np.zeros(0, dtype=np.int64), np.zeros(n, dtype=np.int64)
    starts = np.concatenate([[0], rows[:-1]])[:n]
    bases = starts - starts[np.arange(len(starts)) // pieces * pieces]

    @F.pandas_udf("piece int, shard int, base long")
    def place(keys: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(splitters, keys.to_numpy(), side="right")
        return pd.DataFrame(
            {"piece": at.astype(np.int32), "shard": (at // pieces).astype(np.int32), "base": bases[at]}
        )

    placed = fixed.withColumn(key, order).withColumn(at, place(F.col(key)))
    within = Window.partitionBy(f"{at}.piece").orderBy(key, row)
    return placed.select(
        *map(quoted, kept),
        "size",
        "text_crc32",
        F.col(f"{at}.shard").alias("shard"),
        (F.col(f"{at}.base") + F.row_number().over(within) - 1).alias("slot"),
    )
