"""Merkle dataset manifest with a witness per row, grown by incremental witnesses.

A tree joins FAN consecutive nodes to their hash, level by level, until one is left; the last
run of a level may be shorter, even a single node. Each group of rows (a source) has a tree
over its leaves in the order of ``order``, and the groups' roots, in the order of the
groups, have a tree of their own.

``append`` grows a tree by streaming: a digest joins the open run of its level, and when a
run is complete every leaf below it gets the siblings of its node, its witness so far, and
the run's hash is appended one level up. Because runs are aligned, a block of
``FAN ** BLOCK_LEVELS`` consecutive leaves is a subtree of its own: blocks are grown side by
side in their tasks, and their roots are then treated as further appends, in blocks again,
until one root is left. A leaf's witness is that of its block, extended by the block's.

Places are counted without a global sort in one task: rows are range-partitioned by group,
order and leaf, the partition that a row went to is written with it, and the counts of the
partitions give each one its first place. So a group of any size is spread over tasks.

Results: every row gives one row. A null group comes first, then groups by their UTF-8 bytes.
Rows of one group go by ``order``, nulls first, equal ones by leaf; rows that are equal in
both are interchangeable and get places of their own. A group of one row has its leaf as
root, and a table of one group that group's root. An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.llm.common import lookup_join, quoted, written

FAN = 16
BLOCK_LEVELS = 3
BLOCK = FAN**BLOCK_LEVELS
WITNESS = "array<struct<at: int, siblings: array<string>>>"
_WITNESS_ARROW = pa.list_(pa.struct([("at", pa.int32()), ("siblings", pa.list_(pa.string()))]))


def field_bytes(value: Column) -> Column:
    """A value as ``-`` if null, else its length in UTF-8 bytes, a colon and the value."""
    shown = value.cast("string")
    framed = F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown)
    return F.coalesce(framed, F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_bytes(f) for f in fields]), 256)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness give."""

    def up(node: Column, level: Column) -> Column:
        siblings, at = level["siblings"], level["at"]
        left = F.array_join(F.slice(siblings, F.lit(1), at), "")
        right = F.array_join(F.slice(siblings, at + 1, F.size(siblings)), "")
        return F.sha2(F.concat(left, node, right), 256)

    return F.aggregate(witness, leaf, up)


def witness_text(witness: Column) -> Column:
    """All siblings of a witness, level by level, left to right."""
    return F.array_join(F.flatten(F.transform(witness, lambda level: level["siblings"])), "")


def depth(nodes: int) -> int:
    """Levels to climb until one node is left, in a block at most BLOCK_LEVELS."""
    levels = 0
    while nodes > 1 and levels < BLOCK_LEVELS:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


class Subtree:
    """A growing tree of ``levels`` levels; ``witnesses`` has what each leaf's witness holds so far."""

    def __init__(self, levels: int) -> None:
        self.open: list[list[tuple[str, int, int]]] = [[] for _ in range(levels + 1)]
        self.witnesses: list[list[tuple[int, list[str]]]] = []

    def append(self, digest: str) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._join(0, (digest, at, at + 1))

    def _join(self, level: int, node: tuple[str, int, int]) -> None:
        run = self.open[level]
        run.append(node)
        if len(run) == FAN and level + 1 < len(self.open):
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for at, (_, first, end) in enumerate(run):
            siblings = [digest for digest, _, _ in run[:at] + run[at + 1 :]]
            for leaf in range(first, end):
                self.witnesses[leaf].append((at, siblings))
        parent = sha256("".join(digest for digest, _, _ in run).encode()).hexdigest()
        self._join(level + 1, (parent, run[0][1], run[-1][2]))

    def root(self) -> str:
        """Completes the runs that are still open, from below."""
        for level in range(len(self.open) - 1):
            if self.open[level]:
                self._complete(level)
        return self.open[-1][0][0]


def _grown(table: pa.Table) -> tuple[pa.Table, Subtree, str]:
    table = table.take(pa.array(np.argsort(table["pos"].to_numpy())))
    tree = Subtree(depth(table["total"][0].as_py()))
    for digest in table["digest"].to_pylist():
        tree.append(digest)
    return table, tree, tree.root()


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``pos``, their place in their ``grp``, and ``total``, the rows of the group."""
    fixed = written(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    ranged = fixed.repartitionByRange("grp", *order, "row").withColumn("part", F.spark_partition_id())
    dealt = written(ranged, "leaves-in-order")
    counts = dealt.groupBy("grp", "part").agg(F.count("*").alias("held"))
    group = Window.partitionBy("grp")
    upto = group.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select(
        "grp",
        "part",
        (F.sum("held").over(upto) - F.col("held")).alias("start"),
        F.sum("held").over(group).alias("total"),
    )
    within = Window.partitionBy("grp", "part").orderBy(*order, "row")
    pos = F.col("start") + F.row_number().over(within) - 1
    numbered = dealt.join(starts, ["grp", "part"]).withColumn("pos", pos).drop("start", "part", "row")
    return numbered.withColumn("block", F.floor(F.col("pos") / BLOCK))


def block_roots(nodes: DataFrame) -> DataFrame:
    """The next level's nodes: one per block, placed in the order of the blocks."""

    def root(table: pa.Table) -> pa.Table:
        table, _, digest = _grown(table)
        total = -(-table["total"][0].as_py() // BLOCK)
        columns = [table["grp"][:1], table["block"][:1], pa.array([total], pa.int64()), pa.array([digest])]
        return pa.table(columns, names=["grp", "pos", "total", "digest"])

    found = (
        nodes.select("grp", "block", "pos", "total", "digest")
        .groupBy("grp", "block")
        .applyInArrow(root, "grp string, pos long, total long, digest string")
    )
    return written(found.withColumn("block", F.floor(F.col("pos") / BLOCK)), "block-roots")


def extended(nodes: DataFrame, above: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The nodes with their witness: what it is within their block, then the block's own.

    ``above``: grp, pos (the block), witness and columns that hold for the whole block.
    """
    known = [c for c in above.columns if c not in ("grp", "pos", "witness")]
    fields = [nodes.schema[c] for c in ("grp", "pos", "digest", *carry)] + [above.schema[c] for c in known]
    schema = T.StructType([*fields, above.schema["witness"]])

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        left, tree, _ = _grown(left)
        tail = right["witness"][0].as_py()
        witnesses = [
            [{"at": at, "siblings": siblings} for at, siblings in own] + tail for own in tree.witnesses
        ]
        columns = [left[c] for c in ("grp", "pos", "digest", *carry)]
        columns += [right[c].take(pa.array(np.zeros(len(left), dtype=np.int64))) for c in known]
        columns.append(pa.array(witnesses, _WITNESS_ARROW))
        return pa.table(columns, names=[f.name for f in schema])

    own = nodes.select("grp", "block", "pos", "total", "digest", *carry).groupBy("grp", "block")
    return own.cogroup(above.withColumn("block", F.col("pos")).groupBy("grp", "block")).applyInArrow(
        extend, schema
    )


def above_blocks(nodes: DataFrame) -> DataFrame:
    """grp, pos (a block), root and the block's witness: its root is appended among its group's blocks."""
    roots = block_roots(nodes)
    if roots.where("total > 1").isEmpty():
        return roots.select("grp", "pos", F.col("digest").alias("root"), F.array().cast(WITNESS).alias("witness"))
    return extended(roots, above_blocks(roots), []).select("grp", "pos", "root", "witness")


def manifest(
    docs: DataFrame, fields: Sequence[str], *, group: str, order: str, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per row: ``order``, ``group``, ``carry``, leaf, subroot, root and witness.

    A leaf is the hash of the ``fields``. The witness lists per level, from the leaf to the
    root, the siblings of the node (the others of its run, in order) and the number of them
    that stand before it.
    """
    named = {f"c{i}": name for i, name in enumerate(dict.fromkeys([order, group, *carry]))}
    leaves = docs.select(
        # Groups as text whose order is that of the groups, null first.
        F.coalesce(F.concat(F.lit("="), quoted(group).cast("string")), F.lit("")).alias("grp"),
        leaf_hash([quoted(f) for f in fields]).alias("digest"),
        *[quoted(name).alias(c) for c, name in named.items()],
    )
    nodes = written(placed(leaves, ["c0", "digest"]), "placed-leaves")
    of_block = written(above_blocks(nodes), "block-witnesses")

    subroots = of_block.where("pos = 0").select(
        F.lit("").alias("grp"), F.col("grp").alias("subtree"), F.col("root").alias("digest")
    )
    groups = written(placed(subroots, ["subtree"]), "placed-subroots")
    top = extended(groups, above_blocks(groups), ["subtree"]).select(
        F.col("subtree").alias("grp"), F.col("root").alias("top_root"), F.col("witness").alias("top_witness")
    )
    above = lookup_join(of_block, written(top, "top-witnesses"), "grp", "pos").select(
        "grp",
        "pos",
        F.col("root").alias("subroot"),
        F.col("top_root").alias("root"),
        F.concat("witness", "top_witness").alias("witness"),
    )
    found = extended(nodes, above, list(named))
    return found.select(
        *[quoted(c).alias(name) for c, name in named.items()],
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "witness",
    )
