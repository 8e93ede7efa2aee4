"""Near-duplicate vectors by an inverted multi-index, every link verified in double precision.

1. Vectors that are equal bit by bit become one class, which counts once from here on.
2. Each half of the vectors has a codebook of its own, fitted by k-means on about
   FIT_VECTORS classes chosen by hash. The two nearest centroids name a class's cell in the
   product grid; the number of centroids follows the number of classes, so that a cell
   holds about CELL_VECTORS of them.
3. A class visits cells in the order of their distance (the sum of both halves' squared
   distances), by multi-sequence traversal, and stops when the distance exceeds that of its
   own cell by more than ``reach``. ``reach`` is calibrated for the target recall: by
   vectors turned away from sampled ones to exactly the wanted cosine, and by the real
   links of about PROBED_VECTORS sampled classes, found by comparing these with all classes.
4. The members of a cell and the classes that visit it meet in blocks of bounded size,
   where cosines are computed in double precision. A block gives back the number of links of
   each class and the edges of a spanning forest, never its pairs. A link is found from
   either side; the visits that travel with a class tell whether the other side sees it too.

Results: a vector that is null, zero or holds a null, an infinity or NaN links with nothing:
n_links 0, a component of its own. Vectors of different length do not link with each other.
Copies are linked with each other. Rows that repeat count as vectors of their own, a null id
too; it is nobody's component_id while another id is there. If a component has no id, all its
rows are kept. Columns but the id and the vector are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.llm.common import lookup_join, quoted, written
from ratingloom.llm.components import components

FIT_VECTORS = 20_000  # classes from which the codebooks are learned, about
PROBED_VECTORS = 500  # classes that are compared with all others, about
CELL_VECTORS = 64  # classes in a cell, on average
MOST_CENTROIDS = 1024
MEMBER_BLOCK, VISITOR_BLOCK = 2048, 8192  # classes that meet in one task
SLICE = 512  # visitors that are compared with a block of members at once


def _decoded(vectors: list[bytes], length: int, kind: str) -> np.ndarray:
    """Unit vectors as rows, in doubles, shorter ones filled up with zeros."""
    rows = np.zeros((len(vectors), length))
    for row, held in zip(rows, vectors):
        values = np.frombuffer(held, dtype=kind)
        row[: len(values)] = values
    rows /= np.abs(rows).max(axis=1, keepdims=True)  # else squares of tiny or huge components leave the doubles
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def signed(vectors: DataFrame, vector_id: str, embedding: str) -> tuple[DataFrame, str]:
    """vec_id, vec_key (null if the vector cannot link) and the vector's bytes; how the bytes are to be read.

    The bytes are those of the table: floats stay floats, anything else becomes doubles.
    """
    id_type = vectors.schema[vector_id].dataType.simpleString()
    held_type = vectors.schema[embedding].dataType
    floats = isinstance(held_type, T.ArrayType) and isinstance(held_type.elementType, T.FloatType)
    kind = "float32" if floats else "float64"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, held = [], []
            for value in batch.column(1):
                key = body = None
                if value.is_valid and len(value) and not value.values.null_count:
                    raw = value.values.to_numpy(zero_copy_only=False)
                    if np.isfinite(raw).all() and raw.any():
                        body = raw.tobytes()
                        key = blake2b(body, digest_size=16).digest()
                keys.append(key)
                held.append(body)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(held, pa.binary())],
                ["vec_id", "vec_key", "vec"],
            )

    listed = quoted(embedding) if floats else quoted(embedding).cast("array<double>")
    rows = vectors.select(quoted(vector_id).alias("vec_id"), listed.alias("vec"))
    return rows.mapInArrow(sign, f"vec_id {id_type}, vec_key binary, vec binary"), kind


@dataclass
class Grid:
    """Codebooks of both halves, and how much farther than the own cell a visited one may be."""

    codebooks: tuple[np.ndarray, np.ndarray]
    length: int
    kind: str = "float64"
    reach: float = 0.0

    def rows(self, vectors: list[bytes]) -> np.ndarray:
        return _decoded(vectors, self.length, self.kind)

    def excess(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per half and centroid: the squared distance less that of the nearest centroid."""
        cut, found = self.length // 2, []
        for half, book in zip((rows[:, :cut], rows[:, cut:]), self.codebooks):
            far = (book**2).sum(axis=1)[None] - 2 * half @ book.T
            found.append(far - far.min(axis=1, keepdims=True))
        return found[0], found[1]

    def cell(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first * len(self.codebooks[1]) + second

    def cells(self, rows: np.ndarray) -> np.ndarray:
        first, second = self.excess(rows)
        return self.cell(first.argmin(axis=1), second.argmin(axis=1))

    def distance(self, rows: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How much farther than its own cell a cell (one per row) is."""
        first, second = self.excess(rows)
        at, n = np.arange(len(rows)), len(self.codebooks[1])
        return first[at, cells // n] + second[at, cells % n]

    def visited(self, rows: np.ndarray) -> list[np.ndarray]:
        """Each row's cells, nearest first, by multi-sequence traversal.

        Both halves' centroids are put in order. A step takes the nearest pair of ranks on the
        frontier; (i + 1, j) and (i, j + 1) enter it when their other predecessors were taken.
        """
        found = []
        for first, second in zip(*self.excess(rows)):
            order, other = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
            near, far = first[order].tolist(), second[other].tolist()
            taken = [0] * (len(near) + 1)  # of each rank of the first half, the ranks of the second
            frontier, walk = [(near[0] + far[0], 0, 0)], []
            while frontier and frontier[0][0] <= self.reach:
                _, i, j = heapq.heappop(frontier)
                walk.append((i, j))
                taken[i] = j + 1
                if i + 1 < len(near) and taken[i + 1] == j:
                    heapq.heappush(frontier, (near[i + 1] + far[j], i + 1, j))
                if j + 1 < len(far) and (i == 0 or taken[i - 1] > j + 1):
                    heapq.heappush(frontier, (near[i] + far[j + 1], i, j + 1))
            ranks = np.array(walk)
            found.append(self.cell(order[ranks[:, 0]], other[ranks[:, 1]]))
        return found


def _codebook(rows: np.ndarray, size: int, random: np.random.Generator, rounds: int = 12) -> np.ndarray:
    book = rows[random.choice(len(rows), size, replace=False)].copy()
    for _ in range(rounds):
        nearest = ((book**2).sum(axis=1)[None] - 2 * rows @ book.T).argmin(axis=1)
        order = np.argsort(nearest, kind="stable")
        present, starts = np.unique(nearest[order], return_index=True)
        held = np.diff([*starts, len(rows)])
        book[present] = np.add.reduceat(rows[order], starts, axis=0) / held[:, None]
    return book


def _turned(rows: np.ndarray, cosine: float, random: np.random.Generator) -> np.ndarray:
    """A vector at exactly this cosine from each row, in a random direction."""
    aside = random.normal(size=rows.shape)
    aside -= (aside * rows).sum(axis=1)[:, None] * rows
    aside /= np.maximum(np.linalg.norm(aside, axis=1), 1e-300)[:, None]
    return cosine * rows + np.sqrt(1 - cosine * cosine) * aside


def _sampled(classes: DataFrame, share: float, salt: int) -> list[bytes]:
    """Vectors of a share of the classes, chosen by hash."""
    chosen = F.pmod(F.xxhash64("vec_key", F.lit(salt)), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    return [bytes(r.vec) for r in classes.where(chosen).orderBy("vec_key").select("vec").collect()]


def real_distances(classes: DataFrame, grid: Grid, probes: np.ndarray, cosine: float) -> np.ndarray:
    """For each probe with links, how far a walk must go to find the farthest of them.

    All classes are compared with the probes; a task sends one line per probe at most.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = grid.cells(probes)
        farthest = np.full(len(probes), -1.0)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = grid.rows(batch.column(0).slice(at, SLICE).to_pylist())
                p, r = np.nonzero(probes @ rows.T >= cosine)
                if len(p):
                    there = grid.distance(probes[p], grid.cells(rows)[r])
                    back = grid.distance(rows[r], own[p])
                    np.maximum.at(farthest, p, np.minimum(there, back))
        seen = np.flatnonzero(farthest >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(farthest[seen])], ["probe", "far"])

    found = classes.select("vec").mapInArrow(measure, "probe long, far double")
    rows = found.groupBy("probe").agg(F.max("far").alias("far")).collect()
    return np.array([r.far for r in rows])


def fit(classes: DataFrame, kind: str, cosine: float, target: float) -> Grid | None:
    """The grid, calibrated for the target recall; None for an empty table."""
    n, longest = classes.agg(F.count("*"), F.max(F.octet_length("vec"))).first()
    if not n:
        return None
    length = longest // np.dtype(kind).itemsize
    sample = _sampled(classes, FIT_VECTORS / n, 1) or [bytes(classes.first().vec)]
    sample = _decoded(sample, length, kind)
    size = int(np.clip(np.sqrt(n / CELL_VECTORS), 1, min(MOST_CENTROIDS, len(sample))))
    random, cut = np.random.default_rng(13), length // 2
    books = (_codebook(sample[:, :cut], size, random), _codebook(sample[:, cut:], size, random))
    grid = Grid(books, length, kind)
    turned = _turned(sample, cosine, random)
    # A link is found from either side: the shorter of both walks counts.
    made = np.minimum(grid.distance(sample, grid.cells(turned)), grid.distance(turned, grid.cells(sample)))
    probes = _sampled(classes, PROBED_VECTORS / n, 2)
    real = real_distances(classes, grid, grid.rows(probes), cosine) if probes else np.zeros(0)
    grid.reach = float(max(np.quantile(far, target) for far in (made, real) if len(far))) + 1e-9
    return grid


def _forest(edges: np.ndarray) -> np.ndarray:
    """Of edges between numbers, as many as connect what they connect."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for i, (a, b) in enumerate(edges.tolist()):
        a, b = find(a), find(b)
        if a != b:
            parent[a] = b
            kept.append(i)
    return edges[kept]


def block_links(members: pa.Table, visitors: pa.Table, grid: Grid, cosine: float):
    """Links of each class that the block counts, and forest edges, both by vec_key.

    A visitor counts all its links with members. A member counts a link if its own walk
    does not reach the visitor's cell, where the link would be found from its side.
    """
    m_keys, v_keys = members["vec_key"].to_pylist(), visitors["vec_key"].to_pylist()
    m_vecs, v_vecs = members["vec"].to_pylist(), visitors["vec"].to_pylist()
    m_rows, m_len = grid.rows(m_vecs), np.array([len(v) for v in m_vecs])
    m_held, v_held = members["held"].to_numpy(), visitors["held"].to_numpy()
    v_len, v_cell = np.array([len(v) for v in v_vecs]), visitors["own"].to_numpy()
    walks = members["walk"].to_pylist()
    # One number per (member, cell of its walk), in order.
    span = 1 + max(int(v_cell.max()), *(max(w) for w in walks))
    seen = np.sort(np.concatenate([np.array(w, dtype=np.int64) + i * span for i, w in enumerate(walks)]))
    place = {key: i for i, key in enumerate(m_keys)}
    v_links, m_links = np.zeros(len(v_keys), dtype=np.int64), np.zeros(len(m_keys), dtype=np.int64)
    edges = []
    for at in range(0, len(v_keys), SLICE):
        part = slice(at, min(at + SLICE, len(v_keys)))
        near = grid.rows(v_vecs[part]) @ m_rows.T >= cosine
        near &= v_len[part, None] == m_len[None]
        for i, key in enumerate(v_keys[part]):
            if key in place:
                near[i, place[key]] = False
        i, j = np.nonzero(near)
        if not len(i):
            continue
        v_links[part] += np.bincount(i, m_held[j], minlength=near.shape[0]).astype(np.int64)
        back = j * span + v_cell[part][i]
        at_seen = np.minimum(np.searchsorted(seen, back), len(seen) - 1)
        unseen = seen[at_seen] != back
        np.add.at(m_links, j[unseen], v_held[part][i[unseen]])
        # Visitors are numbered after the members; each one's first link stands for the rest.
        first = np.argmax(near, axis=1)[i]
        linked = np.unique(i)
        edges.append(np.stack([len(m_keys) + at + linked, np.argmax(near, axis=1)[linked]], axis=1))
        edges.append(np.unique(np.stack([first, j], axis=1)[first != j], axis=0))
    keys = m_keys + v_keys
    counted = [(keys[i], int(n)) for i, n in enumerate([*m_links, *v_links]) if n]
    joined = _forest(np.concatenate(edges)) if edges else []
    return counted, [(keys[a], keys[b]) for a, b in joined if keys[a] != keys[b]]


def links(classes: DataFrame, grid: Grid, cosine: float) -> tuple[DataFrame, DataFrame]:
    """vec_key and links to other classes' vectors; edges (u, v) that make the components."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                walks = grid.visited(grid.rows(part.column(2).to_pylist()))
                own = [w[0] for w in walks]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(own, pa.int64()), pa.array(walks, pa.list_(pa.int64()))],
                    [*part.schema.names, "own", "walk"],
                )

    walked = classes.select("vec_key", "held", "vec").mapInArrow(
        walk, "vec_key binary, held long, vec binary, own long, walk array<long>"
    )
    walked = written(walked, "walks")
    visits = walked.select(F.explode("walk").alias("cell"))
    sizes = walked.groupBy(F.col("own").alias("cell")).agg(F.count("*").alias("members"))
    visited = visits.groupBy("cell").agg(F.count("*").alias("visitors"))
    # Cells without members need no visit.
    cells = written(
        sizes.join(visited, "cell").select(
            "cell",
            F.ceil(F.col("members") / MEMBER_BLOCK).alias("m_blocks"),
            F.ceil(F.col("visitors") / VISITOR_BLOCK).alias("v_blocks"),
        ),
        "cells",
    )
    visiting = walked.select("vec_key", "held", "vec", "own", F.explode("walk").alias("cell"))
    visitors = (
        lookup_join(visiting, cells, "cell", "vec_key", how="inner")
        .withColumn("v", F.pmod(F.xxhash64("vec_key", F.lit(3)), F.col("v_blocks")))
        .withColumn("m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m_blocks") - 1)))
        .select("cell", "m", "v", "vec_key", "held", "vec", "own")
    )
    members = (
        lookup_join(walked.withColumn("cell", F.col("own")), cells, "cell", "vec_key", how="inner")
        .withColumn("m", F.pmod(F.xxhash64("vec_key", F.lit(4)), F.col("m_blocks")))
        .withColumn("v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("v_blocks") - 1)))
        .select("cell", "m", "v", "vec_key", "held", "vec", "walk")
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        counted, joined = [], []
        if len(left) and len(right):
            counted, joined = block_links(left, right, grid, cosine)
        u = [k for k, _ in counted] + [a for a, _ in joined]
        v = [None] * len(counted) + [b for _, b in joined]
        n = [x for _, x in counted] + [None] * len(joined)
        return pa.table([pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(n, pa.int64())], ["u", "v", "n"])

    by = ["cell", "m", "v"]
    visitors = visitors.toDF(*visitors.columns)  # both sides stem from one table: columns of their own
    met = members.groupBy(*by).cogroup(visitors.groupBy(*by)).applyInArrow(meet, "u binary, v binary, n long")
    met = written(met, "vector-links")
    counts = met.where("n IS NOT NULL").groupBy(F.col("u").alias("vec_key")).agg(F.sum("n").alias("links"))
    return counts, met.where("v IS NOT NULL").select("u", "v")


def near_vectors(
    vectors: DataFrame,
    *,
    cosine: float = 0.95,
    target: float = 0.9999,
    vector_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``target``: share of the links at exactly the wanted cosine that the walks must find;
    closer links are found more often.
    """
    signed_rows, kind = signed(vectors, vector_id, embedding)
    rows = written(signed_rows, "vectors")
    classes = rows.where("vec_key IS NOT NULL").groupBy("vec_key").agg(
        F.count("*").alias("held"), F.min("vec_id").alias("least_id"), F.first("vec").alias("vec")
    )
    classes = written(classes, "vector-classes")
    grid = fit(classes, kind, cosine, target)
    labelled = classes.select("vec_key", "held", "least_id")
    if grid is None:
        labelled = labelled.select("*", F.lit(0).cast("long").alias("links"), F.col("vec_key").alias("component"))
    else:
        counts, edges = links(classes, grid, cosine)
        nodes = components(edges).select(F.col("node").alias("vec_key"), "component")
        labelled = labelled.join(counts, "vec_key", "left").join(nodes, "vec_key", "left")
        labelled = labelled.withColumn("component", F.coalesce("component", "vec_key"))
    labelled = written(labelled, "vector-labels")
    ids = labelled.groupBy("component").agg(F.min("least_id").alias("least"))
    of_class = lookup_join(labelled, ids, "component", "vec_key").select(
        "vec_key", (F.coalesce("links", F.lit(0)) + F.col("held") - 1).alias("n_links"), "least"
    )
    found = lookup_join(rows.select("vec_id", "vec_key"), written(of_class, "class-links"), "vec_key", "vec_id")
    least = F.coalesce("least", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        least.alias("component_id"),
        F.coalesce(least == F.col("vec_id"), least.isNull()).alias("kept"),
    )
